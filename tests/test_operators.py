"""Small hand-made cases: nulls, ties, edges."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from donorloom.functions import bands, clean, codes, dates, rules
from donorloom.functions.codes import Part
from donorloom.operators import aggregates, dedupe, filters, joins, quality, setops, windows
from donorloom.operators.scale import dense_index, exact_quantiles, most_common
from donorloom.plans import campaigns, file_health, hooks, sustainers


def D(text):
    return dt.date.fromisoformat(text)


def col_values(df, *names):
    return sorted([tuple(r[n] for n in names) if len(names) > 1 else r[names[0]] for r in df.collect()], key=repr)


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


# ---- dates ----------------------------------------------------------------------------

def test_fiscal_year_edges(spark):
    df = spark.createDataFrame([(D("2020-06-30"),), (D("2020-07-01"),), (None,)], "d date")
    got = [tuple(r) for r in df.select(dates.fiscal_year(F.col("d"), 7), dates.fiscal_year(F.col("d"), 1),
                                       dates.period_year(F.col("d"), 7, "r12")).collect()]
    assert got == [(2020, 2020, 2019), (2021, 2020, 2020), (None, None, None)]
    dates.register_fiscal_from_date(spark)
    assert spark.sql("SELECT fiscal_from_date(DATE '2020-07-01', 7), fiscal_from_date(DATE '2020-07-01', 1)").first()[:] == (2021, 2020)


def test_report_windows(spark):
    def window(period, year, last, month):
        a, b = dates.report_window(period, F.lit(year), F.lit(last).cast("date"), month)
        return tuple(str(x) for x in one(spark, a.alias("a"), b.alias("b")))
    assert window("fy", 2020, "2020-09-15", 7) == ("2019-07-01", "2020-06-30")
    assert window("cy", 2020, "2020-09-15", 1) == ("2020-01-01", "2020-12-31")
    assert window("fytd", 2020, "2020-09-15", 7) == ("2020-07-01", "2020-08-31")
    assert window("fytd", 2020, "2020-03-15", 7) == ("2020-07-01", "2021-02-28")
    assert window("fytd", 2020, "2020-07-15", 7) == ("2019-07-01", "2020-06-30")
    assert window("r12", 2020, "2020-03-15", 7) == ("2020-03-01", "2021-02-28")
    assert window("cytd", 2020, "2020-03-15", 1) == ("2021-01-01", "2021-02-28")


def test_months_and_windows(spark):
    d = F.lit("2024-01-31").cast("date")
    assert one(spark, dates.days_in_following_months(d).alias("x"))[0][:3] == [0, 29, 31]
    assert [str(x) for x in one(spark, *[c.alias(str(i)) for i, c in enumerate(dates.fytd_window(d, 7) + dates.r12_window(d))])] == [
        "2023-07-01", "2024-01-31", "2023-02-01", "2024-01-31"]
    assert one(spark, dates.last_complete_day(F.lit("2024-03-30").cast("date")).alias("x"))[0] == D("2024-02-29")


# ---- values -----------------------------------------------------------------------------

def test_cleaning(spark):
    df = spark.createDataFrame([("$1,234.50",), (" - ",), ("",), ("nan",), (None,), ("12",)], "v string")
    assert [r[0] for r in df.select(clean.money(F.col("v"))).collect()] == [1234.5, 0.0, 0.0, 0.0, 0.0, 12.0]
    assert [r[0] for r in df.select(clean.budget_number(F.col("v"))).collect()][1:3] == [None, None]
    t = spark.createDataFrame([("a nan b",), ("None",), ("",), ("banana",), (None,)], "v string")
    assert [r[0] for r in t.select(clean.null_tokens(F.col("v"))).collect()] == [None, None, None, "banana", None]
    n = spark.createDataFrame([("12.0",), ("12.50",), ("x.0",), ("1.5E3",)], "v string")
    assert [r[0] for r in n.select(clean.strip_point_zero(F.col("v"))).collect()] == ["12", "12.50", "x", "1.5E3"]
    assert [r[0] for r in n.select(clean.plain_number_text(F.col("v"))).collect()] == ["12", "13", "x.0", "1500"]
    p = spark.createDataFrame([("3/4/2020 10:00",), ("2020-03-04 00:00:00",), ("soon",)], "v string")
    assert [r[0] for r in p.select(clean.two_format_date(F.col("v"))).collect()] == [D("2020-03-04"), D("2020-03-04"), None]


def test_headers(spark):
    assert clean.snake_header("GiftID#") == "gift_idnmb"
    assert clean.snake_header("CampaignName (old)") == "campaign_name_old"
    assert clean.camel_header("GIFT ID") == "GiftId" and clean.id_suffix("GiftId") == "GiftID"
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError):
        clean.rename_checked(df, {"a": "b"})
    assert clean.rename_checked(df, {"a": "c", "x": "y"}).columns == ["c", "b"]
    twice = df.toDF("k", "k").unionAll(spark.createDataFrame([(None, 5)], "k int, k2 int"))
    assert col_values(clean.merge_duplicate_names(twice), "k") == [1, 5]
    with pytest.raises(ValueError):
        clean.enforce_schema(df, {"z": "int"})
    assert clean.table_schema({"gift_key": "object", "n": "Int32", "what": "boolean"}).simpleString() == "struct<gift_key:bigint,n:int,what:string>"


def test_type_inference(spark):
    df = spark.createDataFrame([("10%", "yes", "2020-01-01", "1,200", "a"), ("5%", "no", "1/31/2021", "7", "1"),
                                (None, None, "nan", "", "b")], "p string, b string, d string, n string, t string")
    kinds = clean.infer_types(df)
    assert kinds == {"p": "percent", "b": "boolean", "d": "timestamp", "n": "double", "t": "string"}
    assert clean.apply_types(df, kinds).agg(F.sum("p"), F.sum("n"), F.count("d")).first()[:] == (pytest.approx(0.15), 1207.0, 2)


# ---- filters and dedupe ---------------------------------------------------------------------

def test_exclude_keeps_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert set(col_values(filters.in_values(df, "v", ["a"], False), "v")) == {"b", None}
    assert set(col_values(filters.contains(df, "v", ["a"], False), "v")) == {"b", None}
    assert set(col_values(filters.none_of(df, "v", ["a"]), "v")) == {"b", None}
    assert col_values(filters.whitelist(df, "v", ["None", "b"], False), "v") == ["b", None]


def test_offset_pairs(spark):
    data = [(1, "g", 10), (2, "g", -10), (3, "g", -10), (4, "h", 5), (5, "h", 5), (6, "h", -5), (7, "k", 10), (8, "m", -10),
            (9, "m", 0), (10, None, 10), (11, None, -10)]
    df = spark.createDataFrame(data, "i long, id string, a int")
    got = col_values(filters.offset_pairs(df, "id", "a", ["i"], [F.shiftright("i", 1)]), "i")
    assert sorted(got) == [3, 5, 7, 8, 9, 10, 11]


def test_dedupe_forms(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "i int, k string")
    order = [F.col("i")]
    assert col_values(dedupe.first_by(df, ["k"], order), "i") == [1, 3]
    assert col_values(dedupe.first_or_null(df, "k", order), "i") == [1, 3, 4]
    assert col_values(dedupe.first_not_null(df, "k", order), "i") == [1]
    assert col_values(dedupe.last_not_null(df, "k", order), "i") == [2]
    assert col_values(dedupe.apply_dedupe(df, "ignore_dupes", "k", order), "i") == [1, 2, 3, 4]
    assert col_values(dedupe.duplicate_rows(df, ["k"]), "i") == [1, 2]
    filled = dedupe.fill_missing_ids(df, "k", order)
    assert col_values(filled, "k") == ["_2", "_3", "a", "a"]


# ---- joins -----------------------------------------------------------------------------------

def test_priority_key(spark):
    codes_df = spark.createDataFrame([
        (1, "X", "s", "n", "c", None, "k_full"), (2, "X", "s", "n", "d", None, "k_name"), (3, "X", "s", "m", "z", None, "k_other"),
        (4, "X", "UNS", "u", "UNSOURCED-FY2020", 2020, "k_year"), (5, "X", "s", "n", "c", None, "k_duplicate")],
        "o int, client string, source_code string, campaign_name string, campaign_code string, fy int, sc_key_curated string")
    gifts = spark.createDataFrame([
        (1, "X", "s", "n", "c", 2020), (2, "X", "s", "m", "q", 2020), (3, "X", "s", "zz", None, 2020), (4, "X", "none", None, None, 2020),
        (5, "X", "none", None, None, 1999), (6, "Y", "s", "n", "c", 2020)],
        "g int, client string, source_code string, campaign_name string, campaign_code string, gift_fy int")
    out = joins.curated_code_key(gifts, codes_df, [F.col("o")])
    assert {r.g: r.sc_key_curated for r in out.collect()} == {1: "k_full", 2: "k_other", 3: "k_full", 4: "k_year", 5: None, 6: None}


def test_table_diff(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, "x", None), (3, None, 3), (5, "q", 1)], "id int, u string, v int")
    b = spark.createDataFrame([(2, "x", None), (3, "y", 3), (4, "z", 4), (5, "q", None)], "id int, u string, v int")
    got = {(r.id, r.side): (r.u, r.v) for r in joins.table_diff(a, b, "id").collect()}
    assert got == {(1, "left_only"): ("x", 1), (3, "right_changed"): ("y", None), (4, "right_only"): ("z", 4), (5, "left_changed"): (None, 1)}
    parts = joins.split_diff(joins.table_diff(a, b, "id"))
    assert {k: v.count() for k, v in parts.items()} == {"left_only": 1, "left_changed": 1, "right_only": 1, "right_changed": 1}


def test_table_diff_with_repeated_keys(spark):
    a = spark.createDataFrame([(1, "a"), (1, "b"), (2, "x"), (2, "x"), (3, "p"), (3, "q"), (None, "n")], "id int, u string")
    b = spark.createDataFrame([(1, "b"), (2, "x"), (3, "r"), (None, "n")], "id int, u string")
    got = sorted((r.id, r.side, r.u) for r in joins.table_diff(a, b, "id").collect())
    assert got[:2] == [(1, "left_only", "a"), (2, "left_only", "x")]
    assert [g[1] for g in got[2:]] == ["left_changed", "left_only", "right_changed"] and {g[2] for g in got[2:]} == {"p", "q", "r"}


def test_outer_and_missing(spark):
    gifts = spark.createDataFrame([(1, "a", None), (2, "b", "L2"), (3, None, None)], "g int, code string, list string")
    sc = spark.createDataFrame([("a", "L1"), ("c", "L3")], "code string, list string")
    out = joins.outer_with_codes(gifts, sc, "code")
    assert col_values(out, "g", "code", "list") == sorted([(1, "a", "L1"), (2, "b", "L2"), (3, None, None), (None, "c", "L3")], key=repr)
    assert col_values(joins.missing_codes(gifts, sc, "code"), "g") == [2, 3]


# ---- sequences ---------------------------------------------------------------------------------

def test_streaks(spark):
    given = {2018, 2019, 2021, 2022, 2024}
    df = spark.createDataFrame([(1, y, int(y in given)) for y in range(2018, 2026)], "d int, yr int, gave int")
    got = {r.yr: (r.streak_start, r.first_year_in_streak, r.last_years_streak) for r in windows.streaks(df, ["d"], "yr", "gave").collect()}
    assert got[2018] == (2018, 2018, None) and got[2019] == (None, 2018, 2018) and got[2020] == (None, None, 2018)
    assert got[2021] == (2021, 2021, None) and got[2022][1] == 2021 and got[2025] == (None, None, 2024)


def test_first_values_with_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, 1, D("2020-01-01"), 5, None), (1, 2, D("2020-01-01"), 9, "b"), (1, 3, D("2021-01-01"), 99, "c"),
                                (2, 4, D("2020-01-01"), 7, None), (2, 5, D("2022-01-01"), 8, "z")], "d int, i int, t date, a int, v string")
    order = windows.first_gift_order("t", "a", "i")
    assert col_values(windows.first_attributes(df, "d", order, {"x": "v", "i": "i"}), "d", "i", "x") == [(1, 2, "b"), (2, 4, None)]


def test_lifecycle_labels(spark):
    years = {1: [2024], 2: [2023], 3: [2022, 2023, 2024], 4: [2020, 2024], 5: [2020, 2023, 2024], 6: [2021], 7: [2015, 2016, 2022, 2023]}
    rows = [(d, D(f"{y}-03-01"), 10) for d, ys in years.items() for y in ys] + [(8, D("2024-05-01"), 0), (8, D("2017-05-01"), -5)]
    gifts = spark.createDataFrame(rows, "donor_id int, gift_date date, gift_amount int")
    out = file_health.lifecycle_groups(gifts, "X", "cy", F.lit("2024-01-01").cast("date"), F.lit("2024-12-31").cast("date"), 1)
    got = {r.donor_id: (r.fh_group, r.fh_group_detail, r.donor_subtype, r.past_2_years) for r in out.filter("yr = 2024").collect()}
    assert got == {
        1: ("New", "New", "Pipeline", 0), 2: ("New Last Year", "New Last Year", "2nd Year", 0),
        3: ("Consecutive Giver", "Consecutive Giver2", "Consecutive Giver", 1), 4: ("Reacquired", "Reacquired4", "Pipeline", 0),
        5: ("Reacquired Last Year", "Reacquired Last Year3", "2nd Year", 1), 6: ("Reacquired", "Reacquired3", "Pipeline", 0),
        7: ("Consecutive Giver", "Consecutive Giver2", "Consecutive Giver", 0)}


def test_year_list_functions(spark):
    y = F.array(*[F.lit(v) for v in (2015, 2018, 2019, 2020, 2022)])
    run = lambda t: one(spark, file_health.run_length(y, F.lit(t)).alias("x"))[0]
    gap = lambda t: one(spark, file_health.reinstated_gap(y, F.lit(t)).alias("x"))[0]
    assert [run(t) for t in (2021, 2020, 2023, 2022, 2019)] == [3, 2, None, None, None]
    assert [gap(t) for t in (2023, 2021, 2022, 2019)] == [2, None, None, 3]
    label = lambda t: one(spark, file_health.capped_detail(y, F.lit(t)).alias("x"))[0]
    assert [label(t) for t in (2015, 2016, 2018, 2019, 2021, 2022, 2023, 2040)] == [
        "New", "New Last Year", "Lapsed 25-36", "Reinstated Last Year 25-36", "Consecutive Giver 3 Yrs", "Lapsed 13-24",
        "Reinstated Last Year 13-24", "Lapsed 85+"]


def test_sustainer_status(spark):
    newest = D("2024-06-10")
    months = {1: "2024-05-03", 2: "2024-04-30", 3: "2023-12-01", 4: "2023-11-15", 5: "2023-06-01", 6: "2023-05-31", 7: "2024-06-05"}
    rows = [(d, D(t), True) for d, t in months.items()] + [(8, newest, False)]
    gifts = spark.createDataFrame(rows, "donor_id int, gift_date date, r boolean")
    got = {r.donor_id: r.sustainer_status for r in sustainers.sustainer_status(gifts, F.col("r")).collect()}
    assert got == {1: "Active", 2: "Lapsing- Short", 3: "Lapsing- Short", 4: "Lapsing-Long", 5: "Lapsing-Long", 6: "Lapsed", 7: "N/A", 8: "N/A"}


def test_memberships_restart(spark):
    rows = [(1, 1, "2020-01-01", True), (1, 2, "2020-03-01", True), (1, 3, "2020-12-01", False), (1, 4, "2021-02-01", True), (1, 5, "2019-01-01", False)]
    gifts = spark.createDataFrame([(d, i, D(t), 1, r) for d, i, t, r in rows], "donor_id int, gift_id int, gift_date date, gift_amount int, r boolean")
    got = {r.gift_id: (str(r.membership_start), r.sustainer_status, r.sustainer_type) for r in sustainers.memberships(gifts, F.col("r"), 1).collect()}
    assert got == {1: ("2020-01-01", "Active", "Converted"), 2: ("2020-01-01", "Active", "Converted"),
                   3: ("2020-01-01", "Lapsed", "Converted"), 4: ("2021-02-01", "Active", "Converted")}


def test_upgrade_labels(spark):
    rows = [(1, "2020-01-01", 10), (1, "2021-01-01", 20), (1, "2022-01-01", 5), (1, "2024-01-01", 5), (2, "2023-01-01", 1), (2, "2024-01-01", 1)]
    gifts = spark.createDataFrame([(d, D(t), a) for d, t, a in rows], "donor_id int, gift_date date, gift_amount int")
    got = {(r.donor_id, r.yr): r.upgrade_downgrade for r in sustainers.upgrade_downgrade(gifts, 1).collect()}
    assert got == {(1, 2020): "NoPreviousYearGiving", (1, 2021): "Upgrade", (1, 2022): "Downgrade", (1, 2023): "NoCurrentYearGiving",
                   (1, 2024): "NoPreviousYearGiving", (2, 2023): "NoPreviousYearGiving", (2, 2024): "Same"}


# ---- codes and bands ------------------------------------------------------------------------------

def test_positional_decode(spark):
    layout = {"a": Part(1, {"X": "ex"}), "b": Part((2, 4)), "c": Part(9), "d": Part(None)}
    df = spark.createDataFrame([("XYZ1",), ("Q",), (None,)], "code string")
    assert [tuple(r)[1:] for r in codes.decode(df, "code", layout).collect()] == [("ex", "YZ1", None, None), ("Q", "", None, None), (None,) * 4]


def test_year_switched_decode(spark):
    df = spark.createDataFrame([("AB", D("2022-12-31"), "c"), ("AB", D("2023-01-01"), "c"), ("AB", None, "c"), ("AB", D("2023-05-01"), "QQ1")],
                               "code string, d date, camp string")
    out = codes.decode_by_year(df, "code", {2022: {"x": Part(1)}, 2023: {"x": Part(2)}}, "d", untouched=F.col("camp").startswith("QQ"))
    assert [r.x for r in out.collect()] == ["A", "B", "A", None]


def test_bands(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (4.99,), (5.0,), (9999.99,), (10000.0,), (1e8,), (None,)], "a double")
    assert [r[0] for r in df.select(bands.gift_level(F.col("a"))).collect()] == [
        "A: 0-4.99", "A: 0-4.99", "A: 0-4.99", "B: 5-9.99", "M: 5000-9999.99", "N: 10000+", "No GiftLevelID", "No GiftLevelID"]
    assert [r[0] for r in df.select(bands.interval_label(F.col("a"), [(1, 5, "x"), (5, 6, "y")], "both")).collect()][1:4] == ["x", "x", "x"]


def test_rules_and_registry(spark):
    df = spark.createDataFrame([("DMSOL",), (None,)], "appeal_id string")
    assert [r.channel for r in hooks.PARSE.apply(df, ["channel_from_appeal"]).collect()] == ["Solicitation", "Other"]
    first = rules.classify([(F.col("appeal_id").contains("DM"), "a"), (F.col("appeal_id").contains("SOL"), "b")], "z")
    assert [r[0] for r in df.select(first).collect()] == ["a", "z"]
    assert hooks.FEATURES.apply(df, ["nothing"]).columns == ["appeal_id"]


# ---- aggregates and sets ---------------------------------------------------------------------------

def test_mode_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, None), (3, "z"), (3, "z"), (3, "a")], "k int, v string")
    assert col_values(most_common(df, ["k"], "v", "m"), "k", "m") == [(1, "a"), (3, "z")]


def test_quantiles(spark):
    import numpy as np
    values = [5.0] * 400 + [float(i) ** 1.5 for i in range(801)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    points = [0.0, 0.1, 0.333, 0.5, 0.9, 0.995, 1.0]
    got = {r.p: r.value for r in exact_quantiles(df, "v", points).collect()}
    for p in points:
        assert got[p] == pytest.approx(float(np.quantile(values, p)), rel=1e-9)
    tail = [float(i) / 100 for i in range(2000)] + [1e9]
    got = {r.p: r.value for r in exact_quantiles(spark.createDataFrame([(v,) for v in tail], "v double"), "v", points).collect()}
    for p in points:
        assert got[p] == pytest.approx(float(np.quantile(tail, p)), rel=1e-9)
    same = exact_quantiles(spark.createDataFrame([(3.0,)] * 5, "v double"), "v", [0.5])
    assert same.first().value == 3.0


def test_dense_index(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x")).repartition(5)
    got = dense_index(df, [F.col("x")], "n").collect()
    assert all(r.x == r.n for r in got) and len(got) == 1000


def test_window_replace(spark):
    schema = "id int, d date"
    master = spark.createDataFrame([(1, D("2020-01-01")), (2, D("2020-02-01")), (3, D("2020-03-01"))], schema)
    batch = spark.createDataFrame([(9, D("2020-01-15")), (8, D("2020-02-15"))], schema)
    once = setops.replace_window(master, batch, "d")
    assert col_values(once, "id") == [1, 3, 8, 9]
    assert col_values(setops.replace_window(once, batch, "d"), "id") == [1, 3, 8, 9]
    assert col_values(setops.replace_window(master.limit(0), batch, "d"), "id") == [8, 9]


def test_column_profile_and_compare(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (2, "a")], "x int, y string")
    assert col_values(aggregates.column_profile(df), "column", "unique", "null", "not_null", "total") == [("x", 2, 0, 3, 3), ("y", 1, 1, 2, 3)]
    assert col_values(setops.symmetric_difference(df.select("x"), df.select(F.lit(2).alias("x")), "x"), "x") == [1]


def test_hash_sample_is_stable(spark):
    df = spark.range(4000).select(F.col("id").cast("string").alias("g"), F.col("id").alias("d"), (F.lit(2015) + F.col("id") % 10).cast("int").alias("fy"))
    once = setops.hash_sample(df, "g", "d", "fy")
    twice = setops.hash_sample(once.drop("is_synthetic"), "g", "d", "fy")
    assert col_values(once, "g") == col_values(twice, "g")
    rate = once.filter("is_synthetic AND fy = 2024").count() / 400
    assert 0.1 < rate < 0.35


def test_quality(spark):
    trx = spark.createDataFrame([("g", None, D("2020-01-01"))], "gift_id string, donor_id string, gift_date date")
    results = quality.transaction_checks(trx, "X")
    assert quality.failures(results).first()[:] == (1, 1)
    fixed = results.withColumn("fail", F.lit(0).cast("long"))
    assert quality.failures(quality.upsert_results(results, fixed)).first()[:] == (0, 0)
    assert quality.private_columns_left(trx, ["donor_id", "email"]) == ["donor_id"]
    assert one(spark, quality.month_passed(F.lit("2024-01-31").cast("date"), F.lit("2024-03-01").cast("date")).alias("x"))[0] is True


def test_campaign_rules(spark):
    df = spark.createDataFrame([("AH23X",), ("AG24X",), ("ZZ23",)], "c string")
    assert col_values(campaigns.select_campaigns(df, "c", starts=["AH", "AG"], years=["23"], year_position=2), "c") == ["AH23X"]


# ---- properties on random small data --------------------------------------------------------------

@pytest.mark.parametrize("seed", range(3))
def test_streaks_equal_self_join(spark, seed):
    rng = random.Random(seed)
    rows = [(d, y, int(rng.random() < 0.5)) for d in range(20) for y in range(2010, 2025)]
    df = spark.createDataFrame(rows, "d int, yr int, gave int")
    out = windows.streaks(df, ["d"], "yr", "gave").collect()
    gave = {(d, y): g for d, y, g in rows}
    starts = {(d, y) for d, y, g in rows if g and not gave.get((d, y - 1), 0)}
    for r in out:
        mine = [y for (d, y) in starts if d == r.d and y <= r.yr]
        assert r.first_year_in_streak == (max(mine) if r.gave else None)


@pytest.mark.parametrize("seed", range(3))
def test_offset_pairs_leave_one_sign(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice("ab"), rng.choice([5, -5, 7, -7, 0])) for i in range(200)]
    out = filters.offset_pairs(spark.createDataFrame(rows, "i long, k string, a int"), "k", "a", ["i"], [F.shiftright("i", 4)]).collect()
    removed = {r[0] for r in rows} - {r.i for r in out}
    assert sum(a for i, _, a in rows if i in removed) == 0
    for key in "ab":
        for size in (5, 7):
            signs = {r.a > 0 for r in out if r.k == key and abs(r.a) == size}
            assert len(signs) <= 1


@pytest.mark.parametrize("seed", range(2))
def test_priority_key_keeps_rows(spark, seed):
    rng = random.Random(seed)
    pick = lambda: (rng.choice(["A", "B"]), rng.choice(["s", "t", None]), rng.choice(["n", "m", None]), rng.choice(["c", None]))
    sc = spark.createDataFrame([(i, *pick(), rng.choice([2020, None]), f"k{i}") for i in range(15)],
                               "o int, client string, source_code string, campaign_name string, campaign_code string, fy int, sc_key_curated string")
    gifts = spark.createDataFrame([(i, *pick(), 2020) for i in range(120)],
                                  "g int, client string, source_code string, campaign_name string, campaign_code string, gift_fy int")
    out = joins.curated_code_key(gifts, sc, [F.col("o")])
    assert col_values(out, "g") == sorted(range(120), key=repr)


def test_rule_table_and_batch(spark):
    df = spark.createDataFrame([("7.0", None), ("8", "x vc y"), ("8", None), ("nan", "VC")], "outlet string, segment string")
    rules = [("One", [("outlet", "in", ["7"])]), ("Two", [("outlet", "in", ["8"]), ("segment", "has", ["VC"])]), ("Three", [("outlet", "in", ["8"])])]
    assert [r.p for r in hooks.by_table(df, "p", rules, "Other").collect()] == ["One", "Two", "Three", "Other"]
    known = spark.createDataFrame([("AB", "a", "s", "p", "1")], "code string, appeal_id string, segment_code string, package_id string, n string")
    batch = spark.createDataFrame([(" AB ", "a", "s", "p", "2"), ("TOOLONG", "a", "s", "p", "3")], known.schema)
    good, bad = codes.validate_batch(known, batch, "code", {"n": F.col("n").cast("int")}, {"code": "A"}, length=2)
    assert col_values(good, "code", "n") == [("AB", 2), ("ASP", 3)] and bad.count() == 0


def test_nothing_lost_to_missing_values(spark):
    from donorloom.operators.windows import gift_numbers
    from donorloom.operators.scale import number_rows
    from donorloom.plans import base_tables

    df = spark.createDataFrame([(1, "a", "2020-01-01", 5.0), (2, "a", "2020-01-01", None), (3, "a", "2020-01-01", 3.0), (4, "a", None, 9.0),
                                (5, None, "2020-01-01", 1.0), (6, None, None, 1.0)], "g int, d string, t string, a double")
    want = {1: 2, 2: 4, 3: 3, 4: 1, 5: 2, 6: 1}
    assert {r.g: r.donor_gift_number for r in gift_numbers(df, "d", "t", "a", "g").collect()} == want
    buckets = [F.col("t"), F.struct(F.col("a").isNull(), -F.col("a")), F.col("g")]
    for limit in (1, 10, 10 ** 6):
        got = number_rows(df, ["d"], buckets, [F.col("t"), F.col("a").desc(), F.col("g")], "n", limit)
        assert {r.g: r.n for r in got.collect()} == want, limit

    codes = spark.createDataFrame([("A", "c", "g")], "source_code string, campaign_code string, campaign_group string")
    gifts = spark.createDataFrame([("", None, "n", "2020-01-02"), (None, None, None, "2020-01-03"), ("NONE", "c", None, "2020-01-04"), ("B", None, None, "2020-01-05"),
                                   ("A", None, None, "2020-01-06")], "source_code string, campaign_code string, campaign_name string, gift_date string")
    out = base_tables.inferred_codes(gifts.withColumn("gift_date", F.col("gift_date").cast("date")), codes, "Acme", 7)
    assert sorted(((r.source_code, r.campaign_code, r.campaign_name) for r in out.collect()), key=repr) == [
        ("B", None, None), (None, "c", None), (None, None, "n"), (None, None, None)]


def test_offset_rule_by_name(spark):
    df = spark.createDataFrame([(1, "x", 5.0), (2, "x", -5.0), (3, "x", 5.0)], "at int, g string, a double")
    assert [r["at"] for r in filters.suppress(df, [("offset_pairs", "g", ["a", "at"], True)]).collect()] == [3]
    with pytest.warns(UserWarning):
        filters.suppress(df, [("no_such_rule", "g", [], True)])


def test_client_hooks_refuse_unknown_names(spark):
    from donorloom.plans.hooks import Client
    c = Client("X", {"donors": [lambda d, g: d.join(g, "id")]}, switches=frozenset({"skip_gift_qa"}))
    assert c.apply("donors", spark.range(3), spark.range(1, 9)).count() == 2 and c.apply("filters", spark.range(3)).count() == 3
    assert c.has("skip_gift_qa") and not c.has("skip_trx_qa")
    for make in (lambda: Client("X", {"donor": []}), lambda: Client("X", switches=frozenset({"skip"})), lambda: c.apply("gone", None)):
        with pytest.raises(ValueError):
            make()


# ---- periods given as rows ----------------------------------------------------------------

def day_rows(rng, n):
    return [(i, D("2020-01-01") + dt.timedelta(days=rng.choice([rng.randrange(900), 40])) if rng.random() > 0.05 else None, rng.choice("ab")) for i in range(n)]


def period_rows(rng, n):
    out = []
    for y in range(n):
        start = D("2019-11-01") + dt.timedelta(days=rng.randrange(900))
        out.append((rng.choice("ab"), y, None if rng.random() < 0.2 else start, None if rng.random() < 0.2 else start + dt.timedelta(days=rng.randrange(-20, 500))))
    return out


def test_interval_join(spark):
    rng = random.Random(11)
    rows, periods = day_rows(rng, 400), period_rows(rng, 25)
    r = spark.createDataFrame(rows, "id int, day date, client string")
    p = spark.createDataFrame(periods, "client string, yr int, s date, e date")
    holds = lambda day, s, e: day is not None and (s is None or day >= s) and (e is None or day <= e)
    want = sorted((i, y) for i, day, c in rows for k, y, s, e in periods if c == k and holds(day, s, e))
    got = joins.interval_join(r, "day", p, "s", "e", ["client"])
    assert col_values(got, "id", "yr") == sorted(want, key=repr)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    every = joins.interval_join(r.drop("client"), "day", p.drop("client"), "s", "e")
    assert col_values(every, "id", "yr") == sorted([(i, y) for i, day, _ in rows for _, y, s, e in periods if holds(day, s, e)], key=repr)
    assert joins.interval_join(r.limit(0), "day", p, "s", "e", ["client"]).count() == 0
    assert joins.interval_join(r, "day", p.limit(0), "s", "e", ["client"]).count() == 0


def test_lifecycle_of_given_periods(spark):
    periods = spark.createDataFrame([
        ("A", 1, None, D("2019-12-31")), ("A", 2, D("2019-12-01"), D("2020-12-31")), ("A", 3, D("2021-03-01"), D("2021-12-31")), ("A", 4, D("2022-01-01"), None),
        ("B", 1, None, None)], "client string, yr int, start_date date, end_date date")
    gifts = spark.createDataFrame([
        ("A", 7, D("2019-12-15"), 5.0), ("A", 7, D("2022-02-01"), 5.0), ("A", 8, D("2021-01-15"), 5.0), ("A", 9, D("2021-05-01"), 5.0), ("A", 9, D("2030-01-01"), 5.0),
        ("A", 10, D("2021-05-01"), 0.0), ("B", 7, D("2021-05-01"), 5.0), ("C", 7, D("2021-05-01"), 5.0)], "client string, donor_id int, gift_date date, gift_amount double")
    got = file_health.lifecycle_by_period(gifts, periods, "rows")
    assert col_values(got, "client", "donor_id", "yr", "fh_group_detail") == sorted([
        ("A", 7, 1, "New"), ("A", 7, 2, "New Last Year"), ("A", 7, 3, "Consecutive Giver2"), ("A", 7, 4, "Reacquired2"),
        ("A", 9, 3, "New"), ("A", 9, 4, "New Last Year"), ("B", 7, 1, "New")], key=repr)
    assert {r.report_period for r in got.filter("client = 'A' AND yr = 4").collect()} == {"01/01/2022 - open"}


def test_priority_key_takes_the_best_form(spark):
    rng = random.Random(12)
    value = lambda *v: rng.choice([None, *v])
    codes_ = [(i, rng.choice("xy"), value("c1", "c2", " c1 "), value("n1", "n2"), value("p1", "UNSOURCED-FY20"), value("2020", "2021"), value(f"k{i}", f"k{i}")) for i in range(60)]
    gifts = [(i, rng.choice("xyz"), value("c1", "c2", "c3"), value("n1", "n2", "n3"), value("p1", "p2"), value(2020, 2021)) for i in range(200)]
    dim = spark.createDataFrame(codes_, "i int, client string, source_code string, campaign_name string, campaign_code string, fy string, sc_key_curated string")
    rows = spark.createDataFrame(gifts, "id int, client string, source_code string, campaign_name string, campaign_code string, gift_fy int")
    text = lambda v: "" if v is None else str(v).strip()

    def best(g):
        _, client, code, name, camp, fy = [text(v) for v in g]
        known = [[text(v) for v in c[:6]] + [c[6]] for c in codes_ if c[6] is not None]
        forms = [lambda c: c[1:5] == [client, code, name, camp], lambda c: c[1:4] == [client, code, name], lambda c: c[1:3] == [client, code],
                 lambda c: c[4].startswith("UNSOURCED-FY") and (c[1], c[5]) == (client, fy)]
        for form in forms:
            if found := [c for c in known if form(c)]:
                return min(found, key=lambda c: int(c[0]))[6]

    got = joins.curated_code_key(rows, dim, [F.col("i")])
    assert col_values(got, "id", "sc_key_curated") == sorted([(g[0], best(g)) for g in gifts], key=repr)
    assert got.columns == [*rows.columns, "sc_key_curated"]


def test_clusters_follow_lloyd_from_the_ranked_start(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(80, 3)) + c for c in ([0, 0, 0], [6, 0, 1], [0, 7, 3], [9, 9, 9])])
    rows = [(i, *map(float, v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    total = z.sum(1)
    edges = [np.percentile(total, 100 * i / 5) for i in range(1, 5)]
    label = (total[:, None] > np.array(edges)[None]).sum(1)
    centres = np.array([z[label == k].mean(0) for k in range(5)])
    for _ in range(20):
        label = ((z[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        centres = np.array([z[label == k].mean(0) if (label == k).any() else centres[k] for k in range(5)])
    for parts in (1, 7):  # partitions do not matter
        got, found = aggregates.donor_clusters(df.repartition(parts), ["a", "b", "c"], 5)
        assert [r.cluster for r in got.orderBy("id").collect()] == label.tolist()
        assert np.allclose([list(r)[1:] for r in found.orderBy("cluster").collect()], centres)
    with pytest.raises(ValueError):
        aggregates.donor_clusters(spark.createDataFrame([(1, None)], "id int, a double"), ["a"], 2)


def test_table_diff_against_plain_rows(spark):
    rng = random.Random(13)
    for trial in range(3):
        side = lambda n: [(rng.choice([None, *range(40)]), rng.choice(["x", "y", None]), rng.randrange(3)) for _ in range(n)]
        common = side(60) if trial else [(i, "x", 1) for i in range(300)]
        left, right = common + side(15 if trial else 2), common + side(15 if trial else 0)
        frame = lambda rows: spark.createDataFrame(rows, "k int, t string, n int").repartition(3)
        out = joins.table_diff(frame(left), frame(right), "k").collect()
        spare = lambda a, b: {r: a.count(r) - b.count(r) for r in set(a) if a.count(r) > b.count(r)}
        only_left, only_right = spare(left, right), spare(right, left)
        n_left, n_right = {}, {}
        for counts, into in ((only_left, n_left), (only_right, n_right)):
            for r, n in counts.items():
                into[r[0]] = into.get(r[0], 0) + n
        want = {}
        for k in {*n_left, *n_right}:
            a, b = n_left.get(k, 0), n_right.get(k, 0)
            want[k] = (a - min(a, b), b - min(a, b), min(a, b))
        for k, (l_only, r_only, pairs) in want.items():
            got = [r.side for r in out if r.k == k]
            # A side that is blank altogether says nothing, so there may be fewer rows than pairs.
            assert got.count("left_only") <= l_only and got.count("right_only") <= r_only and len(got) <= l_only + r_only + 2 * pairs
            assert not pairs or got.count("left_changed") + got.count("right_changed") >= pairs
        assert {r.k for r in out} <= set(want)
        assert joins.table_diff(frame(common), frame(list(reversed(common))), "k").count() == 0
