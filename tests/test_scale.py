"""A third of all rows on one key: same results, and plans without a window over raw rows."""

import datetime as dt
import math
import re

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from donorloom.operators import joins, scale, windows
from donorloom.operators.scale import heavy_groups, keep_first, number_rows, running_last, spread_join
from donorloom.plans import file_health, response_curve
from donorloom.sources import tables


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 gifts; donor 0 has a third of them, most on one day with one amount."""
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(3000).select(
        i.alias("gift_id"), F.when(hot, 0).otherwise(i % 40 + 1).cast("long").alias("donor_id"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), F.when(hot & (i % 6 == 0), 0).otherwise(i % 700).cast("int")).alias("gift_date"),
        F.when(hot & (i % 12 == 0), 5).otherwise(i % 17).cast("int").alias("gift_amount"))


def test_numbering_splits_hot_groups(skewed):
    order = [F.col("gift_date"), F.col("gift_amount").desc(), F.col("gift_id")]
    plain = skewed.withColumn("n", F.row_number().over(W.partitionBy("donor_id").orderBy(*order)))
    expected = {r.gift_id: r.n for r in plain.collect()}
    for limit in (1, 10, 10**6):
        got = number_rows(skewed, ["donor_id"], [F.col("gift_date"), -F.col("gift_amount"), F.shiftright("gift_id", 6)], order, "n", limit)
        assert {r.gift_id: r.n for r in got.collect()} == expected


def test_numbering_shuffles_usual_keys_once(skewed):
    """Without a heavy key the rows move once, by the key, beside the counts of the keys."""
    out = number_rows(skewed, ["donor_id"], [F.col("gift_date"), -F.col("gift_amount")], [F.col("gift_date"), -F.col("gift_amount"), F.col("gift_id")], "n")
    out.collect()
    final = plan_of(out).split("== Initial Plan ==")[0]
    assert "Final Plan" in final and "SortMergeJoin" not in final
    assert len(re.findall(r"Exchange hashpartitioning", final)) <= 2, final


def test_base_run_derives_its_transactions_once(spark, tmp_path):
    from donorloom.plans import hooks, run
    from donorloom.sources.store import Store
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(i):
        seen.add(1)
        return i
    i = F.col("id")
    trx = spark.range(0, 300, numPartitions=3).select(
        counted("id").alias("gift_id"), (i % 40).alias("donor_id"), F.date_add(F.lit(dt.date(2020, 1, 1)), i.cast("int")).alias("gift_date"),
        (i % 9).cast("decimal(12,2)").alias("gift_amount"), F.lit("mail").alias("channel"), F.lit("gift").alias("gift_type"),
        F.concat(F.lit("S"), (i % 7).cast("string")).alias("source_code"), F.concat(F.lit("C"), (i % 3).cast("string")).alias("campaign_code"),
        F.lit(None).cast("string").alias("campaign_name"))
    codes = spark.createDataFrame([("S1", "C1", "g", dt.date(2020, 1, 1), "n", "load_source_codes")],
                                  "source_code string, campaign_code string, campaign_group string, mail_date date, campaign_name string, source string")
    store = Store(spark, str(tmp_path), "ACME")
    run.build(store, hooks.Client("ACME"), trx, codes, 7)
    assert seen.value == 300
    gifts = store.read("gift")
    # Codes that only gifts know are added to the table before it is looked up, so their campaigns count as tracked.
    assert gifts.count() == 300 and gifts.filter("tracked_campaign").count() == 300
    assert store.read("source_code").filter("source = 'inferred from trx'").select("source_code").distinct().count() == 6
    assert {(r["check"], r.detail): r.fail for r in store.read(run.RESULTS).collect()}[("volume", "Record count: 300")] == 0


def test_rare_keys_are_dealt_out_before_they_are_grouped(spark):
    """No map-side table of all keys; frequent and null keys count like others."""
    from donorloom.operators import dedupe
    from donorloom.plans.campaigns import broker_report
    i = F.col("id")
    rows = spark.range(0, 900, numPartitions=6).select(
        F.when(i % 3 == 0, 0).when(i % 50 != 7, i % 500).alias("k"), F.lit(1).alias("line"), i.alias("v"))
    counts = rows.groupBy("k", "line").count().collect()
    out = dedupe.duplicate_count(rows, ["k", "line"])
    assert out.first()[0] == sum(r["count"] - 1 for r in counts)
    assert "HashAggregate" not in plan_of(dedupe.duplicate_count(rows, ["k", "line"])).split("Exchange hashpartitioning")[-1]
    twice = {r.k for r in counts if r["count"] > 1 and r.k is not None}
    assert sorted(r.v for r in dedupe.duplicate_rows(rows, ["k", "line"]).collect()) == sorted(r.v for r in rows.collect() if r.k in twice)
    gifts = rows.select(F.lit("A").alias("source_code"), F.col("k").alias("gift_id"), F.lit(5).cast("decimal(14,4)").alias("gift_amount"))
    codes = spark.createDataFrame([("A", "C", 10, 1.0, 1.0)], "source_code string, campaign_code string, quantity long, list_cpp double, package_cpp double")
    report = broker_report(gifts, codes).first()
    assert report.returns == len({r.k for r in counts} - {None}) and report.revenue == 4500.0


def test_skewed_first_and_as_of(skewed):
    first = keep_first(skewed, ["donor_id"], [F.col("gift_date"), F.col("gift_id")])
    assert first.count() == 41 and first.filter("donor_id = 0").first().gift_id == 0
    seen = running_last(skewed, ["donor_id"], F.col("gift_date"), F.when(F.col("gift_amount") == 5, F.col("gift_date")), "e")
    w = W.partitionBy("donor_id").orderBy("gift_date")
    expected = skewed.withColumn("e", F.max(F.when(F.col("gift_amount") == 5, F.col("gift_date"))).over(w))
    assert seen.select("gift_id", "e").exceptAll(expected.select("gift_id", "e")).count() == 0


def test_spread_join_pieces(spark, skewed):
    rows = skewed.withColumn("donor_id", F.when(F.col("gift_id") % 50 != 0, F.col("donor_id")))
    values = rows.groupBy("donor_id").agg(F.max("gift_amount").alias("top"), F.count(F.lit(1)).alias("n"))
    plain = rows.join(values.drop("n"), "donor_id", "left")
    for size, how in (("n", "left"), (None, "left"), ("n", "inner")):
        v = values if size else values.drop("n")
        got = spread_join(rows, v, ["donor_id"], how, size, limit=20)
        expected = plain if how == "left" else plain.filter("donor_id IS NOT NULL")
        assert got.select("gift_id", "donor_id", "top").exceptAll(expected.select("gift_id", "donor_id", "top")).count() == 0
        assert got.count() == expected.count()
    twice = values.drop("n").unionAll(values.drop("n"))
    hidden = spread_join(rows, values.withColumn("top", F.when(F.col("donor_id") > 0, F.col("top"))), ["donor_id"], size="n", limit=20)
    assert hidden.filter("donor_id = 0 AND top IS NULL").count() == rows.filter("donor_id = 0").count()
    assert spread_join(rows, twice, ["donor_id"], limit=20).count() == rows.join(twice, "donor_id", "left").count()
    assert heavy_groups(values, ["donor_id"], "n", 900).count() == 1


def test_gap_matches_row_window(skewed):
    w = W.partitionBy("donor_id").orderBy("gift_date", "gift_id")
    expected = skewed.withColumn("x", F.datediff("gift_date", F.lag("gift_date").over(w)))
    got = windows.days_since_previous(skewed, "donor_id", "gift_date", "gift_id").withColumnRenamed("days_since_previous", "x")
    assert got.select("gift_id", "x").exceptAll(expected.select("gift_id", "x")).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lifecycle_plan_shuffles_gifts_once(spark, sf):
    day = lambda t: F.lit(t).cast("date")
    plan = plan_of(file_health.lifecycle_groups(tables.gifts(spark, sf), "X", "r12", day("2000-08-01"), day("2001-07-31"), 7))
    assert "Join" not in plan and "CartesianProduct" not in plan
    # The subquery repeats the donor shuffle in the plan; it is the same exchange at run time.
    # Besides it only the years per client move, a set for each map task.
    keys = {re.sub(r"#\d+L?|, \d+.*", "", k) for k in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)}
    assert keys <= {"X, donor_id", "donor_id", "X", "client, donor_id", "client"}, keys


def test_joins_derive_their_input_once(spark, sf):
    """Exchanges in the initial plan: one aggregate and one join back need five at most."""
    from donorloom.catalog import load
    bounds = {"j01_donor_total_on_gifts": 5, "x11_cohort_flags": 25, "j05_priority_code_key": 15, "a15_broker_report": 10,
              "x01_file_health_fy": 24, "j09_gifts_in_given_periods": 25}
    for name, most in bounds.items():
        plan = plan_of(load()[name].run(spark, sf))
        found = len(re.findall(r"Exchange (?:hash|range|Single|Identity|Round)", plan)) + plan.count("BroadcastExchange")
        assert found <= most, (name, found)


def test_priority_key_derives_its_rows_once(spark, sf):
    """The mailings' joins run once, and small tables of answers come to the rows without a shuffle of them."""
    from donorloom.catalog import load
    out = load()["j05_priority_code_key"].run(spark, sf)
    plan = plan_of(out)
    assert "Exchange hashpartitioning" not in plan and "lineitem" not in plan
    assert out.count() == tables.mailings(spark, sf).count()


def test_priority_key_with_many_answers(spark, sf, monkeypatch):
    """Answers too many to be broadcast give the same keys by a join that shuffles the rows."""
    from donorloom.catalog import load
    small = load()["j05_priority_code_key"].run(spark, sf)
    monkeypatch.setattr(joins, "LOOKUP_ROWS", 0)
    large = load()["j05_priority_code_key"].run(spark, sf)
    assert "Exchange hashpartitioning" in plan_of(large)
    assert small.filter("sc_key_curated LIKE 'ACME_sc%'").count() > 0 and small.filter("sc_key_curated LIKE 'ACME_uns%'").count() > 0
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()


def test_equal_rows_of_a_hot_key_are_dealt_out(spark):
    """A third of all rows are equal; they still meet their value in many tasks."""
    rows = spark.range(0, 9000, numPartitions=30).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v"))
    values = spark.range(0, 9000).select(F.col("id").alias("k"), (F.col("id") + 1).alias("w"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = scale.spread_join(rows, values, ["k"], "left", limit=100).withColumn("p", F.spark_partition_id())
        assert out.filter("w = k + 1").count() == 9000
        assert out.filter("k = 0").select("p").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_no_cross_join_anywhere(spark, sf):
    from donorloom.catalog import load
    for name, q in load().items():
        if name.startswith(("s", "a28", "p14", "u03_standard", "u04", "q01_publish")):  # they report on what they have written
            continue
        plan = plan_of(q.run(spark, sf))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_gamma_distribution(spark):
    def reference(x, a, n=200000):
        h = x / n
        total = sum(math.exp((a - 1) * math.log((i + 0.5) * h) - (i + 0.5) * h) for i in range(n)) * h
        return total / math.gamma(a)
    for x, a in ((0.5, 1.0), (3.0, 2.5), (10.0, 4.0), (40.0, 5.0)):
        got = spark.range(1).select(response_curve.gamma_cdf(F.lit(x * 20.0 + 1), F.lit(a), F.lit(1.0), F.lit(20.0)).alias("p")).first().p
        assert got == pytest.approx(reference(x, a), abs=1e-6)
    edge = spark.range(1).select(response_curve.gamma_cdf(F.lit(0.0), F.lit(2.0), F.lit(0.0), F.lit(1.0)).alias("a"),
                                 response_curve.gamma_cdf(F.lit(9e4), F.lit(2.0), F.lit(0.0), F.lit(1.0)).alias("b")).first()
    assert edge[:] == (0.0, 1.0)


def _plain_fit(days):
    """Three parameters of greatest likelihood by plain searches with the library's bound on the start."""
    import numpy as np
    days = np.array(days, float)

    def given_start(loc):
        y = days - loc
        level = math.log(y.mean()) - np.log(y).mean()
        height = lambda a: -a * math.log(y.mean() / a) - math.lgamma(a) + (a - 1) * np.log(y).mean() - a
        lo, hi = 0.5 / level, 1 / level
        for _ in range(200):  # golden section on a concave function
            one, two = hi - (hi - lo) * 0.6180339887, lo + (hi - lo) * 0.6180339887
            lo, hi = (lo, two) if height(one) > height(two) else (one, hi)
        return height((lo + hi) / 2), (lo + hi) / 2
    starts = days.min() - np.geomspace(0.5, 8 * days.std(), 400)
    at = max(range(len(starts)), key=lambda i: given_start(starts[i])[0])
    for _ in range(3):
        starts = np.linspace(starts[max(at - 1, 0)], starts[min(at + 1, len(starts) - 1)], 60)
        at = max(range(len(starts)), key=lambda i: given_start(starts[i])[0])
    shape = given_start(starts[at])[1]
    return shape, starts[at], (days - starts[at]).mean() / shape


def test_likelihood_fit_equals_a_plain_search(spark):
    import numpy as np
    r = np.random.default_rng(11)
    made = {"late": np.floor(r.gamma(2.0, 30.0, 3000) + 10), "near": np.floor(r.gamma(4.0, 12.0, 2000)),
            "steep": np.floor(r.gamma(0.8, 40.0, 1500)), "negative": np.floor(r.gamma(1.5, 20.0, 800)) - 30}
    rows = [(c, int(v)) for c, values in made.items() for v in values]
    left_out = [("even", int(v)) for v in r.integers(0, 365, 1000)] + [("mirrored", -int(v)) for v in made["late"]]
    left_out += [("one", 3), ("same", 5), ("same", 5), ("unknown", 1), ("unknown", 9), ("unknown", None)]
    got = {x.c: x for x in response_curve.fit_likelihood(
        spark.createDataFrame(rows + left_out, "c string, days int"), "c").collect()}
    assert set(got) == set(made)
    for c, values in made.items():
        shape, loc, scale = _plain_fit(values)
        assert got[c].n == len(values)
        assert got[c]["shape"] == pytest.approx(shape, rel=2e-3), c
        assert got[c]["loc"] == pytest.approx(loc, abs=0.05), c
        assert got[c]["scale"] == pytest.approx(scale, rel=2e-3), c
    assert got["steep"]["loc"] == pytest.approx(made["steep"].min() - 0.5)
    assert got["late"]["shape"] == pytest.approx(2.0, abs=0.25) and got["late"]["scale"] == pytest.approx(30, abs=3)
    empty = spark.createDataFrame([], "c string, days int")
    assert response_curve.fit_likelihood(empty, "c").count() == 0
    with pytest.raises(ValueError):
        response_curve.fit_likelihood(empty, "c", (0.3, 80.0))


def test_gamma_derivatives(spark):
    """Differences of log_gamma, and the recurrences of both derivatives."""
    for a in (0.05, 0.3, 1.0, 4.5, 40.0):
        x = F.lit(a)
        row = spark.range(1).select(
            response_curve.digamma(x).alias("d"), response_curve.digamma(x + 1).alias("d1"),
            response_curve.trigamma(x).alias("t"), response_curve.trigamma(x + 1).alias("t1")).first()
        h = a * 1e-5
        assert row.d == pytest.approx((math.lgamma(a + h) - math.lgamma(a - h)) / (2 * h), rel=1e-5, abs=1e-6)
        assert row.d1 - row.d == pytest.approx(1 / a, rel=1e-9)
        assert row.t - row.t1 == pytest.approx(1 / (a * a), rel=1e-9)


def test_monthly_shares_add_up(spark):
    one = spark.createDataFrame([("c", dt.date(2024, 1, 15), 1000.0, 1.8, 0.0, 24.0)], "c string, m date, b double, shape double, loc double, scale double")
    flow = response_curve.cash_flow(one, "c", "m", "b")
    total = float(flow.agg(F.sum("amount")).first()[0])
    assert total == pytest.approx(1000.0, abs=0.5) and flow.count() == 12
    assert response_curve.flow_table(flow, "c", ["c"]).agg(F.sum("monthly_total")).first()[0] == flow.agg(F.sum("amount")).first()[0]


def test_percentiles_with_outliers(spark):
    """Ordered buckets stay small beside a huge value, and keep the order across signs and zero."""
    import numpy as np
    values = [float(v) for v in range(-50, 3000)] + [1e18, -1e-300, 5e-324, 2.0 ** 53]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    points = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = {r.p: r.value for r in scale.exact_quantiles(df, "v", points).collect()}
    assert [got[p] for p in points] == pytest.approx(list(np.percentile(values, [p * 100 for p in points])))
    buckets = df.select(scale._ordered_bucket(F.col("v")).alias("b"))
    assert buckets.groupBy("b").count().agg(F.max("count")).first()[0] <= 2
    ordered = [r.b for r in df.select("v", scale._ordered_bucket(F.col("v")).alias("b")).orderBy("v").collect()]
    assert ordered == sorted(ordered)
