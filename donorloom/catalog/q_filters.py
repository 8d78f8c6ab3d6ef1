"""Suppressions and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from donorloom.catalog.base import query, with_views
from donorloom.functions import rules
from donorloom.functions.clean import money
from donorloom.operators import dedupe, filters
from donorloom.sources import tables

# Gifts with holes: a null channel for one gift type, to show what excludes do with nulls.
HOLES = "hole AS (SELECT gift_id, donor_id, gift_date, gift_amount, gift_type, CASE WHEN gift_type <> 'P' THEN channel END AS channel FROM gift)"
PIECE = ["gift_id", "line", "part_id", "list_id", "quantity", "revenue", "mail_date"]
PIECE_SQL = "gift_id, line, part_id, list_id, quantity, CAST(revenue AS DOUBLE) AS revenue, CAST(mail_date AS VARCHAR) AS mail_date"


def holes(spark, d):
    return tables.gifts(spark, d).withColumn("channel", F.when(F.col("gift_type") != "P", F.col("channel")))


def piece_order():
    return [F.col(c) for c in ("part_id", "list_id", "quantity", "revenue", "mail_date")]


def tagged(name, df):
    return df.select(F.lit(name).alias("rule"), "gift_id")


@query("f01_f06_include_exclude", with_views("gift", more=HOLES) + """
SELECT 'isin in' AS rule, gift_id FROM hole WHERE channel IN ('1-URGENT', '2-HIGH')
UNION ALL SELECT 'isin out', gift_id FROM hole WHERE NOT coalesce(channel IN ('1-URGENT', '2-HIGH'), false)
UNION ALL SELECT 'contains in', gift_id FROM hole WHERE regexp_matches(channel, 'URG|LOW')
UNION ALL SELECT 'contains out', gift_id FROM hole WHERE NOT coalesce(regexp_matches(channel, 'URG|LOW'), false)
UNION ALL SELECT 'isin_or out', gift_id FROM hole WHERE NOT (coalesce(channel IN ('5-LOW'), false) OR gift_type IN ('O'))
UNION ALL SELECT 'whitelist', gift_id FROM hole WHERE coalesce(channel, 'None') IN ('5-LOW', 'None')
UNION ALL SELECT 'greater out', gift_id FROM hole WHERE NOT gift_amount > 250000
UNION ALL SELECT 'starts in', gift_id FROM hole WHERE regexp_matches(channel, '^(1|3-M)')
UNION ALL SELECT 'starts out', gift_id FROM hole WHERE NOT coalesce(regexp_matches(channel, '^(1|3-M)'), false)""")
def f01(spark, d):
    g = holes(spark, d)
    parts = [
        ("isin in", filters.in_values(g, "channel", ["1-URGENT", "2-HIGH"])),
        ("isin out", filters.in_values(g, "channel", ["1-URGENT", "2-HIGH"], False)),
        ("contains in", filters.contains(g, "channel", ["URG", "LOW"])),
        ("contains out", filters.contains(g, "channel", ["URG", "LOW"], False)),
        ("isin_or out", filters.in_any(g, "channel", {"channel": ["5-LOW"], "gift_type": ["O"]}, False)),
        ("whitelist", filters.whitelist(g, "channel", ["5-LOW", "None"], False)),
        ("greater out", filters.greater_than(g, "gift_amount", [250000], False)),
        ("starts in", filters.starts_with(g, "channel", ["1", "3-M"])),
        ("starts out", filters.starts_with(g, "channel", ["1", "3-M"], False)),
    ]
    out = tagged(*parts[0])
    for p in parts[1:]:
        out = out.unionAll(tagged(*p))
    return out


@query("f07_offset_pairs", with_views("event", more="""
e AS (SELECT gift_id, donor_id, floor(gift_amount / 50) * CASE WHEN gift_type IN ('error', 'view') THEN -1 ELSE 1 END AS amount, gift_date FROM event),
r AS (SELECT *, row_number() OVER (PARTITION BY donor_id, amount ORDER BY gift_id) AS n FROM e),
p AS (SELECT donor_id, abs(amount) AS size, least(count(*) FILTER (amount > 0), count(*) FILTER (amount < 0)) AS pairs FROM e GROUP BY 1, 2)""") + """
SELECT r.gift_id, r.donor_id, CAST(r.amount AS BIGINT) AS amount FROM r JOIN p ON p.donor_id = r.donor_id AND p.size = abs(r.amount)
WHERE r.amount = 0 OR r.n > p.pairs""")
def f07(spark, d):
    sign = F.when(F.col("gift_type").isin("error", "view"), -1).otherwise(1)
    e = tables.recurring(spark, d).withColumn("amount", (F.floor(F.col("gift_amount") / 50) * sign).cast("long"))
    e = e.select("gift_id", "donor_id", "amount")
    # Event ids rise in row order, so blocks of ids are neighbours in the numbering.
    return filters.offset_pairs(e, "donor_id", "amount", ["gift_id"], [F.shiftright("gift_id", 20)])


@query("f08_suppression_pipeline", with_views("gift", more=HOLES) + """
SELECT gift_id FROM hole WHERE NOT coalesce(channel IN ('5-LOW'), false) AND NOT coalesce(regexp_matches(channel, 'MED'), false)
  AND gift_type IN ('F', 'P') AND NOT gift_amount > 400000""")
def f08(spark, d):
    return filters.suppress(holes(spark, d), [
        ("isin", "channel", ["5-LOW"], False), ("contains", "channel", ["MED"], False),
        ("isin", "gift_type", ["F", "P"], True), ("greater_than", "gift_amount", [400000], False),
        ("offset_pairs", "gift_id", ["gift_amount", "gift_date"], True), ("no_such_rule", "channel", [], True)]).select("gift_id")


@query("f09_drop_future", with_views("gift") + """
SELECT 'date' AS kind, gift_id FROM gift WHERE gift_date <= DATE '2000-01-01'
UNION ALL SELECT 'number', gift_id FROM gift WHERE CAST(strftime(gift_date, '%Y%m%d') AS INTEGER) <= 20000101""")
def f09(spark, d):
    now = F.lit("2000-01-01").cast("date")
    g = tables.gifts(spark, d).withColumn("ymd", F.date_format("gift_date", "yyyyMMdd").cast("int"))
    return filters.drop_future(g, "gift_date", now).select(F.lit("date").alias("kind"), "gift_id").unionAll(
        filters.drop_future(g, "ymd", now).select(F.lit("number"), "gift_id"))


@query("f10_usable_gifts", with_views("raw") + """
SELECT k AS gift_id, donor_id, gift_amount FROM raw WHERE donor_id <> 'nan' AND gift_amount <> 0""")
def f10(spark, d):
    raw = tables.raw_gifts(spark, d).select(
        F.regexp_replace("Gift ID", r"\.0$", "").cast("long").alias("gift_id"),
        F.when(F.col("Donor ID") != "nan", F.col("Donor ID")).alias("donor_id"), F.col("Gift Date").alias("gift_date"),
        money(F.col("Gift Amount")).alias("gift_amount"))
    return filters.usable_gifts(raw, "donor_id", "gift_date", "gift_amount").select("gift_id", "donor_id", "gift_amount")


@query("f11_none_of", with_views("gift", more=HOLES) + """
SELECT gift_id FROM hole WHERE coalesce(channel, '') NOT IN ('5-LOW', '2-HIGH')""")
def f11(spark, d):
    return filters.none_of(holes(spark, d), "channel", ["5-LOW", "2-HIGH"]).select("gift_id")


@query("f12_text_predicates", with_views("code") + """
SELECT part_id, campaign_name LIKE '%ring%' OR campaign_name LIKE '%red%' AS keyword, substr(source_code, 2, 1) = '1' AS char_at,
  substr(package_name, 1, 1) IN ('S', 'L') AS first_char, length(source_code) = 8 AS has_length,
  CASE WHEN length(source_code) = 8 AND substr(source_code, 3, 1) = '2' THEN 'yes' ELSE 'no' END AS position FROM code""")
def f12(spark, d):
    code, name = F.col("source_code"), F.col("campaign_name")
    return tables.parts(spark, d).select(
        "part_id", rules.keyword_in(name, ["ring", "red"]).alias("keyword"), rules.char_at(code, 1, "1").alias("char_at"),
        rules.first_char_in(F.col("package_name"), ["S", "L"]).alias("first_char"), rules.has_length(code, 8).alias("has_length"),
        rules.position_label(code, 2, "2", "yes", "no", 8).alias("position"))


@query("f13_keep_first", with_views("mail", more="""
r AS (SELECT *, row_number() OVER (PARTITION BY gift_id, line ORDER BY part_id, list_id, quantity, revenue, mail_date) AS n FROM mail)""") + f"""
SELECT {PIECE_SQL} FROM r WHERE n = 1""")
def f13(spark, d):
    m = tables.mailings(spark, d).select(*PIECE)
    return dedupe.first_by(m, ["gift_id", "line"], piece_order())


@query("f13_first_or_null", with_views("mail", more="""
k AS (SELECT *, CASE WHEN line < 6 THEN gift_id * 10 + line END AS key FROM mail),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY part_id, list_id, quantity, revenue, mail_date) AS n FROM k)""") + f"""
SELECT key, {PIECE_SQL} FROM r WHERE key IS NULL OR n = 1""")
def f13b(spark, d):
    m = tables.mailings(spark, d).select(
        F.when(F.col("line") < 6, F.col("gift_id") * 10 + F.col("line")).alias("key"), *PIECE)
    return dedupe.first_or_null(m, "key", piece_order())


@query("f14_keep_last_without_nulls", with_views("mail", more="""
k AS (SELECT *, CASE WHEN line < 6 THEN gift_id * 10 + line END AS key FROM mail),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY part_id DESC, list_id DESC, quantity DESC, revenue DESC, mail_date DESC) AS n FROM k)""") + f"""
SELECT key, {PIECE_SQL} FROM r WHERE key IS NOT NULL AND n = 1""")
def f14(spark, d):
    m = tables.mailings(spark, d).select(
        F.when(F.col("line") < 6, F.col("gift_id") * 10 + F.col("line")).alias("key"), *PIECE)
    return dedupe.apply_dedupe(m, "dedupe_keep_last", "key", piece_order())


@query("f14_distinct_except_audit", with_views("mail") + """
SELECT donor_id, campaign_code, package_name, min(line) AS row_added_at FROM mail GROUP BY 1, 2, 3""")
def f14b(spark, d):
    m = tables.mailings(spark, d).select("donor_id", "campaign_code", "package_name", F.col("line").alias("row_added_at"))
    return dedupe.distinct_except_audit(m, [F.col("row_added_at")])


@query("f15_business_key", with_views("mail", more="""
r AS (SELECT *, row_number() OVER (PARTITION BY donor_id, quantity, mail_date ORDER BY gift_id DESC, line DESC, part_id DESC, list_id DESC, revenue DESC) AS n FROM mail)""") + f"""
SELECT donor_id, {PIECE_SQL} FROM r WHERE n = 1""")
def f15(spark, d):
    m = tables.mailings(spark, d).select("donor_id", *PIECE)
    return dedupe.last_by_business_key(m, ["donor_id", "quantity", "mail_date"], [
        F.col(c) for c in ("gift_id", "line", "part_id", "list_id", "revenue")])


@query("f15_newest_by_id", with_views("mail", more="""
r AS (SELECT *, row_number() OVER (PARTITION BY gift_id ORDER BY mail_date DESC, line DESC, part_id DESC, list_id DESC, quantity DESC, revenue DESC) AS n FROM mail)""") + f"""
SELECT {PIECE_SQL} FROM r WHERE n = 1""")
def f15b(spark, d):
    return dedupe.newest_by_id(tables.mailings(spark, d).select(*PIECE), "gift_id", "mail_date", [
        "line", "part_id", "list_id", "quantity", "revenue"])


@query("f16_dedupe_after_cutoff", with_views("mail", more="""
r AS (SELECT *, row_number() OVER (PARTITION BY gift_id, line ORDER BY part_id DESC, list_id DESC, quantity DESC, revenue DESC, mail_date DESC) AS n FROM mail WHERE mail_date >= DATE '1999-07-01')""") + f"""
SELECT {PIECE_SQL} FROM r WHERE n = 1 UNION ALL SELECT {PIECE_SQL} FROM mail WHERE mail_date < DATE '1999-07-01'""")
def f16(spark, d):
    m = tables.mailings(spark, d).select(*PIECE)
    return dedupe.last_after(m, F.col("mail_date") >= F.lit("1999-07-01").cast("date"), ["gift_id", "line"], piece_order())


@query("f17_fill_missing_ids", with_views("gift", more="""
h AS (SELECT CASE WHEN gift_type <> 'P' THEN gift_id END AS gift_id, donor_id, gift_date, gift_amount FROM gift),
n AS (SELECT *, row_number() OVER (ORDER BY gift_date, donor_id, gift_amount, gift_id) - 1 AS pos FROM (SELECT DISTINCT * FROM h))""") + """
SELECT coalesce(CAST(gift_id AS VARCHAR), '_' || pos) AS gift_id, donor_id, CAST(gift_date AS VARCHAR) AS gift_date, CAST(gift_amount AS DOUBLE) AS gift_amount FROM n""")
def f17(spark, d):
    h = tables.gifts(spark, d).select(F.when(F.col("gift_type") != "P", F.col("gift_id")).alias("gift_id"),
                                      "donor_id", "gift_date", "gift_amount")
    order = [F.col("gift_date"), F.col("donor_id"), F.col("gift_amount"), F.col("gift_id").asc_nulls_last()]
    return dedupe.fill_missing_ids(h, "gift_id", order)


@query("f18_duplicate_rows", with_views("mail", more="k AS (SELECT gift_id, line FROM mail GROUP BY 1, 2 HAVING count(*) > 1)") + f"""
SELECT {PIECE_SQL} FROM mail JOIN k USING (gift_id, line)""")
def f18(spark, d):
    return dedupe.duplicate_rows(tables.mailings(spark, d).select(*PIECE), ["gift_id", "line"])


@query("f18_duplicate_count", "SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates FROM lineitem")
def f18b(spark, d):
    return dedupe.duplicate_count(tables.mailings(spark, d), ["gift_id", "line"])


@query("f20_outliers", with_views("gift", "person").rstrip() + """
SELECT gift_id FROM gift JOIN person USING (donor_id) WHERE NOT gift_amount > 300000 AND program <> 'MACHINERY'""")
def f20(spark, d):
    g = tables.gifts(spark, d).join(tables.people(spark, d), "donor_id")
    return filters.below_outlier(g, "gift_amount", 300000, F.col("program") == "MACHINERY").select("gift_id")


@query("f21_keyword_suppression", with_views("code", more="""
c AS (SELECT part_id, upper(lpad(CAST(quantity AS VARCHAR), 2, '0') || campaign_name) AS appeal FROM code)""") + """
SELECT part_id, appeal FROM c WHERE NOT regexp_matches(appeal, 'RING|BOLT') AND appeal NOT IN ('10RED WIDGET')
  AND NOT regexp_matches(appeal, '^(2|31)') AND regexp_matches(appeal, '^[0-9]{2}')""")
def f21(spark, d):
    c = tables.parts(spark, d).select("part_id", F.concat(F.lpad(F.col("quantity").cast("string"), 2, "0"), "campaign_name").alias("appeal"))
    return filters.keyword_suppression(c, "appeal", ["RING", "BOLT"], ["10RED WIDGET"], ["2", "31"])


@query("f12_month_from", with_views("gift") + "SELECT gift_id, month(gift_date) >= 10 AS late FROM gift")
def f12b(spark, d):
    return tables.gifts(spark, d).select("gift_id", rules.month_from(F.col("gift_date"), 10).alias("late"))
