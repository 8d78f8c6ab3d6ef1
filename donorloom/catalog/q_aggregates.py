"""Donor, campaign and table aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from donorloom.catalog.base import START, newest_year, query, scratch, with_views
from donorloom.catalog.q_dates import band_sql
from donorloom.functions.bands import MONETARY
from donorloom.functions.dates import fiscal_year
from donorloom.operators import aggregates as agg
from donorloom.operators.scale import exact_quantiles, most_common
from donorloom.plans import campaigns, profiles
from donorloom.sources import tables
from donorloom.sources.store import Store

LEVEL_SQL = band_sql("greatest(floor({amount}), 1)", MONETARY, "No GiftLevelID")


@query("a01_a04_donor_profile", with_views("gift") + """
SELECT donor_id, CAST(min(gift_date) AS VARCHAR) AS first_gift_date, CAST(max(gift_date) AS VARCHAR) AS last_gift_date, count(*) AS gifts,
  CAST(min(gift_amount) AS DOUBLE) AS min_gift_amount, CAST(max(gift_amount) AS DOUBLE) AS max_gift_amount,
  CAST(sum(gift_amount) AS DOUBLE) / count(*) AS donor_average_gift,
  CAST(min(CASE WHEN gift_amount >= 400000 THEN gift_date END) AS VARCHAR) AS min_major_gift_date,
  CAST(max(CASE WHEN gift_amount >= 400000 THEN gift_date END) AS VARCHAR) AS max_major_gift_date,
  (date_diff('day', min(gift_date), max(gift_date)) + 1) / 365.0::DOUBLE AS lifespan,
  (date_diff('day', min(gift_date), max(gift_date)) + 1) >= 730 AS core_donor FROM gift GROUP BY donor_id""")
def a01(spark, d):
    out = agg.donor_profile(tables.gifts(spark, d), "donor_id", "gift_date", "gift_amount", 400000)
    return out.drop("major_gift_definition")


@query("a05_giving_history", with_views("mail") + """
SELECT donor_id, count(*) AS rows, count(DISTINCT gift_id) AS gift_ids, CASE WHEN count(*) > 1 THEN 'Multi' ELSE 'Single' END AS donor_group,
  CASE WHEN count(DISTINCT gift_id) > 1 THEN 'Multi' ELSE 'Single' END AS gift_history FROM mail GROUP BY donor_id""")
def a05(spark, d):
    return agg.giving_history(tables.mailings(spark, d), "donor_id", "gift_id")


@query("a06_channel_behavior", with_views("gift") + """
SELECT donor_id, gift_fy AS yr, count(DISTINCT channel) AS channels, CASE WHEN count(DISTINCT channel) > 1 THEN 'Multi' ELSE min(channel) END AS behavior FROM gift GROUP BY 1, 2""")
def a06(spark, d):
    g = tables.gifts(spark, d).withColumn("key", F.struct("donor_id", fiscal_year(F.col("gift_date"), START).alias("yr")))
    return agg.channel_behavior(g, "key", "channel", "Multi", None).select("key.donor_id", "key.yr", "channels", "behavior")


@query("a07_channel_set_label", with_views("gift", more="""
s AS (SELECT donor_id, string_agg(DISTINCT gift_type, ',' ORDER BY gift_type) AS channels FROM gift GROUP BY 1)""") + """
SELECT donor_id, channels, CASE channels WHEN 'F' THEN 'F Only' WHEN 'O' THEN 'O Only' WHEN 'F,O' THEN 'F Only' ELSE 'Multi' END AS channel_group FROM s""")
def a07(spark, d):
    return agg.channel_set_label(tables.gifts(spark, d), "donor_id", "gift_type", {"F": "F Only", "O": "O Only", "F,O": "F Only"})


@query("a08_value_sets", with_views("gift") + """
SELECT donor_id, string_agg(DISTINCT CAST(gift_fy AS VARCHAR), ',' ORDER BY CAST(gift_fy AS VARCHAR)) AS years FROM gift GROUP BY 1""")
def a08(spark, d):
    g = tables.gifts(spark, d).withColumn("yr", fiscal_year(F.col("gift_date"), START).cast("string"))
    return agg.value_set(g, ["donor_id"], "yr", "years").withColumn("years", F.array_join("years", ","))


@query("a09_mode", with_views("mail", more="""
n AS (SELECT donor_id, campaign_code, count(*) AS n FROM mail WHERE line > 1 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY donor_id ORDER BY n DESC, campaign_code) AS k FROM n)""") + """
SELECT donor_id, campaign_code AS favourite FROM r WHERE k = 1""")
def a09(spark, d):
    m = tables.mailings(spark, d).withColumn("campaign_code", F.when(F.col("line") > 1, F.col("campaign_code")))
    return most_common(m, ["donor_id"], "campaign_code", "favourite")


@query("a10_merge_quantities", with_views("code") + """
SELECT source_code, sum(quantity)::BIGINT AS quantity, arg_min(campaign_name, part_id) AS campaign_name, min(part_id) AS part_id FROM code GROUP BY 1""")
def a10(spark, d):
    p = tables.parts(spark, d).select("source_code", "quantity", "campaign_name", "part_id")
    return agg.merge_quantities(p, "source_code", "quantity", [F.col("part_id")])


@query("a11_mail_counts", with_views("mail") + """
SELECT source_code, count(DISTINCT donor_id) AS quantity, CAST(max(mail_date) AS VARCHAR) AS mail_date FROM mail GROUP BY 1""")
def a11(spark, d):
    return agg.mail_counts(tables.mailings(spark, d), "source_code", "donor_id", "mail_date")


@query("a12_decouple_costs", with_views("code", more="""
l AS (SELECT *, CASE WHEN part_id % 5 <> 0 THEN CAST(part_id % 90 AS DECIMAL(12,2)) END AS list_cpp FROM code),
t AS (SELECT package_name, sum(coalesce(quantity * list_cpp, 0)) AS lst, sum(quantity * package_cpp) AS pkg, sum(quantity) AS n FROM l GROUP BY 1)""") + """
SELECT part_id, floor(CAST(pkg - lst AS DOUBLE) / CAST(n AS DOUBLE) * 100 + 0.5) / 100 AS package_cpp FROM l JOIN t USING (package_name)""")
def a12(spark, d):
    p = tables.parts(spark, d).withColumn("list_cpp", F.when(F.col("part_id") % 5 != 0, (F.col("part_id") % 90).cast("decimal(12,2)")))
    return agg.decouple_costs(p).select("part_id", "package_cpp")


@query("a15_broker_report", with_views("mail", more="""
s AS (SELECT source_code, min(campaign_code) AS campaign_code, sum(quantity) AS quantity, max(package_cpp) AS package_cpp,
  CAST(min(part_id) % 7 AS DECIMAL(12,2)) AS list_cpp FROM code WHERE quantity <= 44 GROUP BY 1),
g AS (SELECT source_code, """ + LEVEL_SQL.format(amount="revenue / 10.0") + """ AS gift_level, gift_id, revenue FROM mail),
a AS (SELECT source_code, gift_level, count(DISTINCT gift_id) AS returns, sum(CAST(revenue / 10.0 AS DECIMAL(14,4))) AS revenue FROM g GROUP BY 1, 2),
n AS (SELECT source_code, count(*) AS levels FROM a GROUP BY 1),
j AS (SELECT coalesce(s.source_code, a.source_code) AS source_code, coalesce(campaign_code, substr(coalesce(s.source_code, a.source_code), 1, 8)) AS campaign_code, gift_level, coalesce(returns, 0) AS returns,
  coalesce(CAST(revenue AS DOUBLE), 0) AS revenue, CAST(list_cpp AS DOUBLE) AS lc, CAST(package_cpp AS DOUBLE) AS pc, CAST(quantity AS DOUBLE) / coalesce(levels, 1) AS share
  FROM s FULL JOIN a ON s.source_code = a.source_code LEFT JOIN n ON n.source_code = s.source_code),
c AS (SELECT *, coalesce(lc * share, 0) AS list_cost, coalesce(pc * share, 0) AS package_cost FROM j)""") + """
SELECT source_code, campaign_code, gift_level, returns, revenue, share, list_cost, package_cost, revenue - list_cost - package_cost AS net,
  CASE WHEN returns > 0 THEN (revenue - list_cost - package_cost) / returns WHEN revenue - list_cost - package_cost < 0 THEN 0 END AS net_per_response FROM c""")
def a15(spark, d):
    codes = tables.parts(spark, d).filter("quantity <= 44").groupBy("source_code").agg(
        F.min("campaign_code").alias("campaign_code"), F.sum("quantity").alias("quantity"), F.max("package_cpp").alias("package_cpp"),
        (F.min("part_id") % 7).cast("decimal(12,2)").alias("list_cpp"))
    gifts = tables.mailings(spark, d).select(
        "source_code", "gift_id", (F.col("revenue") / 10).cast("decimal(14,4)").alias("gift_amount"))
    return campaigns.broker_report(gifts, codes).select(
        "source_code", "campaign_code", "gift_level", "returns", "revenue", "share", "list_cost", "package_cost", "net", "net_per_response")


@query("a16_revenue_by_category", with_views("mail") + """
SELECT campaign_code, package_name, CAST(sum(revenue) AS DOUBLE) AS revenue FROM mail GROUP BY 1, 2""")
def a16(spark, d):
    return agg.revenue_by(tables.mailings(spark, d), ["campaign_code", "package_name"], "revenue")


@query("a17_fiscal_year_summary", with_views("gift") + """
SELECT gift_fy, count(DISTINCT donor_id) AS donors, count(*) AS gifts, CAST(sum(gift_amount) AS DOUBLE) AS revenue, CAST(max(gift_amount) AS DOUBLE) AS top FROM gift GROUP BY 1""")
def a17(spark, d):
    return tables.gifts(spark, d).groupBy(fiscal_year(F.col("gift_date"), START).alias("gift_fy")).agg(
        F.count_distinct("donor_id").alias("donors"), F.count(F.lit(1)).alias("gifts"), F.sum("gift_amount").alias("revenue"), F.max("gift_amount").alias("top"))


@query("a18_frequency_pivot", with_views("gift", "mail").rstrip() + """
, f AS (SELECT donor_id, least(count(*), 20) AS n FROM gift GROUP BY 1), t AS (SELECT donor_id, CASE WHEN count(*) < 30 THEN 'few' WHEN count(*) < 60 THEN 'some' ELSE 'many' END AS mailed FROM mail GROUP BY 1)
SELECT n AS frequency, nullif(count(*) FILTER (mailed = 'few'), 0) AS few, nullif(count(*) FILTER (mailed = 'some'), 0) AS some, nullif(count(*) FILTER (mailed = 'many'), 0) AS many
FROM f JOIN t USING (donor_id) GROUP BY 1""")
def a18(spark, d):
    f = tables.gifts(spark, d).groupBy("donor_id").agg(F.least(F.count(F.lit(1)), F.lit(20)).alias("frequency"))
    n = F.count(F.lit(1))
    t = tables.mailings(spark, d).groupBy("donor_id").agg(F.when(n < 30, "few").when(n < 60, "some").otherwise("many").alias("mailed"))
    return agg.pivot_counts(f.join(t, "donor_id"), "frequency", "mailed", ["few", "some", "many"], F.nullif(n, F.lit(0)))


@query("a19_membership_label", with_views("gift") + """
SELECT donor_id, CASE WHEN bool_and(gift_type = 'F') THEN 'Membership Only' WHEN NOT bool_or(gift_type = 'F') THEN 'Non-Membership Only' ELSE 'Member/Non-Member' END AS donor_group FROM gift GROUP BY 1""")
def a19(spark, d):
    return agg.membership_label(tables.gifts(spark, d), "donor_id", F.col("gift_type") == "F")


POINTS = [0.05, 0.25, 0.5, 0.75, 0.9, 0.96, 0.99, 0.999, 1.0]


@query("a20_percentile_profile", with_views("gift", more="t AS (SELECT CAST(sum(gift_amount) AS DOUBLE) AS v FROM gift GROUP BY donor_id)") + " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS p, round(quantile_cont(v, {p}), 4) AS value FROM t" for p in POINTS))
def a20(spark, d):
    t = tables.gifts(spark, d).groupBy("donor_id").agg(F.sum("gift_amount").alias("v"))
    return exact_quantiles(t, "v", POINTS).withColumn("value", F.round("value", 4))


PROFILE = ["gift_id", "donor_id", "gift_date", "gift_amount", "channel", "gift_type"]
NUMBERS = ["gift_id", "donor_id", "gift_amount"]


@query("a21_column_profile", with_views("gift", more="h AS (SELECT gift_id, donor_id, gift_date, gift_amount, CASE WHEN gift_type <> 'P' THEN channel END AS channel, gift_type FROM gift)") + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS "unique", count(*) - count({c}) AS "null", count(DISTINCT {c}) + count(*) - count({c}) AS unique_plus_null,
  count({c}) AS not_null, count(*) AS total FROM h""" for c in PROFILE))
def a21(spark, d):
    g = tables.gifts(spark, d).withColumn("channel", F.when(F.col("gift_type") != "P", F.col("channel")))
    return agg.column_profile(g.select(*PROFILE))


def stored_sketches(spark, d):
    """Sketches of the gifts by fiscal year, written once; the newest year's are renewed as a delivery would."""
    g = tables.gifts(spark, d).withColumns({"year": fiscal_year(F.col("gift_date"), START), "channel": F.when(F.col("gift_type") != "P", F.col("channel"))})
    newest = newest_year(spark, d)
    s = Store(spark, scratch(spark), "ACME")
    s.overwrite(profiles.sketch_rows(g, "year", PROFILE), "profile", partition=["year"])
    s.replace_partition(profiles.sketch_rows(g.filter(F.col("year") == newest), "year", PROFILE), "profile", "year")
    return g, s.read("profile"), newest


@query("a20_a21_profile_from_sketches", with_views("gift", more="h AS (SELECT gift_id, donor_id, gift_date, gift_amount, CASE WHEN gift_type <> 'P' THEN channel END AS channel, gift_type FROM gift)") + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS total, count({c}) AS filled, count(*) - count({c}) AS "null", {"CAST(min({0}) AS DOUBLE) AS low, CAST(max({0}) AS DOUBLE)".format(c) if c in NUMBERS else "NULL AS low, NULL"} AS high,
  true AS distinct_within, {"true" if c in NUMBERS else "NULL"} AS quantiles_within FROM h""" for c in PROFILE))
def a21b(spark, d):
    # The estimates are held against exact counts: of different values, and of the values below each quantile.
    g, sketches, _ = stored_sketches(spark, d)
    found = profiles.profile(sketches, POINTS)
    exact = agg.column_profile(g.select(*PROFILE)).select("column", F.col("unique").alias("exact"))
    numbers = g.select([F.col(c).cast("double").alias(c) for c in NUMBERS]).unpivot([], NUMBERS, "column", "v")
    values = numbers.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    below = values.join(found.select("column", F.posexplode("quantiles").alias("i", "q")), "column").groupBy("column", "i").agg(
        F.sum(F.when(F.col("v") < F.col("q"), F.col("n")).otherwise(0)).alias("lt"), F.sum(F.when(F.col("v") <= F.col("q"), F.col("n")).otherwise(0)).alias("le"), F.sum("n").alias("n"))
    point = F.element_at(F.array(*[F.lit(p) for p in POINTS]), F.col("i") + 1)
    good = below.groupBy("column").agg(F.bool_and((F.col("lt") / F.col("n") <= point + 2 * profiles.RANK_BOUND) & (F.col("le") / F.col("n") >= point - 2 * profiles.RANK_BOUND)).alias("quantiles_within"))
    near = F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(profiles.DISTINCT_BOUND * F.col("exact"), F.lit(1))
    return found.join(exact, "column").join(good, "column", "left").select("column", "total", "filled", "null", "low", "high", near.alias("distinct_within"), "quantiles_within")


@query("a22_profile_change", with_views("gift", more="h AS (SELECT *, gift_fy < (SELECT max(gift_fy) FROM gift) AS old FROM (SELECT * REPLACE (CASE WHEN gift_type <> 'P' THEN channel END AS channel) FROM gift))") + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER (old) AS total_before, count(*) AS total_now, count({c}) FILTER (old) AS filled_before, count({c}) AS filled_now, {"true" if c in NUMBERS else "NULL"} AS alike FROM h""" for c in PROFILE))
def a22c(spark, d):
    # The version without the newest fiscal year against the whole; a fourteenth of the rows cannot move a distribution far.
    _, sketches, newest = stored_sketches(spark, d)
    return profiles.change(sketches.filter(F.col("year") < newest), sketches).select(
        "column", "total_before", "total_now", "filled_before", "filled_now", (F.col("shift") < 0.2).alias("alike"))


@query("a22_non_null_counts", with_views("gift", more="h AS (SELECT gift_id, CASE WHEN gift_type <> 'P' THEN channel END AS channel FROM gift)") + """
SELECT 'gift_id' AS "column", count(gift_id) AS filled FROM h UNION ALL SELECT 'channel', count(channel) FROM h""")
def a22(spark, d):
    return agg.non_null_counts(tables.gifts(spark, d).select("gift_id", F.when(F.col("gift_type") != "P", F.col("channel")).alias("channel")))


@query("a22_rows_by_year", with_views("gift") + 'SELECT year(gift_date) AS "year", count(*) AS gifts FROM gift GROUP BY 1')
def a22b(spark, d):
    return agg.rows_by_year(tables.gifts(spark, d), "gift_date")


@query("a23_distinct_values", with_views("gift", "event").rstrip() + "\nSELECT 'orders' AS client, gift_type FROM gift UNION SELECT 'events', gift_type FROM event")
def a23(spark, d):
    one = lambda df, name: df.select(F.lit(name).alias("client"), "gift_type").distinct()
    return one(tables.gifts(spark, d), "orders").unionAll(one(tables.recurring(spark, d), "events"))


@query("a24_weekly_joins", with_views("mail", more="""
f AS (SELECT donor_id, campaign_code, min(mail_date) AS d FROM mail GROUP BY 1, 2), y AS (SELECT max(year(d)) - min(year(d)) AS n FROM f)""") + """
SELECT weekofyear(d) AS week, CAST(floor(count(*) / any_value(n)) AS BIGINT) AS average, count(*) FILTER (year(d) = 1997) AS in_year FROM f, y GROUP BY 1""")
def a24(spark, d):
    first = tables.mailings(spark, d).groupBy("donor_id", "campaign_code").agg(F.min("mail_date").alias("d"))
    return agg.weekly_joins(first, "d", 1997)


@query("a25_max_over_rest", with_views("code") + """
SELECT campaign_code, CASE WHEN quantity > 25 THEN package_name END AS package_name, max(CAST(package_cpp AS DOUBLE)) AS package_cpp FROM code GROUP BY 1, 2""")
def a25(spark, d):
    p = tables.parts(spark, d).select("campaign_code", F.when(F.col("quantity") > 25, F.col("package_name")).alias("package_name"), "package_cpp")
    return agg.max_over_rest(p, "package_cpp")


@query("a26_watermarks", with_views("gift", "mail").rstrip() + """
SELECT 'gift' AS stage, CAST(max(gift_date) AS VARCHAR) AS max_date FROM gift UNION ALL SELECT 'mail', CAST(max(mail_date) AS VARCHAR) FROM mail""")
def a26(spark, d):
    return tables.gifts(spark, d).agg(F.max("gift_date").alias("max_date")).withColumn("stage", F.lit("gift")).unionByName(
        tables.mailings(spark, d).agg(F.max("mail_date").alias("max_date")).withColumn("stage", F.lit("mail")))


@query("a27_giving_before_mailing", with_views("gift", "mail").rstrip() + """
, p AS (SELECT DISTINCT donor_id, mail_date FROM mail),
j AS (SELECT p.donor_id, p.mail_date, g.gift_date, g.gift_amount, g.gift_id FROM p LEFT JOIN gift g ON g.donor_id = p.donor_id AND g.gift_date < p.mail_date)
SELECT donor_id, CAST(mail_date AS VARCHAR) AS mail_date,
  CAST(coalesce(sum(CASE WHEN gift_date >= CAST(mail_date - INTERVAL 1 YEAR AS DATE) THEN gift_amount END), 0) AS DOUBLE) AS cume12,
  count(gift_id) AS count_before, CAST(coalesce(max(gift_amount), 0) AS DOUBLE) AS highest,
  CAST(coalesce(arg_max(gift_amount, (gift_date, gift_id)), 0) AS DOUBLE) AS latest_amount,
  CAST(floor(date_diff('day', max(gift_date), mail_date) / 30.436875::DOUBLE + 0.5) AS BIGINT) AS months_since FROM j GROUP BY donor_id, mail_date""")
def a27(spark, d):
    return agg.giving_before(tables.mailings(spark, d), tables.gifts(spark, d), "donor_id", "mail_date", "gift_date", "gift_amount", "gift_id")


@query("a29_correlations", with_views("gift", more="""
r AS (SELECT CAST(date_diff('day', max(gift_date), DATE '2001-09-01') AS DOUBLE) AS recency, CAST(count(*) AS DOUBLE) AS frequency, CAST(max(gift_amount) AS DOUBLE) AS monetary FROM gift GROUP BY donor_id)""") + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) + 0.0 AS r FROM r" for a in ("recency", "frequency", "monetary") for b in ("recency", "frequency", "monetary")))
def a29(spark, d):
    r = agg.rfm(tables.gifts(spark, d), "donor_id", "gift_id", "gift_date", "gift_amount", F.lit("2001-09-01").cast("date"))
    r = r.select(*[F.col(c).cast("double").alias(c) for c in ("recency", "frequency", "monetary")])
    return agg.correlations(r, r.columns).withColumn("r", F.round("r", 8))


@query("a28_donor_clusters", with_views("gift", "mail").rstrip() + """
, newest AS (SELECT max(gift_fy) AS fy FROM gift),
y AS (SELECT donor_id FROM gift, newest WHERE gift_fy = fy GROUP BY 1),
m AS (SELECT DISTINCT donor_id FROM mail, newest WHERE year(mail_date) + CASE WHEN month(mail_date) >= 7 THEN 1 ELSE 0 END = fy)
SELECT count(*) AS donors, least(10, count(*)) AS clusters, CAST(0 AS BIGINT) AS misplaced FROM y JOIN m USING (donor_id)""")
def a28(spark, d):
    """Donors clustered, clusters with donors, and donors that another centre is nearer to."""
    m = campaigns.frequent_donors(tables.gifts(spark, d), tables.mailings(spark, d), F.lit("2001-09-01").cast("date"), newest_year(spark, d), START, 1e9)
    columns = ["recency", "frequency", "monetary", "year_revenue", "times_mailed"]
    m = m.select("donor_id", *[F.col(c).cast("double").alias(c) for c in columns])
    rows, centres = agg.donor_clusters(m, columns)
    z = [f"_z{i}" for i in range(len(columns))]
    listed = centres.agg(F.collect_list(F.struct(F.col("cluster"), F.array(*z).alias("c")))).scalar()
    square = lambda c: F.aggregate(F.zip_with(F.array(*z), c["c"], lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    rows = rows.withColumn("centres", listed).withColumn("squares", F.transform("centres", lambda c: F.struct(square(c).alias("d"), c["cluster"].alias("k"))))
    own = F.filter("squares", lambda x: x["k"] == F.col("cluster"))[0]["d"]
    return rows.agg(F.count(F.lit(1)).alias("donors"), F.count_distinct("cluster").alias("clusters"),
                    F.count_if(own > F.array_min("squares")["d"] * (1 + 1e-12)).alias("misplaced"))


@query("a30_non_giver_shares", with_views("gift", "mail").rstrip() + """
, g AS (SELECT donor_id, max(CASE WHEN gift_fy = (SELECT max(gift_fy) FROM gift) THEN 1 ELSE 0 END) AS gave, date_diff('day', max(gift_date), DATE '2001-09-01') AS recency, count(DISTINCT gift_id) AS n, max(gift_amount) AS top FROM gift GROUP BY 1),
m AS (SELECT DISTINCT donor_id FROM mail),
b AS (SELECT m.donor_id IS NOT NULL AS mailed, coalesce(gave, 0) AS gave, recency > 1000 AND n = 1 AND top < 100 AS rule FROM g FULL JOIN m USING (donor_id))
SELECT count(*) FILTER (mailed) AS mailed, count(*) FILTER (mailed AND gave = 0) AS silent, count(*) FILTER (rule) AS matching, count(*) AS people,
  count(*) FILTER (mailed AND gave = 0) / count(*) FILTER (mailed) AS silent_share, count(*) FILTER (rule) / count(*) AS matching_share FROM b""")
def a30(spark, d):
    return campaigns.non_giver_shares(tables.gifts(spark, d), tables.mailings(spark, d), newest_year(spark, d), START, F.lit("2001-09-01").cast("date"))


@query("a31_online_mix", with_views("gift", more="""
c AS (SELECT donor_id, count(*) FILTER (gift_type = 'F' AND gift_date < DATE '1997-01-01') AS web, count(*) FILTER (gift_type <> 'F') AS dm FROM gift GROUP BY 1)""") + """
SELECT donor_id, CASE WHEN web > 0 AND dm > 0 THEN 'Multi-Channel' WHEN dm > 0 THEN 'DM Only' WHEN web > 0 THEN 'Online Only' ELSE 'Other Giving' END AS channel_behavior FROM c""")
def a31(spark, d):
    g = tables.gifts(spark, d).withColumn(
        "program", F.when(F.col("gift_type") == "F", "Online").otherwise("Mail"))
    return agg.online_mix(g, "donor_id", "program", F.col("gift_date") < F.lit("1997-01-01").cast("date"))


@query("b06_rfm", with_views("gift") + """
SELECT donor_id, date_diff('day', max(gift_date), DATE '2001-09-01') AS recency, count(DISTINCT gift_id) AS frequency, CAST(max(gift_amount) AS DOUBLE) AS monetary FROM gift GROUP BY 1""")
def b06(spark, d):
    return agg.rfm(tables.gifts(spark, d), "donor_id", "gift_id", "gift_date", "gift_amount", F.lit("2001-09-01").cast("date"))
