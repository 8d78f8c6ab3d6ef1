"""Sequences per donor, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from donorloom.catalog.base import START, query, with_views
from donorloom.functions.dates import fiscal_year
from donorloom.operators import setops, windows
from donorloom.operators.scale import rising
from donorloom.sources import tables

def first():
    return windows.first_gift_order("gift_date", "gift_amount", "gift_id")


@query("w01_donor_gift_number", with_views("gift") + """
SELECT gift_id, donor_id, row_number() OVER (PARTITION BY donor_id ORDER BY gift_date, gift_amount DESC, gift_id) AS donor_gift_number
FROM gift""")
def w01(spark, d):
    return windows.gift_numbers(tables.gifts(spark, d), "donor_id", "gift_date", "gift_amount", "gift_id").select(
        "gift_id", "donor_id", "donor_gift_number")


@query("w02_join_attributes", with_views("gift", more="""
ranked AS (SELECT *, row_number() OVER (PARTITION BY donor_id ORDER BY gift_date, gift_amount DESC, gift_id) AS n FROM gift)""") + """
SELECT donor_id, gift_id AS join_gift_id, CAST(gift_date AS VARCHAR) AS first_gift_date,
  CAST(gift_amount AS DOUBLE) AS join_gift_amount, channel AS join_channel, gift_type AS join_gift_type FROM ranked WHERE n = 1""")
def w02(spark, d):
    return windows.first_attributes(tables.gifts(spark, d), "donor_id", first(), {
        "join_gift_id": "gift_id", "first_gift_date": "gift_date", "join_gift_amount": "gift_amount",
        "join_channel": "channel", "join_gift_type": "gift_type"})


@query("w03_join_channel_on_gifts", with_views("gift") + """
SELECT gift_id, first_value(channel) OVER w AS join_channel, first_value(gift_type) OVER w AS join_type
FROM gift WINDOW w AS (PARTITION BY donor_id ORDER BY gift_date, gift_amount DESC, gift_id)""")
def w03(spark, d):
    return windows.with_join_values(tables.gifts(spark, d), "donor_id", first(), {
        "join_channel": "channel", "join_type": "gift_type"}).select("gift_id", "join_channel", "join_type")


@query("w04_last_gift_attributes", with_views("gift", more="""
ranked AS (SELECT *, row_number() OVER (PARTITION BY donor_id ORDER BY gift_date DESC, gift_amount DESC, gift_id DESC) AS n FROM gift)""") + """
SELECT donor_id, channel AS channel_last_gift, gift_type AS type_last_gift FROM ranked WHERE n = 1""")
def w04(spark, d):
    order = [*rising("gift_date", "gift_amount"), F.col("gift_id")]
    return windows.last_attributes(tables.gifts(spark, d), "donor_id", order, {
        "channel_last_gift": "channel", "type_last_gift": "gift_type"})


@query("w05_w07_giving_streaks", with_views("gift", more="""
given AS (SELECT DISTINCT donor_id, gift_fy AS yr FROM gift),
years AS (SELECT DISTINCT yr FROM given),
firsts AS (SELECT donor_id, min(yr) AS lo FROM given GROUP BY 1),
grid AS (SELECT f.donor_id, y.yr, CASE WHEN g.yr IS NULL THEN 0 ELSE 1 END AS gave FROM firsts f JOIN years y ON y.yr >= f.lo
  LEFT JOIN given g ON g.donor_id = f.donor_id AND g.yr = y.yr),
marked AS (SELECT *, CASE WHEN gave = 1 AND coalesce(lag(gave) OVER (PARTITION BY donor_id ORDER BY yr), 0) = 0 THEN yr END AS st FROM grid),
run AS (SELECT a.donor_id, a.yr, a.gave, a.st, max(CASE WHEN a.gave = 1 THEN b.st END) AS first_year_in_streak
  FROM marked a LEFT JOIN marked b ON a.donor_id = b.donor_id AND b.st IS NOT NULL AND a.yr >= b.st GROUP BY 1, 2, 3, 4)""") + """
SELECT donor_id, yr, gave, st AS streak_start, first_year_in_streak,
  lag(first_year_in_streak) OVER (PARTITION BY donor_id ORDER BY yr) AS last_years_streak FROM run""")
def w05(spark, d):
    given = tables.gifts(spark, d).select("donor_id", fiscal_year(F.col("gift_date"), START).alias("yr")).distinct()
    # The list of years is as short as the history is long; every donor gets its tail.
    years = given.select("yr").distinct().agg(F.array_sort(F.collect_set("yr"))).scalar()
    grid = given.groupBy("donor_id").agg(F.min("yr").alias("lo")).withColumn("years", years).select(
        "donor_id", F.explode(F.filter("years", lambda y: y >= F.col("lo"))).alias("yr"), F.lit(0).alias("gave"))
    line = grid.unionByName(given.withColumn("gave", F.lit(1))).groupBy("donor_id", "yr").agg(F.max("gave").alias("gave"))
    return windows.streaks(line, ["donor_id"], "yr", "gave")


@query("w08_year_offsets", with_views("gift") + """
SELECT gift_fy AS yr, gift_fy - (SELECT max(gift_fy) FROM gift) AS "offset" FROM gift GROUP BY gift_fy""")
def w08(spark, d):
    return windows.year_offsets(tables.gifts(spark, d).select(fiscal_year(F.col("gift_date"), START).alias("yr")), "yr")


@query("w09_previous_years", with_views("gift") + """
SELECT donor_id, coalesce(max(CASE WHEN gift_fy < 2000 THEN gift_fy END), 0) AS prev_year,
  coalesce(max(CASE WHEN gift_fy < 1999 THEN gift_fy END), 0) AS prev_prev_year FROM gift GROUP BY donor_id""")
def w09(spark, d):
    g = tables.gifts(spark, d).withColumn("fy", fiscal_year(F.col("gift_date"), START))
    return windows.years_before(g, "donor_id", "fy", F.lit(2000))


@query("w10_date_gaps", with_views("gift", more="""
days AS (SELECT DISTINCT channel, gift_type, gift_date AS d FROM gift UNION SELECT DISTINCT NULL, NULL, gift_date FROM gift),
gaps AS (SELECT channel, gift_type, d, lag(d) OVER (PARTITION BY channel, gift_type ORDER BY d) AS p FROM days)""") + """
SELECT channel, gift_type, CAST(d AS VARCHAR) AS gift_date, CAST(p AS VARCHAR) AS prev_date, date_diff('day', p, d) AS gap_days
FROM gaps WHERE date_diff('day', p, d) > 2""")
def w10(spark, d):
    """Gaps in each channel and gift type, and gaps of all gifts together."""
    g = tables.gifts(spark, d)
    together = windows.date_gaps(g, "gift_date").withColumns({"channel": F.lit(None).cast("string"), "gift_type": F.lit(None).cast("string")})
    return windows.date_gaps(g, "gift_date", ["channel", "gift_type"]).unionByName(together)


@query("w11_days_since_previous", with_views("gift") + """
SELECT gift_id, date_diff('day', lag(gift_date) OVER (PARTITION BY donor_id ORDER BY gift_date, gift_id), gift_date) AS days_since_previous
FROM gift""")
def w11(spark, d):
    return windows.days_since_previous(tables.gifts(spark, d), "donor_id", "gift_date", "gift_id").select(
        "gift_id", "days_since_previous")


@query("w12_mean_gap", with_views("gift", more="""
gaps AS (SELECT donor_id, date_diff('day', lag(gift_date) OVER (PARTITION BY donor_id ORDER BY gift_date, gift_id), gift_date) AS g FROM gift)""") + """
SELECT donor_id, CAST(sum(g) AS DOUBLE) / count(g) AS mean_gap_days FROM gaps GROUP BY donor_id""")
def w12(spark, d):
    return windows.mean_gap(tables.gifts(spark, d), "donor_id", "gift_date")


@query("w13_second_gift", with_views("gift", more="""
f AS (SELECT donor_id, min(gift_date) AS first, max(gift_date) AS last, count(*) AS n FROM gift GROUP BY 1),
s AS (SELECT g.donor_id, min(g.gift_date) AS second FROM gift g JOIN f USING (donor_id) WHERE g.gift_date > f.first GROUP BY 1),
a AS (SELECT s.donor_id, arg_min(g.gift_amount, g.gift_id) AS amount FROM s JOIN gift g ON g.donor_id = s.donor_id AND g.gift_date = s.second GROUP BY 1)""") + """
SELECT f.donor_id, CAST(f.first AS VARCHAR) AS first_gift_date, CAST(s.second AS VARCHAR) AS second_gift_date,
  CAST(a.amount AS DOUBLE) AS second_gift_amount, CAST(f.last AS VARCHAR) AS last_gift_date, f.n AS total_gifts,
  date_diff('day', f.first, s.second) AS days_to_second_gift, f.n > 1 AS gave_second_gift, date_diff('day', f.first, f.last) AS days_on_file
FROM f LEFT JOIN s USING (donor_id) LEFT JOIN a USING (donor_id)""")
def w13(spark, d):
    return windows.second_gift(tables.gifts(spark, d), "donor_id", "gift_date", "gift_amount", "gift_id")


@query("w14_group_fill", with_views("gift", more="""
holes AS (SELECT gift_id, donor_id, gift_date, CASE WHEN gift_type = 'F' THEN channel END AS channel FROM gift),
firsts AS (SELECT donor_id, arg_min(channel, (gift_date, gift_id)) AS c FROM holes WHERE channel IS NOT NULL GROUP BY 1)""") + """
SELECT gift_id, c AS channel FROM holes LEFT JOIN firsts USING (donor_id)""")
def w14(spark, d):
    g = tables.gifts(spark, d).withColumn("channel", F.when(F.col("gift_type") == "F", F.col("channel")))
    return windows.fill_from_group(g, ["donor_id"], "channel", [F.col("gift_date"), F.col("gift_id")]).select(
        "gift_id", "channel")


@query("w14_forward_fill", with_views("gift", more="""
days AS (SELECT donor_id, gift_date, max(CASE WHEN gift_type = 'F' THEN channel END) AS channel FROM gift GROUP BY 1, 2)""") + """
SELECT donor_id, CAST(gift_date AS VARCHAR) AS gift_date,
  last_value(channel IGNORE NULLS) OVER (PARTITION BY donor_id ORDER BY gift_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled
FROM days""")
def w14b(spark, d):
    days = tables.gifts(spark, d).groupBy("donor_id", "gift_date").agg(
        F.max(F.when(F.col("gift_type") == "F", F.col("channel"))).alias("channel"))
    return windows.fill_forward(days, ["donor_id"], "gift_date", "channel", "filled").select("donor_id", "gift_date", "filled")


@query("w15_group_transform", with_views("gift") + """
SELECT gift_id, CAST(max(CASE WHEN channel = '1-URGENT' THEN gift_amount END) OVER (PARTITION BY donor_id) AS DOUBLE) AS top_urgent
FROM gift""")
def w15(spark, d):
    return windows.group_transform(tables.gifts(spark, d), ["donor_id"], F.max(
        F.when(F.col("channel") == "1-URGENT", F.col("gift_amount"))), "top_urgent").select("gift_id", "top_urgent")


@query("w15_join_detail", with_views("gift", more="""
f AS (SELECT donor_id, min(gift_date) AS first FROM gift GROUP BY 1)""") + """
SELECT g.gift_id, CAST(sum(CASE WHEN g.gift_date = f.first THEN g.gift_amount END) OVER (PARTITION BY g.donor_id) AS DOUBLE) AS join_total
FROM gift g JOIN f USING (donor_id)""")
def w15b(spark, d):
    return windows.join_detail(tables.gifts(spark, d), "donor_id", "gift_date", F.sum, "gift_amount", "join_total").select(
        "gift_id", "join_total")


@query("w16_membership_periods", with_views("gift", more="""
days AS (SELECT donor_id, gift_date, bool_or(gift_type = 'F') AS r FROM gift GROUP BY 1, 2),
seen AS (SELECT *, max(CASE WHEN r THEN gift_date END) OVER (PARTITION BY donor_id ORDER BY gift_date) AS e FROM days),
kept AS (SELECT * FROM seen WHERE e IS NOT NULL),
jump AS (SELECT *, row_number() OVER w AS n, date_diff('day', lag(e) OVER w, e) AS j, first_value(e) OVER w AS f FROM kept
  WINDOW w AS (PARTITION BY donor_id ORDER BY gift_date)),
st AS (SELECT *, CASE WHEN n = 1 THEN f WHEN j > 183 THEN e END AS s FROM jump)""") + """
SELECT donor_id, CAST(gift_date AS VARCHAR) AS gift_date, CAST(e AS VARCHAR) AS recent,
  CAST(last_value(s IGNORE NULLS) OVER (PARTITION BY donor_id ORDER BY gift_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS VARCHAR) AS membership_start
FROM st""")
def w16(spark, d):
    days = tables.gifts(spark, d).groupBy("donor_id", "gift_date").agg(F.max(F.col("gift_type") == "F").alias("r"))
    days = windows.fill_forward(days.withColumn("e", F.when(F.col("r"), F.col("gift_date"))), ["donor_id"], "gift_date", "e", "recent")
    kept = days.filter(F.col("recent").isNotNull()).select("donor_id", "gift_date", "recent")
    return windows.membership_periods(kept, "donor_id", "gift_date", "recent")


@query("w17_split_shared_codes", with_views("mail", more="""
pair AS (SELECT campaign_code, package_name, min(gift_id * 10 + line) AS seen FROM mail GROUP BY 1, 2),
nth AS (SELECT *, row_number() OVER (PARTITION BY campaign_code ORDER BY seen, package_name) AS n FROM pair)""") + """
SELECT campaign_code || CASE WHEN n > 1 THEN '_' || n ELSE '' END AS campaign_code, package_name, count(*) AS pieces
FROM mail JOIN nth USING (campaign_code, package_name) GROUP BY ALL""")
def w17(spark, d):
    m = tables.mailings(spark, d).withColumn("at", F.col("gift_id") * 10 + F.col("line"))
    return windows.split_shared_codes(m, "campaign_code", "package_name", "at").groupBy("campaign_code", "package_name").agg(
        F.count(F.lit(1)).alias("pieces"))


@query("w18_rejoin_channel", with_views("gift", more="""
p AS (SELECT donor_id, gift_fy AS period, min(CASE WHEN month(gift_date) <> 12 THEN (gift_date, gift_id) END) AS k FROM gift GROUP BY 1, 2),
f AS (SELECT p.donor_id, p.period, g.channel, month(g.gift_date) AS m FROM p LEFT JOIN gift g ON g.donor_id = p.donor_id AND (g.gift_date, g.gift_id) = p.k)""") + """
SELECT donor_id, period, last_value(channel IGNORE NULLS) OVER w AS rejoin_channel, last_value(m IGNORE NULLS) OVER w AS rejoin_month
FROM f WINDOW w AS (PARTITION BY donor_id ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def w18(spark, d):
    fy = fiscal_year(F.col("gift_date"), START)
    # December gifts lie outside the example's windows, so some periods are carried forward.
    g = tables.gifts(spark, d).withColumns({
        "period": fy, "start": F.make_date(fy - 1, F.lit(7), F.lit(1)),
        "end": F.when(F.month("gift_date") == 12, F.make_date(fy - 1, F.lit(7), F.lit(1))).otherwise(F.make_date(fy, F.lit(6), F.lit(30)))})
    return windows.rejoin_by_period(g, "donor_id", "period", "start", "end", "gift_date", "gift_id", "channel")


@query("w19_surrogate_keys", with_views("gift") + """
SELECT gift_id, donor_id, dense_rank() OVER (ORDER BY donor_id) - 1 AS donor_key FROM gift""")
def w19(spark, d):
    return windows.surrogate_key(tables.gifts(spark, d), "donor_id", "donor_key").select("gift_id", "donor_id", "donor_key")


@query("w20_latest_row", with_views("mail", more="""
r AS (SELECT *, row_number() OVER (PARTITION BY donor_id ORDER BY mail_date DESC, gift_id DESC, line DESC, part_id DESC, list_id DESC, quantity DESC, revenue DESC) AS n FROM mail)""") + """
SELECT donor_id, gift_id, line, source_code, CAST(mail_date AS VARCHAR) AS mail_date FROM r WHERE n = 1""")
def w20(spark, d):
    return windows.latest_row(tables.mailings(spark, d), ["donor_id"], "mail_date", [
        "gift_id", "line", "part_id", "list_id", "quantity", "revenue"]).select(
        "donor_id", "gift_id", "line", "source_code", "mail_date")


@query("w21_yearly_change", with_views("gift", more="t AS (SELECT donor_id, gift_fy AS yr, sum(gift_amount) AS total FROM gift GROUP BY 1, 2)") + """
SELECT donor_id, yr, CAST(total AS DOUBLE) AS total,
  CAST(total - lag(total) OVER (PARTITION BY donor_id ORDER BY yr) AS DOUBLE) AS change FROM t""")
def w21(spark, d):
    g = tables.gifts(spark, d).withColumn("yr", fiscal_year(F.col("gift_date"), START))
    return windows.yearly_change(g, ["donor_id"], "yr", F.col("gift_amount"))


# ---- sort, limit, sets ----------------------------------------------------------------

@query("o01_o02_largest_gifts", with_views("gift") + """
SELECT gift_id, donor_id, CAST(gift_date AS VARCHAR) AS gift_date, CAST(gift_amount AS DOUBLE) AS gift_amount
FROM gift ORDER BY gift_amount DESC, gift_date, gift_id LIMIT 100""")
def o01(spark, d):
    return tables.gifts(spark, d).orderBy(F.desc("gift_amount"), "gift_date", "gift_id").limit(100).select(
        "gift_id", "donor_id", "gift_date", "gift_amount")


@query("o03_union_all", with_views("gift", "event") + """
SELECT origin, gift_type, count(*) AS n, CAST(sum(gift_amount) AS DOUBLE) AS total FROM (
  SELECT 'orders' AS origin, gift_type, gift_amount FROM gift UNION ALL SELECT 'events', gift_type, gift_amount FROM event) GROUP BY 1, 2""")
def o03(spark, d):
    both = setops.union_all(tables.gifts(spark, d).withColumn("origin", F.lit("orders")),
                            tables.recurring(spark, d).withColumn("origin", F.lit("events")))
    return both.groupBy("origin", "gift_type").agg(F.count(F.lit(1)).alias("n"), F.sum("gift_amount").alias("total"))


@query("o04_date_window_replace", with_views("gift", more="""
batch AS (SELECT gift_id + 10000000 AS gift_id, donor_id, gift_date, gift_amount * 2 AS gift_amount FROM gift WHERE year(gift_date) = 1999 AND channel = '5-LOW')""") + """
SELECT gift_id, donor_id, CAST(gift_date AS VARCHAR) AS gift_date, CAST(gift_amount AS DOUBLE) AS gift_amount FROM gift
WHERE gift_date < (SELECT min(gift_date) FROM batch) OR gift_date > (SELECT max(gift_date) FROM batch)
UNION ALL SELECT gift_id, donor_id, CAST(gift_date AS VARCHAR), CAST(gift_amount AS DOUBLE) FROM batch""")
def o04(spark, d):
    g = tables.gifts(spark, d).select("gift_id", "donor_id", "gift_date", "gift_amount", "channel")
    batch = g.filter((F.year("gift_date") == 1999) & (F.col("channel") == "5-LOW")).withColumns({
        "gift_id": F.col("gift_id") + 10000000, "gift_amount": F.col("gift_amount") * 2}).drop("channel")
    return setops.replace_window(g.drop("channel"), batch, "gift_date")


@query("o05_set_operations", with_views("gift", "mail").rstrip() + """
, a AS (SELECT DISTINCT donor_id FROM gift WHERE gift_fy = 2000), b AS (SELECT DISTINCT donor_id FROM mail WHERE year(mail_date) = 1999)
SELECT 'difference' AS op, donor_id FROM a WHERE donor_id NOT IN (SELECT donor_id FROM b)
UNION ALL SELECT 'common', donor_id FROM a WHERE donor_id IN (SELECT donor_id FROM b)
UNION ALL SELECT 'symmetric', donor_id FROM (SELECT donor_id FROM a WHERE donor_id NOT IN (SELECT donor_id FROM b)
  UNION ALL SELECT donor_id FROM b WHERE donor_id NOT IN (SELECT donor_id FROM a))""")
def o05(spark, d):
    a = tables.gifts(spark, d).filter(fiscal_year(F.col("gift_date"), START) == 2000)
    b = tables.mailings(spark, d).filter(F.year("mail_date") == 1999)
    tag = lambda df, op: df.select(F.lit(op).alias("op"), "donor_id")
    return tag(setops.difference(a, b, "donor_id"), "difference").unionAll(
        tag(setops.common(a, b, "donor_id"), "common")).unionAll(
        tag(setops.symmetric_difference(a, b, "donor_id"), "symmetric"))


@query("o06_distinct", with_views("mail") + "SELECT DISTINCT campaign_code, package_name, year(mail_date) AS yr FROM mail")
def o06(spark, d):
    return tables.mailings(spark, d).select("campaign_code", "package_name", F.year("mail_date").alias("yr")).distinct()


@query("o07_long_and_wide", with_views("gift", more="""
w AS (SELECT donor_id, min(gift_amount) AS low, max(gift_amount) AS high FROM gift GROUP BY 1)""") + """
SELECT donor_id, 'low' AS measure, CAST(low AS DOUBLE) AS amount FROM w UNION ALL SELECT donor_id, 'high', CAST(high AS DOUBLE) FROM w""")
def o07(spark, d):
    wide = tables.gifts(spark, d).groupBy("donor_id").agg(F.min("gift_amount").alias("low"), F.max("gift_amount").alias("high"))
    return setops.to_long(wide, ["donor_id"], ["low", "high"], "measure", "amount")


@query("o07_wide", with_views("gift") + """
SELECT donor_id, CAST(sum(CASE WHEN gift_type = 'F' THEN gift_amount END) AS DOUBLE) AS "F",
  CAST(sum(CASE WHEN gift_type = 'O' THEN gift_amount END) AS DOUBLE) AS "O",
  CAST(sum(CASE WHEN gift_type = 'P' THEN gift_amount END) AS DOUBLE) AS "P" FROM gift GROUP BY donor_id""")
def o07b(spark, d):
    return setops.to_wide(tables.gifts(spark, d), ["donor_id"], "gift_type", ["F", "O", "P"], F.sum("gift_amount"))


@query("o08_donor_split_integrity", with_views("gift") + """
SELECT count(DISTINCT donor_id) AS donors, count(*) AS gifts, 0 AS donors_in_two_sets FROM gift""")
def o08(spark, d):
    g = tables.gifts(spark, d).withColumn("part", setops.split_number(F.col("donor_id"), 10))
    per_set = g.groupBy("part").agg(F.count_distinct("donor_id").alias("donors"), F.count(F.lit(1)).alias("gifts"))
    broken = setops.split_integrity(g, "donor_id", "part").agg(F.count(F.lit(1)))
    return per_set.agg(F.sum("donors").alias("donors"), F.sum("gifts").alias("gifts")).withColumn(
        "donors_in_two_sets", broken.scalar())
