"""Lookups, key resolution, table comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from donorloom.catalog.base import START, newest_year, query, with_views
from donorloom.functions.dates import fiscal_year
from donorloom.operators import joins
from donorloom.operators.scale import attach
from donorloom.session import stored
from donorloom.sources import tables

# The known part of the code dimension: codes of the six largest sizes were never registered.
KNOWN = "known AS (SELECT source_code, min(campaign_code) AS campaign_code, min(campaign_name) AS campaign_name, min(package_cpp) AS package_cpp, min(part_id) AS code_id FROM code WHERE quantity <= 44 GROUP BY 1)"
PIECE_SQL = "gift_id, line, part_id, list_id, CAST(revenue AS DOUBLE) AS revenue"
PIECE = ["gift_id", "line", "part_id", "list_id", "revenue"]


def known(spark, d):
    return tables.parts(spark, d).filter("quantity <= 44").groupBy("source_code").agg(
        F.min("campaign_code").alias("campaign_code"), F.min("campaign_name").alias("campaign_name"),
        F.min("package_cpp").alias("package_cpp"), F.min("part_id").alias("code_id"))


@query("j01_donor_total_on_gifts", with_views("gift") + """
SELECT gift_id, CAST(sum(gift_amount) OVER (PARTITION BY donor_id) AS DOUBLE) AS donor_total, count(*) OVER (PARTITION BY donor_id) AS donor_gifts FROM gift""")
def j01(spark, d):
    g = tables.gifts(spark, d)
    n = F.count(F.lit(1))
    totals = g.groupBy("donor_id").agg(F.sum("gift_amount").alias("donor_total"), n.alias("donor_gifts"), n.alias("_n"))
    return attach(g, totals, ["donor_id"], "_n").select("gift_id", "donor_total", "donor_gifts")


@query("j02_outer_with_codes", with_views("mail", more=KNOWN + """,
s AS (SELECT gift_id, line, part_id, list_id, source_code, CASE WHEN line < 4 THEN campaign_code END AS campaign_code FROM mail)""") + """
SELECT s.gift_id, s.line, s.part_id, s.list_id, coalesce(s.source_code, k.source_code) AS source_code,
  coalesce(s.campaign_code, k.campaign_code) AS campaign_code, k.campaign_name, CAST(k.package_cpp AS DOUBLE) AS package_cpp, k.code_id
FROM s FULL JOIN known k ON s.source_code = k.source_code""")
def j02(spark, d):
    m = tables.mailings(spark, d).select(
        "gift_id", "line", "part_id", "list_id", "source_code", F.when(F.col("line") < 4, F.col("campaign_code")).alias("campaign_code"))
    return joins.outer_with_codes(m, known(spark, d), "source_code")


@query("j03_missing_codes", with_views("mail", more=KNOWN) + f"""
SELECT {PIECE_SQL} FROM mail WHERE source_code NOT IN (SELECT source_code FROM known)""")
def j03(spark, d):
    return joins.missing_codes(tables.mailings(spark, d), known(spark, d), "source_code").select(*PIECE)


@query("j04_lookup_with_fallback", with_views("mail", more=KNOWN + """,
l AS (SELECT campaign_code, arg_max(campaign_name, code_id) AS n FROM known GROUP BY 1)""") + """
SELECT gift_id, line, part_id, list_id, CAST(revenue AS DOUBLE) AS revenue, coalesce(CASE WHEN line < 3 THEN campaign_name END, n) AS campaign_name
FROM mail LEFT JOIN l USING (campaign_code)""")
def j04(spark, d):
    m = tables.mailings(spark, d).withColumn("campaign_name", F.when(F.col("line") < 3, F.col("campaign_name")))
    return joins.fill_from_lookup(m, "campaign_name", known(spark, d), "campaign_code", "campaign_name", [F.col("code_id")]).select(
        *PIECE, "campaign_name")


PRIORITY = """
pc AS (SELECT part_id, CASE WHEN part_id % 2 = 0 THEN source_code ELSE campaign_code END AS source_code, campaign_name,
  CASE WHEN quantity > 20 THEN campaign_code END AS campaign_code, 'ACME_sc_' || part_id AS k FROM code),
pg AS (SELECT gift_id, line, part_id, list_id, revenue, CASE WHEN line = 7 THEN 'zz' WHEN line = 6 THEN campaign_code ELSE source_code END AS source_code,
  CASE WHEN line < 5 THEN campaign_name END AS campaign_name, CASE WHEN line < 4 THEN campaign_code END AS campaign_code,
  year(mail_date) + CASE WHEN month(mail_date) >= 7 THEN 1 ELSE 0 END AS fy FROM mail),
l1 AS (SELECT source_code, arg_min(k, part_id) AS k FROM pc GROUP BY 1),
l3 AS (SELECT source_code, campaign_name, arg_min(k, part_id) AS k FROM pc GROUP BY 1, 2),
l2 AS (SELECT source_code, campaign_name, coalesce(campaign_code, '') AS campaign_code, arg_min(k, part_id) AS k FROM pc GROUP BY 1, 2, 3)"""


@query("j05_priority_code_key", with_views("mail", more=PRIORITY.strip()) + """
SELECT g.gift_id, g.line, g.part_id, g.list_id, CAST(g.revenue AS DOUBLE) AS revenue,
  coalesce(l2.k, l3.k, l1.k, CASE WHEN g.fy BETWEEN 1996 AND 2001 THEN 'ACME_unsourced_' || g.fy END) AS sc_key_curated
FROM pg g LEFT JOIN l1 ON g.source_code = l1.source_code
LEFT JOIN l3 ON g.source_code = l3.source_code AND coalesce(g.campaign_name, '') = l3.campaign_name
LEFT JOIN l2 ON g.source_code = l2.source_code AND coalesce(g.campaign_name, '') = l2.campaign_name AND coalesce(g.campaign_code, '') = l2.campaign_code""")
def j05(spark, d):
    c = F.col
    dim = tables.parts(spark, d).select(
        "part_id", F.lit("ACME").alias("client"), F.when(c("part_id") % 2 == 0, c("source_code")).otherwise(c("campaign_code")).alias("source_code"),
        "campaign_name", F.when(c("quantity") > 20, c("campaign_code")).alias("campaign_code"), F.lit(None).cast("int").alias("fy"),
        F.concat(F.lit("ACME_sc_"), c("part_id").cast("string")).alias("sc_key_curated"))
    m = tables.mailings(spark, d)
    # Stored once: the years, the combinations of keys and the answers are read from it without its joins.
    g = stored(m.select(
        *PIECE, F.lit("ACME").alias("client"),
        F.when(c("line") == 7, "zz").when(c("line") == 6, c("campaign_code")).otherwise(c("source_code")).alias("source_code"),
        F.when(c("line") < 5, c("campaign_name")).alias("campaign_name"), F.when(c("line") < 4, c("campaign_code")).alias("campaign_code"),
        fiscal_year(c("mail_date"), START).alias("gift_fy")))
    years = g.select(c("gift_fy").alias("fy")).distinct().filter("fy BETWEEN 1996 AND 2001").select(
        F.lit(0).cast("long").alias("part_id"), F.lit("ACME").alias("client"), F.concat(F.lit("U"), c("fy").cast("string")).alias("source_code"),
        F.lit("Unsourced").alias("campaign_name"), F.concat(F.lit("UNSOURCED-FY"), c("fy").cast("string")).alias("campaign_code"), "fy",
        F.concat(F.lit("ACME_unsourced_"), c("fy").cast("string")).alias("sc_key_curated"))
    return joins.curated_code_key(g, dim.unionByName(years), [c("part_id")]).select(*PIECE, "sc_key_curated")


@query("j11_as_of_sustainer_gift", with_views("gift") + """
SELECT gift_id, CAST(max(CASE WHEN gift_type = 'F' THEN gift_date END) OVER (PARTITION BY donor_id ORDER BY gift_date) AS VARCHAR) AS recent_sust_date FROM gift""")
def j11(spark, d):
    return joins.most_recent_event(tables.gifts(spark, d), ["donor_id"], "gift_date", F.col("gift_type") == "F", "recent_sust_date").select(
        "gift_id", "recent_sust_date")


@query("j12_id_crosswalk", with_views("gift", "person").rstrip() + """
SELECT gift_id, CASE WHEN program = 'MACHINERY' THEN donor_id + 1000000 ELSE donor_id END AS donor_id FROM gift JOIN person USING (donor_id)""")
def j12(spark, d):
    pairs = tables.people(spark, d).filter("program = 'MACHINERY'").select("donor_id", (F.col("donor_id") + 1000000).alias("new_id"))
    return joins.crosswalk(tables.gifts(spark, d), "donor_id", pairs, "donor_id", "new_id").select("gift_id", "donor_id")


@query("j13_f19_membership_flags", with_views("mail", more=KNOWN) + """
SELECT gift_id, line, part_id, list_id, CAST(revenue AS DOUBLE) AS revenue, source_code IN (SELECT source_code FROM known) AS tracked,
  donor_id IN (SELECT donor_id FROM mail WHERE revenue > 104000) AS mid_level FROM mail""")
def j13(spark, d):
    m = tables.mailings(spark, d)
    flagged = joins.membership_flag(m, "source_code", known(spark, d), "source_code", "tracked")
    return joins.in_list(flagged, "donor_id", m.filter("revenue > 104000"), "mid_level").select(*PIECE, "tracked", "mid_level")


@query("j14_x19_mailings_and_gifts", with_views("gift", "mail").rstrip() + """
, y AS (SELECT donor_id, sum(gift_amount) AS total FROM gift WHERE gift_fy = (SELECT max(gift_fy) FROM gift) GROUP BY 1),
t AS (SELECT donor_id, count(*) AS n FROM mail GROUP BY 1)
SELECT donor_id, CAST(total AS DOUBLE) AS total, n AS times_mailed, CAST(total AS DOUBLE) / n AS revenue_per_mailing FROM y JOIN t USING (donor_id)""")
def j14(spark, d):
    year = tables.gifts(spark, d).filter(fiscal_year(F.col("gift_date"), START) == newest_year(spark, d)).groupBy("donor_id").agg(F.sum("gift_amount").alias("total"))
    mailed = tables.mailings(spark, d).groupBy("donor_id").agg(F.count(F.lit(1)).alias("times_mailed"))
    return year.join(mailed, "donor_id").withColumn("revenue_per_mailing", F.col("total").cast("double") / F.col("times_mailed"))


@query("j15_profile_comparison", with_views("gift", "mail").rstrip() + """
, a AS (SELECT year(gift_date) AS yr, count(*) AS n FROM gift GROUP BY 1), b AS (SELECT year(mail_date) AS yr, count(*) AS n FROM mail GROUP BY 1)
SELECT yr, coalesce(a.n, 0) AS updated, coalesce(b.n, 0) AS previous FROM a FULL JOIN b USING (yr)""")
def j15(spark, d):
    count = lambda df, day: df.groupBy(F.year(day).alias("yr")).agg(F.count(F.lit(1)).alias("n"))
    return joins.compare_profiles(count(tables.gifts(spark, d), "gift_date"), count(tables.mailings(spark, d), "mail_date"), ["yr"], "n")


@query("j16_table_diff", with_views("gift", more="""
l AS (SELECT gift_id, donor_id, channel, CAST(gift_amount AS DOUBLE) AS amount FROM gift WHERE gift_date < DATE '2001-01-01'),
r AS (SELECT gift_id, donor_id, CASE WHEN channel = '5-LOW' THEN NULL ELSE channel END AS channel,
  CAST(CASE WHEN gift_type = 'F' THEN gift_amount + 1 ELSE gift_amount END AS DOUBLE) AS amount FROM gift WHERE gift_date >= DATE '1996-01-01'),
b AS (SELECT l.gift_id AS li, r.gift_id AS ri, coalesce(l.gift_id, r.gift_id) AS gift_id, l.donor_id AS ld, r.donor_id AS rd, l.channel AS lc, r.channel AS rc, l.amount AS la, r.amount AS ra FROM l FULL JOIN r ON l.gift_id = r.gift_id),
s AS (SELECT gift_id, CASE WHEN ri IS NULL THEN 'left_only' ELSE 'left_changed' END AS side, CASE WHEN ld IS DISTINCT FROM rd THEN ld END AS donor_id,
    CASE WHEN lc IS DISTINCT FROM rc THEN lc END AS channel, CASE WHEN la IS DISTINCT FROM ra THEN la END AS amount FROM b WHERE li IS NOT NULL
  UNION ALL SELECT gift_id, CASE WHEN li IS NULL THEN 'right_only' ELSE 'right_changed' END, CASE WHEN ld IS DISTINCT FROM rd THEN rd END,
    CASE WHEN lc IS DISTINCT FROM rc THEN rc END, CASE WHEN la IS DISTINCT FROM ra THEN ra END FROM b WHERE ri IS NOT NULL)""") + """
SELECT gift_id, side, donor_id, channel, amount FROM s WHERE donor_id IS NOT NULL OR channel IS NOT NULL OR amount IS NOT NULL""")
def j16(spark, d):
    g = tables.gifts(spark, d).select("gift_id", "donor_id", "channel", F.col("gift_amount").cast("double").alias("amount"), "gift_date", "gift_type")
    left = g.filter(F.col("gift_date") < F.lit("2001-01-01").cast("date"))
    right = g.filter(F.col("gift_date") >= F.lit("1996-01-01").cast("date")).withColumns({
        "channel": F.when(F.col("channel") != "5-LOW", F.col("channel")),
        "amount": F.when(F.col("gift_type") == "F", F.col("amount") + 1).otherwise(F.col("amount"))})
    return joins.table_diff(left, right, "gift_id", ignore=["gift_date", "gift_type"])


@query("j17_unknown_codes", with_views("mail", more=KNOWN) + """
SELECT DISTINCT source_code FROM mail WHERE source_code NOT IN (SELECT source_code FROM known)""")
def j17(spark, d):
    return joins.unknown_values(tables.mailings(spark, d), known(spark, d), "source_code")


@query("j18_whitemail_rows", with_views("code", more="""
k AS (SELECT part_id, CASE WHEN quantity = 1 THEN campaign_code ELSE source_code END AS source_code, campaign_code, campaign_name, package_name FROM code)""") + """
SELECT source_code, campaign_code, campaign_name, package_name FROM k UNION ALL
SELECT campaign_code, campaign_code, arg_min(campaign_name, part_id), 'Whitemail' FROM k WHERE campaign_code NOT IN (SELECT source_code FROM k) GROUP BY campaign_code""")
def j18(spark, d):
    k = tables.parts(spark, d).select(
        "part_id", F.when(F.col("quantity") == 1, F.col("campaign_code")).otherwise(F.col("source_code")).alias("source_code"),
        "campaign_code", "campaign_name", "package_name", F.lit(None).cast("date").alias("mail_date"))
    return joins.whitemail_rows(k, [F.col("part_id")]).select("source_code", "campaign_code", "campaign_name", "package_name")


@query("j19_backfill_by_gift", with_views("gift", "mail").rstrip() + """
, s AS (SELECT gift_id, min(source_code) AS source_code, max(donor_id) AS donor_id FROM mail GROUP BY 1)
SELECT g.gift_id, coalesce(CASE WHEN g.gift_type = 'F' THEN g.donor_id END, s.donor_id) AS donor_id, coalesce(CASE WHEN g.gift_type = 'F' THEN g.channel END, s.source_code) AS source_code
FROM gift g LEFT JOIN s ON g.gift_id = s.gift_id""")
def j19(spark, d):
    side = tables.mailings(spark, d).groupBy("gift_id").agg(F.min("source_code").alias("code"), F.max("donor_id").alias("contact"))
    g = tables.gifts(spark, d).select("gift_id", F.when(F.col("gift_type") == "F", F.col("donor_id")).alias("donor_id"),
                                      F.when(F.col("gift_type") == "F", F.col("channel")).alias("source_code"))
    return joins.backfill(g, side, "gift_id", {"donor_id": "contact", "source_code": "code"})


@query("j20_soft_credits", with_views("gift", "mail").rstrip() + """
, c AS (SELECT gift_id, gift_id * 10000 + part_id + 100000000 AS credit_id, sum(revenue) AS gift_amount, min(list_id) AS donor_id FROM mail WHERE quantity > 45 GROUP BY 1, 2)
SELECT gift_id, donor_id, CAST(gift_amount AS DOUBLE) AS gift_amount, channel FROM gift WHERE gift_id NOT IN (SELECT gift_id FROM c)
UNION ALL SELECT c.credit_id, c.donor_id, CAST(c.gift_amount AS DOUBLE), g.channel FROM c LEFT JOIN gift g ON c.gift_id = g.gift_id""")
def j20(spark, d):
    credits = tables.mailings(spark, d).filter("quantity > 45").groupBy(
        "gift_id", (F.col("gift_id") * 10000 + F.col("part_id") + 100000000).alias("credit_id")).agg(
        F.sum("revenue").cast("double").alias("gift_amount"), F.min("list_id").alias("donor_id"))
    g = tables.gifts(spark, d).select("gift_id", "donor_id", F.col("gift_amount").cast("double").alias("gift_amount"), "channel")
    return joins.soft_credits(g, credits, "gift_id", "credit_id", ["gift_amount", "donor_id"])


@query("j21_matchback", with_views("mail", more="""
g AS (SELECT gift_id, donor_id, campaign_code FROM mail WHERE line = 1), m AS (SELECT DISTINCT donor_id, campaign_code, source_code FROM mail)""") + """
SELECT g.gift_id, m.source_code FROM g LEFT JOIN m ON g.donor_id = m.donor_id AND g.campaign_code = m.campaign_code""")
def j21(spark, d):
    m = tables.mailings(spark, d)
    # A gift's campaign is that of its first mailing line.
    g = m.filter("line = 1").select("gift_id", "donor_id", "campaign_code")
    return joins.matchback(g, m, ["donor_id", "campaign_code"], ["source_code"]).select("gift_id", "source_code")


@query("j22_donor_attribute", with_views("gift", "person").rstrip() + """
SELECT gift_id, CASE WHEN balance > 5000 THEN program ELSE 'N/A' END AS program FROM gift JOIN person USING (donor_id)""")
def j22(spark, d):
    side = tables.people(spark, d).filter("balance > 5000").select("donor_id", "program")
    return joins.donor_attribute(tables.gifts(spark, d), side, "donor_id", "program", "N/A").select("gift_id", "program")


@query("j16_split_diff", with_views("gift") + """
SELECT 'left_only' AS side, count(*) AS n FROM gift WHERE gift_type = 'O' UNION ALL SELECT 'left_changed', count(*) FROM gift WHERE gift_type = 'P'
UNION ALL SELECT 'right_only', count(*) FROM gift WHERE gift_type = 'F' AND channel = '5-LOW' UNION ALL SELECT 'right_changed', count(*) FROM gift WHERE gift_type = 'P'""")
def j16b(spark, d):
    g = tables.gifts(spark, d).withColumn("gift_date", F.col("gift_date").cast("string"))
    left = g.filter("NOT (gift_type = 'F' AND channel = '5-LOW')")
    right = g.filter("gift_type <> 'O'").withColumn("gift_date", F.when(F.col("gift_type") == "P", "2030-01-01").otherwise(F.col("gift_date")))
    sides = joins.split_diff(joins.table_diff(left, right, "gift_id"))
    count = lambda name: sides[name].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("side"), "n")
    return count("left_only").unionAll(count("left_changed")).unionAll(count("right_only")).unionAll(count("right_changed"))
