"""File health, base tables, sustainers, campaigns and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from donorloom.catalog.base import START, query, with_views
from donorloom.catalog.q_dates import band_sql
from donorloom.functions.bands import RECENCY
from donorloom.functions.dates import fiscal_year, month_spine, newest_window, register_fiscal_from_date
from donorloom.functions.rules import classify, is_in
from donorloom.operators import joins, setops
from donorloom.operators.windows import next_gift_days, second_gift
from donorloom.plans import base_tables, campaigns, file_health, hooks, response_curve, sustainers
from donorloom.sources import tables



def client_gifts(spark, d):
    return tables.gifts(spark, d).withColumn("client", F.lit("ACME"))


def day(text):
    return F.lit(text).cast("date")


# ---- lifecycle groups: the SQL works on lists of giving years ------------------------------

MONTH_END = """edge AS (SELECT CASE WHEN last_day(m) = m THEN m ELSE CAST(date_trunc('month', m) AS DATE) - 1 END AS e FROM (SELECT max(gift_date) AS m FROM gift))"""
WINDOWS = {  # first and last day of the newest period, from the last complete month's end
    "fy": ("make_date(year(e) - CASE WHEN month(e) < 6 THEN 2 ELSE 1 END, 7, 1)", "make_date(year(e) - CASE WHEN month(e) < 6 THEN 1 ELSE 0 END, 6, 30)"),
    "cy": ("make_date(year(e) - CASE WHEN month(e) < 12 THEN 1 ELSE 0 END, 1, 1)", "make_date(year(e) - CASE WHEN month(e) < 12 THEN 1 ELSE 0 END, 12, 31)"),
    "fytd": ("make_date(year(e) - CASE WHEN month(e) < 7 THEN 1 ELSE 0 END, 7, 1)", "e"),
    "cytd": ("make_date(year(e), 1, 1)", "e"),
    "r12": ("CAST(e - INTERVAL 12 MONTH AS DATE) + 1", "e"),
}


# Groups from the years given before (past) and in (gave) the year y; shared by all forms of the lifecycle SQL.
NAMED = """back AS (SELECT *, past[-1] AS p1, past[-2] AS p2, list_filter(past, lambda x, i: x - i = past[-1] - len(past))[1] AS run FROM line),
named AS (SELECT *, CASE WHEN p1 IS NULL AND gave THEN 'New' WHEN p1 IS NULL OR p1 < y - 1 THEN 'Reacquired' WHEN p2 IS NULL THEN 'New Last Year'
  WHEN p2 = y - 2 THEN 'Consecutive Giver' ELSE 'Reacquired Last Year' END AS grp FROM back)"""
SHOWN = "coalesce(strftime({c}, '%m/%d/%Y'), 'open')"
LABELLED = """
SELECT client, donor_id, {key}y AS yr, o AS "offset", '{period}' AS period, """ + SHOWN.format(c="s") + """ || ' - ' || """ + SHOWN.format(c="t") + """ AS report_period,
  client || '-{period} ending ' || """ + SHOWN.format(c="t") + """ AS report_period_id, grp AS fh_group,
  CASE grp WHEN 'Consecutive Giver' THEN grp || (y - run) WHEN 'Reacquired' THEN grp || (y - p1) WHEN 'Reacquired Last Year' THEN grp || (p1 - p2) ELSE grp END AS fh_group_detail,
  CASE WHEN grp IN ('New', 'Reacquired') THEN 'Pipeline' ELSE 'Active' END AS donor_type,
  CASE grp WHEN 'New' THEN 'Pipeline' WHEN 'Reacquired' THEN 'Pipeline' WHEN 'Consecutive Giver' THEN grp ELSE '2nd Year' END AS donor_subtype,
  CASE WHEN gave AND p1 = y - 1 THEN 1 ELSE 0 END AS past_2_years, CASE WHEN gave THEN 1 ELSE 0 END AS gift_made FROM named"""


def lifecycle_sql(period: str, client: str = "'ACME'", key: str = "") -> str:
    year = lambda c: f"year({c}) + CASE WHEN month({c}) >= 7 THEN 1 ELSE 0 END" if period.startswith("fy") else f"year({c})"
    shifted = lambda c: f"CAST({c} + to_months(CAST((k - top) * 12 AS INTEGER)) AS DATE)"
    first, final = WINDOWS[period]
    return with_views("gift", more=f"""{MONTH_END},
win AS (SELECT {first} AS s, {final} AS t FROM edge),
base AS (SELECT {client} AS client, donor_id, gift_date, {year('gift_date')} AS cal FROM gift WHERE gift_amount > 0),
known AS (SELECT client, cal AS k, max(cal) OVER (PARTITION BY client) AS top FROM base GROUP BY client, cal),
per AS (SELECT client, k - top AS o, {shifted('s')} AS s, {shifted('t')} AS t, {year(shifted('t'))} AS y FROM known, win),
given AS (SELECT b.client, b.donor_id, list_sort(list(DISTINCT p.y)) AS g FROM base b JOIN per p
  ON p.client = b.client AND {"b.gift_date BETWEEN p.s AND p.t" if period == "r12" else "p.y = b.cal"} GROUP BY ALL),
line AS (SELECT d.*, p.y, p.o, p.s, p.t, list_filter(coalesce(g, []), lambda x: x < p.y) AS past, coalesce(list_contains(g, p.y), false) AS gave
  FROM (SELECT client, donor_id, min(cal) AS since FROM base GROUP BY ALL) d JOIN per p ON p.client = d.client AND p.y >= d.since AND p.o > -6
  SEMI JOIN known ON known.client = p.client AND known.k = p.y LEFT JOIN given ON given.client = d.client AND given.donor_id = d.donor_id),
""" + NAMED) + LABELLED.format(client=client, period=period, key=key)


def newest(spark, d, period):
    """First and last day of the newest period, from one scalar subquery."""
    last = tables.gifts(spark, d).agg(F.max("gift_date").alias("m"))
    start, end = newest_window(period, F.col("m"), START)
    window = last.select(F.struct(start.alias("start"), end.alias("end"))).scalar()
    return window["start"], window["end"]


def lifecycle(period):
    def run(spark, d):
        return file_health.lifecycle_groups(tables.gifts(spark, d), "ACME", period, *newest(spark, d, period), START)
    return run


for _p in WINDOWS:
    query(f"x01_file_health_{_p}", lifecycle_sql(_p))(lifecycle(_p))


@query("x01_file_health_two_clients", lifecycle_sql("fytd", "CASE WHEN channel < '3' THEN 'ACME' ELSE 'BETA' END", "client || '-' || donor_id AS donor_key, "))
def x01_clients(spark, d):
    g = tables.gifts(spark, d).withColumn("client", F.when(F.col("channel") < "3", "ACME").otherwise("BETA"))
    g = g.withColumn("donor_key", F.concat("client", F.lit("-"), F.col("donor_id").cast("string")))
    return file_health.lifecycle_groups(g, None, "fytd", *newest(spark, d, "fytd"), START)


PERIODS_SQL = """
cal AS (SELECT DISTINCT gift_fy AS y, min(gift_fy) OVER () AS lo, max(gift_fy) OVER () AS top FROM gift),
per AS (SELECT 'ACME' AS client, y, y - top AS o, CASE WHEN y > lo THEN make_date(y - 1, 7, 1) - CAST(CASE WHEN y % 2 = 0 THEN 45 ELSE 0 END AS INTEGER) END AS s,
  CASE WHEN y < top THEN make_date(y, 6, 30) - CAST(CASE WHEN y % 3 = 0 THEN 100 ELSE 0 END AS INTEGER) END AS t FROM cal)"""


def given_periods(spark, d):
    """Report periods as rows: every second one begins early and overlaps the one before, every third one ends early, the outer ones are open."""
    years = tables.gifts(spark, d).select(fiscal_year(F.col("gift_date"), START).alias("yr")).distinct()
    y, span = F.col("yr"), F.col("span")
    years = years.withColumn("span", years.agg(F.struct(F.min("yr").alias("lo"), F.max("yr").alias("top"))).scalar())
    return years.select(
        F.lit("ACME").alias("client"), "yr",
        F.when(y > span["lo"], F.date_sub(F.make_date(y - 1, F.lit(7), F.lit(1)), F.when(y % 2 == 0, 45).otherwise(0))).alias("start_date"),
        F.when(y < span["top"], F.date_sub(F.make_date(y, F.lit(6), F.lit(30)), F.when(y % 3 == 0, 100).otherwise(0))).alias("end_date"))


@query("x01_j07_given_periods", with_views("gift", more=PERIODS_SQL.strip() + """,
given AS (SELECT donor_id, list_sort(list(DISTINCT y)) AS g FROM gift JOIN per ON (s IS NULL OR gift_date >= s) AND (t IS NULL OR gift_date <= t) WHERE gift_amount > 0 GROUP BY ALL),
line AS (SELECT given.donor_id, per.*, list_filter(g, lambda x: x < per.y) AS past, list_contains(g, per.y) AS gave FROM given JOIN per ON per.y >= g[1] WHERE o > -6),
""" + NAMED) + LABELLED.format(client="'ACME'", period="rows", key=""))
def x01_rows(spark, d):
    return file_health.lifecycle_by_period(client_gifts(spark, d), given_periods(spark, d), "rows")


@query("j09_gifts_in_given_periods", with_views("gift", more=PERIODS_SQL.strip()) + """
SELECT gift_id, y AS yr, CAST(s AS VARCHAR) AS start_date, CAST(t AS VARCHAR) AS end_date FROM gift JOIN per ON (s IS NULL OR gift_date >= s) AND (t IS NULL OR gift_date <= t)""")
def j09_rows(spark, d):
    g = tables.gifts(spark, d).select("gift_id", "gift_date")
    return joins.interval_join(g, "gift_date", given_periods(spark, d), "start_date", "end_date").select("gift_id", "yr", "start_date", "end_date")


@query("x05_j09_report_period_days", with_views("gift", more=MONTH_END + f""",
y AS (SELECT DISTINCT gift_fy - (SELECT max(gift_fy) FROM gift) AS o FROM gift),
rp AS (SELECT o, CAST({WINDOWS['fy'][0]} + to_years(CAST(o AS INTEGER)) AS DATE) AS s, CAST({WINDOWS['fy'][1]} + to_years(CAST(o AS INTEGER)) AS DATE) AS e FROM y, edge WHERE o > -6)""".replace(
    "month(e)", "month(edge.e)").replace("year(e)", "year(edge.e)")) + """
SELECT 'ACME' AS client, o AS "offset", CAST(s AS VARCHAR) AS start_date, CAST(e AS VARCHAR) AS end_date, CASE WHEN o > -5 THEN 1 ELSE 0 END AS reportable,
  CAST(CAST(x AS DATE) AS VARCHAR) AS date, 'ACME-' || CAST(x AS DATE) AS client_date FROM rp, unnest(generate_series(s, e, INTERVAL 1 DAY)) AS t(x)""")
def x05(spark, d):
    periods = file_health.report_periods(client_gifts(spark, d), "fy", *newest(spark, d, "fy"), START)
    return file_health.period_days(periods).select("client", "offset", "start_date", "end_date", "reportable", "date", "client_date")


GROUPS_SQL = """
fy AS (SELECT donor_id, gift_fy AS y FROM gift GROUP BY 1, 2),
r AS (SELECT unnest(range(min(y), max(y) + 1)) AS ry FROM fy),
c AS (SELECT donor_id, ry, min(y) AS f, coalesce(max(CASE WHEN y < ry THEN y END), 0) AS p, coalesce(max(CASE WHEN y < ry - 1 THEN y END), 0) AS pp,
  max(y) AS l, list_sort(list(y)) AS ys FROM fy JOIN r ON y <= ry GROUP BY 1, 2),
g AS (SELECT *, (CASE WHEN f = ry THEN 'New' ELSE '' END) || (CASE WHEN f = ry - 1 THEN 'New Last Year' ELSE '' END) || (CASE WHEN ry - p > 1 AND f <> ry THEN 'Lapsed' ELSE '' END)
  || (CASE WHEN p = ry - 1 AND pp < ry - 2 AND f <> ry - 1 THEN 'Reinstated Last Year' ELSE '' END) || (CASE WHEN p = ry - 1 AND pp = ry - 2 THEN 'Consecutive Giver' ELSE '' END) AS grp FROM c)"""
RUN_SQL = "(SELECT max(k) FROM range(1, 40) AS t(k) WHERE list_has_all(ys, list_transform(range(1, k + 1), lambda i: {r} - i)))"


@query("x02_x03_w09_report_groups", with_views("gift", more=GROUPS_SQL.strip()) + f"""
SELECT donor_id, ry AS report_year, strftime(make_date(ry - 1, 7, 1), '%m/%d/%Y') || ' - ' || strftime(make_date(ry, 6, 30), '%m/%d/%Y') AS report_period,
  f AS first_year, l AS last_year, p AS prev_year, pp AS prev_prev_year, grp AS fh_group,
  grp || coalesce(CAST(CASE WHEN grp LIKE '%Lapsed%' THEN ry - p WHEN grp LIKE '%Consecutive%' THEN CASE WHEN {RUN_SQL.format(r='ry')} >= 2 THEN {RUN_SQL.format(r='ry')} END
    WHEN grp LIKE '%Reinstated%' THEN CASE WHEN pp > 0 THEN p - pp END END AS VARCHAR), '') AS fh_group_detail FROM g""")
def x02(spark, d):
    last = tables.gifts(spark, d).agg(F.max("gift_date")).scalar()
    groups = file_health.report_groups(tables.gifts(spark, d), "fy", None, last, START)
    return file_health.with_detail(groups).drop("years", "period", "report")


@query("x02_report_groups_r12", with_views("gift", more="""
m AS (SELECT month(max(gift_date)) AS m FROM gift),
fy AS (SELECT donor_id, year(gift_date) - CASE WHEN month(gift_date) < m THEN 1 ELSE 0 END AS y, min(gift_date) AS d FROM gift, m GROUP BY 1, 2),
r AS (SELECT y AS ry, CAST(make_date(y + 1, m, 1) - INTERVAL 1 DAY AS DATE) AS e, make_date(y, m, 1) AS s FROM (SELECT unnest(range(min(y), max(y) + 1)) AS y FROM fy), m),
c AS (SELECT donor_id, ry, s, e, min(y) AS f, coalesce(max(CASE WHEN y < ry THEN y END), 0) AS p, coalesce(max(CASE WHEN y < ry - 1 THEN y END), 0) AS pp
  FROM fy JOIN r ON y <= ry + 1 AND d <= e GROUP BY ALL)""") + """
SELECT donor_id, ry AS report_year, strftime(s, '%m/%d/%Y') || ' - ' || strftime(e, '%m/%d/%Y') AS report_period,
  (CASE WHEN f = ry THEN 'New' ELSE '' END) || (CASE WHEN f = ry - 1 THEN 'New Last Year' ELSE '' END) || (CASE WHEN ry - p > 1 AND f <> ry THEN 'Lapsed' ELSE '' END)
  || (CASE WHEN p = ry - 1 AND pp < ry - 2 AND f <> ry - 1 THEN 'Reinstated Last Year' ELSE '' END) || (CASE WHEN p = ry - 1 AND pp = ry - 2 THEN 'Consecutive Giver' ELSE '' END) AS fh_group FROM c""")
def x02b(spark, d):
    last = tables.gifts(spark, d).agg(F.max("gift_date")).scalar()
    groups = file_health.report_groups(tables.gifts(spark, d), "r12", None, last, START)
    return groups.select("donor_id", "report_year", "report_period", "fh_group")


@query("x04_capped_detail", with_views("gift", more="""
ys AS (SELECT donor_id, list_sort(list(DISTINCT gift_fy)) AS ys FROM gift GROUP BY 1), rs AS (SELECT unnest(range(min(gift_fy) + 1, max(gift_fy) + 2)) AS ry FROM gift), r AS (SELECT donor_id, ys, ry, ry - 1 AS c, ys[1] AS f FROM ys, rs),
v AS (SELECT *, list_contains(ys, c) AS g, list_contains(ys, c - 1) AS gb, c - coalesce(list_max(list_filter(ys, lambda y: y < c)), c) AS l, """ + RUN_SQL.format(r="ry") + """ AS run FROM r),
n AS (SELECT *, CASE WHEN l = 0 THEN 0 ELSE l - 1 END AS b FROM v)""") + """
SELECT donor_id, ry AS reference, CASE WHEN ry <= f THEN 'New' WHEN NOT g AND l = 0 THEN 'No Giving History'
  WHEN NOT g THEN 'Lapsed ' || CASE WHEN l >= 7 THEN '85+' ELSE (l * 12 + 1) || '-' || (l * 12 + 12) END
  WHEN g AND NOT gb AND c <> f AND b >= 1 THEN 'Reinstated Last Year ' || CASE WHEN b >= 7 THEN '85+' ELSE (b * 12 + 1) || '-' || (b * 12 + 12) END
  WHEN g AND gb THEN 'Consecutive Giver ' || CASE WHEN run >= 4 THEN '4+' ELSE CAST(run AS VARCHAR) END || ' Yrs' WHEN c = f THEN 'New Last Year' ELSE 'No Giving History' END AS detail FROM n""")
def x04(spark, d):
    years = tables.gifts(spark, d).groupBy("donor_id").agg(
        F.array_sort(F.collect_set(fiscal_year(F.col("gift_date"), START))).alias("ys"))
    span = years.agg(F.sequence(F.min(F.array_min("ys")) + 1, F.max(F.array_max("ys")) + 1)).scalar()
    rows = years.withColumn("reference", F.explode(span))
    return rows.select("donor_id", "reference", file_health.capped_detail(F.col("ys"), F.col("reference")).alias("detail"))


@query("a13_a14_file_health_measures", with_views("gift", more=GROUPS_SQL.strip() + """,
y AS (SELECT donor_id, gift_fy AS ry, count(*) AS n, sum(gift_amount) AS t FROM gift GROUP BY 1, 2),
m AS (SELECT grp, ry, count(*) AS u, count(n) AS resp, sum(t) AS rev, sum(n) AS gifts FROM g LEFT JOIN y USING (donor_id, ry) GROUP BY 1, 2 HAVING count(n) > 0),
a AS (SELECT grp, ry, u, resp, rev, gifts FROM m UNION ALL SELECT 'Total', ry, sum(u), sum(resp), sum(rev), sum(gifts) FROM m GROUP BY ry)""") + """
SELECT grp AS fh_group, strftime(make_date(ry - 1, 7, 1), '%m/%d/%Y') || ' - ' || strftime(make_date(ry, 6, 30), '%m/%d/%Y') AS report_period,
  CAST(u AS BIGINT) AS universe, CAST(resp AS BIGINT) AS responses, CAST(rev AS DOUBLE) AS revenue, CAST(gifts AS BIGINT) AS gifts,
  floor(CAST(resp AS DOUBLE) / CAST(u AS DOUBLE) * 10000 + 0.5) / 10000 AS retention, floor(CAST(gifts AS DOUBLE) / CAST(resp AS DOUBLE) * 100 + 0.5) / 100 AS gifts_per_donor,
  floor(CAST(rev AS DOUBLE) / CAST(resp AS DOUBLE) * 100 + 0.5) / 100 AS value_per_donor, floor(CAST(rev AS DOUBLE) / CAST(gifts AS DOUBLE) * 100 + 0.5) / 100 AS average_gift FROM a""")
def a13(spark, d):
    g = tables.gifts(spark, d)
    groups = file_health.report_groups(g, "fy", None, g.agg(F.max("gift_date")).scalar(), START)
    inside = g.groupBy("donor_id", fiscal_year(F.col("gift_date"), START).alias("report_year")).agg(
        F.count(F.lit(1)).alias("gifts"), F.sum("gift_amount").alias("revenue"))
    rows = groups.join(inside, ["donor_id", "report_year"], "left").select(
        "fh_group", "report_period", F.coalesce("gifts", F.lit(0)).alias("gifts"), F.coalesce("revenue", F.lit(0)).alias("revenue"))
    return file_health.measures(rows)


# ---- base tables ---------------------------------------------------------------------------

@query("x06_donor_table", with_views("gift", more="""
f AS (SELECT *, row_number() OVER (PARTITION BY donor_id ORDER BY gift_date, gift_amount DESC, gift_id) AS n, row_number() OVER (PARTITION BY donor_id ORDER BY gift_date DESC, gift_amount DESC, gift_id DESC) AS m FROM gift),
a AS (SELECT donor_id, min(gift_date) AS lo, max(gift_date) AS hi, count(*) AS gifts, min(gift_amount) AS mi, max(gift_amount) AS ma, CAST(sum(gift_amount) AS DOUBLE) / count(*) AS av,
  min(CASE WHEN gift_amount >= 10000 THEN gift_date END) AS b0, max(CASE WHEN gift_amount >= 10000 THEN gift_date END) AS b1 FROM gift GROUP BY 1)""") + """
SELECT a.donor_id, CAST(lo AS VARCHAR) AS first_gift_date, CAST(hi AS VARCHAR) AS last_gift_date, gifts, CAST(mi AS DOUBLE) AS min_gift_amount, CAST(ma AS DOUBLE) AS max_gift_amount,
  av AS donor_average_gift, CAST(b0 AS VARCHAR) AS min_major_gift_date, CAST(b1 AS VARCHAR) AS max_major_gift_date, (date_diff('day', lo, hi) + 1) / 365.0::DOUBLE AS lifespan,
  date_diff('day', lo, hi) + 1 >= 730 AS core_donor, year(lo) AS join_cy, f.gift_fy AS join_fy, month(lo) AS join_month, 10000 AS major_gift_definition,
  f.gift_id AS join_gift_id, CAST(f.gift_amount AS DOUBLE) AS join_gift_amount, f.channel AS join_channel, f.gift_type AS join_gift_type, l.channel AS channel_last_gift
FROM a JOIN f ON f.donor_id = a.donor_id AND f.n = 1 JOIN f l ON l.donor_id = a.donor_id AND l.m = 1""")
def x06(spark, d):
    return base_tables.donor_table(tables.gifts(spark, d), START, last={"channel_last_gift": "channel"})


@query("x07_gift_table", with_views("gift", "code").rstrip() + """
SELECT gift_id, donor_id, 'B' || substr(channel, 1, 1) || (gift_id % 3) AS campaign_code, row_number() OVER (PARTITION BY donor_id ORDER BY gift_date, gift_amount DESC, gift_id) AS donor_gift_number,
  'B' || substr(channel, 1, 1) || (gift_id % 3) IN (SELECT campaign_code FROM code) AS tracked_campaign FROM gift""")
def x07(spark, d):
    g = tables.gifts(spark, d).withColumn("campaign_code", F.concat(F.lit("B"), F.substring("channel", 1, 1), (F.col("gift_id") % 3).cast("string")))
    return base_tables.gift_table(g, tables.parts(spark, d)).select("gift_id", "donor_id", "campaign_code", "donor_gift_number", "tracked_campaign")


@query("x08_standard_source_codes", with_views("code", more="""
k AS (SELECT *, CASE WHEN quantity > 5 THEN make_date(CAST(1995 + quantity % 6 AS INTEGER), CAST(part_id % 12 + 1 AS INTEGER), 15) END AS mailed FROM code),
f AS (SELECT *, year(mailed) + CASE WHEN month(mailed) >= 7 THEN 1 ELSE 0 END AS fy, CASE WHEN quantity % 2 = 0 THEN campaign_name END AS cn FROM k WHERE mailed IS NOT NULL),
n AS (SELECT *, coalesce(cn, 'FY' || substr(CAST(fy AS VARCHAR), 3, 2) || '_' || monthname(mailed) || '_' || package_name) AS nm FROM f)""") + """
SELECT part_id, source_code, fy, nm AS campaign_name, 'load_source_codes' AS source, 'ACME-' || campaign_code || '-' || nm || '-MD_FY' || fy AS client_campaign,
  dense_rank() OVER (ORDER BY source_code) - 1 AS source_code_key, 'ACME_sc_' || (dense_rank() OVER (ORDER BY source_code) - 1) AS sc_key_curated FROM n""")
def x08(spark, d):
    q, p = F.col("quantity"), F.col("part_id")
    mailed = F.make_date((1995 + q % 6).cast("int"), (p % 12 + 1).cast("int"), F.lit(15))
    k = tables.parts(spark, d).withColumns({"mail_date": F.when(q > 5, mailed), "campaign_name": F.when(q % 2 == 0, F.col("campaign_name"))})
    out = base_tables.numbered_codes(base_tables.standard_source_codes(k, "Acme", START), "Acme", "sc")
    return out.select("part_id", "source_code", "fy", "campaign_name", "source", "client_campaign", "source_code_key", "sc_key_curated")


@query("x08_unsourced_placeholders", with_views("gift", more="y AS (SELECT CAST(unnest(range(min(year(gift_date)) - 1, max(year(gift_date)) + 1)) AS VARCHAR) AS y FROM gift UNION ALL SELECT 'XXXX' FROM gift HAVING count(*) > 0)") + """
SELECT 'Acme' AS client, 'UNSOURCED-FY' || y AS source_code, 'UNSOURCED-FY' || y AS campaign_code, 'Unsourced FY' || y AS campaign_name, 'ACME-UNSOURCED-FY' || y AS client_campaign,
  TRY_CAST(y AS BIGINT) AS fy, y || '-07-01' AS mail_date, 'unsourced fallbacks' AS source FROM y WHERE y <> 'XXXX'
UNION ALL SELECT 'Acme', 'UNSOURCED-FYXXXX', 'UNSOURCED-FYXXXX', 'Unsourced FYXXXX', 'ACME-UNSOURCED-FYXXXX', NULL, NULL, 'unsourced fallbacks' FROM y WHERE y = 'XXXX'""")
def x08b(spark, d):
    return base_tables.unsourced_years(tables.gifts(spark, d), "Acme", START)


@query("x08_inferred_codes", with_views("mail", more="""
k AS (SELECT source_code, campaign_code, package_name AS campaign_group FROM code WHERE quantity <= 44),
t AS (SELECT source_code, CASE WHEN line < 5 THEN campaign_code END AS campaign_code, CASE WHEN line < 3 THEN campaign_name END AS campaign_name, mail_date,
  year(mail_date) + CASE WHEN month(mail_date) >= 7 THEN 1 ELSE 0 END AS fy FROM mail WHERE source_code NOT IN (SELECT source_code FROM k)),
f AS (SELECT source_code, fy, min(mail_date) AS d FROM t GROUP BY 1, 2),
o AS (SELECT DISTINCT t.source_code, t.campaign_code, t.campaign_name, f.d, t.fy FROM t JOIN f USING (source_code, fy)),
n AS (SELECT campaign_code, campaign_group, row_number() OVER (PARTITION BY campaign_code ORDER BY campaign_group) AS r FROM (SELECT DISTINCT campaign_code, campaign_group FROM k))""") + """
SELECT o.source_code, o.campaign_code, o.campaign_name, CAST(o.d AS VARCHAR) AS mail_date, o.fy, n.campaign_group, 'inferred from trx' AS source,
  CASE WHEN o.campaign_code IS NOT NULL AND o.campaign_name IS NOT NULL THEN 'ACME-' || o.campaign_code || '-' || o.campaign_name WHEN o.campaign_code IS NOT NULL THEN 'ACME-' || o.campaign_code
    ELSE 'ACME-' || o.source_code END || '-MD_FY' || o.fy AS client_campaign FROM o LEFT JOIN n ON n.campaign_code = o.campaign_code AND n.r = 1""")
def x08c(spark, d):
    k = tables.parts(spark, d).filter("quantity <= 44").select("source_code", "campaign_code", F.col("package_name").alias("campaign_group"))
    g = tables.mailings(spark, d).select(
        "source_code", F.when(F.col("line") < 5, F.col("campaign_code")).alias("campaign_code"),
        F.when(F.col("line") < 3, F.col("campaign_name")).alias("campaign_name"), F.col("mail_date").alias("gift_date"))
    return base_tables.inferred_codes(g, k, "Acme", START).drop("client")


@query("x09_transactions", with_views("raw", more="""
r AS (SELECT k, CASE WHEN k % 19 <> 0 THEN CAST(k AS VARCHAR) END AS gift_id, CASE WHEN donor_id <> 'nan' THEN replace(donor_id, '.0', '') END AS donor_id, gift_date, gift_amount,
  appeal_category AS appeal, gift_type FROM raw WHERE gift_type <> 'O'),
m AS (SELECT DISTINCT gift_id, donor_id, gift_date, gift_amount, appeal, gift_type FROM r WHERE gift_id IS NULL),
t AS (SELECT gift_id, donor_id, gift_date, gift_amount, appeal, gift_type FROM r WHERE gift_id IS NOT NULL UNION ALL
  SELECT '_' || (row_number() OVER (ORDER BY gift_date NULLS LAST, donor_id NULLS LAST, gift_amount NULLS LAST, appeal NULLS LAST, gift_type NULLS LAST) - 1), donor_id, gift_date, gift_amount, appeal, gift_type FROM m)""") + """
SELECT gift_id, donor_id, CAST(gift_date AS VARCHAR) AS gift_date, gift_amount, appeal, gift_type, 'ACME' AS client,
  month(gift_date) AS gift_month, year(gift_date) AS gift_cy, year(gift_date) + CASE WHEN month(gift_date) >= 7 THEN 1 ELSE 0 END AS gift_fy
FROM t WHERE donor_id IS NOT NULL AND gift_amount <> 0""")
def x09(spark, d):
    raw = tables.raw_gifts(spark, d)
    key = F.regexp_extract("Gift ID", "^[0-9]+", 0).cast("long")
    raw = raw.withColumn("Gift ID", F.when(key % 38 == 0, F.lit("nan")).when(key % 19 != 0, F.col("Gift ID")))
    return base_tables.transactions(raw, {"appeal_category": "appeal"}, [("isin", "Gift Type", ["O"], False)], "ACME", START)


# ---- sustainers ----------------------------------------------------------------------------------

@query("b11_sustainer_status", with_views("gift", more="""
c AS (SELECT CAST(date_trunc('month', max(gift_date)) - INTERVAL 1 MONTH AS DATE) AS m FROM gift),
k AS (SELECT donor_id, min(CASE WHEN gift_type = 'F' AND date_trunc('month', gift_date) <= m THEN (year(m) - year(gift_date)) * 12 + month(m) - month(gift_date) END) AS months_since FROM gift, c GROUP BY 1)""") + """
SELECT donor_id, months_since, CASE WHEN months_since IS NULL THEN 'N/A' WHEN months_since = 0 THEN 'Active' WHEN months_since <= 5 THEN 'Lapsing- Short'
  WHEN months_since <= 11 THEN 'Lapsing-Long' ELSE 'Lapsed' END AS sustainer_status FROM k""")
def b11(spark, d):
    return sustainers.sustainer_status(tables.gifts(spark, d), F.col("gift_type") == "F")


@query("b15_sustainer_recency", with_views("gift", more="""
r AS (SELECT g.gift_id, g.gift_date, max(s.gift_date) AS e FROM gift g LEFT JOIN gift s ON s.donor_id = g.donor_id AND s.gift_type = 'F' AND s.gift_date < g.gift_date GROUP BY 1, 2)""") + """
SELECT gift_id, CAST(e AS VARCHAR) AS recent_sust_date, CAST(floor(date_diff('day', e, gift_date) / 30.436875::DOUBLE + 0.5) AS BIGINT) AS sust_months,
  """ + band_sql("floor(date_diff('day', e, gift_date) / 30.436875::DOUBLE + 0.5)", RECENCY, "Z: None") + """ AS sust_recency FROM r""")
def b15(spark, d):
    return sustainers.sustainer_recency(tables.gifts(spark, d), F.col("gift_type") == "F").select("gift_id", "recent_sust_date", "sust_months", "sust_recency")


@query("x10_sustainer_fields", with_views("gift", more="""
f AS (SELECT donor_id, min(CASE WHEN gift_type = 'F' THEN gift_date END) AS s FROM gift GROUP BY 1),
j AS (SELECT g.*, f.s, g.gift_date >= f.s AS since FROM gift g JOIN f USING (donor_id)),
c AS (SELECT donor_id, arg_min(channel, (gift_date, gift_id)) AS src, count(*) AS n FROM j WHERE since GROUP BY 1)""") + """
SELECT j.gift_id, CASE WHEN gift_type = 'F' THEN 'Sustainer Gift' ELSE '1X Gift' END AS sustainer_gift_flag, CAST(s AS VARCHAR) AS first_sustainer_date,
  CASE WHEN coalesce(since, false) OR (s <= make_date(CAST(gift_fy AS INTEGER), 6, 30) AND coalesce(n, 0) >= 1) THEN 'Sustainer' ELSE '1X Giver' END AS sustainer_flag, src AS sustainer_join_source,
  CASE WHEN since THEN year(s) + CASE WHEN month(s) >= 7 THEN 1 ELSE 0 END END AS sustainer_join_fiscal, CASE WHEN since THEN month(s) END AS sustainer_join_month
FROM j LEFT JOIN c USING (donor_id)""")
def x10(spark, d):
    return sustainers.sustainer_fields(tables.gifts(spark, d), F.col("gift_type") == "F", START, 6, 30).select(
        "gift_id", "sustainer_gift_flag", "first_sustainer_date", "sustainer_flag", "sustainer_join_source",
        "sustainer_join_fiscal", "sustainer_join_month")


MEMBERS_SQL = """
f AS (SELECT donor_id, min(gift_date) AS f0, min(CASE WHEN gift_type = 'F' THEN gift_date END) AS s FROM gift GROUP BY 1),
r AS (SELECT g.*, f0, s FROM gift g JOIN f USING (donor_id) WHERE g.gift_date >= s),
e AS (SELECT *, max(CASE WHEN gift_type = 'F' THEN gift_date END) OVER (PARTITION BY donor_id ORDER BY gift_date) AS e FROM r),
dd AS (SELECT DISTINCT donor_id, gift_date, e FROM e),
jj AS (SELECT *, row_number() OVER w AS n, date_diff('day', lag(e) OVER w, e) AS j FROM dd WINDOW w AS (PARTITION BY donor_id ORDER BY gift_date)),
mm AS (SELECT *, max(CASE WHEN n = 1 OR j > 183 THEN e END) OVER (PARTITION BY donor_id ORDER BY gift_date) AS ms FROM jj),
mb AS (SELECT e.*, ms, date_diff('day', e.e, e.gift_date) AS delta, date_diff('day', ms, e.gift_date) AS dj, year(ms) + CASE WHEN month(ms) >= 7 THEN 1 ELSE 0 END AS jfy FROM e JOIN mm USING (donor_id, gift_date))"""
BOUNDS = [sustainers.year_bounds(y) for y in sustainers.YEARS]


@query("x11_memberships", with_views("gift", more=MEMBERS_SQL.strip()) + """
SELECT gift_id, CAST(e AS VARCHAR) AS recent_sust_date, CAST(ms AS VARCHAR) AS membership_start, gift_fy, CASE WHEN gift_type = 'F' THEN 'Sustainer' ELSE '1x' END AS sust_gift_flag,
  CASE WHEN f0 = s THEN 'New' ELSE 'Converted' END AS sustainer_type, CASE WHEN delta <= 183 THEN 'Active' ELSE 'Lapsed' END AS sustainer_status, jfy AS sust_join_fy, dj AS days_since_join FROM mb""")
def x11(spark, d):
    return sustainers.memberships(tables.gifts(spark, d), F.col("gift_type") == "F", START).select(
        "gift_id", "recent_sust_date", "membership_start", "gift_fy", "sust_gift_flag", "sustainer_type", "sustainer_status",
        "sust_join_fy", "days_since_join")


@query("x11_cohort_flags", with_views("gift", more=MEMBERS_SQL.strip() + """,
ac AS (SELECT * FROM mb WHERE delta <= 183), sp AS (SELECT donor_id, ms, date_diff('day', min(gift_date), max(gift_date)) AS days_on_file FROM ac GROUP BY 1, 2)""") + "\nSELECT gift_id, days_on_file, " + ", ".join(
    f"CASE WHEN dj > {lo} AND dj <= {hi} THEN 1 ELSE 0 END AS active_{y}, CASE WHEN dj <= {y * 365} THEN 1 ELSE 0 END AS ltv_{y}, "
    f"max(CASE WHEN dj > {lo} AND dj <= {hi} THEN 1 ELSE 0 END) OVER (PARTITION BY donor_id, jfy) AS donor_{y}"
    for y, (lo, hi) in zip(sustainers.YEARS, BOUNDS)) + " FROM ac JOIN sp USING (donor_id, ms)")
def x11b(spark, d):
    return sustainers.cohort(tables.gifts(spark, d), F.col("gift_type") == "F", START).select("gift_id", "days_on_file", *[f"{k}_{y}" for y in sustainers.YEARS for k in ("active", "ltv", "donor")])


@query("x11_retention", with_views("gift", more=MEMBERS_SQL.strip() + ", ac AS (SELECT * FROM mb WHERE delta <= 183)") + "\nSELECT jfy AS sust_join_fy, count(DISTINCT donor_id) AS donors, " + ", ".join(
    f"count(DISTINCT CASE WHEN dj > {lo} AND dj <= {hi} THEN donor_id END) / count(DISTINCT donor_id) AS retained_{y}"
    for y, (lo, hi) in zip(sustainers.YEARS, BOUNDS)) + " FROM ac GROUP BY jfy")
def x11c(spark, d):
    return sustainers.retention(tables.gifts(spark, d), F.col("gift_type") == "F", START)


@query("x12_upgrade_downgrade", with_views("gift", more="""
t AS (SELECT donor_id, gift_fy AS yr, sum(gift_amount) AS total FROM gift GROUP BY 1, 2), hi AS (SELECT max(yr) AS hi FROM t),
f AS (SELECT donor_id, min(yr) AS lo FROM t GROUP BY 1), g AS (SELECT donor_id, unnest(range(lo, hi + 1)) AS yr FROM f, hi),
c AS (SELECT *, coalesce(total - lag(total) OVER (PARTITION BY donor_id ORDER BY yr), 0) AS change FROM t),
l AS (SELECT g.donor_id, g.yr, c.total, c.change, p.total AS prev FROM g LEFT JOIN c USING (donor_id, yr) LEFT JOIN t p ON p.donor_id = g.donor_id AND p.yr = g.yr - 1),
k AS (SELECT donor_id, yr, total, prev, last_value(change IGNORE NULLS) OVER (PARTITION BY donor_id ORDER BY yr ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS change FROM l)""") + """
SELECT donor_id, yr, CAST(total AS DOUBLE) AS total, CAST(change AS DOUBLE) AS change, CASE WHEN total IS NULL AND prev IS NULL THEN 'NoRecentGiving' WHEN total IS NULL THEN 'NoCurrentYearGiving'
  WHEN prev IS NULL THEN 'NoPreviousYearGiving' WHEN change > 0 THEN 'Upgrade' WHEN change < 0 THEN 'Downgrade' ELSE 'Same' END AS upgrade_downgrade FROM k""")
def x12(spark, d):
    return sustainers.upgrade_downgrade(tables.gifts(spark, d), START)


# ---- campaigns -----------------------------------------------------------------------------------

@query("x13_join_groups", with_views("gift", more="""
f AS (SELECT donor_id, min(gift_date) AS d, arg_min(CASE channel WHEN '1-URGENT' THEN 'DM' WHEN '5-LOW' THEN 'Digital' ELSE 'Other' END, (gift_date, gift_id)) AS c, max(gift_date) AS l FROM gift GROUP BY 1),
s AS (SELECT g.donor_id, min(g.gift_date) AS s FROM gift g JOIN f USING (donor_id) WHERE g.gift_date > f.d GROUP BY 1)""") + """
SELECT donor_id, c AS join_channel, c || '-' || CASE WHEN d BETWEEN DATE '1995-02-24' AND DATE '1995-05-31' THEN 'spring95' ELSE 'spring96' END AS join_group, date_diff('day', d, s) AS days_to_second_gift,
  date_diff('day', d, l) > 365 AS gave_after_one_year FROM f LEFT JOIN s USING (donor_id)
WHERE c <> 'Other' AND (d BETWEEN DATE '1995-02-24' AND DATE '1995-05-31' OR d BETWEEN DATE '1996-02-24' AND DATE '1996-05-31')""")
def x13(spark, d):
    g = tables.gifts(spark, d)
    channel = classify([(is_in(F.col("channel"), ["1-URGENT"]), "DM"), (is_in(F.col("channel"), ["5-LOW"]), "Digital")], "Other")
    groups = campaigns.join_groups(g, channel, {"spring95": ("1995-02-24", "1995-05-31"), "spring96": ("1996-02-24", "1996-05-31")})
    second = second_gift(g, "donor_id", "gift_date", "gift_amount", "gift_id").select("donor_id", "days_to_second_gift", "days_on_file")
    return groups.filter(F.col("join_group").isNotNull()).join(second, "donor_id", "left").select(
        "donor_id", "join_channel", "join_group", "days_to_second_gift", (F.col("days_on_file") > 365).alias("gave_after_one_year"))


CURVE_VIEWS = """
m0 AS (SELECT campaign_code || '-' || year(mail_date) AS campaign, mail_date AS d, revenue FROM mail),
m1 AS (SELECT campaign, min(d) AS md, sum(revenue) AS budget FROM m0 GROUP BY 1),
dl AS (SELECT campaign, CAST(date_diff('day', md, d) AS BIGINT) AS x FROM m0 JOIN m1 USING (campaign)),
st AS (SELECT campaign, CAST(count(*) AS DOUBLE) AS n, CAST(sum(x) AS DOUBLE) AS s1, CAST(sum(x * x) AS DOUBLE) AS s2 FROM dl GROUP BY 1),
mv AS (SELECT campaign, n, s1 / n AS mean, (s2 - CAST(s1 AS DOUBLE) * s1 / n) / (n - 1) AS var FROM st WHERE n > 1),
fit AS (SELECT campaign, CAST(n AS BIGINT) AS n, mean * mean / var AS shape, var / mean AS scale FROM mv WHERE var > 0 AND mean > 0 AND mean * mean / var BETWEEN 0.3 AND 5)"""


def campaign_days(spark, d):
    """Mailings as responses: each campaign year, its first day and the days since."""
    m = tables.mailings(spark, d).select(
        F.concat("campaign_code", F.lit("-"), F.year("mail_date").cast("string")).alias("campaign"), F.col("mail_date").alias("gift_date"), "revenue")
    sent = m.groupBy("campaign").agg(F.min("gift_date").alias("mail_date"), F.sum("revenue").alias("budget"))
    return response_curve.response_days(m, sent, "campaign", "gift_date", "mail_date"), sent


@query("x14_gamma_fit", with_views("mail", more=CURVE_VIEWS.strip()) + "SELECT campaign, n, round(shape, 9) AS shape, 0.0::DOUBLE AS loc, round(scale, 9) AS scale FROM fit")
def x14(spark, d):
    fits = response_curve.fit_campaigns(campaign_days(spark, d)[0], "campaign")
    return fits.withColumns({"shape": F.round("shape", 9), "scale": F.round("scale", 9)})


CDF_SQL = """list_sum(list_transform(range(0, 401), lambda k: exp(k * ln({z}) - (lgamma({a} + k + 1) - lgamma({a} + 1)) - {z} + {a} * ln({z}) - lgamma({a} + 1))))"""


@query("x14_average_curve", with_views("mail", more=CURVE_VIEWS.strip() + """,
av AS (SELECT avg(shape) AS a, avg(scale) AS b FROM fit), dy AS (SELECT unnest(range(0, 341)) AS dd FROM av)""") + f"""
SELECT 'ALL' AS curve, dd AS "day", round(100 * CASE WHEN dd = 0 THEN 0 ELSE {CDF_SQL.format(z='(dd / b)', a='a')} END, 6) AS percent_complete FROM dy, av""")
def x14b(spark, d):
    average = response_curve.average_curve(response_curve.fit_campaigns(campaign_days(spark, d)[0], "campaign"))
    return response_curve.curve_table(average.withColumn("curve", F.lit("ALL")), "curve").withColumn(
        "percent_complete", F.round("percent_complete", 6))


@query("x14_observed_curve", with_views("mail", more=CURVE_VIEWS.strip() + ", c AS (SELECT campaign, x, count(*) AS n FROM dl GROUP BY 1, 2)") + """
SELECT campaign, x AS days, CAST(sum(n) OVER (PARTITION BY campaign ORDER BY x) AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY campaign) AS DOUBLE) AS share FROM c""")
def x14c(spark, d):
    return response_curve.cumulative_share(campaign_days(spark, d)[0], "campaign")


@query("x15_campaign_selection", with_views("mail", more="c AS (SELECT DISTINCT campaign_code || '-' || year(mail_date) AS campaign FROM mail)") + """
SELECT 'start and end' AS rule, campaign FROM c WHERE regexp_matches(campaign, '^(B1|B25)') AND regexp_matches(campaign, '(1998|1999)$') AND regexp_matches(substr(campaign, 3, 2), '1-|-1')
UNION ALL SELECT 'contains', campaign FROM c WHERE regexp_matches(campaign, '(?i)b2|-2001')""")
def x15(spark, d):
    c = tables.mailings(spark, d).select(F.concat("campaign_code", F.lit("-"), F.year("mail_date").cast("string")).alias("campaign")).distinct()
    a = campaigns.select_campaigns(c, "campaign", ["B1", "B25"], ["1998", "1999"], years=["1-", "-1"], year_position=2)
    b = campaigns.select_campaigns(c, "campaign", contains=["b2", "-2001"])
    return a.select(F.lit("start and end").alias("rule"), "campaign").unionAll(b.select(F.lit("contains"), "campaign"))


@query("x15_running_campaigns", with_views("mail") + """
SELECT source_code || '-' || year(mail_date) AS campaign, CAST(min(mail_date) AS VARCHAR) AS first_gift, CAST(max(mail_date) AS VARCHAR) AS last_gift FROM mail GROUP BY 1
HAVING count(*) FILTER (year(mail_date) + CASE WHEN month(mail_date) >= 7 THEN 1 ELSE 0 END = 2001) > 0 AND date_diff('day', min(mail_date), max(mail_date)) < 340""")
def x15b(spark, d):
    m = tables.mailings(spark, d).withColumn("campaign", F.concat("source_code", F.lit("-"), F.year("mail_date").cast("string")))
    return campaigns.running_campaigns(m, "campaign", "mail_date", START, F.lit(2001))


FLOW_VIEWS = CURVE_VIEWS.strip() + """,
b0 AS (SELECT campaign, md, budget, shape AS a, scale AS b FROM fit JOIN m1 USING (campaign)),
b1 AS (SELECT *, unnest(range(0, 12)) AS i FROM b0),
b2 AS (SELECT *, CAST(date_trunc('month', md) + to_months(CAST(i AS INTEGER)) AS DATE) AS month,
  date_diff('day', md, last_day(CAST(md + to_months(CAST(i AS INTEGER)) AS DATE))) AS hi, CASE WHEN i = 0 THEN 0 ELSE date_diff('day', md, last_day(CAST(md + to_months(CAST(i - 1 AS INTEGER)) AS DATE))) END AS lo FROM b1),
b3 AS (SELECT campaign, month, budget, CASE WHEN hi = 0 THEN 0 WHEN hi / b > 200 THEN 1 ELSE """ + CDF_SQL.format(z="(hi / b)", a="a") + """ END AS c1,
  CASE WHEN lo = 0 THEN 0 WHEN lo / b > 200 THEN 1 ELSE """ + CDF_SQL.format(z="(lo / b)", a="a") + """ END AS c0 FROM b2)"""


def flows(spark, d):
    days, sent = campaign_days(spark, d)
    fits = response_curve.fit_campaigns(days, "campaign").drop("n")
    return response_curve.cash_flow(fits.join(sent, "campaign"), "campaign", "mail_date", "budget"), sent


@query("x16_cash_flow", with_views("mail", more=FLOW_VIEWS) + """
SELECT campaign, CAST(month AS VARCHAR) AS month, CAST(CAST(round(c1 - c0, 6) AS DECIMAL(9,6)) AS DOUBLE) AS share,
  CAST(CAST(budget AS DECIMAL(18,2)) * CAST(round(c1 - c0, 6) AS DECIMAL(9,6)) AS DOUBLE) AS amount FROM b3""")
def x16(spark, d):
    return flows(spark, d)[0]


@query("x16_monthly_totals", with_views("mail", more=FLOW_VIEWS + """,
t AS (SELECT month, sum(CAST(budget AS DECIMAL(18,2)) * CAST(round(c1 - c0, 6) AS DECIMAL(9,6))) AS total FROM b3 GROUP BY 1),
sp AS (SELECT CAST(unnest(generate_series(date_trunc('month', min(md)), CAST(max(md) + INTERVAL 12 MONTH AS DATE), INTERVAL 1 MONTH)) AS DATE) AS month FROM m1)""") + """
SELECT CAST(month AS VARCHAR) AS month, CAST(coalesce(total, 0) AS DOUBLE) AS total FROM sp LEFT JOIN t USING (month)""")
def x16b(spark, d):
    flow, sent = flows(spark, d)
    return response_curve.monthly_totals(flow, month_spine(sent, "mail_date"))


CODES = [f"B{n}" for n in range(1, 26)]  # the brands of the parts table


@query("x16_month_by_campaign", with_views("mail", more=FLOW_VIEWS + """,
f AS (SELECT month, split_part(campaign, '-', 1) AS c, CAST(budget AS DECIMAL(18,2)) * CAST(round(c1 - c0, 6) AS DECIMAL(9,6)) AS amount FROM b3)""") + f"""
SELECT CAST(month AS VARCHAR) AS month, {', '.join(f"CAST(coalesce(sum(amount) FILTER (c = '{c}'), 0) AS DOUBLE) AS {c}" for c in CODES)},
  CAST(sum(amount) AS DOUBLE) AS monthly_total FROM f GROUP BY 1""")
def x16c(spark, d):
    flow = flows(spark, d)[0].withColumn("campaign", F.split_part("campaign", F.lit("-"), F.lit(1)))
    return response_curve.flow_table(flow, "campaign", CODES)


# ---- curves of greatest likelihood: letters thank for a gift day, responses are the donor's next gift days ----

PSI_SQL = "(ln({a} + 8) - 1 / (2 * ({a} + 8)) - 1 / (12 * pow({a} + 8, 2)) + 1 / (120 * pow({a} + 8, 4)) - 1 / (252 * pow({a} + 8, 6)) + 1 / (240 * pow({a} + 8, 8)) - " + " - ".join(
    f"1 / ({{a}} + {k})" for k in range(8)) + ")"


def best_shape_sql(name: str, source: str) -> str:
    """View with ln(a) - digamma(a) = gap for each row of ``source``, by halving; a lies between 1 / (2 gap) and 1 / gap."""
    low = f"ln((lo + hi) / 2) - {PSI_SQL.format(a='((lo + hi) / 2)')} > gap"
    return f"""{name}_h AS (SELECT 0 AS i, campaign, k, gap, 0.5 / gap AS lo, 1 / gap AS hi FROM {source}
  UNION ALL SELECT i + 1, campaign, k, gap, CASE WHEN {low} THEN (lo + hi) / 2 ELSE lo END, CASE WHEN {low} THEN hi ELSE (lo + hi) / 2 END FROM {name}_h WHERE i < 60),
{name} AS (SELECT campaign, k, (lo + hi) / 2 AS a FROM {name}_h WHERE i = 60)"""


def weighted_mean_sql(f: str) -> str:
    return f"list_sum(list_transform(range(1, len(xs) + 1), lambda j: ws[j] * {f})) / n"


LOGS = weighted_mean_sql("ln(xs[j] + (near + far) / 2)")
INVERSES = weighted_mean_sql("1 / (xs[j] + (near + far) / 2)")
LIKELY_VIEWS = f"""nx AS (SELECT strftime(gift_date, '%Y-%m') AS campaign, date_diff('day', gift_date, lead(gift_date) OVER (PARTITION BY donor_id ORDER BY gift_date)) AS x
  FROM (SELECT DISTINCT donor_id, gift_date FROM gift)),
hs AS (SELECT campaign, x, CAST(count(*) AS DOUBLE) AS w FROM nx WHERE x IS NOT NULL GROUP BY 1, 2),
cs AS (SELECT campaign, sum(w) AS n, CAST(min(x) AS DOUBLE) AS mn, sum(w * x) / sum(w) - min(x) AS above, sqrt((sum(w * x * x) - sum(w * x) * sum(w * x) / sum(w)) / sum(w)) AS sd,
  list(CAST(x AS DOUBLE) ORDER BY x) AS x0, list(w ORDER BY x) AS ws FROM hs GROUP BY 1 HAVING count(*) > 1),
cp AS (SELECT * EXCLUDE (x0), list_transform(x0, lambda v: v - mn) AS xs FROM cs),
gr AS (SELECT *, 0.5 * pow(greatest(8 * sd / 0.5, 2), k / 16.0) AS d FROM (SELECT *, unnest(range(0, 17)) AS k FROM cp)),
gp AS (SELECT *, ln(above + d) - {weighted_mean_sql("ln(xs[j] + d)")} AS gap FROM gr),
{best_shape_sql('s1', 'gp')},
hg AS (SELECT campaign, k, d, -a * ln((above + d) / a) - lgamma(a) + (a - 1) * (ln(above + d) - gap) - a AS height FROM gp JOIN s1 USING (campaign, k)),
tp AS (SELECT campaign, arg_max(k, height) AS top FROM hg GROUP BY 1),
rf AS (SELECT 0 AS i, campaign, max(d) FILTER (k = greatest(top - 1, 0)) AS near, max(d) FILTER (k = top + 1) AS far FROM hg JOIN tp USING (campaign) WHERE top < 16 GROUP BY campaign
  UNION ALL SELECT i + 1, campaign, CASE WHEN rises THEN near ELSE (near + far) / 2 END, CASE WHEN rises THEN (near + far) / 2 ELSE far END FROM (
    SELECT i, campaign, near, far, ln(above + (near + far) / 2) - logs > ln(lv / (lv - 1)) - {PSI_SQL.format(a='(lv / (lv - 1))')} AS rises FROM (
      SELECT i, campaign, near, far, above, {LOGS} AS logs, (above + (near + far) / 2) * {INVERSES} AS lv FROM rf JOIN cp USING (campaign) WHERE i < 40))),
fd AS (SELECT campaign, 0 AS k, n, mn, above, (near + far) / 2 AS d, ln(above + (near + far) / 2) - {LOGS} AS gap FROM rf JOIN cp USING (campaign) WHERE i = 40),
{best_shape_sql('s2', 'fd')},
lf AS (SELECT campaign, CAST(n AS BIGINT) AS n, a AS shape, mn - d AS loc, (above + d) / a AS scale FROM fd JOIN s2 USING (campaign) WHERE a BETWEEN 0.3 AND 5)"""


def likely_sql(more: str = "") -> str:
    return with_views("gift", more=LIKELY_VIEWS + more).replace("WITH", "WITH RECURSIVE", 1)


def thanks_days(spark, d):
    """One row per donor and gift day: its month as campaign and the days to the donor's next gift day."""
    return next_gift_days(tables.gifts(spark, d), "donor_id", "gift_date").select(
        F.date_format("gift_date", "yyyy-MM").alias("campaign"), F.col("days_to_next").alias("days")).filter("days IS NOT NULL")


@query("x14_likelihood_fit", likely_sql() + "SELECT campaign, n, round(shape, 6) AS shape, round(loc, 6) AS loc, round(scale, 6) AS scale FROM lf")
def x14d(spark, d):
    fits = response_curve.fit_likelihood(thanks_days(spark, d), "campaign")
    return fits.withColumns({c: F.round(c, 6) for c in ("shape", "loc", "scale")})


@query("x16_likelihood_flow", likely_sql(""",
mb AS (SELECT strftime(gift_date, '%Y-%m') AS campaign, CAST(date_trunc('month', min(gift_date)) AS DATE) AS md, sum(gift_amount) AS budget FROM gift GROUP BY 1),
b1 AS (SELECT campaign, md, budget, shape AS a, loc AS l, scale AS b, unnest(range(0, 12)) AS i FROM lf JOIN mb USING (campaign)),
b2 AS (SELECT *, CAST(md + to_months(CAST(i AS INTEGER)) AS DATE) AS month, date_diff('day', md, last_day(CAST(md + to_months(CAST(i AS INTEGER)) AS DATE))) - l AS hi,
  CASE WHEN i = 0 THEN 0 ELSE date_diff('day', md, last_day(CAST(md + to_months(CAST(i - 1 AS INTEGER)) AS DATE))) END - l AS lo FROM b1),
b3 AS (SELECT campaign, month, budget, CASE WHEN hi <= 0 THEN 0 WHEN hi / b > 200 THEN 1 ELSE """ + CDF_SQL.format(z="(hi / b)", a="a") + """ END AS c1,
  CASE WHEN lo <= 0 THEN 0 WHEN lo / b > 200 THEN 1 ELSE """ + CDF_SQL.format(z="(lo / b)", a="a") + """ END AS c0 FROM b2)""") + """
SELECT campaign, CAST(month AS VARCHAR) AS month, CAST(CAST(round(least(c1, 1) - least(c0, 1), 6) AS DECIMAL(9,6)) AS DOUBLE) AS share,
  CAST(CAST(budget AS DECIMAL(18,2)) * CAST(round(least(c1, 1) - least(c0, 1), 6) AS DECIMAL(9,6)) AS DOUBLE) AS amount FROM b3""")
def x16d(spark, d):
    fits = response_curve.fit_likelihood(thanks_days(spark, d), "campaign").drop("n")
    month = F.date_format("gift_date", "yyyy-MM").alias("campaign")
    letters = tables.gifts(spark, d).groupBy(month).agg(
        F.trunc(F.min("gift_date"), "month").alias("mail_date"), F.sum("gift_amount").alias("budget"))
    return response_curve.cash_flow(fits.join(letters, "campaign"), "campaign", "mail_date", "budget")


@query("x17_campaign_counts", with_views("mail") + 'SELECT campaign_code, count(*) AS "count", CAST(min(mail_date) AS VARCHAR) AS first_mail_date FROM mail GROUP BY 1')
def x17(spark, d):
    return campaigns.campaign_counts(tables.mailings(spark, d))


@query("x18_hash_sample", with_views("gift", more="""
r AS (SELECT *, 0.02::DOUBLE + greatest(0, gift_fy - (SELECT max(gift_fy) FROM gift) + 5 + 1) * 0.03::DOUBLE AS rate,
  (('0x' || substr(md5(CAST(gift_id AS VARCHAR) || CAST(gift_fy AS VARCHAR) || 'v1'), 1, 8))::BIGINT % 1000000) / 1000000.0::DOUBLE AS score FROM gift)""") + """
SELECT CAST(gift_id AS VARCHAR) AS gift_id, CAST(donor_id AS VARCHAR) AS donor_id, gift_fy, CAST(gift_amount AS DOUBLE) AS gift_amount, false AS is_synthetic FROM r
UNION ALL SELECT gift_id || '_FS', donor_id || '_FS', gift_fy, CAST(gift_amount AS DOUBLE), true FROM r WHERE score < rate""")
def x18(spark, d):
    g = tables.gifts(spark, d).withColumn("gift_fy", fiscal_year(F.col("gift_date"), START))
    return setops.hash_sample(g, "gift_id", "donor_id", "gift_fy").select("gift_id", "donor_id", "gift_fy", "gift_amount", "is_synthetic")


@query("x19_times_mailed", with_views("gift", "mail").rstrip() + """
, t AS (SELECT donor_id, count(*) AS times_mailed FROM mail GROUP BY 1)
SELECT gift_id, times_mailed FROM gift JOIN t USING (donor_id)""")
def x19(spark, d):
    return campaigns.times_mailed(tables.gifts(spark, d), tables.mailings(spark, d)).select("gift_id", "times_mailed")


@query("x20_promo_history", with_views("mail", more="""
p AS (SELECT *, campaign_code LIKE 'B2%' AS cold, rpad('QQ' || campaign_code, 8, 'Z') AS qc, rpad(campaign_code, 8, 'Z') AS cc, substr(package_name, 1, 1) || 'Z' AS pc,
  CASE WHEN list_id % 10 <> 0 THEN CASE WHEN length(CAST(list_id AS VARCHAR)) < 4 THEN lpad(CAST(list_id AS VARCHAR), 4, 'L') ELSE CAST(list_id AS VARCHAR) END ELSE 'LLLL' END AS lc FROM mail),
s AS (SELECT *, CASE WHEN cold THEN replace('QQ ' || source_code, ' ', '') ELSE cc || lc || pc END AS sc FROM p),
n AS (SELECT *, CASE WHEN cold THEN rpad(substr(sc, 9, 4), 4, 'Z') ELSE lc END AS l2, CASE WHEN cold THEN qc ELSE cc END AS c2 FROM s),
o AS (SELECT sc, min((c2, l2, pc, package_name)) AS r FROM n GROUP BY 1)""") + """
SELECT n.sc AS source_code, count(DISTINCT donor_id) AS quantity, CAST(max(mail_date) AS VARCHAR) AS mail_date, any_value(r[1]) AS campaign_code, any_value(r[2]) AS list_code,
  any_value(r[3]) AS package_code, any_value(r[4]) AS package_name FROM n JOIN o ON n.sc = o.sc GROUP BY n.sc""")
def x20(spark, d):
    cold = F.col("campaign_code").startswith("B2")
    m = tables.mailings(spark, d).select(
        F.when(cold, F.concat(F.lit("QQ"), "campaign_code")).otherwise(F.col("campaign_code")).alias("campaign_code"),
        F.substring("package_name", 1, 1).alias("package_code"), F.when(F.col("list_id") % 10 != 0, F.col("list_id").cast("string")).alias("list_code"),
        F.when(cold, F.concat(F.lit("QQ "), "source_code")).otherwise(F.col("source_code")).alias("source_code"),
        F.col("donor_id").alias("constituent"), "mail_date", "package_name")
    return campaigns.promo_history(m)


@query("x20_mail_masters", with_views("mail", more="""
a AS (SELECT *, row_number() OVER (PARTITION BY gift_id ORDER BY mail_date DESC, line * 1000000 + part_id) AS n FROM mail), b AS (SELECT *, row_number() OVER (PARTITION BY donor_id ORDER BY mail_date DESC, gift_id * 10 + line) AS n FROM mail)""") + """
SELECT 'promo' AS master, gift_id AS key, CAST(mail_date AS VARCHAR) AS newest FROM a WHERE n = 1 UNION ALL SELECT 'account', donor_id, CAST(mail_date AS VARCHAR) FROM b WHERE n = 1""")
def x20b(spark, d):
    m = tables.mailings(spark, d)
    promos = m.select(F.col("gift_id").alias("finder_number"), "mail_date", (F.col("line") * 1000000 + F.col("part_id")).alias("line"))
    accounts = m.select(F.col("donor_id").alias("constituent"), F.col("mail_date").alias("acquired"), (F.col("gift_id") * 10 + F.col("line")).alias("line"))
    p, a = campaigns.mail_masters(promos, accounts)
    return p.select(F.lit("promo").alias("master"), F.col("finder_number").alias("key"), F.col("mail_date").alias("newest")).unionAll(
        a.select(F.lit("account"), "constituent", "acquired"))


@query("u01_fiscal_sql_function", with_views("gift") + "SELECT gift_fy, count(*) AS gifts FROM gift GROUP BY 1")
def u01(spark, d):
    register_fiscal_from_date(spark)
    return tables.gifts(spark, d).groupBy(F.expr("fiscal_from_date(gift_date, 7)").alias("gift_fy")).agg(F.count(F.lit(1)).alias("gifts"))


@query("u03_u05_registered_features", with_views("gift", "code").rstrip() + """
SELECT gift_id, month(gift_date) AS gift_month, gift_fy AS gift_fiscal, CASE WHEN gift_amount < 10000 THEN '<$10,000' ELSE '>=$10,000' END AS gift_amount_flag FROM gift""")
def u03(spark, d):
    return hooks.FEATURES.apply(tables.gifts(spark, d), ["gift_month", "gift_fiscal", "gift_amount_flag", "unknown"]).select(
        "gift_id", "gift_month", "gift_fiscal", "gift_amount_flag")


@query("u03_source_code_hooks", with_views("code") + "SELECT part_id, source_code, substr(source_code, 1, 4) AS campaign_code FROM code")
def u03b(spark, d):
    p = tables.parts(spark, d).withColumns({"source_code": F.concat(F.lit(" "), F.lower("source_code"), F.lit("-")), "campaign_code": F.lit(None).cast("string")})
    p = hooks.SOURCE_CODE.apply(p, ["upper_code", "campaign_from_code"])
    return p.select("part_id", "source_code", "campaign_code")
