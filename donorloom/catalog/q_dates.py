"""Date, fiscal-year and banding columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from donorloom.catalog.base import START, query, with_views
from donorloom.functions import bands, dates, rules
from donorloom.operators import windows
from donorloom.plans.hooks import by_table, channel_from_appeal
from donorloom.sources import tables



def level_sql(x: str) -> str:
    bounds = sorted(bands.MONETARY.items())
    cases = " ".join(f"WHEN greatest(floor({x}), 1) <= {b} THEN '{t}'" for b, t in bounds)
    return f"CASE {cases} ELSE 'No GiftLevelID' END"


def band_sql(x: str, table: dict, missing: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} <= {b} THEN '{t}'" for b, t in sorted(table.items())) + f" ELSE '{missing}' END"


@query("d01_d03_calendar_columns", with_views("gift") + """
SELECT gift_id, gift_fy AS fiscal_year, year(gift_date) AS fiscal_year_january,
  year(gift_date) - CASE WHEN month(gift_date) < 7 THEN 1 ELSE 0 END AS rolling_year,
  month(gift_date) AS gift_month, year(gift_date) AS gift_cy, monthname(gift_date) AS month_name, weekofyear(gift_date) AS iso_week
FROM gift""")
def d01(spark, d):
    day = F.col("gift_date")
    return tables.gifts(spark, d).select(
        "gift_id", dates.fiscal_year(day, START).alias("fiscal_year"), dates.fiscal_year(day, 1).alias("fiscal_year_january"),
        dates.period_year(day, START, "r12").alias("rolling_year"), F.month(day).alias("gift_month"), F.year(day).alias("gift_cy"),
        dates.month_name(day).alias("month_name"), dates.iso_week(day).alias("iso_week"))


@query("d02_period_year", with_views("gift") + """
SELECT gift_id, gift_fy AS fy, year(gift_date) - CASE WHEN month(gift_date) < 7 THEN 1 ELSE 0 END AS r12, year(gift_date) AS cy FROM gift""")
def d02(spark, d):
    day = F.col("gift_date")
    return tables.gifts(spark, d).select("gift_id", *[dates.period_year(day, m, p).alias(p) for p, m in (("fy", 7), ("r12", 7), ("cy", 1))])


@query("d04_report_windows", with_views("gift", more="""
l AS (SELECT max(gift_date) AS d FROM gift), y AS (SELECT DISTINCT year(gift_date) AS y FROM gift)""") + """
SELECT 'fy' AS period, y AS report, CAST(make_date(y - 1, 7, 1) AS VARCHAR) AS start_date, CAST(make_date(y, 6, 30) AS VARCHAR) AS end_date FROM y
UNION ALL SELECT 'cy', y, CAST(make_date(y, 1, 1) AS VARCHAR), CAST(make_date(y, 12, 31) AS VARCHAR) FROM y
UNION ALL SELECT 'fytd', y, CAST(make_date(y - CASE WHEN month(d) = 7 THEN 1 ELSE 0 END, 7, 1) AS VARCHAR),
  CAST(last_day(make_date(y + CASE WHEN month(d) < 7 AND month(d) <> 1 THEN 1 ELSE 0 END, month(CAST(d - INTERVAL 1 MONTH AS DATE)), 1)) AS VARCHAR) FROM y, l
UNION ALL SELECT 'cytd', y, CAST(make_date(y + 1, 1, 1) AS VARCHAR), CAST(last_day(make_date(y + 1, month(CAST(d - INTERVAL 1 MONTH AS DATE)), 1)) AS VARCHAR) FROM y, l
UNION ALL SELECT 'r12', y, CAST(make_date(y, month(d), 1) AS VARCHAR), CAST(CAST(make_date(y + 1, month(d), 1) - INTERVAL 1 DAY AS DATE) AS VARCHAR) FROM y, l""")
def d04(spark, d):
    g = tables.gifts(spark, d)
    years = g.select(F.year("gift_date").alias("report")).distinct().withColumn("last", g.agg(F.max("gift_date")).scalar())
    out = None
    for period, month in (("fy", 7), ("cy", 1), ("fytd", 7), ("cytd", 1), ("r12", 7)):
        lo, hi = dates.report_window(period, F.col("report"), F.col("last"), month)
        one = years.select(F.lit(period).alias("period"), "report", lo.alias("start_date"), hi.alias("end_date"))
        out = one if out is None else out.unionAll(one)
    return out


@query("d06_day_deltas", with_views("mail", "gift") + """
SELECT m.gift_id, m.line, m.part_id, m.list_id, CAST(m.revenue AS DOUBLE) AS revenue, date_diff('day', m.mail_date, g.gift_date) AS days,
  (year(g.gift_date) - year(m.mail_date)) * 12 + month(g.gift_date) - month(m.mail_date) AS months
FROM mail m JOIN gift g USING (gift_id)""")
def d06(spark, d):
    m = tables.mailings(spark, d).join(tables.gifts(spark, d).select("gift_id", "gift_date"), "gift_id")
    return m.select("gift_id", "line", "part_id", "list_id", "revenue", F.datediff("gift_date", "mail_date").alias("days"),
                    dates.months_ago(F.col("gift_date"), F.col("mail_date")).alias("months"))


@query("d07_days_in_following_months", with_views("gift") + """
SELECT gift_id, i AS month_index, CASE WHEN i = 0 THEN date_diff('day', gift_date, last_day(gift_date))
  ELSE day(last_day(CAST(gift_date + to_months(CAST(i AS INTEGER)) AS DATE))) END AS days FROM gift, range(12) AS r(i)""")
def d07(spark, d):
    return tables.gifts(spark, d).select("gift_id", F.posexplode(
        dates.days_in_following_months(F.col("gift_date"))).alias("month_index", "days"))


@query("d08_month_spine", with_views("gift") + """
SELECT CAST(CAST(m AS DATE) AS VARCHAR) AS month FROM (SELECT unnest(generate_series(date_trunc('month', min(gift_date)),
  CAST(max(gift_date) + INTERVAL 12 MONTH AS DATE), INTERVAL 1 MONTH)) AS m FROM gift)""")
def d08(spark, d):
    return dates.month_spine(tables.gifts(spark, d), "gift_date")


@query("d09_calendar_days_per_month", with_views("gift") + """
SELECT CAST(date_trunc('month', day)::DATE AS VARCHAR) AS month, count(*) AS days FROM (
  SELECT unnest(generate_series(min(gift_date), max(gift_date), INTERVAL 1 DAY)) AS day FROM gift) GROUP BY 1""")
def d09(spark, d):
    days = tables.gifts(spark, d).agg(F.min("gift_date").alias("a"), F.max("gift_date").alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("day"))
    return days.groupBy(F.trunc("day", "month").alias("month")).agg(F.count(F.lit(1)).alias("days"))


@query("d10_fiscal_windows", with_views("gift", more="""
e AS (SELECT *, CASE WHEN last_day(gift_date) = gift_date THEN gift_date ELSE CAST(date_trunc('month', gift_date) - INTERVAL 1 DAY AS DATE) END AS done FROM gift)""") + """
SELECT gift_id, CAST(make_date(gift_fy - 1, 7, 1) AS VARCHAR) AS day1_fiscal, CAST(make_date(gift_fy, 6, 30) AS VARCHAR) AS end_fiscal,
  CAST(done AS VARCHAR) AS last_complete, CASE WHEN month(gift_date) > 6 THEN month(gift_date) - 6 ELSE month(gift_date) + 6 END AS fiscal_month,
  CAST(make_date(year(done) - CASE WHEN month(done) < 7 THEN 1 ELSE 0 END, 7, 1) AS VARCHAR) AS fytd_start,
  CAST(CAST(CAST(done - INTERVAL 12 MONTH AS DATE) + INTERVAL 1 DAY AS DATE) AS VARCHAR) AS r12_start,
  CAST(make_date(gift_fy, 6, 30) AS VARCHAR) AS fy_end FROM e""")
def d10(spark, d):
    day = F.col("gift_date")
    fy = dates.fiscal_year(day, START)
    fytd, r12 = dates.fytd_window(day, START), dates.r12_window(day)
    return tables.gifts(spark, d).select(
        "gift_id", dates.fiscal_first_day(fy, known=day).alias("day1_fiscal"), dates.fiscal_last_day(fy, known=day).alias("end_fiscal"),
        fytd[1].alias("last_complete"), dates.fiscal_month_number(F.month(day), 6).alias("fiscal_month"),
        fytd[0].alias("fytd_start"), r12[0].alias("r12_start"), dates.fiscal_end_on_or_after(day, 6).alias("fy_end"))


@query("d11_period_expansion", with_views("gift", more="""
p AS (SELECT i, make_date(2001 - i, 6, 30) AS e FROM range(5) AS r(i))""") + """
SELECT donor_id, CAST(e AS VARCHAR) AS period_end, count(*) AS gifts, CAST(sum(gift_amount) AS DOUBLE) AS total
FROM gift JOIN p ON gift_date <= e GROUP BY 1, 2""")
def d11(spark, d):
    # Daily totals per donor are enough for every period, and each is copied only to the periods that reach it.
    days = tables.gifts(spark, d).groupBy("donor_id", "gift_date").agg(F.count(F.lit(1)).alias("n"), F.sum("gift_amount").alias("t"))
    ends = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.make_date(F.lit(2001) - i, F.lit(6), F.lit(30)))
    wide = days.withColumn("period_end", F.explode(F.filter(ends, lambda e: F.col("gift_date") <= e)))
    return wide.groupBy("donor_id", "period_end").agg(F.sum("n").alias("gifts"), F.sum("t").alias("total"))


@query("d12_period_of_gift", with_views("gift", more="p AS (SELECT make_date(1996 + i, 8, 1) AS s FROM range(6) AS r(i))") + """
SELECT gift_id, CAST(max(s) AS VARCHAR) AS period_start FROM gift LEFT JOIN p ON s <= gift_date GROUP BY gift_id""")
def d12(spark, d):
    starts = F.transform(F.sequence(F.lit(0), F.lit(5)), lambda i: F.make_date(F.lit(1996) + i, F.lit(8), F.lit(1)))
    return tables.gifts(spark, d).select("gift_id", F.array_max(
        F.filter(starts, lambda s: s <= F.col("gift_date"))).alias("period_start"))


# ---- bands and labels --------------------------------------------------------------------

@query("b01_b03_gift_level", with_views("gift") + f"""
SELECT gift_id, {level_sql('gift_amount / 100.0')} AS gift_level,
  CASE WHEN gift_amount < 10000 THEN '<$10,000' ELSE '>=$10,000' END AS amount_flag FROM gift""")
def b01(spark, d):
    return tables.gifts(spark, d).select("gift_id", bands.gift_level(F.col("gift_amount") / 100).alias("gift_level"),
                                         bands.amount_flag(F.col("gift_amount")).alias("amount_flag"))


@query("b02_join_level", with_views("gift", more="""
f AS (SELECT donor_id, arg_min(gift_amount, (gift_date, -gift_amount, gift_id)) AS a FROM gift GROUP BY 1)""") + f"""
SELECT gift_id, {level_sql('a / 100.0')} AS join_level FROM gift JOIN f USING (donor_id)""")
def b02(spark, d):
    order = windows.first_gift_order("gift_date", "gift_amount", "gift_id")
    g = windows.with_join_values(tables.gifts(spark, d), "donor_id", order, {"first_amount": "gift_amount"})
    return g.select("gift_id", bands.gift_level(F.col("first_amount") / 100).alias("join_level"))


@query("b04_recency_frequency_bands", with_views("gift", more="""
m AS (SELECT donor_id, count(*) AS n, (2001 - year(max(gift_date))) * 12 + 9 - month(max(gift_date)) AS months FROM gift GROUP BY 1)""") + f"""
SELECT donor_id, {band_sql('months', bands.RECENCY, 'Z: NoMRCid')} AS recency, {band_sql('n', bands.FREQUENCY, 'Z: NoFreqid')} AS frequency FROM m""")
def b04(spark, d):
    m = tables.gifts(spark, d).groupBy("donor_id").agg(F.count(F.lit(1)).alias("n"), F.max("gift_date").alias("last"))
    months = dates.months_ago(F.lit("2001-09-01").cast("date"), F.col("last"))
    return m.select("donor_id", bands.recency_band(months).alias("recency"), bands.frequency_band(F.col("n")).alias("frequency"))


@query("b05_interval_labels", with_views("gift") + """
SELECT gift_id, CASE WHEN gift_amount >= 1000 AND gift_amount < 50000 THEN 'A: low' WHEN gift_amount >= 50000 AND gift_amount < 250000 THEN 'B: mid'
  WHEN gift_amount >= 260000 AND gift_amount < 400000 THEN 'C: high' ELSE 'Z: NoAmt' END AS label FROM gift""")
def b05(spark, d):
    return tables.gifts(spark, d).select("gift_id", bands.interval_label(F.col("gift_amount"), [
        (1000, 50000, "A: low"), (50000, 250000, "B: mid"), (260000, 400000, "C: high")]).alias("label"))


@query("b07_rule_classifier", with_views("mail") + """
SELECT gift_id, line, part_id, list_id, CAST(revenue AS DOUBLE) AS revenue,
  CASE WHEN campaign_name LIKE '%ring%' THEN 'Event' WHEN package_name = 'PROMO' OR package_name IS NULL THEN 'Solicitation'
       WHEN source_code LIKE 'B1%' THEN 'Direct Mail' ELSE 'Other' END AS channel FROM mail""")
def b07(spark, d):
    # Last match wins, so the rules read from weakest to strongest.
    channel = rules.classify([
        (rules.starts_any(F.col("source_code"), ["B1"]), "Direct Mail"),
        (rules.is_in(F.col("package_name"), ["PROMO"]), "Solicitation"),
        (rules.keyword_in(F.col("campaign_name"), ["ring"]), "Event"),
    ], "Other", match="last")
    return tables.mailings(spark, d).select("gift_id", "line", "part_id", "list_id", "revenue", channel.alias("channel"))


@query("b07_registered_channel_rules", with_views("gift") + """
SELECT gift_id, CASE WHEN gift_type = 'F' AND channel = '1-URGENT' THEN 'Other' WHEN gift_type = 'F' THEN 'Direct Mail' WHEN gift_type = 'O' THEN 'Solicitation' ELSE 'Event' END AS channel FROM gift""")
def b07b(spark, d):
    # Codes carry several marks, so the order of the rules shows; urgent gifts of one type have no code.
    marks = F.when(F.col("gift_type") == "F", F.when(F.col("channel") != "1-URGENT", "DM01")).when(
        F.col("gift_type") == "O", "DM-SOL").otherwise("SOLDMEV")
    g = tables.gifts(spark, d).withColumn("appeal_id", marks).drop("channel")
    return channel_from_appeal(g).select("gift_id", "channel")


@query("b08_b13_equality_and_new_existing", with_views("gift") + """
SELECT gift_id, CASE WHEN gift_type = 'F' THEN 'True' ELSE 'False' END AS finished,
  CASE gift_type WHEN 'F' THEN 'New' WHEN 'O' THEN '(blank)' ELSE 'Existing' END AS new_existing, channel AS channel_copy FROM gift""")
def b08(spark, d):
    group = F.when(F.col("gift_type") == "F", "New").when(F.col("gift_type") == "O", "No Giving History").otherwise("Lapsed")
    return tables.gifts(spark, d).select(
        "gift_id", rules.label(F.col("gift_type") == "F", "True", "False").alias("finished"),
        bands.new_or_existing(group).alias("new_existing"), F.col("channel").alias("channel_copy"))


@query("b09_window_donors", with_views("gift") + """
SELECT donor_id, min(gift_date) BETWEEN DATE '1995-02-24' AND DATE '1995-05-31' AS joined_in_window,
  bool_or(gift_date BETWEEN DATE '1998-02-24' AND DATE '1998-05-31') AS gave_in_window FROM gift GROUP BY donor_id""")
def b09(spark, d):
    day = F.col("gift_date")
    between = lambda c, a, b: c.between(F.lit(a).cast("date"), F.lit(b).cast("date"))
    return tables.gifts(spark, d).groupBy("donor_id").agg(
        between(F.min(day), "1995-02-24", "1995-05-31").alias("joined_in_window"),
        F.max(between(day, "1998-02-24", "1998-05-31")).alias("gave_in_window"))


@query("b10_sustainer_flag", with_views("gift") + """
SELECT gift_id, CASE WHEN bool_or(gift_type = 'F') OVER (PARTITION BY donor_id) THEN 'Sustainer' ELSE '1x' END AS sustainer FROM gift""")
def b10(spark, d):
    flag = F.when(F.max(F.col("gift_type") == "F"), "Sustainer").otherwise("1x")
    return windows.group_transform(tables.gifts(spark, d), ["donor_id"], flag, "sustainer").select("gift_id", "sustainer")


@query("b12_years_on_file", with_views("gift", more="""
y AS (SELECT donor_id, date_diff('day', min(gift_date), DATE '1999-07-01') AS n FROM gift GROUP BY 1)""") + """
SELECT donor_id, CASE WHEN n >= 1825 THEN '5+ Years' WHEN n >= 1460 THEN '4th Year' WHEN n >= 1095 THEN '3rd Year'
  WHEN n >= 730 THEN '2nd Year' WHEN n >= 365 THEN '1st Year' ELSE 'No Giving' END AS years_on_file FROM y""")
def b12(spark, d):
    first = tables.gifts(spark, d).groupBy("donor_id").agg(F.min("gift_date").alias("first"))
    return first.select("donor_id", bands.years_on_file(F.lit("1999-07-01").cast("date"), F.col("first")).alias("years_on_file"))


@query("b14_b16_appeal_rules", with_views("code") + """
SELECT part_id, CASE WHEN campaign_code IN ('B11', 'B12') THEN NULL WHEN length(campaign_code) IN (3, 4) AND substr(campaign_code, 1, 1) = 'B' THEN 'US Appeal'
    WHEN upper(campaign_code) = 'B2' THEN 'Online' END AS program,
  CASE WHEN (length(campaign_code) IN (3, 4) AND substr(campaign_code, 1, 1) IN ('B', 'C')) OR campaign_code LIKE '%9%' THEN 'Tracked' ELSE 'Other' END AS program_filter,
  CASE WHEN length(source_code) = 7 AND substr(source_code, 1, 1) = 'B' THEN 'Acq' ELSE 'NonAcq' END AS acquisition FROM code""")
def b14(spark, d):
    c = F.col("campaign_code")
    return tables.parts(spark, d).select(
        "part_id", rules.appeal_program(c, {"B": "US Appeal"}, ["B11", "B12"], {"B2": "Online"}).alias("program"),
        rules.appeal_filter(c, ["B", "C"], ["9"]).alias("program_filter"),
        rules.acquisition_flag(F.col("source_code"), 7, ["B"]).alias("acquisition"))


@query("b18_fund_program", with_views("mail", more="""
f AS (SELECT gift_id, line, part_id, list_id, revenue, quantity, package_name AS s, list_id % 6 AS o FROM mail)""") + """
SELECT gift_id, line, part_id, list_id, CAST(revenue AS DOUBLE) AS revenue, CASE WHEN quantity > 48 THEN 'Project' WHEN o = 2 AND s LIKE '%STEEL%' THEN 'Steel shop'
  WHEN o IN (0, 1, 2) THEN 'Shop' WHEN o = 3 THEN 'Fair' ELSE 'Other' END AS program FROM f""")
def b18(spark, d):
    outlet = F.element_at(F.array(*[F.lit(x) for x in ("11.0", " shop", "12", "21.0", "77", "nan")]), (F.col("list_id") % 6 + 1).cast("int"))
    m = tables.mailings(spark, d).withColumns({
        "outlet": outlet, "segment": F.lower("package_name"), "project": F.when(F.col("quantity") > 48, "P5.0").otherwise("None")})
    rules = [("Project", [("project", "in", ["P5"])]), ("Steel shop", [("outlet", "in", ["12"]), ("segment", "has", ["STEEL"])]),
             ("Shop", [("outlet", "in", ["11", "12", "shop"])]), ("Fair", [("outlet", "in", ["21"])])]
    return by_table(m, "program", rules, "Other").select("gift_id", "line", "part_id", "list_id", "revenue", "program")


@query("b17_letter_codes", with_views("code") + """
SELECT part_id, CASE substr(package_name, 1, 1) WHEN 'S' THEN NULL WHEN 'E' THEN '13-18 months' WHEN 'P' THEN '109-120 months'
  WHEN 'L' THEN '61-72 months' WHEN 'M' THEN '73-84 months' END AS recency,
  CASE substr(package_name, 1, 1) WHEN 'E' THEN '5 gifts' END AS frequency,
  CASE substr(package_name, 1, 1) WHEN 'E' THEN '$15-$19.99' WHEN 'L' THEN '$1,000+' END AS monetary FROM code""")
def b17(spark, d):
    letter = F.substring("package_name", 1, 1)
    return tables.parts(spark, d).select(
        "part_id", bands.letter_label(letter, bands.RECENCY_LETTERS).alias("recency"),
        bands.letter_label(letter, bands.FREQUENCY_LETTERS).alias("frequency"),
        bands.letter_label(letter, bands.MONETARY_LETTERS).alias("monetary"))
