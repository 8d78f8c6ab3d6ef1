"""Data-quality results."""

from __future__ import annotations

from pyspark.sql import functions as F

from donorloom.catalog.base import START, query, scratch, with_views
from donorloom.operators import quality
from donorloom.operators.aggregates import non_null_counts
from donorloom.operators.windows import surrogate_key
from donorloom.plans import base_tables, hooks, run
from donorloom.sources import tables
from donorloom.sources.store import Store

HEAD = "SELECT 'ACME' AS client, '{ds}' AS dataset, '{ck}' AS \"check\", {dt} AS detail, {fl} AS fail, '{lv}' AS level FROM {src}"


def line(ds, ck, dt, fl, lv, src):
    return HEAD.format(ds=ds, ck=ck, dt=dt, fl=f"CAST(({fl}) AS BIGINT)", lv=lv, src=src)


def trx(spark, d):
    return tables.gifts(spark, d).withColumns({
        "donor_id": F.when(F.col("channel") != "5-LOW", F.col("donor_id")), "gift_id": F.when(F.col("gift_type") != "x", F.col("gift_id"))})


@query("q01_q02_transaction_checks", with_views("gift", more="t AS (SELECT count(*) AS n, count(*) FILTER (channel = '5-LOW') AS m FROM gift)") + " UNION ALL ".join([
    line("transactions", "volume", "'Record count: ' || n", "n <= 100", "error", "t"),
    line("transactions", "donor ids present", "m || ' records missing donor_id'", "m > 0", "warning", "t"),
    line("transactions", "gift ids present", "'0 records missing gift_id'", "0", "warning", "t")]))
def q02(spark, d):
    return quality.transaction_checks(trx(spark, d), "ACME")


@query("q01_upsert_and_count_failures", with_views("gift") + """
SELECT CAST(1 AS BIGINT) AS warnings, CAST(0 AS BIGINT) AS errors FROM gift HAVING count(*) > 100""")
def q01(spark, d):
    old = quality.transaction_checks(trx(spark, d).filter("gift_type = 'none'"), "ACME")
    return quality.failures(quality.upsert_results(old, quality.transaction_checks(trx(spark, d), "ACME")), ["transactions"])


@query("q03_amount_reconciliation", with_views("gift", more="""
s AS (SELECT * FROM gift WHERE gift_amount > 0), g AS (SELECT gift_date, gift_amount FROM gift WHERE gift_type <> 'P'),
t AS (SELECT (SELECT CAST(round(sum(gift_amount), 0) AS BIGINT) FROM s) AS s, (SELECT CAST(round(sum(gift_amount), 0) AS BIGINT) FROM g
  WHERE gift_date BETWEEN (SELECT min(gift_date) FROM s) AND (SELECT max(gift_date) FROM s)) AS g)""") +
    line("gift", "amount compared to staged", "'staged: ' || s || ', gift: ' || g", "s > g", "warning", "t"))
def q03(spark, d):
    g = tables.gifts(spark, d)
    return quality.reconcile_amounts(g, g.filter("gift_type <> 'P'"), "gift_date", "gift_amount", "ACME")


@query("q04_donor_key_checks", with_views("gift", more="t AS (SELECT count(DISTINCT donor_id) AS n, count(DISTINCT CASE WHEN gift_date < DATE '2000-01-01' THEN donor_id END) AS m FROM gift)") + " UNION ALL ".join([
    line("donor", "null keys", "'0'", "0", "error", "t"), line("donor", "repeated keys", "'0'", "0", "error", "t"),
    line("donor", "keys match gifts", "m || ' vs ' || n", "m <> n", "error", "t")]))
def q04(spark, d):
    g = surrogate_key(tables.gifts(spark, d), "donor_id", "donor_key")
    donors = g.filter(F.col("gift_date") < F.lit("2000-01-01").cast("date")).select("donor_key").distinct()
    return quality.donor_key_checks(donors, g, "ACME")


@query("q05_source_code_checks", with_views("mail", more="t AS (SELECT count(DISTINCT source_code) AS n FROM code), u AS (SELECT count(DISTINCT source_code) AS n FROM mail)") + " UNION ALL ".join([
    line("source_code", "codes populated", "CAST(n AS VARCHAR)", "n = 0", "error", "t"),
    line("source_code", "placeholders populated", "'0'", "1", "error", "t"), line("source_code", "codes on gifts", "CAST(n AS VARCHAR)", "n = 0", "warning", "u")]))
def q05(spark, d):
    return quality.source_code_checks(tables.parts(spark, d).withColumn("source", F.lit("load_source_codes")), tables.mailings(spark, d), "ACME")


@query("q06_q07_dates_and_private_columns", with_views("gift") + line(
    "dates", "plausible range", "(SELECT min(gift_date) || ' to ' || max(gift_date) FROM gift)",
    "(SELECT NOT (max(gift_date) >= DATE '2001-08-01' AND min(gift_date) <= DATE '2001-01-01') FROM gift)", "error", "region WHERE r_regionkey = 0"))
def q07(spark, d):
    g = tables.gifts(spark, d)
    return quality.date_range_check(g, "gift_date", F.lit("2001-09-15").cast("date"), "ACME")


@query("q06_private_columns", "SELECT * FROM (" + line("gift", "no private columns", "'none'", "0", "error", "orders LIMIT 1") + ") UNION ALL SELECT * FROM (" +
       line("person", "no private columns", "'name, balance'", "1", "error", "customer LIMIT 1") + ")")
def q06(spark, d):
    private = ["balance", "email", "name"]
    return quality.private_columns_check(tables.gifts(spark, d), private, "ACME", "gift").unionByName(
        quality.private_columns_check(tables.people(spark, d), private, "ACME", "person"))


@query("q08_month_passed", with_views("gift") + """
SELECT donor_id, CAST(max(gift_date) AS VARCHAR) AS reported, last_day(last_day(max(gift_date)) + 1) < DATE '2001-03-15' AS rerun FROM gift GROUP BY 1""")
def q08b(spark, d):
    newest = tables.gifts(spark, d).groupBy("donor_id").agg(F.max("gift_date").alias("reported"))
    return newest.withColumn("rerun", quality.month_passed(F.col("reported"), F.lit("2001-03-15").cast("date")))


@query("q08_freshness", with_views("gift") + """
SELECT CAST(max(gift_date) AS VARCHAR) AS newest, CAST(max(CASE WHEN gift_type = 'F' AND gift_fy < 2001 THEN gift_date END) AS VARCHAR) AS curated, true AS rerun FROM gift""")
def q08(spark, d):
    g = tables.gifts(spark, d)
    old = g.filter((F.col("gift_type") == "F") & (F.col("gift_date") < F.lit("2000-07-01").cast("date")))
    return quality.needs_rerun(g, old, "gift_date")


@query("q09_column_contract", with_views("gift") + """
SELECT 'ACME' AS client, 'gift' AS "table", 'channel' AS column_name, count(channel) AS filled FROM gift
UNION ALL SELECT 'ACME', 'gift', 'gift_id', count(gift_id) FROM gift UNION ALL SELECT 'ACME', 'gift', 'zip_code', NULL FROM gift HAVING count(*) > 0""")
def q09(spark, d):
    # Contracted columns with the number of values found; an absent column has none.
    contract = quality.column_contract(spark, {"gift": ["gift_id", "channel", "zip_code"]}, "ACME")
    found = non_null_counts(tables.gifts(spark, d)).withColumnRenamed("column", "column_name")
    return contract.join(found, "column_name", "left").select("client", "table", "column_name", "filled")


@query("q10_status_log", with_views("gift") + "SELECT 'ACME' AS client, 'Base tables' AS process, 'max gift date included: ' || max(gift_date) AS step FROM gift")
def q10(spark, d):
    newest = tables.gifts(spark, d).agg(F.max("gift_date")).scalar().cast("string")
    return quality.status_rows(spark, "ACME", "Base tables", "max gift date included: ").withColumn(
        "step", F.concat("step", newest)).drop("ts")


@query("q10_status_log_appended", with_views("gift", more="g AS (SELECT gift_fy, count(*) AS n FROM gift GROUP BY 1)") + """
SELECT 'ACME' AS client, 'Base tables' AS process, 'started' AS step, true AS stamped FROM g HAVING count(*) > 0 UNION ALL SELECT 'ACME', 'Base tables', 'gifts: ' || sum(n), true FROM g""")
def q10b(spark, d):
    s = Store(spark, scratch(spark), "ACME")
    run.log(s, "Base tables", "started")
    counted = tables.gifts(spark, d).agg(F.count(F.lit(1))).scalar()
    s.append(quality.status_rows(spark, "ACME", "Base tables", "").withColumn("step", F.concat(F.lit("gifts: "), counted)), run.LOG)
    return s.read(run.LOG).select("client", "process", "step", F.col("ts").isNotNull().alias("stamped"))


def base_run(spark, d):
    """Mailed pieces as gifts, and the codes of all parts. The seventh piece of a mailing has a code that no part has."""
    m = tables.mailings(spark, d).withColumn("source_code", F.when(F.col("line") == 7, F.concat(F.lit("NEW"), "campaign_code")).otherwise(F.col("source_code")))
    t = m.select((F.col("gift_id") * 10 + F.col("line")).alias("gift_id"), "donor_id", F.col("mail_date").alias("gift_date"),
                 F.col("revenue").alias("gift_amount"), F.lit("mail").alias("channel"), F.lit("gift").alias("gift_type"),
                 "source_code", "campaign_code", "campaign_name")
    c = tables.parts(spark, d).withColumns({
        "mail_date": F.lit("1998-01-01").cast("date"), "campaign_group": F.col("package_name"),
        "source_code": F.lower("source_code")})
    return t, base_tables.standard_source_codes(c.drop("quantity", "package_cpp"), "ACME", START)


def upper_codes(codes):
    return codes.withColumn("source_code", F.upper("source_code"))


@query("u04_base_table_hooks", with_views("code", "mail").rstrip() + """
, known AS (SELECT source_code FROM code), lost AS (SELECT DISTINCT 'NEW' || campaign_code AS source_code FROM mail WHERE line = 7)
SELECT 'gift' AS tbl, count(*) AS n, count(DISTINCT donor_id) AS marked FROM mail
UNION ALL SELECT 'donor', count(*), count(*) FILTER (t > 1000000) FROM (SELECT donor_id, sum(revenue) AS t FROM mail GROUP BY 1)
UNION ALL SELECT 'source_code', (SELECT count(*) FROM known) + (SELECT count(*) FROM lost) + 1 +
  (SELECT max(year(mail_date)) - min(year(mail_date)) + 2 FROM mail), (SELECT count(*) FROM lost)
UNION ALL SELECT 'qa: ' || ds, n, f FROM (VALUES ('donor', 3, 0), ('gift', 1, 0), ('source_code', 3, 0)) q(ds, n, f)
UNION ALL SELECT 'log: published', 1, 1""")
def u04(spark, d):
    t, c = base_run(spark, d)
    big = lambda donors, gifts: donors.join(gifts.groupBy("donor_id").agg(F.sum("gift_amount").alias("total")), "donor_id", "left")
    client = hooks.Client("ACME", {
        "source_codes": [upper_codes], "donors": [big],
        "missing_codes": [lambda m: m.groupBy("source_code", "campaign_code", "client", "source").agg(F.min("fy").alias("fy"), F.min("mail_date").alias("mail_date"))],
    }, switches=frozenset({"skip_trx_qa"}))
    s = Store(spark, scratch(spark), "ACME")
    run.build(s, client, t, c, START)
    run.publish(s, client)
    count = lambda df, name, marked: df.agg(F.count(F.lit(1)).alias("n"), marked.alias("marked")).select(F.lit(name).alias("tbl"), "n", "marked")
    results = s.read(run.RESULTS).groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.sum("fail").alias("marked"))
    logged = s.read(run.LOG).groupBy("step").agg(F.count(F.lit(1)).alias("n"))
    return (count(s.read("gift", "curated"), "gift", F.count_distinct("donor_id"))
            .unionAll(count(s.read("donor", "curated"), "donor", F.count_if(F.col("total") > 1000000)))
            .unionAll(count(s.read("source_code", "curated"), "source_code", F.count_if(F.col("source") == "inferred from trx")))
            .unionAll(results.select(F.concat(F.lit("qa: "), "dataset"), "n", "marked"))
            .unionAll(logged.select(F.concat(F.lit("log: "), "step"), "n", "n")))


@query("q01_publish_gate", with_views("mail") + """
SELECT 'before' AS attempt, false AS published, CAST(0 AS BIGINT) AS gifts FROM mail HAVING count(*) > 0 UNION ALL SELECT 'forced', true, count(*) FROM mail""")
def q01b(spark, d):
    # Donor keys, volume and amounts are right; placeholders for years are taken out, which is an error of the codes.
    t, c = base_run(spark, d)
    s = Store(spark, scratch(spark), "ACME")
    strict = hooks.Client("ACME", {"source_codes": [upper_codes]})
    run.build(s, strict, t, c, START)
    gaps = s.read("source_code").filter("source <> 'unsourced fallbacks'")
    run.record(s, quality.source_code_checks(gaps, s.read("gift"), "ACME"))
    try:
        run.publish(s, strict)
    except run.NotPublished:
        pass
    before = s.exists("gift", "curated")
    run.publish(s, hooks.Client("ACME", switches=frozenset({"force_publish_source_code"})))
    now = s.read("gift", "curated").agg(F.count(F.lit(1)).alias("gifts"))
    return spark.range(1).select(F.lit("before").alias("attempt"), F.lit(before).alias("published"), F.lit(0).cast("long").alias("gifts")).unionAll(
        now.select(F.lit("forced"), F.lit(True), "gifts"))


# ---- a client's whole run --------------------------------------------------------------------

def stepping_in(**more):
    """A client with a step at every point of the run from raw text to the base tables."""
    c = F.col
    return hooks.Client("ACME", {
        "parse": [lambda t: t.withColumns({"channel": c("appeal"), "source_code": F.upper("source_code"), "campaign_code": F.upper("source_code"),
                                           "campaign_name": F.lit(None).cast("string")}).drop("appeal")],
        "raw_source_codes": [lambda k: k.withColumn("mail_date", F.try_to_timestamp("mailed", F.lit("dd.MM.yyyy")).cast("date")).drop("mailed")],
        "initiate_codes": [lambda k, t: k.join(t.select(F.lower("source_code").alias("source_code")).distinct(), "source_code", "left_semi"), lambda k, t: upper_codes(k)],
        "update_codes": [lambda k: k.withColumn("campaign_group", F.substring("source_code", 1, 2))],
        "names": [lambda k: k.withColumn("campaign_name", F.concat(F.lit("Campaign "), "source_code"))],
        "filters": [lambda p: p.withColumn("program", F.when(c("channel") < "3", "Urgent").otherwise("Other"))],
        "campaign_performance": [lambda p: p.withColumn("large", (c("gift_amount") >= 100000).cast("int"))],
        "dataset_filters": [lambda p: p.filter(c("campaign_group").isNotNull() | (c("source_code") == "ZZ"))],
    }, **more)


@query("u03_standard_run", with_views("raw", "code").rstrip() + """
, t AS (SELECT k, CAST(replace(donor_id, '.0', '') AS BIGINT) AS donor, gift_amount, CASE WHEN appeal_category < '3' THEN 'Urgent' ELSE 'Other' END AS program,
  CASE WHEN k % 10 = 0 THEN 'ZZ' WHEN k % 10 = 1 THEN 'YY' ELSE 'B' || (k % 5 + 1) || (k % 5 + 1) END AS source_code FROM raw WHERE donor_id <> 'nan' AND gift_amount <> 0),
c AS (SELECT DISTINCT campaign_code AS source_code FROM code WHERE campaign_code IN (SELECT source_code FROM t)),
p AS (SELECT t.*, c.source_code IS NOT NULL AS known FROM t LEFT JOIN c USING (source_code))
SELECT 'performance' AS part, source_code, CASE WHEN known THEN 'Campaign ' || source_code END AS campaign_name, program, count(*) AS n,
  CAST(sum(CASE WHEN gift_amount >= 100000 THEN 1 ELSE 0 END) AS BIGINT) AS large FROM p WHERE known OR source_code = 'ZZ' GROUP BY ALL
UNION ALL SELECT 'gift', NULL, NULL, NULL, count(*), NULL FROM t UNION ALL SELECT 'donor', NULL, NULL, NULL, count(DISTINCT donor), NULL FROM t
UNION ALL SELECT 'source_code', source, NULL, NULL, n, NULL FROM (VALUES ('load_source_codes', (SELECT count(*) FROM c)),
  ('inferred from trx', (SELECT count(DISTINCT source_code) FROM p WHERE NOT known))) v(source, n)""")
def u03_run(spark, d):
    c = F.col
    key = F.regexp_extract("Gift ID", "^[0-9]+", 0).cast("long")
    code = F.when(key % 10 == 0, "zz").when(key % 10 == 1, "yy").otherwise(F.concat(F.lit("b"), key % 5 + 1, key % 5 + 1))
    raw = tables.raw_gifts(spark, d).withColumn("Source Code", code)
    codes = tables.parts(spark, d).groupBy(F.lower("campaign_code").alias("source_code")).agg(
        F.min("package_name").alias("package_name"), F.date_format(F.make_date(F.lit(1997), (F.min("part_id") % 12 + 1).cast("int"), F.lit(1)), "dd.MM.yyyy").alias("mailed")).select(
        "*", F.upper("source_code").alias("campaign_code"), F.lit(None).cast("string").alias("campaign_name"))
    s = Store(spark, scratch(spark), "ACME")
    run.ingest(s, stepping_in(), raw, codes, {"appeal_category": "appeal"}, [], START)
    none = F.lit(None).cast("string")
    report = s.read("campaign_performance").groupBy(F.lit("performance").alias("part"), "source_code", "campaign_name", "program").agg(
        F.count(F.lit(1)).alias("n"), F.sum("large").alias("large"))
    count = lambda name: s.read(name).select(F.lit(name).alias("part"), none.alias("source_code"), none.alias("campaign_name"), none.alias("program")).groupBy(
        "part", "source_code", "campaign_name", "program").agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("long").alias("large"))
    kinds = s.read("source_code").filter("source <> 'unsourced fallbacks'").groupBy(F.lit("source_code").alias("part"), "source").agg(
        F.count_distinct("source_code").alias("n")).select("part", c("source").alias("source_code"), none.alias("campaign_name"), none.alias("program"), "n", F.lit(None).cast("long").alias("large"))
    return report.unionAll(count("gift")).unionAll(count("donor")).unionAll(kinds)
