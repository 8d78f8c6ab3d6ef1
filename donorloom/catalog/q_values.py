"""Headers, typing and value cleaning over untidy gift rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from donorloom.catalog.base import query, with_views
from donorloom.functions import clean
from donorloom.sources import tables

RAW_ALL = "SELECT k AS gift_id, CASE WHEN donor_id <> 'nan' THEN replace(donor_id, '.0', '') END AS donor_id FROM raw"


@query("p01_p02_database_headers", with_views("raw") + """
SELECT gift_id, donor_id, CAST(gift_date AS VARCHAR) AS gift_date, appeal_category AS appeal_cat_nmb, gift_type FROM raw""")
def p01(spark, d):
    raw = tables.raw_gifts(spark, d).withColumn("Gift Date", clean.two_format_date(F.col("Gift Date"))).drop("Gift Amount")
    raw = raw.withColumn("Appeal Category", clean.null_tokens(F.col("Appeal Category"))).withColumnsRenamed(
        {"Gift ID": "GiftID", "Donor ID": "ORG_DonorID.", "Gift Date": "giftDate", "Appeal Category": "org_AppealCat-#"})
    return clean.drop_name_prefix(clean.database_headers(raw), "ORG")


@query("p03_header_styles", with_views("raw") + 'SELECT gift_id AS "GiftID", donor_id AS "DonorID", gift_type AS "GiftType" FROM raw')
def p03(spark, d):
    raw = tables.raw_gifts(spark, d).select(F.col("Gift ID").alias("gift id"), F.col("Donor ID").alias("DONOR_ID"), "Gift Type")
    return clean.rename_headers(clean.rename_headers(raw, clean.camel_header), clean.id_suffix)


@query("p04_p05_rename_and_merge_duplicates", with_views("raw") + """
SELECT gift_id, coalesce(appeal_category, gift_type) AS appeal FROM raw""")
def p04(spark, d):
    raw = clean.clean_null_tokens(tables.raw_gifts(spark, d)).select(
        F.col("Gift ID").alias("key"), F.col("Appeal Category").alias("appeal"), F.col("Gift Type").alias("appeal"))
    return clean.rename_checked(clean.merge_duplicate_names(raw), {"key": "gift_id", "absent": "other"})


@query("p06_p07_null_tokens_and_ids", with_views("raw") + RAW_ALL.replace("FROM raw", ", appeal_category FROM raw"))
def p06(spark, d):
    raw = clean.clean_null_tokens(clean.database_headers(tables.raw_gifts(spark, d)))
    return raw.select(clean.strip_point_zero(F.col("gift_id")).cast("long").alias("gift_id"),
                      clean.float_text_to_int(F.col("donor_id")).alias("donor_id"), "appeal_category")


@query("p08_numeric_ids", with_views("raw") + """
SELECT k AS gift_id, CAST(CAST(donor_id AS DOUBLE) AS BIGINT) AS donor_id FROM raw WHERE donor_id <> 'nan'""")
def p08(spark, d):
    raw = clean.numeric_ids(clean.database_headers(tables.raw_gifts(spark, d)), "donor_id")
    return raw.select(clean.whole_number(F.col("gift_id")).alias("gift_id"), "donor_id")


@query("p09_p10_money", with_views("raw") + """
SELECT k AS gift_id, gift_amount, CASE WHEN gift_amount <> 0 AND k % 2 <> 0 THEN gift_amount END AS budget FROM raw""")
def p09(spark, d):
    raw = tables.raw_gifts(spark, d)
    return raw.select(clean.whole_number(F.col("Gift ID")).alias("gift_id"), clean.money(F.col("Gift Amount")).alias("gift_amount"),
                      clean.budget_number(F.col("Gift Amount")).alias("budget"))


@query("p11_p15_cast_and_enforce", with_views("raw") + """
SELECT CAST(k AS DOUBLE) AS gift_id, CASE WHEN k % 3 = 0 THEN NULL ELSE strftime(gift_date, '%Y-%m-%d %H:%M:%S') END AS gift_date, gift_type FROM raw""")
def p11(spark, d):
    raw = clean.database_headers(tables.raw_gifts(spark, d))
    typed = clean.cast_by_map(raw, {"gift_id": "double", "gift_date": "timestamp"})
    return clean.enforce_schema(typed, {"gift_id": "double", "gift_date": "timestamp", "gift_type": "string"})


@query("p12_two_format_dates", with_views("raw") + "SELECT k AS gift_id, CAST(gift_date AS VARCHAR) AS gift_date FROM raw")
def p12(spark, d):
    return tables.raw_gifts(spark, d).select(clean.whole_number(F.col("Gift ID")).alias("gift_id"),
                                             clean.two_format_date(F.col("Gift Date")).alias("gift_date"))


@query("p13_budget_typing", with_views("code") + """
SELECT 'ACME' AS client, campaign_code AS budg_campaign_code, CAST(package_cpp AS DOUBLE) AS budg_revenue, CAST(NULL AS DOUBLE) AS budg_gifts, part_id FROM code""")
def p13(spark, d):
    budget = tables.parts(spark, d).select(
        F.lit(" ACME ").alias("client"), F.concat(F.lit(" "), "campaign_code").alias("budg_campaign_code"),
        F.col("package_cpp").cast("string").alias("budg_revenue"), F.lit("n/a").alias("budg_gifts"), "part_id")
    return clean.expected_types(budget, {"client": "string", "budg_campaign_code": "string", "budg_revenue": "double",
                                         "budg_gifts": "double", "budg_cost": "double"})


@query("p14_inferred_types", with_views("raw", more="e AS (SELECT event_id, ts, value, event_type FROM events)") + """
SELECT event_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, value, value AS share, event_id % 2 = 0 AS even, event_type AS kind FROM e""")
def p14(spark, d):
    e = tables.table(spark, d, "events")
    text = e.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), F.col("value").cast("string").alias("value"),
                    F.concat((F.col("value") * 100).cast("string"), F.lit("%")).alias("share"),
                    F.when(F.col("event_id") % 2 == 0, "yes").otherwise("no").alias("even"), F.col("event_type").alias("kind"))
    typed = clean.apply_types(text, clean.infer_types(text))
    return typed.select(F.col("event_id").alias("id"), "at", "value", F.round("share", 6).alias("share"), "even", "kind")


@query("p16_p19_column_sets", with_views("gift") + """
SELECT gift_id, donor_id, CAST(NULL AS VARCHAR) AS campaign_code, channel, 'ACME' AS client, 'orders' AS transaction_file_name FROM gift""")
def p16(spark, d):
    g = tables.gifts(spark, d).withColumns({"email": F.lit("x"), "empty": F.lit(None).cast("string")})
    g = clean.drop_private(clean.drop_matching(clean.drop_empty_columns(g), "amount"), ["email", "phone"])
    g = clean.align_columns(clean.prefer_order(g, ["donor_id"]), ["gift_id", "donor_id", "campaign_code", "channel"])
    return clean.stamp_load(g, "ACME", "orders").drop("row_added_at")


@query("p21_short_text", with_views("code") + """
SELECT part_id, CASE WHEN campaign_name NOT LIKE '%ring' THEN trim(substr(campaign_name, 1, 9)) END AS campaign_name FROM code""")
def p21(spark, d):
    name = F.when(F.col("campaign_name").endswith("ring"), "nan").otherwise(F.col("campaign_name"))
    return tables.parts(spark, d).select("part_id", clean.short_text(name, 9).alias("campaign_name"))


@query("c20_scientific_codes", with_views("gift") + """
SELECT gift_id, CAST(gift_id * 1000 AS VARCHAR) AS plain, channel AS text FROM gift""")
def c20(spark, d):
    sci = F.concat((F.col("gift_id") * 1000).cast("string"), F.lit("E0"))
    return tables.gifts(spark, d).select("gift_id", clean.plain_number_text(sci).alias("plain"),
                                         clean.plain_number_text(F.col("channel")).alias("text"))


@query("p19_common_first", with_views("gift", "person").rstrip() + """
SELECT 'gifts' AS side, 'donor_id,channel,gift_id,gift_date,gift_amount,gift_type' AS columns, count(*) AS n FROM gift
UNION ALL SELECT 'people', 'donor_id,channel,name,program,state,region,balance', count(*) FROM person""")
def p19(spark, d):
    left = tables.gifts(spark, d).select("gift_id", "donor_id", "gift_date", "gift_amount", "channel", "gift_type")
    right = tables.people(spark, d).withColumn("channel", F.lit(None).cast("string"))
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("side"), F.lit(",".join(df.columns)).alias("columns"), "n")
    left, right = clean.common_first(left, right)
    return count(left, "gifts").unionAll(count(right, "people"))
