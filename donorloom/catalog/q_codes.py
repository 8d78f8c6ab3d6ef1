"""Source-code text over the code dimension and the mailings."""

from __future__ import annotations

from pyspark.sql import functions as F

from donorloom.catalog.base import START, query, with_views
from donorloom.functions import codes
from donorloom.functions.codes import Part
from donorloom.functions.dates import fiscal_year
from donorloom.functions.rules import first_true_label
from donorloom.operators.aggregates import value_flags
from donorloom.sources import tables

# Layout of the example codes "B17ECO28": brand, type letters, size digits.
OLD = {"list_code": Part((1, 3)), "recency_code": Part(4, {"E": "recent", "P": "older"}), "frequency_code": Part(8, {"1": "one", "2": "two"}),
       "monetary_code": Part(None)}
NEW = {"list_code": Part((1, 2)), "recency_code": Part(5, {"C": "c-label"}), "frequency_code": Part((6, 7)), "monetary_code": Part(9)}
OLD_SQL = """substr({c}, 1, 3) AS list_code,
  CASE substr({c}, 4, 1) WHEN 'E' THEN 'recent' WHEN 'P' THEN 'older' ELSE substr({c}, 4, 1) END AS recency_code,
  CASE WHEN length({c}) < 8 THEN NULL ELSE CASE substr({c}, 8, 1) WHEN '1' THEN 'one' WHEN '2' THEN 'two' ELSE substr({c}, 8, 1) END END AS frequency_code"""


def picked(df):
    return df.select("part_id", "list_code", "recency_code", "frequency_code", "monetary_code")


@query("c01_positional_decode", with_views("code") + f"""
SELECT part_id, {OLD_SQL.format(c='source_code')}, CAST(NULL AS VARCHAR) AS monetary_code FROM code""")
def c01(spark, d):
    return picked(codes.decode_as("header", tables.parts(spark, d), "source_code", layout=OLD))


YEAR_SQL = """
SELECT gift_id, line, part_id, list_id, CAST(revenue AS DOUBLE) AS revenue,
  CASE WHEN {late} THEN {skip} substr(c, 1, 2) {end} ELSE substr(c, 1, 3) END AS list_code,
  CASE WHEN {late} THEN {skip} CASE substr(c, 5, 1) WHEN 'C' THEN 'c-label' ELSE substr(c, 5, 1) END {end}
    ELSE CASE substr(c, 4, 1) WHEN 'E' THEN 'recent' WHEN 'P' THEN 'older' ELSE substr(c, 4, 1) END END AS recency_code
FROM (SELECT *, source_code AS c, CASE WHEN list_id % 10 <> 0 THEN mail_date END AS mailed FROM mail)"""


def dated_pieces(spark, d):
    """Mailings where one list in ten has no date."""
    m = tables.mailings(spark, d).select("gift_id", "line", "part_id", F.col("list_id"), "revenue", "source_code", "campaign_code",
                                         F.when(F.col("list_id") % 10 != 0, F.col("mail_date")).alias("mailed"))
    return m.withColumnRenamed("list_id", "lid")


def piece(df):
    return df.select("gift_id", "line", "part_id", F.col("lid").alias("list_id"), "revenue", "list_code", "recency_code")


@query("c02_year_switched_decode", with_views("mail") + YEAR_SQL.format(late="coalesce(year(mailed) >= 1999, false)", skip="", end=""))
def c02(spark, d):
    return piece(codes.decode_as("year", dated_pieces(spark, d), "source_code", layouts={1998: OLD, 1999: NEW}, mail_date="mailed"))


@query("c02_fiscal_switched_decode_with_carve_out", with_views("mail") + YEAR_SQL.format(
    late="coalesce(year(mailed) + CASE WHEN month(mailed) >= 7 THEN 1 ELSE 0 END >= 1999, false)",
    skip="CASE WHEN campaign_code NOT LIKE 'B2%' THEN", end="END"))
def c02b(spark, d):
    return piece(codes.decode_as("fiscal_year", dated_pieces(spark, d), "source_code", layouts={1998: OLD, 1999: NEW},
                                 mail_date="mailed", start_month=START, untouched=F.col("campaign_code").startswith("B2")))


@query("c03_conditional_decode", with_views("code") + """
SELECT part_id, CASE WHEN source_code LIKE 'B2%' THEN substr(source_code, 1, 3) END AS list_code,
  CASE WHEN source_code NOT LIKE 'B2%' THEN CASE substr(source_code, 4, 1) WHEN 'E' THEN 'recent' WHEN 'P' THEN 'older' ELSE substr(source_code, 4, 1) END END AS recency_code FROM code""")
def c03(spark, d):
    return codes.decode_as("conditional", tables.parts(spark, d), "source_code", layout=OLD, prefix="B2").select(
        "part_id", "list_code", "recency_code")


@query("c04_override_decode", with_views("code") + """
SELECT part_id, substr(source_code, 1, 3) AS list_code, CASE WHEN substr(source_code, 1, 3) IN ('B10', 'B11') THEN
    CASE WHEN source_code IN ('B10', 'B11') THEN 'never' END
  ELSE CASE substr(source_code, 4, 1) WHEN 'E' THEN 'recent' WHEN 'P' THEN 'older' ELSE substr(source_code, 4, 1) END END AS recency_code FROM code""")
def c04(spark, d):
    return codes.decode_as("override", tables.parts(spark, d), "source_code", layout=OLD, overrides={
        "B10": "never", "B11": "never"}).select("part_id", "list_code", "recency_code")


@query("c06_synthetic_code", with_views("code") + """
SELECT part_id, coalesce(CASE WHEN quantity % 2 = 0 THEN source_code END, campaign_code || 'PKG' || campaign_name) AS source_code FROM code""")
def c06(spark, d):
    p = tables.parts(spark, d).withColumns({"source_code": F.when(F.col("quantity") % 2 == 0, F.col("source_code")),
                                            "package_code": F.lit(None).cast("string")})
    return codes.synthetic_code(p, "source_code", [("campaign_code", "CAMP"), ("package_code", "PKG"), ("campaign_name", "NAME")]).select(
        "part_id", "source_code")


@query("c07_regex_quarantine", with_views("code") + """
SELECT part_id, source_code, regexp_matches(source_code, '^(B1[0-9][A-Z]{3})') AND regexp_matches(package_name, '^(ECO|STAND|LARGE)') AS valid FROM code""")
def c07(spark, d):
    good, bad = codes.split_valid(tables.parts(spark, d), {"source_code": "B1[0-9][A-Z]{3}", "package_name": "ECO|STAND|LARGE"})
    return good.withColumn("valid", F.lit(True)).unionByName(bad.withColumn("valid", F.lit(False))).select(
        "part_id", "source_code", "valid")


@query("c07_invalid_counts", with_views("code") + """
SELECT count(*) FILTER (NOT regexp_matches(source_code, '^B1[0-9]')) AS source_code, count(*) FILTER (NOT regexp_matches(package_name, '^[EL]')) AS package_name FROM code""")
def c07b(spark, d):
    return codes.count_invalid(tables.parts(spark, d), {"source_code": "B1[0-9]", "package_name": "[EL]"})


@query("c08_c10_repair_and_pad", with_views("code") + """
SELECT part_id, CASE WHEN length(source_code) = 8 THEN source_code ELSE campaign_code || package_name || quantity END AS repaired,
  rpad(campaign_code, 5, 'Z') AS padded_right, lpad(campaign_code, 5, 'L') AS padded_left,
  CASE WHEN length(package_name) < 6 THEN rpad(package_name, 6, '_') ELSE package_name END AS never_cut FROM code""")
def c08(spark, d):
    c = F.col
    return tables.parts(spark, d).select(
        "part_id", codes.repair_code(c("source_code"), c("campaign_code"), c("package_name"), c("quantity").cast("string"), 8).alias("repaired"),
        codes.pad_right(c("campaign_code"), 5, "Z").alias("padded_right"), codes.pad_left(c("campaign_code"), 5, "L").alias("padded_left"),
        codes.pad_right(c("package_name"), 6, "_").alias("never_cut"))


@query("c09_validate_batch", with_views("code", more="""
a AS (SELECT source_code AS code, campaign_code AS appeal_id, package_name AS segment_code, CAST(part_id AS VARCHAR) AS package_id, CAST(package_cpp AS VARCHAR) AS cpp, 0 AS age FROM code WHERE quantity <= 25
  UNION ALL SELECT source_code, campaign_code, package_name, CAST(part_id + 1000000 AS VARCHAR), CAST(package_cpp + 1 AS VARCHAR), 1 FROM code WHERE quantity >= 20),
r AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY age DESC, appeal_id DESC, segment_code DESC, package_id DESC, cpp DESC) AS n FROM a),
f AS (SELECT CASE WHEN length(code) = 8 THEN code ELSE appeal_id || segment_code || package_id END AS code, appeal_id, CAST(cpp AS DOUBLE) AS cpp FROM r WHERE n = 1)""") + """
SELECT code, appeal_id, cpp, regexp_matches(code, '^(B[12][0-9][A-Z]{3}[0-9]{2})') AS valid FROM f""")
def c09(spark, d):
    p = tables.parts(spark, d)
    pick = lambda df, more: df.select(
        F.col("source_code").alias("code"), F.col("campaign_code").alias("appeal_id"), F.col("package_name").alias("segment_code"),
        (F.col("part_id") + more * 1000000).cast("string").alias("package_id"), (F.col("package_cpp") + more).cast("decimal(12,2)").cast("string").alias("cpp"))
    good, bad = codes.validate_batch(
        pick(p.filter("quantity <= 25"), 0), pick(p.filter("quantity >= 20"), 1), "code", {"cpp": F.col("cpp").cast("double")},
        {"code": "B[12][0-9][A-Z]{3}[0-9]{2}"}, length=8)
    return good.withColumn("valid", F.lit(True)).unionByName(bad.withColumn("valid", F.lit(False))).select("code", "appeal_id", "cpp", "valid")


@query("c11_c12_campaign_keys", with_views("code", more="""
k AS (SELECT *, CASE WHEN quantity % 3 <> 0 THEN campaign_code END AS cc, CASE WHEN quantity % 2 = 0 THEN campaign_name END AS cn,
  CASE WHEN quantity > 10 THEN 1990 + quantity END AS fy, make_date(2000, CAST(quantity % 12 + 1 AS INTEGER), 1) AS mailed FROM code)""") + """
SELECT part_id, CASE WHEN cc IS NULL AND cn IS NULL THEN 'ACME-' || source_code WHEN cc IS NULL THEN 'ACME--' || cn WHEN cn IS NULL THEN 'ACME-' || cc
    ELSE 'ACME-' || cc || '-' || cn END || CASE WHEN fy IS NULL THEN '' ELSE '-MD_FY' || fy END AS client_campaign,
  CASE WHEN cc IS NOT NULL AND cn IS NOT NULL THEN 'ACME-' || cc || '-' || cn WHEN cc IS NOT NULL THEN 'ACME-' || cc WHEN cn IS NOT NULL THEN 'ACME-CN ' || cn
    ELSE 'ACME-' || source_code END || CASE WHEN fy IS NULL THEN '' ELSE '-MD_FY' || fy END AS inferred_campaign,
  'FY' || coalesce(substr(CAST(fy AS VARCHAR), 3, 2), 'XX') || '_' || monthname(mailed) || '_' || package_name AS default_name FROM k""")
def c11(spark, d):
    q = F.col("quantity")
    p = tables.parts(spark, d).withColumns({
        "cc": F.when(q % 3 != 0, F.col("campaign_code")), "cn": F.when(q % 2 == 0, F.col("campaign_name")),
        "fy": F.when(q > 10, 1990 + q), "mailed": F.make_date(F.lit(2000), (q % 12 + 1).cast("int"), F.lit(1))})
    args = (F.lit("Acme"), F.col("cc"), F.col("cn"), F.col("source_code"), F.col("fy"))
    return p.select("part_id", codes.client_campaign(*args).alias("client_campaign"), codes.inferred_campaign(*args).alias("inferred_campaign"),
                    codes.default_campaign_name(F.col("fy"), F.col("mailed"), F.col("package_name")).alias("default_name"))


@query("c13_budget_key", with_views("code") + """
SELECT part_id, upper('acme_' || campaign_code || '_' || CASE WHEN quantity > 25 THEN package_name ELSE 'NULL' END || '_NULL') AS budget_key FROM code""")
def c13(spark, d):
    p = tables.parts(spark, d).withColumns({"client": F.lit(" acme "), "program": F.when(F.col("quantity") > 25, F.col("package_name"))})
    return codes.budget_key(p, "budget_key", ["client", "campaign_code"], ["program", "channel"]).select("part_id", "budget_key")


@query("c14_c15_delimited_parts", with_views("gift") + """
SELECT gift_id, split_part(channel, '-', 1) AS first_part, split_part(channel, '-', 2) AS zip_last, channel AS no_list,
  'A-' || channel AS leading FROM gift""")
def c14(spark, d):
    ch = F.col("channel")
    return tables.gifts(spark, d).select(
        "gift_id", codes.first_part(ch, "-").alias("first_part"), codes.zip_part(ch, "last").alias("zip_last"),
        codes.id_list(ch, ";").getItem(0).alias("no_list"),
        codes.leading_parts(F.concat(F.lit("A-"), ch, F.lit("-tail")), "-", 3).alias("leading"))


@query("c16_unsourced_codes", with_views("mail") + """
SELECT gift_id, line, part_id, list_id, CAST(revenue AS DOUBLE) AS revenue, CASE WHEN quantity > 40 AND (source_code LIKE 'B1%' OR source_code LIKE 'B2%')
  THEN CASE WHEN line > 3 THEN campaign_code ELSE CAST(year(mail_date) + CASE WHEN month(mail_date) >= 7 THEN 1 ELSE 0 END AS VARCHAR) ||
    CASE WHEN source_code LIKE 'B1%' THEN 'Appeal' ELSE 'Cold' END || 'Unsourced' END ELSE source_code END AS code FROM mail""")
def c16(spark, d):
    m = tables.mailings(spark, d)
    code = codes.unsourced_code(
        F.col("source_code"), F.when(F.col("line") > 3, F.col("campaign_code")), fiscal_year(F.col("mail_date"), START),
        {"B1": "Appeal", "B2": "Cold"}, F.col("quantity") > 40)
    return m.select("gift_id", "line", "part_id", "list_id", "revenue", code.alias("code"))


@query("c17_first_true_label", with_views("gift") + """
SELECT gift_id, CASE WHEN gift_type = 'F' THEN 'is_f' WHEN gift_amount > 300000 THEN 'is_big' ELSE 'no_label' END AS label FROM gift""")
def c17(spark, d):
    g = tables.gifts(spark, d).withColumns({"is_f": F.col("gift_type") == "F", "is_big": F.col("gift_amount") > 300000})
    return g.select("gift_id", first_true_label(["is_f", "is_big"]).alias("label"))


@query("c18_value_flags", with_views("gift") + """
SELECT donor_id, bool_or(gift_fy = 1996) AS fy_1996, bool_or(gift_fy = 1999) AS fy_1999, bool_or(gift_fy = 2001) AS fy_2001 FROM gift GROUP BY donor_id""")
def c18(spark, d):
    g = tables.gifts(spark, d).withColumn("fy", fiscal_year(F.col("gift_date"), START))
    return value_flags(g, "donor_id", "fy", [1996, 1999, 2001])


@query("c19_row_hash_changes", with_views("gift") + "SELECT gift_id FROM gift WHERE gift_type = 'F' AND gift_amount > 250000")
def c19(spark, d):
    old = tables.gifts(spark, d)
    new = old.withColumn("channel", F.when((F.col("gift_type") == "F") & (F.col("gift_amount") > 250000), "changed").otherwise(F.col("channel")))
    hashed = lambda df, n: df.select("gift_id", codes.row_hash("donor_id", "gift_date", "gift_amount", "channel").alias(n))
    return hashed(old, "h0").join(hashed(new, "h1"), "gift_id").filter(F.col("h0") != F.col("h1")).select("gift_id")


@query("c21_c23_client_code_rules", with_views("code", more="""
k AS (SELECT *, 'SCANLINE' || repeat('0', 3) || source_code || quantity AS scan FROM code)""") + """
SELECT part_id, upper(CASE WHEN length(substr(scan, 12, 10)) = 10 THEN substr(scan, 12, 10) ELSE campaign_code END) AS scan_code,
  CASE WHEN length(source_code) >= 7 AND regexp_matches(upper(substr(source_code, 4, 4)), '^[A-Z]+[0-9]') THEN upper(substr(source_code, 4, 4)) ELSE '' END AS guarded,
  CASE WHEN regexp_matches(campaign_code, '^B1') THEN CASE WHEN source_code LIKE campaign_code || '%' THEN source_code ELSE campaign_code || source_code END ELSE '' END AS appeal_package,
  CASE WHEN regexp_matches(campaign_code, '^(B1|B2)') THEN campaign_code || '-' || package_name ELSE '' END AS campaign_package FROM k""")
def c21(spark, d):
    c = F.col
    p = tables.parts(spark, d).withColumn("scan", F.concat(F.lit("SCANLINE000"), "source_code", c("quantity").cast("string")))
    return p.select(
        "part_id", codes.scanline_code(c("scan"), c("campaign_code")).alias("scan_code"),
        codes.guarded_slice(c("source_code"), 4, 7, "^[A-Z]+[0-9]").alias("guarded"),
        codes.appeal_package_code(c("campaign_code"), c("source_code"), "^B1").alias("appeal_package"),
        codes.campaign_package_code(c("campaign_code"), c("package_name"), ["B1", "B2"]).alias("campaign_package"))
