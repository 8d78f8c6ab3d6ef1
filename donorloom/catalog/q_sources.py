"""Files and stored tables: written to the shared work folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from donorloom.catalog.base import START, query, scratch, with_views
from donorloom.functions.clean import strip_point_zero, whole_number
from donorloom.functions.dates import fiscal_year
from donorloom.operators.setops import replace_window, union_aligned
from donorloom.plans.base_tables import ingest_clean
from donorloom.sources import derived, files, tables
from donorloom.sources.mixed import BAD_LINE, read_mixed
from donorloom.sources.store import Store
from donorloom.streaming.incremental import file_stream, run_available

HEADER = ["Gift ID", "Donor ID", "Gift Date", "Gift Amount", "Appeal Category", "Gift Type"]
RENAMES = {"Gift ID": "gift_id", "Donor ID": "donor_id", "Gift Date": "gift_date", "Gift Type": "gift_type"}
BASIC = "SELECT gift_id, donor_id, CAST(gift_date AS VARCHAR) AS gift_date, CAST(gift_amount AS DOUBLE) AS gift_amount FROM gift"


def basic(spark, d):
    return tables.gifts(spark, d).select("gift_id", "donor_id", "gift_date", "gift_amount")


def store(spark):
    return Store(spark, scratch(spark), "ACME")


FORMS = {"O": ("\t", '"', "ISO-8859-1", ""), "F": (";", "'", "UTF-8", "\ufeff"), "P": (",", '"', "UTF-8", "")}  # delimiter, quote, encoding, byte-order mark


def delivered(spark, d):
    """A folder with files of three formats, each with its own order of columns, and line breaks, delimiters and quotes inside quotes."""
    folder = scratch(spark)
    note = F.concat(F.lit("first line\n\tsecond; né, \"o'clock\" "), F.col("Gift Type"))
    raw = tables.raw_gifts(spark, d).withColumn("Appeal Category", note)
    for kind, (delimiter, quote, encoding, mark) in FORMS.items():
        own = HEADER if kind == "O" else HEADER[::-1]
        rows = raw.filter(F.col("Gift Type") == kind).select(*own).withColumnRenamed(own[0], mark + own[0])
        rows.write.option("header", True).option("sep", delimiter).option("quote", quote).option("encoding", encoding).option(
            "escapeQuotes", True).option("quoteAll", kind == "F").csv(f"{folder}/{kind}")
    return folder


@query("s01_collect_transaction_files", with_views("raw") + """
SELECT gift_id, donor_id, CAST(gift_date AS VARCHAR) AS gift_date, gift_type, 'first line' || chr(10) || chr(9) || 'second; né, "o''clock" ' || gift_type AS appeal FROM raw""")
def s01(spark, d):
    return files.collect_transactions(spark, delivered(spark, d), RENAMES | {"Appeal Category": "appeal"},
                                      ["gift_id", "donor_id", "gift_date", "gift_type", "appeal", "not there"])


@query("s02_broken_lines", with_views("gift") + """
SELECT 'kept' AS part, count(*) AS lines FROM gift WHERE gift_type <> 'P' UNION ALL SELECT 'short', count(*) FROM gift WHERE gift_type = 'O'
UNION ALL SELECT 'quarantine', count(*) FROM gift WHERE gift_type = 'P'""")
def s02(spark, d):
    folder = scratch(spark)
    # Lines with a field too many are broken; lines with one too few are only incomplete.
    text = F.concat_ws(",", "gift_id", "donor_id", F.when(F.col("gift_type") == "P", F.lit("x,y")), F.when(F.col("gift_type") != "O", F.lit("z")))
    tables.gifts(spark, d).select(text).write.text(folder + "/in.csv")
    df = files.read_delimited(spark, folder + "/in.csv", ["gift_id", "donor_id", "tail"], header=False, glob=None)
    return parts_of(df, files.good_lines(df), files.bad_lines(df))


def parts_of(df, kept, broken):
    one = lambda x, name: x.agg(F.count(F.lit(1)).alias("lines")).select(F.lit(name).alias("part"), "lines")
    return one(kept, "kept").unionAll(one(kept.filter("tail IS NULL"), "short")).unionAll(one(broken, "quarantine"))


@query("s02_mixed_formats", with_views("gift") + """
SELECT channel, CAST(gift_id AS VARCHAR) AS gift_id, CASE WHEN gift_type <> 'P' THEN CAST(donor_id AS VARCHAR) END AS donor_id,
  CASE gift_type WHEN 'F' THEN 'it''s' || chr(10) || 'open' END AS tail, CASE WHEN gift_type = 'P' THEN 'too many' END AS broken FROM gift""")
def s02b(spark, d):
    """One file per channel, each with its own delimiter and quote: broken lines keep their raw text, short ones are incomplete."""
    folder = scratch(spark)
    form = [(",", '"'), ("\t", "'"), (";", '"'), ("|", "'"), (";", "'")]
    digit = F.substring("channel", 1, 1).cast("int")
    pick = lambda i: F.element_at(F.array(*[F.lit(f[i]) for f in form]), digit)
    mark = pick(1)
    tail = F.concat(mark, F.lit("it"), F.when(mark == "'", "''").otherwise("'"), F.lit("s\nopen"), mark)
    line = F.concat_ws("\0", "gift_id", "donor_id", F.when(F.col("gift_type") == "P", F.lit("x\0y")).when(F.col("gift_type") == "F", tail))
    g = tables.gifts(spark, d).select("channel", F.translate(line, "\0", "\x01").alias("line"), pick(0).alias("by"))
    head = g.select("channel", "by").distinct().select("channel", "by", F.lit("gift_id\x01donor_id\x01tail").alias("line"))
    # The header goes first: within a channel's one file lines keep the order of the sort.
    lines = head.withColumn("at", F.lit(0)).unionByName(g.withColumn("at", F.lit(1))).select(
        "channel", "at", F.replace("line", F.lit("\x01"), F.col("by")).alias("line"))
    lines.repartition(5, "channel").sortWithinPartitions("channel", "at").select("channel", "line").write.partitionBy("channel").text(folder)
    df = read_mixed(spark, folder, glob=None)
    raw = F.split(BAD_LINE, "[,\t;|]")
    return df.select(
        F.url_decode(F.regexp_extract("_file", "channel=([^/]+)", 1)).alias("channel"), F.coalesce("gift_id", raw[0]).alias("gift_id"), "donor_id", "tail",
        F.when(F.size(raw) == 4, "too many").alias("broken"))


@query("s03_s04_versions_and_layers", with_views("gift") + """
SELECT 'now' AS version, count(*) AS gifts, CAST(sum(gift_amount) AS DOUBLE) AS total FROM gift
UNION ALL SELECT 'before', count(*), CAST(sum(gift_amount) AS DOUBLE) FROM gift WHERE gift_fy < 2000
UNION ALL SELECT 'curated', count(*), CAST(sum(gift_amount) AS DOUBLE) FROM gift""")
def s03(spark, d):
    s, g = store(spark), basic(spark, d)
    s.overwrite(g.filter(fiscal_year(F.col("gift_date"), START) < 2000), "gift")
    s.overwrite(g, "gift")
    s.publish("gift")
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias("gifts"), F.sum("gift_amount").alias("total")).select(F.lit(name).alias("version"), "gifts", "total")
    return one(s.read("gift"), "now").unionAll(one(s.read("gift", back=1), "before")).unionAll(one(s.read("gift", "curated"), "curated"))


@query("s05_projected_csv", with_views("raw") + "SELECT gift_id, gift_type FROM raw")
def s05(spark, d):
    folder = scratch(spark)
    tables.raw_gifts(spark, d).write.option("header", True).csv(folder)
    return files.project_csv(spark, folder, {"Gift ID": "gift_id", "Gift Type": "gift_type"})


@query("s06_recurring_gifts", with_views("raw") + """
SELECT k AS gift_id, CAST(gift_date AS VARCHAR) AS gift_date, gift_amount FROM raw WHERE gift_type = 'F' AND year(gift_date) >= 1998""")
def s06(spark, d):
    raw = tables.raw_gifts(spark, d).select(
        whole_number(F.col("Gift ID")).alias("gift_id"), files.lenient_date(F.col("Gift Date")).alias("gift_date"),
        F.col("Gift Amount").alias("gift_amount"), F.when(F.col("Gift Type") == "F", "R1").otherwise(" ").alias("recurring_id"))
    return files.recurring_gifts(raw, "recurring_id", "gift_date", "gift_amount", 1998).drop("recurring_id")


@query("s07_s10_create_append_align", with_views("gift") + """
SELECT gift_id, donor_id, CAST(gift_amount AS DOUBLE) AS gift_amount, CAST(NULL AS VARCHAR) AS note FROM gift WHERE gift_type <> 'P'
UNION ALL SELECT gift_id, donor_id, CAST(gift_amount AS DOUBLE), 'late' FROM gift WHERE gift_type = 'P'""")
def s07(spark, d):
    s, g = store(spark), tables.gifts(spark, d).withColumn("gift_amount", F.col("gift_amount").cast("double"))
    s.create("gift", {"gift_id": "Int64", "donor_id": "Int64", "gift_amount": "float"})
    s.append_aligned(g.filter("gift_type = 'O'").unionAll(g.filter("gift_type = 'O'")), "gift")
    s.append_aligned(g.filter("gift_type = 'F'"), "gift")
    s.append(g.filter("gift_type = 'P'").select("gift_id", "donor_id", "gift_amount", F.lit("late").alias("note")), "gift")
    return s.read("gift")


@query("s08_create_like_template", with_views("gift") + "SELECT gift_id, donor_id, CAST(gift_date AS VARCHAR) AS gift_date, CAST(gift_amount AS DOUBLE) AS gift_amount FROM gift")
def s08(spark, d):
    s, g = store(spark), basic(spark, d)
    s.create_like("donor", g)
    s.append_aligned(g, "donor")
    return s.read("donor")


@query("s12_replace_period", with_views("gift") + """
SELECT gift_fy AS period, donor_id, count(*) AS gifts FROM gift WHERE gift_fy <> 1999 GROUP BY 1, 2 UNION ALL SELECT 1999, donor_id, -count(*) FROM gift WHERE gift_fy = 1999 GROUP BY 2""")
def s12(spark, d):
    s = store(spark)
    g = tables.gifts(spark, d).groupBy(fiscal_year(F.col("gift_date"), START).alias("period"), "donor_id").agg(F.count(F.lit(1)).alias("gifts"))
    s.replace_partition(g, "fh_group", "period")
    s.replace_partition(g.filter("period = 1999").withColumn("gifts", -F.col("gifts")), "fh_group", "period")
    return s.read("fh_group")


@query("s13_a26_merge_watermarks", with_views("gift") + """
SELECT channel AS client, CAST(max(CASE WHEN gift_type <> 'F' THEN gift_date END) AS VARCHAR) AS curated, CAST(max(CASE WHEN gift_type = 'F' THEN gift_date END) AS VARCHAR) AS master FROM gift GROUP BY 1""")
def s13(spark, d):
    s, g = store(spark), tables.gifts(spark, d)
    mark = lambda df, name: df.groupBy(F.col("channel").alias("client")).agg(F.max("gift_date").alias(name))
    s.upsert(mark(g.filter("gift_type = 'O'"), "curated"), "max_gift_dates", ["client"])
    s.upsert(mark(g.filter("gift_type = 'F' AND channel <> '5-LOW'"), "master"), "max_gift_dates", ["client"])
    s.upsert(mark(g.filter("gift_type <> 'F'"), "curated"), "max_gift_dates", ["client"])
    s.upsert(mark(g.filter("gift_type = 'F' AND channel = '5-LOW'"), "master"), "max_gift_dates", ["client"])
    s.seed(mark(g, "curated"), "max_gift_dates", ["client"])
    return s.read("max_gift_dates")


@query("s14_partitioned_years", with_views("gift") + """
SELECT 'fy' AS period, gift_fy AS "year", count(*) AS gifts FROM gift WHERE gift_fy IN (1998, 2000) GROUP BY 2""")
def s14(spark, d):
    s = store(spark)
    g = basic(spark, d).withColumns({"period": F.lit("fy"), "year": fiscal_year(F.col("gift_date"), START)})
    s.overwrite(g, "subsets", partition=["period", "year"])
    return s.read("subsets").filter("year IN (1998, 2000)").groupBy("period", "year").agg(F.count(F.lit(1)).alias("gifts"))


@query("s15_single_file_export", with_views("gift") + "SELECT CAST(gift_fy AS VARCHAR) AS gift_fy, CAST(count(*) AS VARCHAR) AS gifts FROM gift GROUP BY gift_fy")
def s15(spark, d):
    folder = scratch(spark)
    report = tables.gifts(spark, d).groupBy(fiscal_year(F.col("gift_date"), START).alias("gift_fy")).agg(F.count(F.lit(1)).alias("gifts"))
    files.export_single(report, folder)
    return spark.read.option("header", True).csv(folder)


@query("s16_recent_years", with_views("gift") + BASIC + " WHERE year(gift_date) > 1999")
def s16(spark, d):
    return files.recent_years(basic(spark, d), "gift_date", 2, F.lit("2001-09-01").cast("date"))


@query("s17_new_files", with_views("gift") + "SELECT DISTINCT 'gifts_' || strftime(gift_date, '%m%y') || '.csv' AS file_name FROM gift WHERE gift_fy > 1999")
def s17(spark, d):
    name = F.concat(F.lit("gifts_"), F.date_format("gift_date", "MMyy"), F.lit(".csv"))
    g = tables.gifts(spark, d).withColumn("file_name", name)
    return files.new_files(g, g.filter(fiscal_year(F.col("gift_date"), START) <= 1999))


@query("s18_newest_monthly_file", with_views("gift", more="""
f AS (SELECT DISTINCT CASE WHEN gift_type = 'F' THEN 'Offline_Promo_' WHEN gift_type = 'O' THEN 'Account_' ELSE 'Misc_' END || strftime(gift_date, '%m%y') || '.zip' AS n,
  CASE gift_type WHEN 'F' THEN 'offline' WHEN 'O' THEN 'account' END AS k, CAST(date_trunc('month', gift_date) AS DATE) AS m FROM gift)""") + """
SELECT k AS kind, CAST(max(m) AS VARCHAR) AS file_month, arg_max(n, m) AS file_name FROM f WHERE k IS NOT NULL GROUP BY 1""")
def s18(spark, d):
    kind = F.when(F.col("gift_type") == "F", "Offline_Promo_").when(F.col("gift_type") == "O", "Account_").otherwise("Misc_")
    # Two-digit years below 70 belong to this century in the parser, so months are read back from the date.
    names = tables.gifts(spark, d).select(
        F.concat(kind, F.date_format("gift_date", "MMyy"), F.lit(".zip")).alias("file_name"), F.trunc("gift_date", "month").alias("m"))
    shifted = names.withColumn("file_name", F.concat(F.regexp_extract("file_name", r"^(\D+)", 1), F.date_format(F.add_months("m", 120), "MMyy"), F.lit(".zip")))
    newest = files.newest_monthly_file(shifted.distinct(), "file_name", {"offline": "offline.*promo", "account": "account"})
    back = F.add_months("file_month", -120)
    return newest.select("kind", back.alias("file_month"), F.concat(
        F.regexp_extract("file_name", r"^(\D+)", 1), F.date_format(back, "MMyy"), F.lit(".zip")).alias("file_name"))


@query("s19_union_aligned", with_views("gift", "event").rstrip() + """
SELECT CAST(gift_id AS VARCHAR) AS id, CAST(CAST(gift_amount AS DOUBLE) AS DOUBLE) AS amount, channel, CAST(NULL AS VARCHAR) AS kind FROM gift
UNION ALL SELECT 'e' || gift_id, CAST(gift_amount AS DOUBLE), NULL, gift_type FROM event""")
def s19(spark, d):
    a = tables.gifts(spark, d).select(F.col("gift_id").alias("id"), F.col("gift_amount").cast("double").alias("amount"), "channel")
    b = tables.recurring(spark, d).select(F.concat(F.lit("e"), F.col("gift_id").cast("string")).alias("id"),
                                          F.col("gift_amount").cast("double").alias("amount"), F.col("gift_type").alias("kind"))
    return union_aligned(a, b)


@query("s20_collect_documents", with_views("code", more="""
u AS (SELECT source_code, campaign_name, part_id FROM code UNION ALL SELECT CASE WHEN quantity < 40 THEN substr(source_code, 1, 6) END, campaign_name, part_id + 1000000 FROM code)""") + """
SELECT source_code, arg_min(campaign_name, part_id) AS campaign_name, min(part_id) AS part_id FROM u WHERE source_code IS NOT NULL GROUP BY 1""")
def s20(spark, d):
    p = tables.parts(spark, d)
    one = p.select("source_code", "campaign_name", "part_id")
    two = p.select(
        F.when(F.col("quantity") < 40, F.substring("source_code", 1, 6)).alias("Code"), "campaign_name", (F.col("part_id") + 1000000).alias("part_id"))
    return files.collect_documents([one, two], {"Code": "source_code"}, "source_code", [F.col("part_id")])


@query("s21_derived_dataset_scan", with_views("raw") + """
SELECT CAST(k AS VARCHAR) AS gift_id, CASE WHEN donor_id <> 'nan' THEN replace(donor_id, '.0', '') ELSE 'nan' END AS donor_id, CAST(gift_date AS VARCHAR) AS gift_date FROM raw""")
def s21(spark, d):
    folder = scratch(spark)
    files.parquet_safe(tables.raw_gifts(spark, d)).write.parquet(folder)
    staged = spark.read.parquet(folder)
    return staged.select(strip_point_zero(F.col("Gift_ID")).alias("gift_id"), strip_point_zero(F.col("Donor_ID")).alias("donor_id"),
                         files.lenient_date(F.col("Gift_Date")).alias("gift_date")).orderBy(F.desc("gift_date"))


@query("s21_derived_kinds", with_views("raw", "mail").rstrip() + """
, g AS (SELECT k, gift_date, CASE WHEN gift_date >= DATE '1998-01-01' THEN gift_date END AS since FROM raw)
SELECT 'staged' AS kind, CAST(k AS VARCHAR) || '.0' AS id, CAST(gift_date AS VARCHAR) AS day, NULL AS other FROM g
UNION ALL SELECT 'staged_since', CAST(k AS VARCHAR) || '.0', CAST(since AS VARCHAR), NULL FROM g WHERE since IS NOT NULL
UNION ALL SELECT 'campaign_performance', CASE WHEN gift_id % 5 <> 0 THEN CAST(gift_id AS VARCHAR) END, CASE WHEN gift_id % 7 <> 0 THEN CAST(mail_date + 9 AS VARCHAR) END, CAST(mail_date AS VARCHAR) FROM mail
UNION ALL SELECT 'lifecycle_sorted', CAST(k AS VARCHAR) || '.0', CAST(gift_date AS VARCHAR), NULL FROM g
UNION ALL SELECT 'pledges', CAST(k AS VARCHAR) || '.0', CAST(gift_date AS VARCHAR), NULL FROM g""")
def s21b(spark, d):
    """Staged gifts, campaign performance, lifecycle and pledges as earlier runs leave them, each scanned by its kind."""
    folder, c = scratch(spark), F.col
    raw = tables.raw_gifts(spark, d).select(c("Gift ID").alias("GiftID"), c("Gift Date").alias("GiftDate"), c("Gift Type").alias("GiftType"))
    raw.write.option("header", True).csv(folder + "/staged")
    raw.write.parquet(folder + "/staged_parquet")
    raw.withColumnRenamed("GiftDate", "Recurring Gift Start").write.option("header", True).csv(folder + "/pledges")
    m = tables.mailings(spark, d)
    m.select(
        F.when(c("gift_id") % 5 == 0, "nan").otherwise(F.concat(c("gift_id").cast("string"), F.lit(".0"))).alias("GiftID"),
        F.when(c("gift_id") % 7 == 0, "no date").otherwise(F.date_format(F.date_add("mail_date", 9), "M/d/yyyy")).alias("GiftDate"),
        c("mail_date").alias("MailDate"), "revenue").write.option("header", True).csv(folder + "/performance")
    names = {"GiftID": "gift_id", "GiftDate": "gift_date", "MailDate": "mail_date", "Recurring Gift Start": "recurring_gift_start"}
    scan = lambda path, kind, **more: derived.scan_derived(spark, f"{folder}/{path}", kind, "ACME", names, **more)
    row = lambda df, kind, day, other=None: df.filter("client = 'ACME'").select(
        F.lit(kind).alias("kind"), c("gift_id").alias("id"), c(day).alias("day"), (c(other) if other else F.lit(None).cast("date")).alias("other"))
    return (row(scan("staged", "staged"), "staged", "gift_date")
            .unionAll(row(scan("staged_parquet", "staged_since", since=1998, parquet=True, columns=["gift_id", "gift_date"]), "staged_since", "gift_date"))
            .unionAll(row(scan("performance", "campaign_performance"), "campaign_performance", "gift_date", "mail_date"))
            .unionAll(row(scan("staged", "lifecycle_sorted"), "lifecycle_sorted", "gift_date"))
            .unionAll(row(scan("pledges", "pledges"), "pledges", "recurring_gift_start")))


@query("s22_streamed_window_replace", with_views("gift", more="batch AS (SELECT * FROM gift WHERE gift_fy = 1999)") + BASIC.replace("FROM gift", """FROM gift WHERE gift_date < (SELECT min(gift_date) FROM batch)
  OR gift_date > (SELECT max(gift_date) FROM batch) UNION ALL SELECT gift_id + 10000000, donor_id, CAST(gift_date AS VARCHAR), CAST(gift_amount AS DOUBLE) FROM batch"""))
def s22(spark, d):
    s, g, work = store(spark), basic(spark, d), scratch(spark)
    s.overwrite(g, "gift")
    batch = g.filter(fiscal_year(F.col("gift_date"), START) == 1999).withColumn("gift_id", F.col("gift_id") + 10000000)
    # Files whose dates overlap, in one delivery: together they replace one window.
    batch.repartition(4, "gift_id").write.option("header", True).csv(work + "/in")
    run_available(file_stream(spark, work + "/in", g.schema), s, "gift", "gift_date", work + "/log")
    return s.read("gift")


@query("s22_batch_window_replace_twice", with_views("gift") + BASIC)
def s22b(spark, d):
    g = basic(spark, d)
    batch = g.filter(F.year("gift_date") == 1998)
    return replace_window(replace_window(g, batch, "gift_date"), batch, "gift_date")


@query("s17_names_of_files_read", with_views("gift") + "SELECT 'gift_type=' || gift_type AS folder, true AS named, count(*) AS gifts FROM gift GROUP BY 1")
def s17b(spark, d):
    folder = scratch(spark)
    tables.gifts(spark, d).withColumn("kind", F.col("gift_type")).write.partitionBy("kind").parquet(folder)
    read = files.with_file_name(spark.read.parquet(folder))
    return read.groupBy(F.concat(F.lit("gift_type="), "kind").alias("folder"), F.col("file_name").rlike(r"^part-.*\.parquet$").alias("named")).agg(
        F.count(F.lit(1)).alias("gifts"))


@query("s22_ingest_clean", with_views("raw") + """
SELECT gift_id, CAST(gift_date AS VARCHAR) AS gift_date, gift_amount, coalesce(appeal_category, 'None') AS appeal_category, gift_type FROM raw WHERE gift_date <= DATE '2000-06-30'""")
def s22c(spark, d):
    renames = RENAMES | {"Gift Amount": "gift_amount", "Appeal Category": "appeal_category"}
    raw = tables.raw_gifts(spark, d).withColumn("Appeal Category", F.when(F.col("Appeal Category") != "None", F.col("Appeal Category")))
    return ingest_clean(raw, renames, ["appeal_category"], F.lit("2000-06-30").cast("date")).drop("donor_id")
