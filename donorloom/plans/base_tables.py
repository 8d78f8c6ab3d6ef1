"""Transactions, gift, donor, source-code and budget tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from donorloom.functions.clean import clean_null_tokens, database_headers, money, rename_checked, strip_point_zero, two_format_date
from donorloom.functions.codes import client_campaign, default_campaign_name, inferred_campaign
from donorloom.functions.dates import fiscal_year
from donorloom.operators.dedupe import first_by, with_made_ids
from donorloom.operators.filters import suppress, usable_gifts
from donorloom.operators.joins import missing_codes
from donorloom.operators.scale import attach, dense_index, first_value, last_value, most_common, rising
from donorloom.operators.windows import first_gift_order, gift_numbers
from donorloom.session import durable, stored

JOIN_COLUMNS = ("gift_id", "gift_amount", "channel", "gift_type")


def transactions(
    raw: DataFrame, renames: Mapping[str, str], suppressions: Sequence[tuple], client: str, start_month: int,
) -> DataFrame:
    """Raw text rows to typed, deduplicated gifts with fiscal columns. Gifts without an id get one made from their place."""
    df = suppress(raw, suppressions)
    df = clean_null_tokens(rename_checked(database_headers(df), renames))
    df = df.withColumns({
        "gift_id": strip_point_zero(F.col("gift_id")),
        "donor_id": strip_point_zero(F.col("donor_id")),
        "gift_date": two_format_date(F.col("gift_date")),
        "gift_amount": money(F.col("gift_amount")),
    })
    order = rising("gift_date", "donor_id", "gift_amount")
    rest = [c for c in df.columns if c not in ("gift_id", "gift_date", "donor_id", "gift_amount")]
    df = with_made_ids(df, "gift_id", [*order, *rising(*rest)])
    df = first_by(df, ["gift_id"], order)
    date = F.col("gift_date")
    return usable_gifts(df, "donor_id", "gift_date", "gift_amount").withColumns({
        "client": F.lit(client), "gift_month": F.month(date), "gift_cy": F.year(date),
        "gift_fy": fiscal_year(date, start_month),
    })


def gift_table(trx: DataFrame, codes: DataFrame, code: str = "campaign_code") -> DataFrame:
    """Tracked-campaign flag and the number of each gift in its donor's history.

    The flag is joined to a stored table of the distinct codes: Spark knows its size and broadcasts it
    if it is small, so that the gifts are not shuffled for it; otherwise AQE splits a heavy code.
    """
    known = stored(codes.select(code).dropna().distinct().withColumn("tracked_campaign", F.lit(True)))
    flagged = trx.join(known, code, "left").withColumn("tracked_campaign", F.coalesce("tracked_campaign", F.lit(False)))
    return gift_numbers(flagged, "donor_id", "gift_date", "gift_amount", "gift_id")


def donor_table(
    trx: DataFrame, start_month: int, columns: Sequence[str] = JOIN_COLUMNS, last: Mapping[str, str] | None = None,
) -> DataFrame:
    """Everything known per donor from one grouping: profile, first-gift and last-gift values."""
    first_order = first_gift_order("gift_date", "gift_amount", "gift_id")
    last_order = [*rising("gift_date", "gift_amount"), F.col("gift_id")]
    first_row = F.struct(*[F.col(c).alias(f"join_{c}") for c in columns])
    last = last or {}
    d, a = F.col("gift_date"), F.col("gift_amount")
    big = F.when(a >= 10000, d)
    picks = [first_value(first_row, first_order).alias("_first")]
    if last:
        picks.append(last_value(F.struct(*[F.col(c).alias(n) for n, c in last.items()]), last_order).alias("_last"))
    out = trx.groupBy("donor_id").agg(
        F.min(d).alias("first_gift_date"), F.max(d).alias("last_gift_date"), F.count(F.lit(1)).alias("gifts"),
        F.min(a).alias("min_gift_amount"), F.max(a).alias("max_gift_amount"),
        (F.sum(a).cast("double") / F.count(a)).alias("donor_average_gift"),
        F.min(big).alias("min_major_gift_date"), F.max(big).alias("max_major_gift_date"), *picks)
    span = (F.datediff("last_gift_date", "first_gift_date") + 1) / 365
    out = out.withColumns({
        "lifespan": span, "core_donor": span >= 2, "join_cy": F.year("first_gift_date"),
        "join_fy": fiscal_year(F.col("first_gift_date"), start_month), "join_month": F.month("first_gift_date"),
        "major_gift_definition": F.lit(10000)})
    keep = [c for c in out.columns if not c.startswith("_")]
    return out.select(*keep, "_first.*", *(["_last.*"] if last else []))


def standard_source_codes(codes: DataFrame, client: str, start_month: int) -> DataFrame:
    """Campaign names, fiscal year of the mailing and the client-campaign key; codes without a mail date go."""
    fy = fiscal_year(F.col("mail_date"), start_month)
    out = codes.withColumn("fy", fy).filter(F.col("fy") > 1900)
    out = out.withColumn("campaign_name", F.coalesce("campaign_name", default_campaign_name(
        F.col("fy"), F.col("mail_date"), F.col("package_name"))))
    source = F.when(F.startswith("source_code", F.lit("BUDGET_SC")), "budget_missing_sc").otherwise("load_source_codes")
    return out.withColumns({
        "client": F.lit(client), "source": F.coalesce(source, F.lit("load_source_codes")),
        "client_campaign": client_campaign(F.lit(client), F.col("campaign_code"), F.col("campaign_name"),
                                           F.col("source_code"), F.col("fy")),
    })


def unsourced_years(gifts: DataFrame, client: str, start_month: int) -> DataFrame:
    """One placeholder per year from the year before the first gift, and one without a year."""
    years = gifts.agg(F.min("gift_date").alias("lo"), F.max("gift_date").alias("hi")).select(F.explode(
        F.concat(F.transform(F.sequence(F.year("lo") - 1, F.year("hi")), lambda y: y.cast("string")),
                 F.array(F.lit("XXXX")))).alias("y"))
    named = F.concat(F.lit("UNSOURCED-FY"), "y")
    return years.select(
        F.lit(client).alias("client"), named.alias("source_code"), named.alias("campaign_code"),
        F.concat(F.lit("Unsourced FY"), "y").alias("campaign_name"),
        F.concat(F.upper(F.lit(client)), F.lit("-"), named).alias("client_campaign"),
        F.col("y").try_cast("int").alias("fy"),
        F.make_date(F.col("y").try_cast("int"), F.lit(start_month), F.lit(1)).alias("mail_date"),
        F.lit("unsourced fallbacks").alias("source"))


def inferred_codes(gifts: DataFrame, codes: DataFrame, client: str, start_month: int) -> DataFrame:
    """Codes on gifts that the table lacks, with an estimated mail date per code and fiscal year.

    Empty codes and ``NONE`` count as missing and stay. The campaign group comes from the most frequent group of the campaign code.
    """
    fy = fiscal_year(F.col("gift_date"), start_month)
    code = F.when(~F.col("source_code").isin("", "NONE"), F.col("source_code"))
    # Never null itself, so that rows with neither code nor name keep their date as well.
    key = F.struct(F.concat(F.coalesce("source_code", "campaign_name"), F.lit("_"), fy.cast("string")).alias("k"))
    # Gifts count only by their first date, so their combinations are looked up instead of them, and derived once.
    group = ["source_code", "campaign_code", "campaign_name", "_key"]
    combined = durable(gifts.select(code.alias("source_code"), "campaign_code", "campaign_name", "gift_date").withColumn(
        "_key", key).groupBy(*group).agg(F.min("gift_date").alias("gift_date")))
    rows = missing_codes(combined, codes, "source_code")
    first = rows.groupBy("_key").agg(F.min("gift_date").alias("mail_date"))
    rows = rows.drop("gift_date").join(first, "_key").drop("_key")
    out = rows.withColumn("fy", fiscal_year(F.col("mail_date"), start_month)).distinct()
    groups = most_common(codes.select("campaign_code", "campaign_group").distinct(), ["campaign_code"],
                         "campaign_group", "campaign_group")
    return out.join(groups, "campaign_code", "left").withColumns({
        "client": F.lit(client), "source": F.lit("inferred from trx"),
        "client_campaign": inferred_campaign(F.lit(client), F.col("campaign_code"), F.col("campaign_name"),
                                             F.col("source_code"), F.col("fy")),
    })


def numbered_codes(codes: DataFrame, client: str, kind: str, key: str = "source_code") -> DataFrame:
    """Integer key per distinct code and the curated text key ``CLIENT_kind_n``."""
    ids = dense_index(codes.select(key).distinct(), [F.col(key)], "source_code_key")
    return attach(codes, ids, [key]).withColumn("sc_key_curated", F.concat(
        F.upper(F.lit(client)), F.lit(f"_{kind}_"), F.col("source_code_key").cast("string")))


def ingest_clean(raw: DataFrame, renames: Mapping[str, str], text_columns: Sequence[str], now: Column) -> DataFrame:
    """Bronze typing: dates, no future rows, money, and ``None`` text in declared text columns."""
    df = raw.withColumnsRenamed(dict(renames)).withColumns({
        "gift_date": two_format_date(F.col("gift_date")), "gift_amount": money(F.col("gift_amount"))})
    df = df.filter(F.col("gift_date") <= now)
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in text_columns})
