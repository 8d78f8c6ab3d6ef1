"""Campaign cost, response and mailing reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from donorloom.functions.bands import gift_level
from donorloom.functions.codes import pad_left, pad_right
from donorloom.functions.dates import fiscal_year
from donorloom.functions.rules import matches_any, starts_any, sure
from donorloom.operators.aggregates import rfm
from donorloom.operators.scale import attach, group_rare, keep_first


def broker_report(gifts: DataFrame, codes: DataFrame) -> DataFrame:
    """Returns, revenue, cost and net per source code and gift level.

    A code's quantity is shared evenly over its gift levels. Codes without gifts
    and gifts without a known code both stay in the report.
    """
    # One grouping by code holds its levels, at most as many as there are bands; it meets the codes once.
    # A gift is one row of it first, so that a distinct count becomes a plain one.
    group = ["source_code", "gift_level"]
    levels = gifts.withColumn("gift_level", gift_level(F.col("gift_amount"))).select(*group, "gift_id", "gift_amount")
    by_gift = group_rare(levels, [*group, "gift_id"], "revenue", F.sum("gift_amount"), F.sum("revenue"))
    grouped = by_gift.groupBy(*group).agg(F.count("gift_id").alias("returns"), F.sum("revenue").alias("revenue"))
    by_code = grouped.groupBy("source_code").agg(F.collect_list(F.struct("gift_level", "returns", "revenue")).alias("_levels"))
    rows = codes.join(by_code, "source_code", "full").select("*", F.explode_outer("_levels").alias("_level")).select(
        "*", "_level.*", F.coalesce(F.size("_levels"), F.lit(0)).alias("levels")).drop("_level", "_levels")
    d = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
    n = d("levels")
    rows = rows.withColumn("share", F.when(n > 0, F.col("quantity") / n).otherwise(F.col("quantity").cast("double")))
    rows = rows.withColumns({
        "returns": F.coalesce("returns", F.lit(0)), "revenue": d("revenue"),
        "list_cost": F.coalesce(F.col("list_cpp").cast("double") * F.col("share"), F.lit(0.0)),
        "package_cost": F.coalesce(F.col("package_cpp").cast("double") * F.col("share"), F.lit(0.0)),
    })
    rows = rows.withColumn("net", F.col("revenue") - F.col("list_cost") - F.col("package_cost"))
    return rows.withColumns({
        "net_per_response": F.when(F.col("returns") > 0, F.col("net") / F.col("returns")).when(F.col("net") < 0, 0.0),
        "campaign_code": F.coalesce("campaign_code", F.substring("source_code", 1, 8)),
    })


def campaign_counts(codes: DataFrame, campaign: str = "campaign_code", date: str = "mail_date") -> DataFrame:
    """Rows and first mail date per campaign, joined on the campaign itself."""
    return codes.groupBy(campaign).agg(F.count(F.lit(1)).alias("count"), F.min(date).alias("first_mail_date")).orderBy(
        F.desc("count"), "first_mail_date", campaign)


def select_campaigns(
    campaigns: DataFrame, code: str, starts: Sequence[str] = (), ends: Sequence[str] = (),
    contains: Sequence[str] = (), years: Sequence[str] = (), year_position: int = 0,
) -> DataFrame:
    """Campaigns by start, end and content patterns, and two year digits at a 0-based position."""
    c = F.col(code)
    mask = F.lit(True)
    if starts:
        mask = mask & starts_any(c, starts)
    if ends:
        mask = mask & matches_any(c, [f"({'|'.join(ends)})$"])
    if contains:
        mask = mask & matches_any(c, contains, ignore_case=True)
    if years:
        mask = mask & matches_any(F.substring(c, year_position + 1, 2), years)
    return campaigns.filter(mask)


def running_campaigns(gifts: DataFrame, campaign: str, date: str, start_month: int, fiscal_now: Column, limit: int = 340) -> DataFrame:
    """Campaigns with gifts in the current fiscal year whose gifts span less than ``limit`` days."""
    return gifts.groupBy(campaign).agg(
        F.min(date).alias("first_gift"), F.max(date).alias("last_gift"),
        F.count_if(fiscal_year(F.col(date), start_month) == fiscal_now).alias("_now"),
    ).filter((F.col("_now") > 0) & (F.datediff("last_gift", "first_gift") < limit)).drop("_now")


def frequent_donors(
    gifts: DataFrame, mailings: DataFrame, as_of: Column, fiscal: int | Column, start_month: int, top: float,
) -> DataFrame:
    """Recency, frequency, monetary, year revenue and times mailed of donors who gave and were mailed."""
    base = rfm(gifts, "donor_id", "gift_id", "gift_date", "gift_amount", as_of)
    year = gifts.filter(fiscal_year(F.col("gift_date"), start_month) == fiscal).groupBy("donor_id").agg(
        F.sum("gift_amount").alias("year_revenue")).filter(~sure(F.col("year_revenue") > top))
    mailed = mailings.filter(fiscal_year(F.col("mail_date"), start_month) == fiscal).groupBy("donor_id").agg(
        F.count(F.lit(1)).alias("times_mailed"))
    return base.join(year, "donor_id").join(mailed, "donor_id").withColumn(
        "revenue_per_mailing", F.col("year_revenue").cast("double") / F.col("times_mailed"))


def non_giver_shares(gifts: DataFrame, mailings: DataFrame, fiscal: int | Column, start_month: int, as_of: Column) -> DataFrame:
    """One row: donors mailed, share that did not give in the year, share of one-time small lapsed donors."""
    year = fiscal_year(F.col("gift_date"), start_month) == fiscal
    donors = gifts.groupBy("donor_id").agg(
        F.max(year.cast("int")).alias("gave"), F.datediff(as_of, F.max("gift_date")).alias("recency"),
        F.count_distinct("gift_id").alias("frequency"), F.max("gift_amount").alias("monetary"))
    mailed = mailings.select("donor_id").distinct().withColumn("mailed", F.lit(1))
    # The mailed people and the givers in one grouping; either side may be missing.
    both = donors.withColumn("mailed", F.lit(0)).unionByName(mailed, allowMissingColumns=True).groupBy("donor_id").agg(
        F.max("mailed").alias("mailed"), F.coalesce(F.max("gave"), F.lit(0)).alias("gave"),
        F.max("recency").alias("recency"), F.max("frequency").alias("frequency"), F.max("monetary").alias("monetary"))
    rule = (F.col("recency") > 1000) & (F.col("frequency") == 1) & (F.col("monetary") < 100)
    row = both.agg(
        F.sum("mailed").alias("mailed"), F.count_if((F.col("mailed") == 1) & (F.col("gave") == 0)).alias("silent"),
        F.count_if(rule).alias("matching"), F.count(F.lit(1)).alias("people"))
    return row.withColumns({"silent_share": F.col("silent") / F.col("mailed"),
                            "matching_share": F.col("matching") / F.col("people")})


def mail_masters(promos: DataFrame, accounts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Newest promotion row per finder number and newest account row per constituent."""
    newest = lambda df, key, date, tie: keep_first(
        df, [key], [F.col(date).isNull(), -F.unix_date(date), F.col(tie)])
    return newest(promos, "finder_number", "mail_date", "line"), newest(accounts, "constituent", "acquired", "line")


def promo_history(promos: DataFrame) -> DataFrame:
    """Source codes of promotions, padded and put together, with people mailed and latest date.

    Cold codes (``QQ``) keep their own code without blanks and take the list code from it.
    """
    cold = sure(F.startswith("campaign_code", F.lit("QQ")))
    rows = promos.withColumns({
        "campaign_code": pad_right(F.col("campaign_code"), 8, "Z"),
        "package_code": pad_right(F.col("package_code"), 2, "Z"),
        "list_code": F.coalesce(pad_left(F.col("list_code"), 4, "L"), F.lit("LLLL")),
    })
    rows = rows.withColumn("source_code", F.when(cold, F.replace("source_code", F.lit(" "), F.lit(""))).otherwise(
        F.concat("campaign_code", "list_code", "package_code")))
    rows = rows.withColumn("list_code", F.when(cold, pad_right(F.substring("source_code", 9, 4), 4, "Z")).otherwise(
        F.col("list_code")))
    people = rows.groupBy("source_code", "constituent").agg(
        F.max("mail_date").alias("mail_date"),
        F.min(F.struct("campaign_code", "list_code", "package_code", "package_name")).alias("_n"))
    codes = people.filter(F.col("source_code").isNotNull()).groupBy("source_code").agg(
        F.count(F.lit(1)).alias("quantity"), F.max("mail_date").alias("mail_date"), F.min("_n").alias("_n"))
    return codes.select("source_code", "quantity", "mail_date", "_n.*")


def times_mailed(gifts: DataFrame, mailings: DataFrame) -> DataFrame:
    """Gifts of mailed donors with the number of mailings their donor got."""
    counts = mailings.groupBy("donor_id").agg(F.count(F.lit(1)).alias("times_mailed"))
    return attach(gifts, counts, ["donor_id"]).filter(F.col("times_mailed").isNotNull())


def join_groups(gifts: DataFrame, channel: Column, windows: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Donors by channel of the first gift and the window it falls in; others have no group."""
    first = gifts.withColumn("_channel", channel).groupBy("donor_id").agg(
        F.min("gift_date").alias("first_gift_date"),
        F.min_by("_channel", F.struct("gift_date", "gift_id")).alias("join_channel"))
    group = F.lit(None).cast("string")
    for name, (low, high) in windows.items():
        inside = F.col("first_gift_date").between(F.lit(low).cast("date"), F.lit(high).cast("date"))
        group = F.when(inside, F.concat("join_channel", F.lit(f"-{name}"))).otherwise(group)
    return first.withColumn("join_group", F.when(F.col("join_channel") != "Other", group))
