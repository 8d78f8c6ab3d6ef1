"""Recurring donors: status, cohorts, retention, and upgrade/downgrade labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from donorloom.functions.bands import months_status, recency_band
from donorloom.functions.dates import fiscal_year, months_ago
from donorloom.functions.rules import sure
from donorloom.operators.scale import attach, first_value, spread_join
from donorloom.operators.windows import membership_periods

LAPSE_DAYS = 183
YEARS = (1, 2, 3, 4, 5)


def sustainer_status(gifts: DataFrame, recurring: Column) -> DataFrame:
    """Per donor: months since the last recurring gift at the last complete month, and the status.

    The last complete month is the one before the newest gift's month.
    """
    newest = gifts.agg(F.max("gift_date")).scalar()
    complete = F.add_months(F.trunc(newest, "month"), -1)
    month = F.trunc("gift_date", "month")
    counted = F.when(sure(recurring) & (month <= complete), months_ago(complete, month))
    per_donor = gifts.groupBy("donor_id").agg(F.min(counted).alias("months_since"))
    return per_donor.withColumn("sustainer_status", months_status(F.col("months_since")))


def sustainer_fields(gifts: DataFrame, recurring: Column, start_month: int, last_month: int, last_day: int) -> DataFrame:
    """Flag, first recurring date, join fiscal year and month, and the source and program of the join.

    Donor days give the first recurring date, the channel of the first gift on that
    day and the newest day; one join brings them back. The flag needs the fiscal
    year end of the gift, and whether the donor gave on or after the first
    recurring date by a year end no later than it.
    """
    days = gifts.groupBy("donor_id", "gift_date").agg(
        first_value("channel", [F.col("gift_id")]).alias("_channel"), F.max(sure(recurring)).alias("_r"),
        F.count(F.lit(1)).alias("_n"))
    began_on = F.when(F.col("_r"), F.col("gift_date"))
    donors = days.groupBy("donor_id").agg(
        F.min(began_on).alias("first_sustainer_date"), F.min_by("_channel", began_on).alias("sustainer_join_source"),
        F.max("gift_date").alias("_newest"), F.sum("_n").alias("_n"))
    newest, first = F.col("_newest"), F.col("first_sustainer_date")
    donors = donors.withColumn("_last_since", F.when(newest >= first, newest)).drop("_newest")
    rows = attach(gifts, donors, ["donor_id"], "_n")
    since = sure(F.col("gift_date") >= first)
    year_end = F.make_date(fiscal_year(F.col("gift_date"), start_month), F.lit(last_month), F.lit(last_day))
    began = sure(first <= year_end)
    return rows.withColumns({
        "sustainer_gift_flag": F.when(sure(recurring), "Sustainer Gift").otherwise("1X Gift"),
        "sustainer_flag": F.when(since | (began & F.col("_last_since").isNotNull()), "Sustainer").otherwise("1X Giver"),
        "sustainer_join_fiscal": F.when(since, fiscal_year(first, start_month)),
        "sustainer_join_month": F.when(since, F.month(first)),
    }).drop("_last_since")


def membership_days(gifts: DataFrame, recurring: Column, start_month: int) -> DataFrame:
    """Days of recurring donors from their first recurring gift on, with membership and status.

    One row per donor and day, with its number of gifts in ``_n``; all windows over
    them share one shuffle by donor.
    """
    days = gifts.groupBy("donor_id", "gift_date").agg(
        F.max(sure(recurring)).alias("_r"), F.count(F.lit(1)).alias("_n"))
    donor = W.partitionBy("donor_id")
    given = F.when(F.col("_r"), F.col("gift_date"))
    days = days.withColumns({
        "first_gift_date": F.min("gift_date").over(donor), "sust_first_date": F.min(given).over(donor),
        "recent_sust_date": F.max(given).over(donor.orderBy("gift_date").rowsBetween(W.unboundedPreceding, W.currentRow)),
    }).filter(F.col("gift_date") >= F.col("sust_first_date")).drop("_r")
    days = membership_periods(days, "donor_id", "gift_date", "recent_sust_date", LAPSE_DAYS)
    delta = F.datediff("gift_date", "recent_sust_date")
    return days.withColumns({
        "gift_fy": fiscal_year(F.col("gift_date"), start_month),
        "sustainer_type": F.when(F.col("first_gift_date") == F.col("sust_first_date"), "New").otherwise("Converted"),
        "days_since_sust": delta,
        "sustainer_status": F.when(delta <= LAPSE_DAYS, "Active").when(delta > LAPSE_DAYS, "Lapsed"),
        "sust_join_fy": fiscal_year(F.col("membership_start"), start_month),
        "days_since_join": F.datediff("gift_date", "membership_start"),
    })


def _back_on_gifts(gifts: DataFrame, days: DataFrame, recurring: Column) -> DataFrame:
    flagged = gifts.drop("gift_fy").withColumn("sust_gift_flag", F.when(sure(recurring), "Sustainer").otherwise("1x"))
    return spread_join(flagged, days, ["donor_id", "gift_date"], "inner", "_n")


def memberships(gifts: DataFrame, recurring: Column, start_month: int) -> DataFrame:
    """Gifts of recurring donors from their first recurring gift on, with membership and status."""
    return _back_on_gifts(gifts, membership_days(gifts, recurring, start_month), recurring)


def year_bounds(year: int) -> tuple[int, int]:
    """Days after joining that make a donor active in year n."""
    lead = {1: 275, 2: 184}.get(year, 1)
    return (year - 1) * 365 + lead, year * 365


def active_in_year(days: Column, year: int) -> Column:
    low, high = year_bounds(year)
    return (days > low) & (days <= high)


def active_days(gifts: DataFrame, recurring: Column, start_month: int) -> DataFrame:
    days = membership_days(gifts, recurring, start_month)
    return days.filter(~sure(F.col("sustainer_status") == "Lapsed"))


def cohort(gifts: DataFrame, recurring: Column, start_month: int, years: Sequence[int] = YEARS) -> DataFrame:
    """Active gifts with days on file, yearly activity, cohort flags and lifetime-value flags.

    All of them follow from the donor's days, so the gifts are joined once.
    """
    since = F.col("days_since_join")
    days = active_days(gifts, recurring, start_month)
    days = days.withColumns({f"active_{y}": active_in_year(since, y).cast("int") for y in years}
                            | {f"ltv_{y}": (since <= y * 365).cast("int") for y in years})
    member = W.partitionBy("donor_id", "membership_start")
    joined = W.partitionBy("donor_id", "sust_join_fy")
    days = days.withColumns(
        {"days_on_file": F.datediff(F.max("gift_date").over(member), F.min("gift_date").over(member))}
        | {f"donor_{y}": F.max(f"active_{y}").over(joined) for y in years})
    return _back_on_gifts(gifts, days, recurring)


def retention(gifts: DataFrame, recurring: Column, start_month: int, years: Sequence[int] = YEARS) -> DataFrame:
    """Share of each join year's donors that are active in year 1, 2, ... after joining."""
    donors = active_days(gifts, recurring, start_month).groupBy("sust_join_fy", "donor_id").agg(*[
        F.max(active_in_year(F.col("days_since_join"), y).cast("int")).alias(f"a{y}") for y in years])
    n = F.count(F.lit(1))
    return donors.groupBy("sust_join_fy").agg(
        n.alias("donors"), *[(F.sum(f"a{y}") / n).alias(f"retained_{y}") for y in years])


def sustainer_recency(gifts: DataFrame, recurring: Column, missing: str = "Z: None") -> DataFrame:
    """Recency band of the last recurring gift before each gift's day; the label for none otherwise."""
    # The day before as probe: only earlier days count.
    days = gifts.groupBy("donor_id", "gift_date").agg(F.max(sure(recurring)).alias("_r"), F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("donor_id").orderBy("gift_date").rowsBetween(W.unboundedPreceding, -1)
    days = days.withColumn("recent_sust_date", F.max(F.when(F.col("_r"), F.col("gift_date"))).over(before)).drop("_r")
    out = attach(gifts, days, ["donor_id", "gift_date"], "_n")
    months = F.floor(F.datediff("gift_date", "recent_sust_date") / F.lit(30.436875) + 0.5)
    return out.withColumns({"sust_months": months, "sust_recency": recency_band(months, missing)})


def upgrade_downgrade(gifts: DataFrame, start_month: int) -> DataFrame:
    """Change of giving per donor and report year against the donor's previous giving year.

    Donors have one row per year from their first to the newest year on file.
    """
    totals = gifts.groupBy("donor_id", fiscal_year(F.col("gift_date"), start_month).alias("yr")).agg(
        F.sum("gift_amount").alias("total"))
    last = totals.agg(F.max("yr")).scalar()
    spans = totals.groupBy("donor_id").agg(F.min("yr").alias("lo"))
    grid = spans.select("donor_id", F.explode(F.sequence(F.col("lo"), last)).alias("yr"))
    line = grid.join(totals, ["donor_id", "yr"], "left")
    w = W.partitionBy("donor_id").orderBy("yr")
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = w.rowsBetween(W.unboundedPreceding, -1)
    change = F.when(F.col("total").isNotNull(), F.coalesce(
        F.col("total") - F.last("total", ignorenulls=True).over(earlier), F.lit(0)))
    line = line.withColumn("_change", change)
    line = line.withColumns({
        "change": F.last("_change", ignorenulls=True).over(upto),
        "current_year": F.col("total").isNotNull(),
        "previous_year": F.coalesce(F.lag("total").over(w).isNotNull(), F.lit(False)),
    })
    now, before, c = F.col("current_year"), F.col("previous_year"), F.col("change")
    label = (F.when(~now & ~before, "NoRecentGiving").when(~now & before, "NoCurrentYearGiving")
             .when(now & ~before, "NoPreviousYearGiving").when(c > 0, "Upgrade").when(c < 0, "Downgrade")
             .otherwise("Same"))
    return line.select("donor_id", "yr", "total", "change", label.alias("upgrade_downgrade"))
