"""Sequence operators per donor.

Row-level windows over a donor are avoided. Gifts are first reduced to one row
per donor and day (or year); a window over those rows is bounded by the
calendar, and its answers are joined back to the gifts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from donorloom.functions.rules import sure
from donorloom.operators.scale import attach, dense_index, falling, first_value, keep_last, last_value, number_rows, rising

UP_TO_HERE = (W.unboundedPreceding, W.currentRow)


def gift_numbers(df: DataFrame, donor: str, date: str, amount: str, tie: str, name: str = "donor_gift_number") -> DataFrame:
    """1, 2, ... per donor by date, larger amounts first on the same day.

    Gifts without a date come first, those without an amount last on their day;
    gifts without a donor are numbered among themselves. Days with very many gifts
    of one donor are split by amount, then by id.
    """
    larger_first = F.struct(F.col(amount).isNull(), -F.col(amount))
    return number_rows(df, [donor], [F.col(date), larger_first, F.col(tie)], [F.col(date), F.col(amount).desc(), F.col(tie)], name)


def first_gift_order(date: str, amount: str, tie: str) -> list[Column]:
    return [*rising(date), *falling(amount), F.col(tie)]


def first_attributes(df: DataFrame, donor: str, order: Sequence[Column], columns: Mapping[str, str]) -> DataFrame:
    """One row per donor with values of the first gift: {output name: column}."""
    return _first_rows(df, donor, order, columns).drop("_n")


def _first_rows(df, donor, order, columns) -> DataFrame:
    row = F.struct(*[F.col(c).alias(n) for n, c in columns.items()])
    return df.groupBy(donor).agg(first_value(row, order).alias("_f"), F.count(F.lit(1)).alias("_n")).select(donor, "_f.*", "_n")


def last_attributes(df: DataFrame, donor: str, order: Sequence[Column], columns: Mapping[str, str]) -> DataFrame:
    row = F.struct(*[F.col(c).alias(n) for n, c in columns.items()])
    return df.groupBy(donor).agg(last_value(row, order).alias("_l")).select(donor, "_l.*")


def with_join_values(df: DataFrame, donor: str, order: Sequence[Column], columns: Mapping[str, str]) -> DataFrame:
    """Every gift with values of its donor's first gift."""
    return attach(df, _first_rows(df, donor, order, columns), [donor], "_n")


def streaks(years: DataFrame, keys: Sequence[str], year: str, given: str) -> DataFrame:
    """Start of the giving streak each (key, year) row belongs to, and the streak of the row before.

    ``years`` has one row per key and year; ``given`` is 1 when there was a gift.
    """
    w = W.partitionBy(*keys).orderBy(year)
    starts = F.when((F.col(given) == 1) & (F.coalesce(F.lag(given).over(w), F.lit(0)) == 0), F.col(year))
    out = years.withColumn("streak_start", starts)
    out = out.withColumn("first_year_in_streak", F.when(
        F.col(given) == 1, F.max("streak_start").over(w.rowsBetween(*UP_TO_HERE))))
    return out.withColumn("last_years_streak", F.lag("first_year_in_streak").over(w))


def year_offsets(df: DataFrame, year: str) -> DataFrame:
    """Distinct years with their distance to the newest (0, -1, ...)."""
    years = df.select(year).distinct()
    return years.withColumn("offset", F.col(year) - years.agg(F.max(year)).scalar())


def years_before(df: DataFrame, donor: str, year: str, report_year: Column) -> DataFrame:
    """Per donor: latest gift year before the report year, and before the year before it (0 if none)."""
    y = F.col(year)
    return df.groupBy(donor).agg(
        F.coalesce(F.max(F.when(y < report_year, y)), F.lit(0)).alias("prev_year"),
        F.coalesce(F.max(F.when(y < report_year - 1, y)), F.lit(0)).alias("prev_prev_year"))


def date_gaps(df: DataFrame, date: str, keys: Sequence[str] = (), longer_than: int = 2) -> DataFrame:
    """Breaks in the calendar of gift dates, of each of ``keys`` if there are any. The window sees distinct days only."""
    days = df.select(*keys, F.col(date).cast("date").alias(date)).filter(F.col(date).isNotNull()).distinct()
    gaps = days.withColumn("prev_date", F.lag(date).over(W.partitionBy(*keys).orderBy(date)))
    gaps = gaps.withColumn("gap_days", F.datediff(date, "prev_date"))
    return gaps.filter(F.col("gap_days") > longer_than).orderBy(F.desc("gap_days"), date, *keys)


def days_since_previous(df: DataFrame, donor: str, date: str, tie: str) -> DataFrame:
    """Days since the donor's previous gift; later gifts of a day are 0 days after the first."""
    days = df.groupBy(donor, date).agg(F.min(tie).alias("_first"), F.count(F.lit(1)).alias("_n"))
    days = days.withColumn("_prev", F.lag(date).over(W.partitionBy(donor).orderBy(date)))
    out = attach(df, days, [donor, date], "_n")
    gap = F.when(F.col(tie) == F.col("_first"), F.datediff(date, "_prev")).otherwise(F.lit(0))
    return out.withColumn("days_since_previous", gap).drop("_first", "_prev")


def next_gift_days(df: DataFrame, donor: str, date: str) -> DataFrame:
    """One row per donor and gift day with the days to the donor's next one; null on the last."""
    days = df.select(donor, date).distinct()
    return days.withColumn("days_to_next", F.datediff(F.lead(date).over(W.partitionBy(donor).orderBy(date)), date))


def mean_gap(df: DataFrame, donor: str, date: str) -> DataFrame:
    """Average days between gifts: the differences of a sorted list add up to its range."""
    span = F.datediff(F.max(date), F.min(date))
    n = F.count(date)
    return df.groupBy(donor).agg(F.when(n > 1, span / (n - 1)).alias("mean_gap_days"))


def second_gift(df: DataFrame, donor: str, date: str, amount: str, tie: str) -> DataFrame:
    """Per donor: first and second gift day, the second day's first gift amount, days between."""
    days = df.groupBy(donor, date).agg(F.min_by(amount, tie).alias("_amount"), F.count(F.lit(1)).alias("_n"))
    w = W.partitionBy(donor)
    days = days.withColumn("_first", F.min(date).over(w))
    later = F.col(date) > F.col("_first")
    out = days.groupBy(donor).agg(
        F.min(date).alias("first_gift_date"),
        F.min(F.when(later, F.col(date))).alias("second_gift_date"),
        F.min_by(F.when(later, F.col("_amount")), F.when(later, F.col(date))).alias("second_gift_amount"),
        F.max(date).alias("last_gift_date"),
        F.sum("_n").alias("total_gifts"))
    return out.withColumns({
        "days_to_second_gift": F.datediff("second_gift_date", "first_gift_date"),
        "gave_second_gift": F.col("total_gifts") > 1,
        "days_on_file": F.datediff("last_gift_date", "first_gift_date"),
    })


def fill_from_group(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[Column]) -> DataFrame:
    """Every row gets its group's first non-null value."""
    first = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(first_value(value, order).alias("_v"))
    return attach(df.drop(value), first.withColumnRenamed("_v", value), keys)


def fill_forward(days: DataFrame, keys: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    """Last non-null value up to each row, for a table with one row per key and day (or period)."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(*UP_TO_HERE)
    return days.withColumn(name, F.last(value, ignorenulls=True).over(w))


def group_transform(df: DataFrame, keys: Sequence[str], aggregate: Column, name: str) -> DataFrame:
    """An aggregate per key brought back to the rows. Filters go inside: ``F.max(F.when(mask, x))``."""
    return attach(df, df.groupBy(*keys).agg(aggregate.alias(name), F.count(F.lit(1)).alias("_n")), keys, "_n")


def join_detail(df: DataFrame, donor: str, date: str, aggregate, value: str, name: str) -> DataFrame:
    """An aggregate over the gifts of the donor's first day, on every gift."""
    days = df.groupBy(donor, date).agg(aggregate(value).alias("_v"), F.count(F.lit(1)).alias("_n"))
    first = days.groupBy(donor).agg(F.min_by("_v", date).alias(name), F.sum("_n").alias("_n"))
    return attach(df, first, [donor], "_n")


def membership_periods(days: DataFrame, donor: str, date: str, event: str, gap: int = 183) -> DataFrame:
    """Start date of the membership each donor day belongs to.

    ``days`` has one row per donor and day, ``event`` the most recent recurring
    gift date on or before it. A jump of more than ``gap`` days between
    recurring gifts starts a new membership.
    """
    w = W.partitionBy(donor).orderBy(date)
    jump = F.datediff(F.col(event), F.lag(event).over(w)) > gap
    start = F.when(F.row_number().over(w) == 1, F.first(event).over(w)).when(sure(jump), F.col(event))
    return days.withColumn("_start", start).withColumn(
        "membership_start", F.last("_start", ignorenulls=True).over(w.rowsBetween(*UP_TO_HERE))).drop("_start")


def split_shared_codes(df: DataFrame, code: str, appeal: str, order: str) -> DataFrame:
    """Codes used by several appeals: the second appeal's rows get ``_2``, the third's ``_3``, by first use."""
    pairs = df.filter(F.col(code).isNotNull() & F.col(appeal).isNotNull()).groupBy(code, appeal).agg(
        F.min(order).alias("_seen"))
    nth = F.row_number().over(W.partitionBy(code).orderBy("_seen", appeal))
    suffix = pairs.select(code, appeal, F.when(nth > 1, F.concat(F.lit("_"), nth.cast("string"))).alias("_suffix"))
    out = attach(df, suffix, [code, appeal])
    return out.withColumn(code, F.concat(F.col(code), F.coalesce(F.col("_suffix"), F.lit("")))).drop("_suffix")


def rejoin_by_period(
    gifts: DataFrame, donor: str, period: str, start: str, end: str, date: str, tie: str, channel: str,
) -> DataFrame:
    """Per donor and period: channel and month of the first gift in it, carried forward over empty periods."""
    inside = (F.col(date) >= F.col(start)) & (F.col(date) <= F.col(end))
    pick = F.struct(F.col(channel).alias("channel"), F.month(date).cast("long").alias("month"))
    first = gifts.groupBy(donor, period).agg(
        F.min_by(F.when(inside, pick), F.when(inside, F.struct(date, tie))).alias("_f"))
    w = W.partitionBy(donor).orderBy(period).rowsBetween(*UP_TO_HERE)
    carried = first.withColumn("_f", F.last("_f", ignorenulls=True).over(w))
    return carried.select(donor, period, F.col("_f.channel").alias("rejoin_channel"),
                          F.col("_f.month").alias("rejoin_month"))


def surrogate_key(df: DataFrame, natural: str, name: str) -> DataFrame:
    """Dense integer per distinct natural key, from 0 in key order."""
    ids = df.filter(F.col(natural).isNotNull()).groupBy(natural).agg(F.count(F.lit(1)).alias("_n"))
    return attach(df, dense_index(ids, [F.col(natural)], name), [natural], "_n")


def latest_row(df: DataFrame, keys: Sequence[str], date: str, tie: Sequence[str]) -> DataFrame:
    """Newest row per key; rows without a date come last."""
    return keep_last(df, keys, [F.col(date), *[F.col(c) for c in tie]])


def yearly_change(df: DataFrame, keys: Sequence[str], year: str, amount: Column) -> DataFrame:
    """Total per key and year, and its change from the key's previous giving year."""
    totals = df.groupBy(*keys, year).agg(F.sum(amount).alias("total"))
    return totals.withColumn("change", F.col("total") - F.lag("total").over(W.partitionBy(*keys).orderBy(year)))
