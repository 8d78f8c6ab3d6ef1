"""Fiscal and reporting-period date columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH_END = "last day of month"


def fiscal_year(date: Column, start_month: int) -> Column:
    """Fiscal year named after the calendar year it ends in."""
    if start_month == 1:
        return F.year(date)
    return F.year(date) + (F.month(date) >= start_month).cast("int")


def period_year(date: Column, start_month: int, report: str = "fy") -> Column:
    """Year of a gift in a report: fiscal reports look forward, the others backward."""
    if start_month == 1:
        return F.year(date)
    if "fy" in report:
        return fiscal_year(date, start_month)
    return F.year(date) - (F.month(date) < start_month).cast("int")


def register_fiscal_from_date(spark: SparkSession, name: str = "fiscal_from_date") -> None:
    """The same rule as a SQL function for users who write SQL."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(d DATE, start_month INT) RETURNS INT
        RETURN YEAR(d) + IF(start_month > 1 AND MONTH(d) >= start_month, 1, 0)
    """)


def month_name(date: Column) -> Column:
    return F.date_format(date, "MMMM")


def iso_week(date: Column) -> Column:
    return F.weekofyear(date)


def fiscal_first_day(year: Column, month: int = 7, day: int = 1, known: Column | None = None) -> Column:
    """First day of a fiscal year; null where ``known`` is null."""
    value = F.make_date(year - 1, F.lit(month), F.lit(day))
    return value if known is None else F.when(known.isNotNull(), value)


def fiscal_last_day(year: Column, month: int = 6, day: int = 30, known: Column | None = None) -> Column:
    value = F.make_date(year, F.lit(month), F.lit(day))
    return value if known is None else F.when(known.isNotNull(), value)


def fiscal_month_number(month: Column, last_month: int) -> Column:
    """Position of a calendar month in the fiscal year (1 = first)."""
    return F.when(month > last_month, month - last_month).otherwise(month + (12 - last_month))


def fiscal_end_on_or_after(date: Column, last_month: int) -> Column:
    end = F.last_day(F.make_date(F.year(date), F.lit(last_month), F.lit(1)))
    return F.when(date > end, F.last_day(F.make_date(F.year(date) + 1, F.lit(last_month), F.lit(1)))).otherwise(end)


def last_complete_day(date: Column) -> Column:
    """The date itself at a month end, otherwise the end of the month before."""
    return F.when(F.last_day(date) == date, date).otherwise(F.date_sub(F.trunc(date, "month"), 1))


def fytd_window(date: Column, first_month: int) -> tuple[Column, Column]:
    end = last_complete_day(date)
    before = F.month(end) < first_month if first_month > 1 else F.lit(False)
    start = F.make_date(F.year(end) - before.cast("int"), F.lit(first_month), F.lit(1))
    return start, end


def r12_window(date: Column, months: int = 12) -> tuple[Column, Column]:
    end = last_complete_day(date)
    return F.date_add(F.add_months(end, -months), 1), end


def effective_period(shown: str) -> str:
    """Calendar variants are computed like their fiscal form with another start month."""
    return {"cy": "fy", "covid": "fy", "cytd": "fytd"}.get(shown, shown)


def report_window(period: str, year: Column, last_gift: Column, start_month: int) -> tuple[Column, Column]:
    """Start and end of the report for ``year`` as (start, end) columns.

    fy is the closed fiscal year; fytd runs to the month before the last gift;
    r12 is twelve whole months beginning with the last gift's month in ``year``.
    """
    period = effective_period(period)
    if period == "fy":
        start = F.make_date(year if start_month == 1 else year - 1, F.lit(start_month), F.lit(1))
        return start, F.date_sub(F.add_months(start, 12), 1)
    if period == "r12":
        start = F.make_date(year, F.month(last_gift), F.lit(1))
        return start, F.date_sub(F.add_months(start, 12), 1)
    if period != "fytd":
        raise ValueError(f"unknown period {period}")
    end_month = F.month(F.add_months(last_gift, -1))
    if start_month == 1:
        start_year, end_year = year + 1, year + 1
    else:
        start_year = year - (F.month(last_gift) == start_month).cast("int")
        wraps = (F.month(last_gift) < start_month) & (F.month(last_gift) != 1)
        end_year = year + wraps.cast("int")
    start = F.make_date(start_year, F.lit(start_month), F.lit(1))
    return start, F.last_day(F.make_date(end_year, end_month, F.lit(1)))


def newest_window(period: str, last_gift: Column, start_month: int) -> tuple[Column, Column]:
    """Newest period that the data cover in whole months.

    fy and cy are the last closed year, fytd and cytd the running year up to the
    last complete month, r12 the twelve months up to it.
    """
    if period == "r12":
        return r12_window(last_gift)
    start, end = fytd_window(last_gift, 1 if period in ("cy", "cytd") else start_month)
    if period in ("fytd", "cytd"):
        return start, end
    closed = F.add_months(start, 12) == F.date_add(end, 1)
    start = F.when(closed, start).otherwise(F.add_months(start, -12))
    return start, F.date_sub(F.add_months(start, 12), 1)


def months_ago(from_date: Column, date: Column) -> Column:
    """Whole calendar months between two dates' months."""
    return (F.year(from_date) - F.year(date)) * 12 + (F.month(from_date) - F.month(date))


def days_in_following_months(date: Column, months: int = 12) -> Column:
    """Array: days left in the date's month, then the length of each month after it."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(months - 1)),
        lambda i: F.when(i == 0, F.datediff(F.last_day(date), date)).otherwise(
            F.dayofmonth(F.last_day(F.add_months(date, i)))),
    )


def month_spine(df: DataFrame, date: str, extend: int = 12) -> DataFrame:
    """One row per month from the earliest date to ``extend`` months after the latest."""
    return df.agg(F.min(date).alias("lo"), F.max(date).alias("hi")).select(
        F.explode(F.sequence(
            F.trunc("lo", "month"), F.add_months("hi", extend), F.expr("interval 1 month"))).alias("month"))


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date"))
