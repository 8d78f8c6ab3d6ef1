"""Lifecycle groups of every donor in every reporting period.

Gifts are reduced to one row per donor and year before anything is sequenced;
everything after that is a window over at most as many rows as there are years.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from donorloom.functions.dates import effective_period, fiscal_year, period_year, report_window
from donorloom.operators.aggregates import half_up
from donorloom.operators.joins import interval_join
from donorloom.operators.scale import spread_join
from donorloom.operators.windows import streaks
from donorloom.session import durable

FISCAL = ("fy", "fytd")
REPORTABLE = 5
CLIENTS = 10_000


def period_year_of(period: str, date: Column, start_month: int) -> Column:
    return fiscal_year(date, start_month) if period in FISCAL else F.year(date)


def client_years(gifts: DataFrame, period: str, start_month: int) -> DataFrame:
    """Years in which the client has any gift."""
    return gifts.select("client", period_year_of(period, F.col("gift_date"), start_month).alias("yr")).distinct()


def report_periods(gifts: DataFrame, period: str, start: Column, end: Column, start_month: int) -> DataFrame:
    """One row per report period: the newest one and its parallels in every earlier year on file."""
    years = client_years(gifts, period, start_month)
    newest = W.partitionBy("client")
    offset = F.col("yr") - F.max("yr").over(newest)
    shifted = years.select("client", offset.alias("offset")).withColumns({
        "period": F.lit(period),
        "start_date": F.add_months(start, F.col("offset") * 12),
        "end_date": F.add_months(end, F.col("offset") * 12),
    })
    text = lambda c: F.date_format(c, "MM/dd/yyyy")
    return shifted.withColumns({
        "report_period": F.concat(text("start_date"), F.lit(" - "), text("end_date")),
        "yr": period_year_of(period, F.col("end_date"), start_month),
        "report_period_id": F.concat("client", F.lit("-"), "period", F.lit(" ending "), text("end_date")),
        "reportable": (F.col("offset") > -REPORTABLE).cast("int"),
    })


def period_days(periods: DataFrame, last: int = 6, first_year: Column | None = None) -> DataFrame:
    """One row per period and calendar day, for the newest periods."""
    days = periods.filter(F.col("offset") > -last).withColumn(
        "date", F.explode(F.sequence("start_date", "end_date")))
    if first_year is not None:
        days = days.filter(F.year("date") >= first_year)
    return days.withColumn("client_date", F.concat("client", F.lit("-"), F.date_format("date", "yyyy-MM-dd")))


def _period_numbers(date: Column, start: Column, end: Column) -> Column:
    """Array of offsets of the yearly shifted periods that hold the date.

    Shifting by whole years moves the calendar year by exactly that many, so
    only offsets between the two year distances can fit; no join is needed.
    """
    candidates = F.sequence(F.year(date) - F.year(end), F.year(date) - F.year(start))
    return F.filter(candidates, lambda o: date.between(F.add_months(start, o * 12), F.add_months(end, o * 12)))


def lifecycle_groups(
    gifts: DataFrame, client: str | None, period: str, start: Column, end: Column, start_month: int, last: int | None = 6,
) -> DataFrame:
    """Group of each of a client's donors in each year from the first gift on.

    ``gifts`` has donor_id, gift_date and gift_amount; ``start`` and ``end``
    delimit the newest period. A donor is known by client and donor_id, and by
    donor_key where there is one; ``client=None`` takes the client from the column
    ``client``, a name stands for all rows. Rows without a client are in no group.
    Gifts are shuffled once, to become one row per donor with its set of years;
    the years then unfold inside the same partitions.
    """
    if client is not None:
        gifts = gifts.withColumn("client", F.lit(client))
    keys = ["client", "donor_id", *[c for c in ("donor_key",) if c in gifts.columns]]
    day = F.col("gift_date")
    # Bounds may be scalar subqueries, which lambdas take only as columns.
    bounds = {"_start": start, "_end": end}
    end_year = period_year_of(period, F.col("_end"), start_month)
    calendar_year = period_year_of(period, day, start_month)
    if period == "r12":
        given_years = F.transform(
            _period_numbers(day, F.col("_start"), F.col("_end")), lambda o: end_year + o)
    else:
        given_years = F.array(calendar_year)
    rows = gifts.filter(F.coalesce(F.col("gift_amount"), F.lit(0)) > 0).withColumns(bounds).select(
        *keys, calendar_year.alias("_year"), F.explode_outer(given_years).alias("_given"), *bounds)
    # Sets of years: as many entries as the calendar has, whatever the number of gifts.
    donors = rows.groupBy(*keys).agg(
        F.collect_set("_year").alias("_years"), F.array_sort(F.collect_set("_given")).alias("_given"), *[F.min(b).alias(b) for b in bounds])
    donors = donors.withColumn("_known", F.element_at(_years_by_client(donors), F.col("client"))).withColumn(
        "_max", F.array_max("_known"))

    # A year is reported when the client has gifts in it and the shifted period exists.
    offset = F.col("yr") - end_year
    line = donors.select(*keys, "_given", "_known", "_max", "_start", "_end", F.explode(F.filter(
        "_known", lambda y: y >= F.array_min("_years"))).alias("yr"))
    line = line.withColumn("offset", offset).filter(F.array_contains("_known", F.col("offset") + F.col("_max")))
    # Periods of other years than those on file give no gift years.
    given = F.filter("_given", lambda y: F.array_contains("_known", y - end_year + F.col("_max")))
    shifted = lambda c: F.add_months(c, F.col("offset") * 12)
    line = line.withColumns({"_g": given, "start_date": shifted("_start"), "end_date": shifted("_end")})
    return _labelled(line, keys, period, last)


def lifecycle_by_period(gifts: DataFrame, periods: DataFrame, period: str, last: int | None = 6) -> DataFrame:
    """The same groups for report periods given as rows: client, yr, start_date and end_date.

    Periods are any days: they may overlap, leave gaps, differ in length, and be
    open at either end; ``yr`` numbers a client's periods in order and a gift counts
    in every period that holds its day. A donor is reported from the first period
    with a gift on. Clients without periods, and gifts outside all of them, are left out.
    """
    keys = ["client", "donor_id", *[c for c in ("donor_key",) if c in gifts.columns]]
    bounds = durable(periods.select("client", "yr", "start_date", "end_date"))
    paid = gifts.filter(F.coalesce(F.col("gift_amount"), F.lit(0)) > 0).select(*keys, "gift_date")
    given = interval_join(paid, "gift_date", bounds, "start_date", "end_date", ["client"])
    # Durable, as the join below counts its clients first; a client that is a constant would also leave it without a key.
    donors = durable(given.groupBy(*keys).agg(F.array_sort(F.collect_set("yr")).alias("_g")))
    # One array per client, of as many entries as it has periods.
    listed = bounds.groupBy("client").agg(F.array_sort(F.collect_list(F.struct("yr", "start_date", "end_date"))).alias("_periods"))
    line = spread_join(donors, listed, ["client"], "inner").withColumn(
        "_period", F.explode(F.filter("_periods", lambda p: p["yr"] >= F.array_min("_g"))))
    line = line.select(*keys, "_g", "_period.*", (F.col("_period.yr") - F.array_max("_periods")["yr"]).alias("offset"))
    return _labelled(line, keys, period, last)


def _labelled(line: DataFrame, keys: Sequence[str], period: str, last: int | None) -> DataFrame:
    """Groups of ``line``, which has a row per donor and reported year with the sorted years given in ``_g``."""
    yr, g = F.col("yr"), F.col("_g")
    gave = lambda back: F.when(F.array_contains(g, yr - back), yr - back)
    line = line.select(
        *keys, "yr", "offset", "start_date", "end_date", F.array_contains(g, yr).cast("int").alias("gift_made"),
        gave(1).alias("gift_minus1"), gave(2).alias("gift_minus2"),
        F.array_min(F.filter(g, lambda y: y <= yr)).alias("first_gift"),
        F.array_max(F.filter(g, lambda y: y < yr)).alias("last_gift"))
    line = streaks(line, keys, "yr", "gift_made")

    by_year = W.partitionBy(*keys).orderBy("yr")
    m1, m2 = F.col("gift_minus1"), F.col("gift_minus2")
    group = (
        F.when(yr == F.col("first_gift"), "New")
        .when(yr == F.col("first_gift") + 1, "New Last Year")
        .when((yr == m1 + 1) & (yr == m2 + 2), "Consecutive Giver")
        .when((yr - F.coalesce(m1, F.lit(0))) > 1, "Reacquired")
        .when(m2.isNull() & m1.isNotNull(), "Reacquired Last Year")
        .otherwise("UNKNOWN")
    )
    line = line.withColumn("fh_group", group).withColumn("_before", F.lag("last_gift").over(by_year))
    fh = F.col("fh_group")
    detail = (
        F.when(fh == "Consecutive Giver", (yr - F.col("last_years_streak")).cast("string"))
        .when(fh == "Reacquired", (yr - F.col("last_gift")).cast("string"))
        .when(fh == "Reacquired Last Year", (m1 - F.col("_before")).cast("string"))
        .otherwise("")
    )
    if last is not None:
        line = line.filter(F.col("offset") > -last)
    shown = lambda c: F.coalesce(F.date_format(c, "MM/dd/yyyy"), F.lit("open"))
    return line.select(
        *keys, F.lit(period).alias("period"),
        F.concat(shown("start_date"), F.lit(" - "), shown("end_date")).alias("report_period"),
        F.concat("client", F.lit(f"-{period} ending "), shown("end_date")).alias("report_period_id"),
        "yr", "offset", "fh_group", F.concat(fh, detail).alias("fh_group_detail"),
        F.when(fh.isin("New", "Reacquired"), "Pipeline").when(
            fh.isin("Reacquired Last Year", "Consecutive Giver", "New Last Year"), "Active").alias("donor_type"),
        F.when(fh.isin("New", "Reacquired"), "Pipeline").when(
            fh.isin("Reacquired Last Year", "New Last Year"), "2nd Year").when(
            fh == "Consecutive Giver", "Consecutive Giver").alias("donor_subtype"),
        ((F.col("gift_made") == 1) & m1.isNotNull()).cast("int").alias("past_2_years"), "gift_made")


def _years_by_client(donors: DataFrame) -> Column:
    """Scalar map from client to the sorted years in which it has gifts.

    One entry per client, an organisation whose data are loaded; more than
    ``CLIENTS`` of them are refused, so the map is bounded.
    """
    years = donors.filter(F.col("client").isNotNull()).select("client", F.explode("_years").alias("y"))
    known = years.groupBy("client").agg(F.array_sort(F.collect_set("y")).alias("years"))
    entries = F.collect_list(F.struct("client", "years"))
    found = F.when(F.count(F.lit(1)) <= CLIENTS, F.map_from_entries(entries)).otherwise(
        F.raise_error(F.lit(f"more than {CLIENTS} clients in one run")))
    return known.agg(found).scalar()


# ---- the form with Lapsed and Reinstated labels --------------------------------------

def report_groups(
    gifts: DataFrame, period: str, years: Sequence[int] | None, last_gift: Column, start_month: int,
) -> DataFrame:
    """New, New Last Year, Lapsed, Reinstated Last Year or Consecutive Giver per donor and report year.

    Without ``years`` every year between the first and the newest gift is reported.

    Gifts become one row per donor and year with the year's first date; a year
    counts in a report when that date is not after the report's end.
    """
    kind = effective_period(period)
    month = F.month(last_gift)
    date = F.col("gift_date")
    if kind == "r12":
        year = F.year(date) - (F.month(date) < month).cast("int")
        year = F.when(month == 1, F.year(date)).otherwise(year)
    else:
        year = period_year(date, start_month)
    given = gifts.groupBy("donor_id", year.alias("gift_year")).agg(F.min("gift_date").alias("first_day"))
    if years is None:
        span = given.agg(F.sequence(F.min("gift_year"), F.max("gift_year"))).scalar()
    else:
        span = F.array(*[F.lit(y) for y in years])

    def report(y: Column) -> Column:
        start, end = report_window(kind, y, F.col("_last"), start_month)
        report_year = F.year(start) if kind == "r12" else (
            F.year(start) + (1 if start_month > 1 else 0) if kind == "fytd" else F.year(end))
        return F.struct(y.alias("year"), start.alias("start"), end.alias("end"), report_year.alias("report_year"),
                        (y if kind == "fy" else y + 1).alias("limit"))

    rows = given.withColumns({"_last": last_gift, "_span": span}).withColumn("r", F.explode(F.transform("_span", report))).filter(
        (F.col("gift_year") <= F.col("r.limit")) & (F.col("first_day") <= F.col("r.end")))
    g, ry = F.col("gift_year"), F.col("r.report_year")
    donors = rows.groupBy("donor_id", "r").agg(
        F.min(g).alias("first_year"), F.max(g).alias("last_year"),
        F.coalesce(F.max(F.when(g < ry, g)), F.lit(0)).alias("prev_year"),
        F.coalesce(F.max(F.when(g < ry - 1, g)), F.lit(0)).alias("prev_prev_year"),
        F.array_sort(F.collect_set("gift_year")).alias("years"))
    first, prev, prev2 = F.col("first_year"), F.col("prev_year"), F.col("prev_prev_year")
    new, new_last = first == ry, first == ry - 1
    labels = [
        (new, "New"), (new_last, "New Last Year"), ((ry - prev > 1) & ~new, "Lapsed"),
        ((prev == ry - 1) & (prev2 < ry - 2) & ~new_last, "Reinstated Last Year"),
        ((prev == ry - 1) & (prev2 == ry - 2), "Consecutive Giver"),
    ]
    group = F.concat(*[F.when(condition, F.lit(text)).otherwise(F.lit("")) for condition, text in labels])
    text = lambda c: F.date_format(c, "MM/dd/yyyy")
    return donors.select(
        "donor_id", F.lit(period).alias("period"), F.col("r.year").alias("report"), ry.alias("report_year"),
        F.concat(text("r.start"), F.lit(" - "), text("r.end")).alias("report_period"),
        "first_year", "last_year", "prev_year", "prev_prev_year", "years", group.alias("fh_group"))


def run_length(years: Column, target: Column) -> Column:
    """Years given in a row up to the year before ``target``; null below two.

    ``years`` is a sorted array without repeats; the fold walks it from the end.
    """
    start = F.struct((target - 1).cast("int").alias("want"), F.lit(0).alias("n"))
    run = F.aggregate(
        F.reverse(F.filter(years, lambda y: y < target)), start,
        lambda acc, y: F.struct(
            F.when(y == acc["want"], acc["want"] - 1).otherwise(acc["want"]).cast("int").alias("want"),
            (acc["n"] + (y == acc["want"]).cast("int")).alias("n")),
        lambda acc: acc["n"])
    return F.when(run >= 2, run)


def years_lapsed(years: Column, target: Column) -> Column:
    return target - F.array_max(F.filter(years, lambda y: y < target))


def reinstated_gap(years: Column, target: Column) -> Column:
    """Gap closed by a gift in the year before ``target``; null when the year before that was given too."""
    before = F.filter(years, lambda y: y < target)
    newest = F.try_element_at(before, F.lit(-1))
    earlier = F.try_element_at(before, F.lit(-2))
    return F.when((newest == target - 1) & (newest != earlier + 1), newest - earlier)


def with_detail(groups: DataFrame) -> DataFrame:
    """Append the number of years to Lapsed, Consecutive and Reinstated labels."""
    years, ry, g = F.col("years"), F.col("report_year"), F.col("fh_group")
    number = (F.when(g.contains("Lapsed"), years_lapsed(years, ry))
              .when(g.contains("Consecutive"), run_length(years, ry))
              .when(g.contains("Reinstated"), reinstated_gap(years, ry)))
    return groups.withColumn("fh_group_detail", F.concat(g, F.coalesce(number.cast("string"), F.lit(""))))


def capped_detail(years: Column, reference: Column, cap: int = 7) -> Column:
    """Older label set with month ranges, capped at ``cap`` years."""
    last = reference - 1
    gave, gave_before = F.array_contains(years, last), F.array_contains(years, last - 1)
    first = F.array_min(years)
    new, new_last = reference <= first, last == first
    lapse = last - F.coalesce(F.array_max(F.filter(years, lambda y: y < last)), last)
    back = F.when(lapse == 0, 0).otherwise(lapse - 1)
    run = F.coalesce(run_length(years, reference), F.lit(1))

    def months(n: Column) -> Column:
        shown = F.least(n, F.lit(cap))
        low = (shown * 12 + 1).cast("string")
        return F.concat(low, F.when(shown >= cap, "+").otherwise(
            F.concat(F.lit("-"), (shown * 12 + 12).cast("string"))))

    return (
        F.when(new, "New")
        .when(~gave & (lapse == 0), "No Giving History")
        .when(~gave, F.concat(F.lit("Lapsed "), months(lapse)))
        .when(gave & ~gave_before & ~new_last & (back >= 1), F.concat(F.lit("Reinstated Last Year "), months(back)))
        .when(gave & gave_before, F.concat(F.lit("Consecutive Giver "), F.when(run >= 4, "4+").otherwise(
            run.cast("string")), F.lit(" Yrs")))
        .when(new_last, "New Last Year")
        .otherwise("No Giving History")
    )


# ---- report measures ------------------------------------------------------------------

def measures(labelled: DataFrame) -> DataFrame:
    """Universe, responses, revenue, gifts and ratios per group and period, plus period totals.

    ``labelled`` has one row per donor and period: fh_group, report_period, and
    the donor's gifts and revenue inside the period (zero when none). Totals add
    up the groups; ratios are computed from the sums.
    """
    sums = [
        F.count(F.lit(1)).alias("universe"), F.count_if(F.col("gifts") > 0).alias("responses"),
        F.sum("revenue").alias("revenue"), F.sum("gifts").alias("gifts"),
    ]
    # A group without any response in a period has no measures, so it stays out of the report.
    groups = labelled.groupBy("fh_group", "report_period").agg(*sums).filter(F.col("responses") > 0)
    totals = groups.groupBy("report_period").agg(
        *[F.sum(c).alias(c) for c in ("universe", "responses", "revenue", "gifts")]).withColumn("fh_group", F.lit("Total"))
    return with_ratios(groups.unionByName(totals))


def with_ratios(df: DataFrame) -> DataFrame:
    d = lambda c: F.col(c).cast("double")
    return df.withColumns({
        "retention": half_up(d("responses") / d("universe"), 4),
        "gifts_per_donor": half_up(d("gifts") / d("responses"), 2),
        "value_per_donor": half_up(d("revenue") / d("responses"), 2),
        "average_gift": half_up(d("revenue") / d("gifts"), 2),
    })
