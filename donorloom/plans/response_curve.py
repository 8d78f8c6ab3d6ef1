"""Response curves and cash-flow projection.

A campaign's days from mailing to gift are summarised by a gamma distribution,
either with the sample mean and variance (``fit_campaigns``: two aggregates per
campaign) or with the three parameters of greatest likelihood
(``fit_likelihood``: counted days per campaign and array folds over them). Its
distribution function is the power series of the incomplete gamma integral,
written as one array fold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from donorloom.functions.dates import days_in_following_months
from donorloom.operators.scale import spread_join

SHAPE_RANGE = (0.3, 5.0)
TERMS = 400
FLAT_FROM = 200.0
MAX_SHAPE = 50.0  # up to here the bounds above leave nothing out
NEAREST = 0.5  # days the curve starts before the first response at least; a whole day stands for half a day around it
GRID = 16  # steps of growing size over which the start of the curve is searched
FARTHEST = 8.0  # standard deviations; a curve that starts before that has a shape above MAX_SHAPE
HALVINGS = 40
TINY = 1e-12


def response_days(gifts: DataFrame, mailed: DataFrame, campaign: str, gift_date: str, mail_date: str) -> DataFrame:
    """Days from the campaign's mail date to each gift; null when either date is missing."""
    return spread_join(gifts, mailed.select(campaign, mail_date), [campaign]).withColumn(
        "days", F.datediff(gift_date, mail_date))


def fit_campaigns(days: DataFrame, campaign: str, shape_range: tuple[float, float] = SHAPE_RANGE) -> DataFrame:
    """Gamma shape and scale per campaign; fits with missing days or a shape out of range are left out."""
    low, high = shape_range
    stats = days.groupBy(campaign).agg(
        F.count(F.lit(1)).alias("n"), F.count("days").alias("known"),
        F.sum(F.col("days").cast("long")).alias("s1"), F.sum((F.col("days") * F.col("days")).cast("long")).alias("s2"))
    # Whole-number sums are exact, so the fit does not depend on the order of rows.
    n = F.col("n").cast("double")
    mean = F.col("s1") / n
    var = (F.col("s2") - F.col("s1") * F.col("s1") / n) / (n - 1)
    fit = stats.filter((F.col("n") == F.col("known")) & (F.col("n") > 1)).select(
        campaign, "n", mean.alias("mean"), var.alias("var"))
    fit = fit.filter((F.col("var") > 0) & (F.col("mean") > 0)).select(
        campaign, "n", (F.col("mean") * F.col("mean") / F.col("var")).alias("shape"), F.lit(0.0).alias("loc"),
        (F.col("var") / F.col("mean")).alias("scale"))
    return fit.filter(F.col("shape").between(low, high))


def fit_likelihood(days: DataFrame, campaign: str, shape_range: tuple[float, float] = SHAPE_RANGE) -> DataFrame:
    """Gamma shape, location and scale of greatest likelihood per campaign.

    Left out, as in ``fit_campaigns``: campaigns with missing days, with fewer
    than two different days, or with a shape out of range, which includes days
    without a tail to the right (their likelihood grows towards a normal curve).
    The likelihood has no bound where the curve starts at the first response, so
    it starts ``NEAREST`` days before it at the latest.

    For a given start the best shape solves one equation, so the search has one
    dimension: a grid of distances before the first response, then halvings on
    the sign of the derivative. Gifts are counted per campaign and day before a
    campaign is one row, whose length is bounded by the calendar.
    """
    low, high = shape_range
    if high > MAX_SHAPE:
        raise ValueError(f"gamma shapes up to {MAX_SHAPE} only")
    counts = days.groupBy(campaign, "days").agg(F.count(F.lit(1)).alias("_n"))
    x = F.col("days").cast("long")
    rows = counts.groupBy(campaign).agg(
        F.sum("_n").alias("n"), F.min("days").cast("double").alias("_min"), F.sum(F.col("_n") * x).alias("_s1"),
        F.sum(F.col("_n") * x * x).alias("_s2"), F.bool_or(F.col("days").isNull()).alias("_unknown"),
        F.sort_array(F.collect_list(F.struct(F.col("days").cast("double").alias("x"), F.col("_n").cast("double").alias("n"))))
        .alias("_bins"))
    rows = rows.filter(~F.col("_unknown") & (F.size("_bins") > 1))
    n = F.col("n").cast("double")
    mean = F.col("_s1") / n
    from_first = F.transform("_bins", lambda b: F.struct((b["x"] - F.col("_min")).alias("x"), b["n"].alias("n")))
    rows = rows.withColumns({"_bins": from_first, "_weight": n, "_above": mean - F.col("_min"), "_sd": F.sqrt((F.col("_s2") - F.col("_s1") * mean) / n)})
    step = F.pow(F.greatest(FARTHEST * F.col("_sd") / NEAREST, F.lit(2.0)), F.lit(1.0 / GRID))
    n, above = F.col("_weight"), F.col("_above")
    gap = lambda d: _gap(F.col("_bins"), n, above, d)
    inverse = lambda d: F.aggregate("_bins", F.lit(0.0), lambda acc, b: acc + b["n"] / (b["x"] + d)) / n

    def halve(acc, _):
        mid = (acc["near"] + acc["far"]) / 2
        return _let(mid, lambda d: _let(_rises(above + d, inverse(d), gap(d)), lambda rises: F.struct(
            F.when(rises, acc["near"]).otherwise(d).alias("near"), F.when(rises, d).otherwise(acc["far"]).alias("far"))))

    def refine(grid, best):
        bracket = F.struct(F.element_at(grid, F.greatest(best - 1, F.lit(1))).alias("near"),
                           F.element_at(grid, F.least(best + 1, F.lit(GRID + 1))).alias("far"))
        found = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), bracket, halve, lambda acc: (acc["near"] + acc["far"]) / 2)
        return _let(found, lambda d: F.struct(
            best.alias("best"), d.alias("d"), _let(gap(d), _best_shape).alias("shape")))

    grid = F.transform(F.sequence(F.lit(0), F.lit(GRID)), lambda k: NEAREST * F.pow(step, k))
    heights = lambda grid: F.transform(grid, lambda d: _let(gap(d), lambda v: _height(above + d, v)))
    best = lambda h: F.array_position(h, F.array_max(h)).cast("int")
    search = _let(grid, lambda g: _let(_let(heights(g), best), lambda k: refine(g, k)))
    # A generator keeps the filters below from being evaluated with the whole search once more.
    rows = rows.select(campaign, "n", "_min", "_above", F.explode(F.array(search)).alias("_fit"))
    shape = F.col("_fit.shape")
    # Best at the grid's last step: no greatest likelihood within reach.
    return rows.filter((F.col("_fit.best") <= GRID) & shape.between(low, high)).select(
        campaign, "n", shape.alias("shape"), (F.col("_min") - F.col("_fit.d")).alias("loc"),
        ((F.col("_above") + F.col("_fit.d")) / shape).alias("scale"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _gap(bins: Column, n: Column, above: Column, d: Column) -> Column:
    """log(mean y) - mean(log y) of the days y since ``d`` days before the first response.

    It decides the best shape, and is positive unless all days are equal.
    """
    logs = F.aggregate(bins, F.lit(0.0), lambda acc, b: acc + b["n"] * F.log(b["x"] + d))
    return F.greatest(F.log(above + d) - logs / n, F.lit(TINY))


def _best_shape(gap: Column) -> Column:
    """Shape with log(a) - digamma(a) = gap: a close start, then Newton steps on 1 / a."""
    start = (3 - gap + F.sqrt((gap - 3) * (gap - 3) + 24 * gap)) / (12 * gap)
    return F.aggregate(F.sequence(F.lit(1), F.lit(6)), start, lambda a, _: 1 / (
        1 / a + (F.log(a) - digamma(a) - gap) / (a * a * (1 / a - trigamma(a)))))


def _height(mean: Column, gap: Column) -> Column:
    """Mean log likelihood with the best shape and scale, from the mean day and the gap."""
    return _let(_best_shape(gap), lambda a: -a * F.log(mean / a) - log_gamma(a) + (a - 1) * (F.log(mean) - gap) - a)


def _rises(mean: Column, inverse: Column, gap: Column) -> Column:
    """Whether a later start is likelier: the best shape is below the one at which the derivative vanishes."""
    level = F.greatest(mean * inverse - 1, F.lit(TINY))
    return _let((level + 1) / level, lambda a: gap > F.log(a) - digamma(a))


def average_curve(fits: DataFrame) -> DataFrame:
    """One row: plain average of the campaigns' parameters."""
    return fits.agg(F.avg("shape").alias("shape"), F.avg("loc").alias("loc"), F.avg("scale").alias("scale"))


def log_gamma(a: Column) -> Column:
    """Stirling's series, shifted up by eight."""
    z = a + 8
    r = 1 / (z * z)
    series = (F.lit(1 / 12) - r * (F.lit(1 / 360) - r * (F.lit(1 / 1260) - r * (F.lit(1 / 1680) - r / 1188)))) / z
    product = F.lit(1.0)
    for k in range(8):
        product = product * (a + k)
    return (z - 0.5) * F.log(z) - z + 0.9189385332046727 + series - F.log(product)


def digamma(a: Column) -> Column:
    """Derivative of ``log_gamma``: asymptotic series, shifted up by eight."""
    z = a + 8
    r = 1 / (z * z)
    series = F.log(z) - 1 / (2 * z) - r * (F.lit(1 / 12) - r * (F.lit(1 / 120) - r * (F.lit(1 / 252) - r * (
        F.lit(1 / 240) - r * (F.lit(1 / 132) - r * F.lit(691 / 32760))))))
    for k in range(8):
        series = series - 1 / (a + k)
    return series


def trigamma(a: Column) -> Column:
    """Second derivative of ``log_gamma``."""
    z = a + 8
    r = 1 / (z * z)
    series = 1 / z + r / 2 + r / z * (F.lit(1 / 6) - r * (F.lit(1 / 30) - r * (F.lit(1 / 42) - r * (
        F.lit(1 / 30) - r * F.lit(5 / 66)))))
    for k in range(8):
        series = series + 1 / ((a + k) * (a + k))
    return series


def gamma_cdf(x: Column, shape: Column, loc: Column, scale: Column) -> Column:
    """Regularised lower incomplete gamma function at (x - loc) / scale."""
    z = (x - loc) / scale
    start = F.struct((1 / shape).alias("term"), (1 / shape).alias("total"))

    def add(acc, k):
        term = acc["term"] * z / (shape + k)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    total = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, add, lambda acc: acc["total"])
    value = F.exp(-z + shape * F.log(z) - log_gamma(shape)) * total
    refused = F.raise_error(F.lit(f"gamma shapes up to {MAX_SHAPE} only")).cast("double")
    return F.when(shape > MAX_SHAPE, refused).when(z <= 0, 0.0).when(z > FLAT_FROM, 1.0).otherwise(F.least(value, F.lit(1.0)))


def curve_table(params: DataFrame, name: str, last_day: int = 340) -> DataFrame:
    """Percent complete for each day and curve."""
    return params.withColumn("day", F.explode(F.sequence(F.lit(0), F.lit(last_day)))).select(
        name, "day", (gamma_cdf(F.col("day").cast("double"), F.col("shape"), F.col("loc"), F.col("scale")) * 100)
        .alias("percent_complete"))


def cash_flow(campaigns: DataFrame, campaign: str, mail_date: str, budget: str, months: int = 12) -> DataFrame:
    """Budget of each campaign spread over the mail month and the months after it.

    ``campaigns`` has shape, loc and scale beside the date and budget. Monthly
    shares have six decimals and amounts are decimals, so sums are exact.
    """
    days = campaigns.withColumn("_days", days_in_following_months(F.col(mail_date), months))
    upto = F.transform(F.sequence(F.lit(1), F.lit(months)), lambda i: F.aggregate(
        F.slice("_days", 1, i), F.lit(0), lambda a, b: a + b))
    rows = days.select("*", F.posexplode(upto).alias("_i", "_to"))
    rows = rows.withColumn("_from", F.col("_to") - F.element_at("_days", F.col("_i") + 1))
    cdf = lambda c: gamma_cdf(F.col(c).cast("double"), F.col("shape"), F.col("loc"), F.col("scale"))
    share = F.round(cdf("_to") - cdf("_from"), 6).cast("decimal(9,6)")
    return rows.select(
        campaign, F.add_months(F.trunc(mail_date, "month"), F.col("_i")).alias("month"), share.alias("share"),
        (F.col(budget).cast("decimal(18,2)") * share).alias("amount"))


def monthly_totals(flow: DataFrame, spine: DataFrame) -> DataFrame:
    """Every month of the spine with the sum over campaigns."""
    sums = flow.groupBy("month").agg(F.sum("amount").alias("total"))
    return spine.join(sums, "month", "left").select("month", F.coalesce("total", F.lit(0)).alias("total"))


def flow_table(flow: DataFrame, campaign: str, campaigns: Sequence[str]) -> DataFrame:
    """Months by campaigns, with the monthly total."""
    of = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("amount"))), F.lit(0))
    one = [of(F.col(campaign) == c).alias(c) for c in campaigns]
    return flow.groupBy("month").agg(*one, of(F.col(campaign).isin(*campaigns)).alias("monthly_total"))


def cumulative_share(days: DataFrame, campaign: str) -> DataFrame:
    """Observed curve: share of gifts that came in by each day, per campaign."""
    counts = days.filter(F.col("days").isNotNull()).groupBy(campaign, "days").agg(F.count(F.lit(1)).alias("n"))
    w = W.partitionBy(campaign)
    run = F.sum("n").over(w.orderBy("days").rowsBetween(W.unboundedPreceding, W.currentRow))
    return counts.select(campaign, "days", (run / F.sum("n").over(w)).alias("share"))
