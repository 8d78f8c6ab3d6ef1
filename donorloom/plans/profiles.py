"""Profiles of a table from sketches stored beside it.

One row per partition of the table and column holds exact counts, the smallest
and largest number, a HyperLogLog sketch of the values and a KLL sketch of the
numbers. Sketches merge, so the profile of a table, of any choice of its
partitions or of an earlier version comes from these few rows without a scan,
and a delivery that replaces one partition renews only that partition's rows.

Counts, ``low`` and ``high`` are exact. ``distinct`` is off by 1.6 % in the mean
(``DISTINCT_BOUND`` is three times that), a quantile's rank by less than
``RANK_BOUND`` of the rows in 99 of 100 cases.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HLL_BITS = 12
KLL_SIZE = 400
DISTINCT_BOUND = 0.05
RANK_BOUND = 0.01
STEPS = 200  # quantiles by which two distributions are compared


def sketch_rows(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """Sketches per value of ``by`` and column, in one pass with map-side combine and no row copied per column.

    Null values count in ``total`` only. Not-a-number counts as a value but is no number; other columns than numbers have no KLL sketch.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    sums: list[Column] = []
    for i, c in enumerate(columns):
        value, number = F.col(f"`{c}`"), _number(c, kinds[c])
        sums += [F.count(value).alias(f"filled{i}"), F.hll_sketch_agg(value.cast("string"), HLL_BITS).alias(f"values{i}"),
                 F.count(number).alias(f"numbers{i}"), F.min(number).alias(f"low{i}"), F.max(number).alias(f"high{i}"),
                 F.kll_sketch_agg_double(number, KLL_SIZE).alias(f"spread{i}")]
    per_part = df.groupBy(F.col(f"`{by}`").alias(by)).agg(F.count(F.lit(1)).alias("total"), *sums)
    fields = ("filled", "values", "numbers", "low", "high", "spread")
    each = [F.struct(F.lit(c).alias("column"), *[F.col(f"{f}{i}").alias(f) for f in fields]) for i, c in enumerate(columns)]
    return per_part.select(by, "total", F.explode(F.array(*each)).alias("x")).select("x.column", by, "total", *[f"x.{f}" for f in fields])


def _number(name: str, kind: T.DataType) -> Column:
    if not isinstance(kind, T.NumericType):
        return F.lit(None).cast("double")
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def merged(sketches: DataFrame) -> DataFrame:
    """One row of merged counts and sketches per column."""
    return sketches.groupBy("column").agg(
        F.sum("total").alias("total"), F.sum("filled").alias("filled"), F.hll_union_agg("values").alias("values"),
        F.sum("numbers").alias("numbers"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("spread").alias("spread"))


def profile(sketches: DataFrame, points: Sequence[float]) -> DataFrame:
    """column, total, filled, null, distinct, low, high and the quantiles at ``points``; null quantiles where there is no number."""
    at = F.array(*[F.lit(float(p)) for p in points])
    return merged(sketches).select(
        "column", "total", "filled", (F.col("total") - F.col("filled")).alias("null"),
        F.hll_sketch_estimate("values").alias("distinct"), "low", "high",
        F.when(F.col("numbers") > 0, F.kll_sketch_get_quantile_double(_some("spread"), at)).alias("quantiles"))


def change(before: DataFrame, now: DataFrame) -> DataFrame:
    """Two versions side by side, from their sketches alone.

    ``shift`` is the largest distance between the two distributions over the
    numbers of both (0: alike, 1: apart; off by ``1 / STEPS`` and the sketches'
    bounds), null where either has no number. A column of one version only has
    nulls for the other.
    """
    old, new = (merged(s).select("column", *[F.col(c).alias(f"{c}_{side}") for c in ("total", "filled", "values", "numbers", "spread")])
                for s, side in ((before, "before"), (now, "now")))
    ladder = F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)])
    both = old.join(new, "column", "full_outer").withColumns({
        f"steps_{side}": F.kll_sketch_get_quantile_double(_some(f"spread_{side}"), ladder) for side in ("before", "now")})
    rank = lambda side, v: F.size(F.filter(f"steps_{side}", lambda step: step <= v)) / (STEPS + 1)
    distance = lambda v: F.abs(rank("before", v) - rank("now", v))
    shift = F.array_max(F.transform(F.concat("steps_before", "steps_now"), distance))
    distinct = [F.hll_sketch_estimate(f"values_{side}").alias(f"distinct_{side}") for side in ("before", "now")]
    return both.select(
        "column", "total_before", "total_now", "filled_before", "filled_now", *distinct,
        F.when((F.col("numbers_before") > 0) & (F.col("numbers_now") > 0), shift).alias("shift"))


def _some(sketch: str) -> Column:
    """The sketch, or null if it holds nothing, which could not be asked."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.col(sketch))
