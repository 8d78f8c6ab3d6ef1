"""Unions, set operations, reshaping and date-window replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def union_aligned(*frames: DataFrame) -> DataFrame:
    """Union of columns; a column whose type differs between frames becomes text, a missing one is null."""
    kinds: dict[str, set[str]] = {}
    for frame in frames:
        for name, kind in frame.dtypes:
            kinds.setdefault(name, set()).add(kind)
    target = {name: next(iter(k)) if len(k) == 1 else "string" for name, k in kinds.items()}

    def aligned(frame: DataFrame) -> DataFrame:
        return frame.select(*[
            (F.col(f"`{c}`") if c in frame.columns else F.lit(None)).cast(t).alias(c) for c, t in target.items()])

    return union_all(*[aligned(f) for f in frames])


def replace_window(master: DataFrame, batch: DataFrame, date: str, low_by: str | None = None) -> DataFrame:
    """Master rows outside the batch's date range, plus the batch.

    The bounds are scalar subqueries: nothing is collected, and they reach the
    master scan as filters. Master rows without a date are not inside any range
    and are dropped, as a comparison with a null date never holds.
    """
    low = batch.agg(F.min(low_by or date)).scalar()
    high = batch.agg(F.max(date)).scalar()
    outside = master.filter((F.col(date) < low) | (F.col(date) > high))
    return outside.unionByName(batch, allowMissingColumns=True)


def difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).subtract(right.select(key))


def symmetric_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys on exactly one side, by one grouping over both."""
    sides = left.select(key, F.lit(1).alias("s")).distinct().unionAll(right.select(key, F.lit(2).alias("s")).distinct())
    return sides.groupBy(key).agg(F.sum("s").alias("s")).filter(F.col("s") < 3).select(key)


def common(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).intersect(right.select(key))


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def to_wide(df: DataFrame, ids: Sequence[str], name: str, values: Sequence, aggregate: Column) -> DataFrame:
    return df.groupBy(*ids).pivot(name, list(values)).agg(aggregate)


def split_number(key: Column, sets: int) -> Column:
    """Set number of a key; all rows of a key share it, so the sets are disjoint by construction."""
    return F.pmod(F.xxhash64(key), F.lit(sets)).cast("int")


def split_integrity(df: DataFrame, key: str, part: str) -> DataFrame:
    """Keys that occur in more than one set; empty when the split is sound."""
    return df.groupBy(key).agg(F.min(part).alias("lo"), F.max(part).alias("hi")).filter("lo <> hi")


def hash_sample(
    df: DataFrame, gift: str, donor: str, fiscal: str, base_rate: float = 0.02, step: float = 0.03,
    ramp_years: int = 5, salt: str = "v1", suffix: str = "_FS",
) -> DataFrame:
    """Add suffixed copies of a stable sample of the gifts whose rate grows with the fiscal year.

    Earlier copies are removed first, so a second run gives the same result.
    """
    base = df.filter(~F.coalesce(F.col(gift).cast("string").endswith(suffix), F.lit(False)))
    first = base.agg(F.max(fiscal) - F.lit(ramp_years)).scalar()
    rate = F.lit(base_rate) + F.greatest(F.lit(0), F.col(fiscal) - first + 1) * F.lit(step)
    # A published digest, so that other engines can draw the same sample.
    digest = F.md5(F.concat(F.col(gift).cast("string"), F.col(fiscal).cast("string"), F.lit(salt)).cast("binary"))
    score = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(1_000_000)) / 1_000_000
    copies = base.filter(score < rate).withColumns({
        gift: F.concat(F.col(gift).cast("string"), F.lit(suffix)),
        donor: F.concat(F.col(donor).cast("string"), F.lit(suffix)),
        "is_synthetic": F.lit(True)})
    plain = base.withColumns({
        gift: F.col(gift).cast("string"), donor: F.col(donor).cast("string"), "is_synthetic": F.lit(False)})
    return plain.unionByName(copies)
