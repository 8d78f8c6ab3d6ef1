"""Building blocks that stay balanced when one key holds a large share of rows.

A window over ``partitionBy(donor)`` puts a whole donor into one task, so the
operators in this package do not use one on raw rows. They use these instead:

* ``keep_first`` / ``keep_last``: an aggregate with map-side combine, so a hot
  key shrinks to one row per map task before the shuffle.
* ``number_rows``: row numbers inside a key, computed per (key, bucket) where
  the bucket follows the sort order (usually the calendar day), plus offsets
  from a window over the small table of bucket counts. Buckets that are still
  too large are split by the next column of the sort order.
* ``spread_join`` / ``attach``: a join that cuts heavy keys into pieces, to bring
  per-key values back to the rows. A window cannot be cut like that.
* ``dense_index``: consecutive numbers over a whole table without one task.
* ``exact_quantiles``: percentiles from two counting passes, without holding
  the values of a group in memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from donorloom.session import durable

LEVEL_BITS = 16  # 65,536 buckets per histogram level
LEVELS = 2
HOT_GROUP = 1_000_000
HEAVY_GROUPS = 10_000  # as many keys are treated as heavy at most
NULL_PIECES = 256
# Partitions, at least, of a grouping whose keys are nearly as many as its rows. Up to 200 Spark writes rows of a shuffle
# straight to their files; with more it holds them in memory to sort them.
RARE_PARTS = 192
RARE_PIECES = 16  # tasks that a frequent key is cut into there


def rising(*columns: str | Column) -> list[Column]:
    """Sort keys, ascending with nulls last, usable inside a struct."""
    keys: list[Column] = []
    for column in columns:
        c = F.col(column) if isinstance(column, str) else column
        keys += [c.isNull(), c]
    return keys


def falling(column: str | Column, kind: str = "number") -> list[Column]:
    """A descending sort key, nulls last. Text has no negation, so numbers and dates only."""
    c = F.col(column) if isinstance(column, str) else column
    flipped = {
        "number": lambda: -c,
        "date": lambda: -F.unix_date(c),
        "timestamp": lambda: -F.unix_micros(c),
    }[kind]()
    return [c.isNull(), flipped]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the smallest by ``order``. ``order`` must be total for a stable result."""
    return _extreme(df, keys, order, F.min_by)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the largest by ``order``."""
    return _extreme(df, keys, order, F.max_by)


def _extreme(df, keys, order, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    best = df.groupBy(*keys).agg(pick(F.struct(*[F.col(f"`{c}`") for c in rest]), rank).alias("_best"))
    return best.select(*[
        F.col(f"`{c}`") if c in keys else F.col(f"_best.`{c}`").alias(c) for c in df.columns
    ])


def first_value(value: str | Column, order: Sequence[Column]) -> Column:
    """Aggregate: the value on the first row by ``order`` (nulls allowed as the value)."""
    return F.min_by(value, F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))


def last_value(value: str | Column, order: Sequence[Column]) -> Column:
    return F.max_by(value, F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))


def heavy_groups(counts: DataFrame, keys: Sequence[str], size: str, limit: int = HOT_GROUP) -> DataFrame:
    """Groups of more than ``limit`` rows, the 10,000 largest at most, so the result may be broadcast.

    A group with over 1/10,000 of all rows is always among the 10,000 largest. Ties go by ``keys``, which are
    unique, so every branch of a plan that derives the list finds the same one. No total is needed.
    """
    return counts.filter(F.col(size) > limit).orderBy(F.desc(size), *keys).limit(HEAVY_GROUPS)


def _mix(df: DataFrame) -> Column:
    """A number to deal rows by. Equal rows of different input partitions get different ones, whatever their order inside."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.spark_partition_id())


def _no_key(keys: Sequence[str]) -> Column:
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(f"`{key}`").isNull()
    return missing


def spread_join(
    df: DataFrame, values: DataFrame, keys: Sequence[str], how: str = "left", size: str | None = None,
    limit: int = HOT_GROUP, counts: DataFrame | None = None,
) -> DataFrame:
    """Equi-join that keeps the rows of a heavy key out of a single task.

    AQE can split a skewed join only when both inputs come straight from a
    shuffle; here the right side usually is an aggregate on the join key.

    ``size`` names a column of ``values`` with the number of rows of ``df`` per
    key, and ``values`` then has one row per key: heavy keys find theirs in a
    broadcast table, and their rows go on spread out, as rows with a null key do.

    Without ``size`` the rows per key are counted, or read from ``counts``, a
    table with the keys and ``_rows``. Rows of a heavy key get a number below the
    key's piece count, and only the heavy keys' values are repeated, once per piece.
    """
    keys = list(keys)
    if size is not None:
        return _join_known(df, values, keys, how, size, limit)
    no_key = _no_key(keys)
    if counts is None:
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    heavy = heavy_groups(counts.select(*keys, "_rows").dropna(subset=keys), keys, "_rows", limit)
    pieces = F.broadcast(heavy.select(*keys, F.ceil(F.col("_rows") / limit).cast("int").alias("_pieces")))
    mix = _mix(df)
    rows = df.join(pieces, keys, "left").withColumn("_piece", F.when(
        F.col("_pieces").isNotNull(), F.pmod(mix, F.col("_pieces"))).when(no_key, F.pmod(mix, F.lit(NULL_PIECES))).otherwise(
        F.lit(0)).cast("int")).drop("_pieces")
    right = values.join(pieces, keys, "left").withColumn("_piece", F.explode(
        F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))).drop("_pieces")
    return rows.join(right, [*keys, "_piece"], how).drop("_piece")


def _join_known(df: DataFrame, values: DataFrame, keys: list[str], how: str, size: str, limit: int) -> DataFrame:
    """``spread_join`` with one row of ``values`` per key, which knows its size."""
    if how not in ("left", "inner"):
        raise ValueError(f"left or inner, not {how}")
    brought = [c for c in values.columns if c not in keys and c != size]
    heavy = heavy_groups(values.dropna(subset=keys), keys, size, limit).select(
        *keys, F.struct(F.lit(True).alias("_there"), *[F.col(f"`{c}`") for c in brought]).alias("_heavy"))
    rows = df.join(F.broadcast(heavy), keys, "left")
    mix = F.pmod(_mix(df), F.lit(NULL_PIECES)) + 1
    answered = F.col("_heavy").isNotNull()
    # Pieces from 1 on meet no row of the other side.
    rows = rows.withColumn("_piece", F.when(answered | _no_key(keys), mix).otherwise(F.lit(0)).cast("int"))
    right = values.select(*keys, F.lit(0).alias("_piece"),
                          F.struct(F.lit(True).alias("_there"), *[F.col(f"`{c}`") for c in brought]).alias("_usual"))
    found = rows.join(right, [*keys, "_piece"], "left").withColumn("_found", F.coalesce("_heavy", "_usual"))
    if how == "inner":
        found = found.filter(F.col("_found").isNotNull())
    rest = [F.col(f"`{c}`") for c in df.columns if c not in keys]
    return found.select(*keys, *rest, *[F.col(f"_found.`{c}`").alias(c) for c in brought])


def attach(df: DataFrame, values: DataFrame, keys: Sequence[str], size: str | None = None) -> DataFrame:
    """Per-key values back on the rows; see ``spread_join``."""
    return spread_join(df, values, keys, "left", size)


def _dealt(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(max(RARE_PARTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)


def group_rare(df: DataFrame, keys: Sequence[str], name: str, first: Column, total: Column) -> DataFrame:
    """``first`` per key, a grouping for keys that rarely repeat; ``total`` adds up values ``name`` of the same key.

    With such keys a map-side combine holds about all rows of its input split and saves nothing. So rows are
    dealt into many small partitions before the first grouping; a frequent key is cut into pieces there,
    and the pieces are added up in a second one.
    """
    keys = list(keys)
    pieces = df.withColumn("_piece", F.pmod(_mix(df), F.lit(RARE_PIECES)).cast("int"))
    part = _dealt(pieces, *keys, "_piece").groupBy(*keys, "_piece").agg(first.alias(name)).drop("_piece")
    return _dealt(part, *keys).groupBy(*keys).agg(total.alias(name))


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    buckets: Sequence[Column],
    order: Sequence[Column],
    name: str,
    limit: int = HOT_GROUP,
) -> DataFrame:
    """Row number inside ``keys``, counting from 1.

    ``buckets`` are coarse forms of the sort order, outermost first (day, then
    amount, ...); each must rise along ``order`` inside the ones before it. A key
    of up to ``limit`` rows is numbered by one window, after one shuffle of its
    rows. Heavier keys are taken out before it, and a window sees one (key, first
    bucket) group of theirs at a time. A bucket's offset is a running sum over the
    bucket counts of its key, a table with one row per (key, bucket). Heavy groups
    are again taken out before the shuffle and numbered by the next bucket; where
    there are none, that branch is empty at run time and AQE drops it.
    Nulls are values like others in keys and buckets, and must come first in
    ``order`` where a bucket is null; a struct of null flag and value puts them last.
    """
    # A struct is never null itself, so that plain equality also joins null keys.
    held = {f"_key{i}": F.struct(F.col(k).alias("k")) for i, k in enumerate(keys)}
    wrapped = [F.struct(b.alias("b")) for b in buckets]
    rows, keys = df.withColumns(held), list(held)
    if not keys:
        return _number(rows, keys, wrapped, order, name, limit, 0)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    heavy = F.broadcast(heavy_groups(counts, keys, "_size", limit).select(*keys))
    usual = rows.join(heavy, keys, "left_anti").withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("long"))
    hot = _number(rows.join(heavy, keys), keys, wrapped, order, name, limit, 0)
    return usual.select(*df.columns, name).unionByName(hot.select(*df.columns, name))


def _number(df, keys, buckets, order, name, limit, level) -> DataFrame:
    bucket, skip, size = f"_bucket{level}", f"_skip{level}", f"_size{level}"
    rows = df.withColumn(bucket, buckets[0])
    group = [*keys, bucket]
    counts = rows.groupBy(*group).agg(F.count(F.lit(1)).alias(size))
    before = W.partitionBy(*keys).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*group, size, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(skip))
    number = F.row_number().over(W.partitionBy(*group).orderBy(*order)).cast("long") + F.col(skip)
    if len(buckets) == 1:
        return rows.join(offsets, group).withColumn(name, number).select(*df.columns, name)
    heavy = F.broadcast(heavy_groups(offsets, group, size, limit))
    usual = rows.join(heavy.select(*group), group, "left_anti").join(offsets, group).withColumn(name, number)
    inner = rows.join(heavy, group)
    inner = _number(inner, group, buckets[1:], order, "_inner", limit, level + 1)
    hot = inner.withColumn(name, F.col("_inner") + F.col(skip))
    return usual.select(*df.columns, name).unionByName(hot.select(*df.columns, name))


def dense_index(df: DataFrame, order: Sequence[Column], name: str, start: int = 0) -> DataFrame:
    """Consecutive numbers over the whole table in ``order``.

    A global sort is range-partitioned, so each task numbers its own range. The
    checkpoint fixes which rows are in which range before ranges are counted.
    """
    ordered = durable(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("_range", F.shiftright("_id", 33))
    sizes = ordered.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range, so as many as there were sort partitions: small enough to broadcast.
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        ordered.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_offset") + F.lit(start))
        .drop("_range", "_id", "_offset")
    )


def most_common(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Most frequent non-null value per key, ties to the smallest. Two map-side combined counts."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(
        F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v"))).getField("v").alias(name))


def _ordered_bucket(v: Column) -> Column:
    """Whole number of up to 32 bits and a sign that never falls as ``v`` rises: power of two, then 20 bits inside it."""
    size, inside = F.abs(v), 1 << 20
    finite = size < float("inf")
    power = F.when(F.isnan(v), 1025).when(finite, F.floor(F.log2(size))).otherwise(1024).cast("long")
    part = F.when(finite, F.floor((size / F.pow(F.lit(2.0), power) - 1) * inside)).otherwise(0)
    bucket = F.coalesce((power + 1100) * inside + F.greatest(F.least(part, F.lit(inside - 1)), F.lit(0)), F.lit(0))
    return F.when(v < 0, -1 - bucket).otherwise(bucket)


def exact_quantiles(df: DataFrame, value: str, points: Sequence[float]) -> DataFrame:
    """Linear-interpolated percentiles of a numeric column, exact at any size.

    Equal values are counted first. A histogram over ordered buckets tells which
    of them hold the wanted ranks; those buckets alone are divided again, and only
    the finest ones (2^-20 of the value's power of two, so outliers do not widen
    them) are ranked value by value. Every window sees at most 131,072 buckets, or
    the distinct values of one finest bucket. The wanted ranks are two per point,
    so the joins with them broadcast a handful of rows.
    """
    counted = durable(df.filter(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v")).agg(
        F.count(F.lit(1)).alias("n")))  # read once a level
    fine = counted.withColumn("fine", _ordered_bucket(F.col("v")))
    level = lambda k: F.shiftright("fine", LEVEL_BITS * (LEVELS - k))
    holds = lambda start: (F.col("rank") >= start) & (F.col("rank") < start + F.col("bn"))

    # Top level: every bucket against every wanted rank, both few.
    top = fine.groupBy(level(1).alias("b")).agg(F.sum("n").alias("bn"))
    before = W.orderBy("b").rowsBetween(W.unboundedPreceding, -1)
    top = top.withColumn("skip", F.coalesce(F.sum("bn").over(before), F.lit(0)))
    top = top.select("*", F.explode(F.array(*[F.lit(float(p)) for p in points])).alias("p"))
    top = top.withColumn("pos", F.col("p") * (counted.agg(F.sum("n")).scalar() - F.lit(1)))
    top = top.select("*", F.explode(F.array(F.floor("pos"), F.ceil("pos"))).alias("rank"))
    wanted = top.filter(holds(F.col("skip"))).select("p", "pos", "rank", F.col("b").alias("parent"), "skip")
    for k in range(2, LEVELS + 1):
        parents = F.broadcast(wanted.select("parent").distinct())
        rows = fine.withColumn("parent", level(k - 1)).join(parents, "parent", "left_semi")
        sizes = rows.groupBy("parent", level(k).alias("b")).agg(F.sum("n").alias("bn"))
        before = W.partitionBy("parent").orderBy("b").rowsBetween(W.unboundedPreceding, -1)
        starts = sizes.withColumn("inside", F.coalesce(F.sum("bn").over(before), F.lit(0)))
        start = F.col("skip") + F.col("inside")
        wanted = starts.join(F.broadcast(wanted), "parent").filter(holds(start)).select(
            "p", "pos", "rank", F.col("b").alias("parent"), start.alias("skip"))
    inside = W.partitionBy("parent").orderBy("v").rowsBetween(W.unboundedPreceding, -1)
    values = fine.withColumn("parent", F.col("fine")).join(
        F.broadcast(wanted.select("parent").distinct()), "parent", "left_semi").withColumn(
        "before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    first = F.col("skip") + F.col("before")
    picked = values.join(F.broadcast(wanted), "parent").filter(
        (F.col("rank") >= first) & (F.col("rank") < first + F.col("n")))
    return picked.groupBy("p", "pos").agg(
        F.min_by("v", "rank").alias("v0"), F.max_by("v", "rank").alias("v1")
    ).select("p", (F.col("v0") + (F.col("v1") - F.col("v0")) * (F.col("pos") - F.floor("pos"))).alias("value"))


def running_last(
    df: DataFrame, keys: Sequence[str], bucket: Column, value: Column, name: str,
) -> DataFrame:
    """Largest ``value`` in buckets up to and including the row's own.

    For as-of lookups: with the calendar day as the bucket and the event date as
    the value it is the most recent event not after the row. The window runs
    over one row per (key, bucket), never over raw rows.
    """
    rows = df.withColumn("_bucket", bucket)
    per_bucket = rows.groupBy(*keys, "_bucket").agg(F.max(value).alias("_v"), F.count(F.lit(1)).alias("_n"))
    upto = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    seen = per_bucket.select(*keys, "_bucket", F.max("_v").over(upto).alias(name), "_n")
    return attach(rows, seen, [*keys, "_bucket"], "_n").drop("_bucket")
