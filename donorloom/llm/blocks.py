"""Meeting of two tables in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def meet(
    items: DataFrame, visitors: DataFrame, keys: Sequence[str], item_rows: int, visitor_rows: int,
    work: Callable[[tuple, pa.Table, pa.Table], pa.Table], schema: str,
) -> DataFrame:
    """``work(key, items, visitors)`` for every block of items and every block of visitors with equal ``keys``.

    The caller bounds the number of distinct keys, so their sizes are broadcast.
    A key's rows on either side are dealt into blocks of about the given length
    by the hash of their ``salt`` column, and every block of one side is sent to
    every block of the other. So a hot key becomes many tasks of bounded size,
    and no task depends on how rows are ordered.
    """
    keys = list(keys)
    count = lambda df, name: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    sizes = count(items, "_items").join(count(visitors, "_visitors"), keys).select(
        *keys, F.ceil(F.col("_items") / item_rows).cast("int").alias("_ni"),
        F.ceil(F.col("_visitors") / visitor_rows).cast("int").alias("_nv"))

    def dealt(df: DataFrame, own: str, n_own: str, other: str, n_other: str) -> DataFrame:
        out = df.join(F.broadcast(sizes), keys).withColumn(own, F.pmod(F.xxhash64("salt"), F.col(n_own)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col(n_other) - 1))).drop("_ni", "_nv")
        return out.select(*[F.col(c).alias(c) for c in out.columns])  # both sides may come from one table

    block = [*keys, "_i", "_v"]
    left = dealt(items, "_i", "_ni", "_v", "_nv").groupBy(*block)
    right = dealt(visitors, "_v", "_nv", "_i", "_ni").groupBy(*block)

    def run(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        if a.num_rows == 0 or b.num_rows == 0:
            return empty
        return work(key, a, b)

    empty = _empty(schema)
    return left.cogroup(right).applyInArrow(run, schema)


def _empty(schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    fields = [part.strip().split() for part in schema.split(",")]
    return pa.table({name: pa.array([], kinds[kind]) for name, kind in fields})
