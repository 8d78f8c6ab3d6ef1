"""Small helpers the operators share."""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_KEYS = 1024  # a key with over 1/1024 of all rows is hot, so there are 1,023 hot keys at most
PIECE_BYTES = 1 << 20  # texts are handled in pieces of about this many characters inside a task


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def usable_vector(c: Column) -> Column:
    """True for vectors without null, NaN or infinite components; null or false for others."""
    fits = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce(c.isNotNull() & F.forall(c, fits), F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, dtype=np.float64) -> np.ndarray:
    """Lists of equal length as one array, a row each."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if len(column) == 0:
        return np.zeros((0, 0), dtype)
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), -1)


def numbers(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)


def pieces(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about ``PIECE_BYTES`` characters of column ``text``, a row at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        marks = np.cumsum(lengths) // PIECE_BYTES
        edges = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def hot_share(counts: DataFrame, size: str) -> DataFrame:
    """The rows of ``counts`` whose ``size`` is over 1/1024 of the sum: 1,023 at most, so they may be broadcast."""
    return counts.filter(F.col(size) * HOT_KEYS > counts.agg(F.sum(size)).scalar())


def lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], size: str) -> DataFrame:
    """``rows`` with the columns of ``table`` (unique ``keys``) beside them, null where there is none.

    ``size`` is a column of ``table`` with the number of rows that share the key.
    Hot keys are looked up in a broadcast table of bounded length, so their rows
    stay where they are; the other rows meet the table in an ordinary join, and
    rows with a null key in none.
    """
    keys = list(keys)
    values = [c for c in table.columns if c not in keys and c != size]
    hot = hot_share(table, size).select(*keys, F.struct(*values, F.lit(1).alias("_there")).alias("_hot"))
    marked = rows.join(F.broadcast(hot), keys, "left")
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    done = marked.filter(F.col("_hot").isNotNull() | no_key).select(
        *[F.col(c) for c in rows.columns], *[F.col(f"_hot.{c}").alias(c) for c in values])
    rest = marked.filter(F.col("_hot").isNull() & ~no_key).drop("_hot").join(table.drop(size), keys, "left")
    return done.unionByName(rest.select(*done.columns))
