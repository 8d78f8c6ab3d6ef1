"""Deduplication. Each form is a grouping with map-side combine, never a window over a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from donorloom.operators.scale import dense_index, group_rare, keep_first, keep_last, rising, spread_join

AUDIT_COLUMNS = ("transaction_file_name", "row_added_at")


def first_by(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key; null keys count as one key."""
    return keep_first(df, key, order)


def first_or_null(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key and every row without a key."""
    return keep_first(df.filter(F.col(key).isNotNull()), [key], order).unionByName(df.filter(F.col(key).isNull()))


def first_not_null(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    return keep_first(df.filter(F.col(key).isNotNull()), [key], order)


def last_not_null(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    return keep_last(df.filter(F.col(key).isNotNull()), [key], order)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def distinct_except_audit(df: DataFrame, order: Sequence[Column], audit: Sequence[str] = AUDIT_COLUMNS) -> DataFrame:
    """Duplicates by all columns but the audit ones; the first audit values stay."""
    return keep_first(df, [c for c in df.columns if c not in audit], order)


def untouched(df: DataFrame) -> DataFrame:
    return df


def last_by_business_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Donor, amount and date (and whatever else identifies a gift): the last entry stays."""
    return keep_last(df, keys, order)


def newest_by_id(df: DataFrame, key: str, date: str, tie: Sequence[str]) -> DataFrame:
    return keep_last(df, [key], [*rising(date), *[F.col(c) for c in tie]])


def last_after(df: DataFrame, cut: Column, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Deduplicate rows where ``cut`` holds and keep the older ones as they are."""
    recent = F.coalesce(cut, F.lit(False))
    return keep_last(df.filter(recent), keys, order).unionByName(df.filter(~recent))


def fill_missing_ids(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Distinct rows; a missing id becomes ``_`` and the row's position in ``order``."""
    numbered = dense_index(df.dropDuplicates(), order, "_at")
    made = F.concat(F.lit("_"), F.col("_at").cast("string"))
    value = F.col(key).cast("string") if key in df.columns else F.lit(None).cast("string")
    return numbered.withColumn(key, F.coalesce(value, made)).drop("_at")


def with_made_ids(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Rows with an id as they are; of those without one the distinct ones, with ``_`` and their position in ``order``.

    Only rows without an id are sorted.
    """
    return df.filter(F.col(key).isNotNull()).unionByName(fill_missing_ids(df.filter(F.col(key).isNull()), key, order))


def _times(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    return group_rare(df.select(*key), key, name, F.count(F.lit(1)), F.sum(name))


def duplicate_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once."""
    counts = _times(df, key, "_n").filter(F.col("_n") > 1)
    return spread_join(df, counts, key, "inner", "_n")


def duplicate_count(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: how many rows repeat an earlier key."""
    return _times(df, key, "n").agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


DEDUPE = {
    "dedupe": lambda df, col, order: first_by(df, [col], order),
    "dedupe_or_null": first_or_null,
    "dedupe_dropna": first_not_null,
    "dedupe_keep_last": last_not_null,
    "dedupe_all": lambda df, col, order: distinct_rows(df),
    "dedupe_all_except": lambda df, col, order: distinct_except_audit(df, order),
    "ignore_dupes": lambda df, col, order: df,
}


def apply_dedupe(df: DataFrame, rule: str | None, col: str | None, order: Sequence[Column]) -> DataFrame:
    """Configured rule by name; without one, exact duplicates go."""
    if rule is None:
        return distinct_rows(df)
    return DEDUPE[rule](df, col, order) if rule in DEDUPE else df
