"""Suppressions and row filters."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorloom.functions.rules import greater, is_in, matches_any, not_in, starts_any, sure
from donorloom.operators.scale import attach, number_rows


def keep(df: DataFrame, mask: Column, include: bool) -> DataFrame:
    """Rows that match, or with ``include=False`` all the others (nulls among them)."""
    return df.filter(mask if include else ~mask)


def in_values(df: DataFrame, col: str, values: Sequence, include: bool = True) -> DataFrame:
    return keep(df, is_in(F.col(col), values), include)


def contains(df: DataFrame, col: str, values: Sequence[str], include: bool = True) -> DataFrame:
    return keep(df, matches_any(F.col(col), values), include)


def in_any(df: DataFrame, col: str, values: Mapping[str, Sequence], include: bool = True) -> DataFrame:
    """Some column holds one of its own values; ``col`` is not used."""
    mask = F.lit(False)
    for name, allowed in values.items():
        mask = mask | is_in(F.col(name), allowed)
    return keep(df, mask, include)


def whitelist(df: DataFrame, col: str, values: Sequence[str], include: bool = True) -> DataFrame:
    """Keep rows whose text form is listed, whatever ``include`` says."""
    return df.filter(is_in(F.coalesce(F.col(col).cast("string"), F.lit("None")), values))


def greater_than(df: DataFrame, col: str, values: Sequence, include: bool = True) -> DataFrame:
    return keep(df, greater(F.col(col), values[0]), include)


def starts_with(df: DataFrame, col: str, values: Sequence[str], include: bool = True) -> DataFrame:
    return keep(df, starts_any(F.col(col), values), include)


def offset_pairs(df: DataFrame, col: str, amount: str, order: Sequence[str], buckets: Sequence[Column]) -> DataFrame:
    """Remove equal numbers of +X and -X rows within one id, the earliest of each sign first.

    ``order`` is the row order and ``buckets`` are coarse forms of it (a day, a
    block of row numbers), so that an id with very many rows is not numbered in
    one task. Rows without an id are never removed.
    """
    # The numbering needs keys without nulls; rows that cannot pair pass by.
    can_pair = sure(F.col(col).isNotNull() & (F.col(amount) != 0))
    rows = df.filter(can_pair).withColumns({
        "_size": F.abs(F.col(amount)), "_sign": F.signum(F.col(amount).cast("double")).cast("int")})
    signs = rows.groupBy(col, "_size").agg(
        F.least(F.count_if(F.col("_sign") > 0), F.count_if(F.col("_sign") < 0)).alias("_pairs"),
        F.count(F.lit(1)).alias("_n"))
    numbered = number_rows(rows, [col, "_size", "_sign"], buckets, [F.col(c) for c in order], "_nth")
    kept = attach(numbered, signs, [col, "_size"], "_n").filter(F.col("_nth") > F.col("_pairs"))
    return kept.select(df.columns).unionByName(df.filter(~can_pair))


FILTERS: dict[str, Callable[..., DataFrame]] = {
    "isin": in_values,
    "contains": contains,
    "isin_or": in_any,
    "dropna": whitelist,
    "greater_than": greater_than,
    "starts_with": starts_with,
    # values: the amount column and the column that gives the row order
    "offset_pairs": lambda df, col, values, include: offset_pairs(df, col, values[0], [values[1]], [F.col(values[1])]),
}


def suppress(df: DataFrame, rules: Sequence[tuple[str, str, object, bool]]) -> DataFrame:
    """Apply (function, column, values, include) rules in order; unknown functions are skipped with a warning."""
    for name, col, values, include in rules:
        if name in FILTERS:
            df = FILTERS[name](df, col, values, include)
        else:
            warnings.warn(f"suppression rule {name!r} on {col!r} is unknown and was skipped", stacklevel=2)
    return df


def drop_future(df: DataFrame, col: str, now: Column | None = None) -> DataFrame:
    """Rows dated up to now; the column is a date, a timestamp or a yyyymmdd number."""
    now = F.current_timestamp() if now is None else now
    kind = df.schema[col].dataType
    if isinstance(kind, T.NumericType):
        return df.filter(F.col(col) <= F.date_format(now, "yyyyMMdd").cast("int"))
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return df.filter(F.col(col) <= now)
    return df


def usable_gifts(df: DataFrame, donor: str, date: str, amount: str) -> DataFrame:
    """Donor, date and a non-zero amount are present; negative amounts stay."""
    return df.filter(F.col(donor).isNotNull() & F.col(date).isNotNull()
                     & (F.coalesce(F.col(amount).cast("double"), F.lit(0.0)) != 0))


def none_of(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(not_in(F.col(col), values))


def below_outlier(df: DataFrame, amount: str, limit: float, organisation: Column | None = None) -> DataFrame:
    """Drop amounts above the limit and rows of organisations."""
    df = df.filter(~sure(F.col(amount) > limit))
    return df if organisation is None else df.filter(~sure(organisation))


def keyword_suppression(
    df: DataFrame, col: str, contains_any: Sequence[str], equals_any: Sequence[str], prefixes: Sequence[str],
) -> DataFrame:
    """Drop by content, value and prefix, then require two leading digits."""
    code = F.upper(F.col(col))
    return df.filter(F.col(col).isNotNull()).withColumn(col, code).filter(
        ~matches_any(F.col(col), contains_any)
        & ~is_in(F.col(col), equals_any)
        & ~starts_any(F.col(col), prefixes)
        & F.col(col).rlike("^[0-9]{2}"))
