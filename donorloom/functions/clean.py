"""Header names, typing and value cleaning."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of types in table definitions and their Spark types.
TYPE_NAMES = {
    "object": "string",
    "datetime64[ns]": "timestamp",
    "int": "int",
    "Int32": "int",
    "Int64": "bigint",
    "float": "double",
    "Float64": "double",
    "bool": "boolean",
}
# Text that stands for a missing value.
NULL_WORDS = ("nan", "None")


# ---- column names -----------------------------------------------------------

def snake_header(name: str) -> str:
    """camelCase and symbols to snake_case; ``#`` becomes ``nmb``."""
    words = re.sub(r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name).lower()
    words = re.sub(r"[^a-z0-9_#]", "_", words).replace("#", "nmb")
    return re.sub(r"__", "_", words).removesuffix("_")


def database_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_header(c) for c in df.columns])


def drop_name_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Remove ``prefix_`` wherever it stands, lower or upper case."""
    marks = (f"{prefix.lower()}_", f"{prefix.upper()}_")
    names = df.columns
    for mark in marks:
        names = [c.replace(mark, "") for c in names]
    return df.toDF(*names)


def storage_header(name: str) -> str:
    """Replace characters Parquet refuses in names."""
    return re.sub(r"[ ,;{}()\n\t=]+", "_", name).strip("_")


def camel_header(name: str) -> str:
    if name.isupper() and re.search(r"[ _`/]", name):
        name = name.lower()
    for mark in " _`/":
        if mark in name:
            return "".join(part[:1].upper() + part[1:] for part in name.split(mark))
    return name


def id_suffix(name: str) -> str:
    return name[:-2] + "ID" if name[-2:] in ("id", "Id") else name


def rename_headers(df: DataFrame, rule) -> DataFrame:
    return df.toDF(*[rule(c) for c in df.columns])


def rename_checked(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename, refusing to create a second column of the same name."""
    clash = [(old, new) for old, new in names.items()
             if old != new and old in df.columns and new in df.columns]
    if clash:
        raise ValueError(f"both names present: {clash}")
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def merge_duplicate_names(df: DataFrame) -> DataFrame:
    """Columns with the same name become one: first non-null from left to right."""
    groups: dict[str, list[int]] = {}
    for i, name in enumerate(df.columns):
        groups.setdefault(name, []).append(i)
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return flat.select(*[F.coalesce(*[F.col(f"c{i}") for i in at]).alias(name) for name, at in groups.items()])


# ---- value cleaning -----------------------------------------------------------

def null_tokens(col: Column) -> Column:
    """Null where the text is empty or holds ``nan`` or ``None`` as a word."""
    words = "|".join(rf"\b{w}\b" for w in NULL_WORDS)
    return F.when(~F.coalesce(col.rlike(words) | (col == ""), F.lit(False)), col)


def clean_null_tokens(df: DataFrame) -> DataFrame:
    return df.withColumns({
        f.name: null_tokens(F.col(f"`{f.name}`")) for f in df.schema if isinstance(f.dataType, T.StringType)})


def strip_point_zero(col: Column) -> Column:
    """``123.0`` to ``123``; other text unchanged."""
    return F.regexp_replace(col.cast("string"), r"\.0+$", "")


def float_text_to_int(col: Column) -> Column:
    """Numeric text to integer text (toward zero), anything else unchanged."""
    number = col.cast("string").try_cast("double")
    return F.coalesce(F.when(~F.isnan(number), number.try_cast("bigint").cast("string")), col.cast("string"))


def plain_number_text(col: Column) -> Column:
    """``1.2E5`` to ``120000``; text that is not a number unchanged."""
    return F.coalesce(F.round(col.try_cast("double").try_cast("decimal(38,6)"), 0)
                      .try_cast("decimal(38,0)").cast("string"), col)


def numeric_ids(df: DataFrame, col: str) -> DataFrame:
    """Whole-number ids; rows whose id is not a number are dropped."""
    number = F.col(col).cast("string").try_cast("double")
    return df.withColumn(col, F.when(~F.isnan(number), number).try_cast("bigint")).filter(F.col(col).isNotNull())


def money(col: Column, missing: float | None = 0.0) -> Column:
    """``$1,234.50`` to 1234.5; blanks, ``-``, ``nan`` and ``None`` to ``missing``."""
    text = F.regexp_replace(F.trim(col.cast("string")), r"[$,]", "")
    blank = F.coalesce(F.trim(text).isin("-", "None", "", "nan"), F.lit(True))
    return F.when(blank, F.lit(missing).cast("double")).otherwise(text.try_cast("double"))


def budget_number(col: Column) -> Column:
    """Like ``money`` without the currency sign; ``-`` and blanks are null."""
    text = F.trim(col.cast("string"))
    return F.when(~text.isin("-", ""), text).try_cast("double")


def whole_number(col: Column) -> Column:
    return F.regexp_replace(F.trim(col.cast("string")), ",", "").try_cast("double").try_cast("bigint")


def two_format_date(col: Column) -> Column:
    """Month/day/year first, then year-month-day; any time part is cut off."""
    day = F.split(F.trim(col.cast("string")), " ").getItem(0)
    return F.coalesce(F.try_to_timestamp(day, F.lit("M/d/yyyy")),
                      F.try_to_timestamp(day, F.lit("yyyy-M-d"))).cast("date")


def short_text(col: Column, limit: int = 255) -> Column:
    """Cut to ``limit`` characters, trim, and turn null words into nulls."""
    text = F.trim(F.substring(col.cast("string"), 1, limit))
    return F.when(~text.isin("nan", "None", "NaT"), text)


# ---- typing a whole frame --------------------------------------------------------

def spark_type(column: str, declared: str) -> str:
    """Table definition type to Spark type: keys are big integers, unknown names are text."""
    return "bigint" if column.endswith("_key") else TYPE_NAMES.get(declared, "string")


def table_schema(definition: Mapping[str, str]) -> T.StructType:
    if not definition:
        raise ValueError("a table needs at least one column")
    fields = ", ".join(f"`{c}` {spark_type(c, t)}" for c, t in definition.items())
    return T.StructType.fromDDL(fields)


def cast_by_map(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Lenient cast by name; columns that are not listed become text.

    ``datetimeYMD`` and ``datetimeY-M-D`` name explicit date formats.
    """
    def typed(name: str) -> Column:
        col = F.col(f"`{name}`")
        kind = types.get(name, "string")
        if kind == "datetimeYMD":
            out = F.try_to_timestamp(col.cast("string"), F.lit("yyyyMMdd"))
        elif kind == "datetimeY-M-D":
            out = F.try_to_timestamp(col.cast("string"), F.lit("yyyy-MM-dd"))
        else:
            out = col.cast("string").try_cast(kind) if kind != "string" else col.cast("string")
        return out.alias(name)
    return df.select(*[typed(c) for c in df.columns])


def enforce_schema(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Keep only declared columns, cast, in name order; fails when one is missing."""
    missing = sorted(set(types) - set(df.columns))
    if missing:
        raise ValueError(f"declared columns missing: {missing}")
    return df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in sorted(types)])


def align_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns: extra ones go, missing ones are null text."""
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c)
                       for c in columns])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without any value: one counting pass, one row to the driver."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c]])


def drop_matching(df: DataFrame, keyword: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if keyword in c])


def drop_private(df: DataFrame, private: Iterable[str]) -> DataFrame:
    return df.drop(*[c for c in private if c in df.columns])


def prefer_order(df: DataFrame, first: Sequence[str]) -> DataFrame:
    lead = [c for c in first if c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in lead + [c for c in df.columns if c not in lead]])


def common_first(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Shared columns first and in the same order on both sides."""
    shared = [c for c in left.columns if c in right.columns]
    return prefer_order(left, shared), prefer_order(right, shared)


def stamp_load(df: DataFrame, client: str, files: str, at: Column | None = None) -> DataFrame:
    return df.withColumns({
        "client": F.lit(client),
        "transaction_file_name": F.lit(files),
        "row_added_at": at if at is not None else F.current_timestamp(),
    })


def expected_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Lenient typing of a budget file: dates and numbers that do not parse become null."""
    out = {}
    for name, kind in types.items():
        if name not in df.columns:
            continue
        col = F.col(f"`{name}`")
        out[name] = F.trim(col.cast("string")) if kind == "string" else col.cast("string").try_cast(kind)
    return df.withColumns(out)


# ---- inference ---------------------------------------------------------------------

def infer_types(df: DataFrame) -> dict[str, str]:
    """Target type of each text column from all of its values, in one aggregate.

    The order of the tests is: percent, yes/no, date (after 2000 and longer than
    four characters), number at 95 % or more, else text. Every value counts, not
    a sample, so the answer does not depend on row order.
    """
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not names:
        return {}
    parts = []
    for name in names:
        value = null_tokens(F.col(f"`{name}`"))
        number = F.regexp_replace(value, ",", "").try_cast("double")
        when = F.coalesce(value.try_cast("timestamp"), F.try_to_timestamp(value, F.lit("M/d/yyyy")))
        date = when.isNotNull() & (F.length(value) > 4) & (when > F.lit("2000-01-01").cast("timestamp"))
        yes_no = F.lower(value).isin("y", "yes", "t", "true", "on", "1", "n", "no", "f", "false", "off", "0")
        parts.append(F.struct(
            F.count(value).alias("n"),
            F.count_if(value.endswith("%")).alias("percent"),
            F.count_if(yes_no).alias("bool"),
            F.count_if(date).alias("date"),
            F.count_if(number.isNotNull()).alias("number"),
        ).alias(name))
    row = df.agg(*parts).first()
    return {name: _decide(row[name]) for name in names}


def _decide(seen) -> str:
    n = seen["n"]
    if n == 0:
        return "double"
    if seen["percent"] == n:
        return "percent"
    if seen["bool"] == n:
        return "boolean"
    if seen["date"] == n:
        return "timestamp"
    if seen["number"] and seen["number"] >= 0.95 * n:
        return "double"
    return "string"


def apply_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Project the inferred types."""
    out = {}
    for name, kind in types.items():
        value = null_tokens(F.col(f"`{name}`"))
        if kind == "percent":
            out[name] = F.regexp_replace(value, "%", "").try_cast("double") / 100
        elif kind == "double":
            out[name] = F.regexp_replace(value, ",", "").try_cast("double")
        elif kind == "boolean":
            out[name] = F.lower(value).isin("y", "yes", "t", "true", "on", "1")
        elif kind == "timestamp":
            out[name] = F.coalesce(value.try_cast("timestamp"), F.try_to_timestamp(value, F.lit("M/d/yyyy")))
        else:
            out[name] = value
    return df.withColumns(out)
