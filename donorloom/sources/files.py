"""Delimited files in, exports out, and choosing which files to read."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorloom.functions.clean import money, storage_header
from donorloom.operators.scale import keep_first
from donorloom.sources.mixed import BAD_LINE, MARKS, read_mixed



def read_delimited(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, encoding: str = "ISO-8859-1",
    delimiter: str = ",", quote: str = '"', escape: str = "\\", header: bool = True, glob: str | None = "*.csv*",
) -> DataFrame:
    """All CSV files of a folder, of one known format, as text columns, with lines that do not fit in ``_bad_line``.

    ``columns`` is the header in file order; without it Spark reads the header
    of one file. A byte-order mark is removed from the first name. A line is a
    record here; ``read_mixed`` reads folders whose files differ or whose quoted
    fields hold line breaks.
    """
    reader = (spark.read.option("header", header).option("encoding", encoding).option("sep", delimiter)
              .option("quote", quote).option("escape", escape).option("mode", "PERMISSIVE")
              .option("columnPruning", False))  # a pruned parser does not see surplus fields
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    names = list(columns) if columns is not None else [plain_header(c) for c in reader.csv(path).columns]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names] + [T.StructField(BAD_LINE, T.StringType())])
    lines = reader.schema(schema).option("columnNameOfCorruptRecord", BAD_LINE).csv(path)
    # Spark refuses to read the raw line alone; this always-true filter keeps one field in every plan.
    return lines.filter(F.length(F.concat_ws("", F.col(f"`{names[0]}`"), F.col(BAD_LINE))) >= 0)


def plain_header(name: str) -> str:
    """Header without byte-order mark (also as mis-decoded Latin-1) and stray quotes."""
    for mark in MARKS:
        name = name.removeprefix(mark)
    return name.strip().strip('"')


def _too_long(df: DataFrame, delimiter: str, quote: str = '"') -> Column:
    """The line has more fields than the header, or a quote that does not close. Shorter lines are only incomplete."""
    unquoted = F.regexp_replace(BAD_LINE, f"{quote}[^{quote}]*{quote}", "")
    fields = F.size(F.split(unquoted, "\\Q" + delimiter + "\\E", -1))
    return F.coalesce((fields > len(df.columns) - 1) | unquoted.contains(quote), F.lit(False))


def good_lines(df: DataFrame, delimiter: str = ",", quote: str = '"') -> DataFrame:
    return df.filter(~_too_long(df, delimiter, quote)).drop(BAD_LINE)


def bad_lines(df: DataFrame, delimiter: str = ",", quote: str = '"') -> DataFrame:
    """Quarantine: the raw text of lines with too many fields."""
    return df.filter(_too_long(df, delimiter, quote)).select(BAD_LINE)


def _shape(form: str) -> str | None:
    """Pattern that every text of a date format of numbers matches, so that other text need not be parsed; else None."""
    if not re.fullmatch(r"(?:y+|MM?|d+|H+|m+|s+|[^A-Za-z'\[\]{}#])+", form) or "MMM" in form:
        return None
    parts = re.findall(r"[A-Za-z]+|[^A-Za-z]+", form)
    if any(len(set(part)) > 1 for part in parts if part.isalpha()):
        return None
    return "^" + "".join("[+-]?[0-9]+" if part.isalpha() else rf"\Q{part}\E" for part in parts) + r"\z"


def lenient_date(col: Column, formats: Sequence[str] = ("yyyy-MM-dd", "M/d/yyyy")) -> Column:
    """First format that fits the whole text, or its part before the time; else null.

    Text that does not look like a format is not given to its parser: a text that fails there costs an exception.
    """
    day = F.split(F.trim(col), " ").getItem(0)

    def parsed(text: Column, form: str) -> Column:
        shape, found = _shape(form), F.try_to_timestamp(text, F.lit(form))
        return found if shape is None else F.when(text.rlike(shape), found)

    # A text that fits a format without a space has none itself, and is its own part before the time.
    tries = [parsed(t, f) for f in formats for t in ((col, day) if " " in f else (day,))]
    return F.coalesce(*tries).cast("date")


def collect_transactions(
    spark: SparkSession, path: str | Sequence[str], renames: Mapping[str, str], columns: Sequence[str],
    date: str = "gift_date", encoding: str = "ISO-8859-1", glob: str | None = "*.csv*",
) -> DataFrame:
    """Folder of transaction files of any format: read, rename, keep configured columns, parse the date."""
    df = read_mixed(spark, path, encoding, glob)
    df = df.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE).withColumnsRenamed(dict(renames))
    df = df.select(*[c for c in columns if c in df.columns])
    return df.withColumn(date, lenient_date(F.col(date))) if date in df.columns else df


def collect_documents(frames: Sequence[DataFrame], renames: Mapping[str, str], key: str, order: Sequence[Column]) -> DataFrame:
    """Union of reference files, renamed, without null codes, first row per code."""
    out = None
    for frame in frames:
        frame = frame.withColumnsRenamed({k: v for k, v in renames.items() if k in frame.columns})
        out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
    return keep_first(out.filter(F.col(key).isNotNull()), [key], order)


def project_csv(spark: SparkSession, path: str, renames: Mapping[str, str], encoding: str = "UTF-8") -> DataFrame:
    """Only the mapped columns, renamed; the parser skips the others."""
    df = spark.read.option("header", True).option("encoding", encoding).csv(path)
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in renames.items()])


def recurring_gifts(df: DataFrame, recurring_id: str, date: str, amount: str, start_year: int) -> DataFrame:
    """Gifts with a recurring id from the start year on, newest first."""
    return df.filter(F.coalesce(F.trim(F.col(recurring_id).cast("string")) != "", F.lit(False))
                     & (F.year(date) >= start_year)).withColumn(amount, money(F.col(amount))).orderBy(F.desc(date))


def recent_years(df: DataFrame, date: str, years: int, now: Column | None = None) -> DataFrame:
    now = F.current_date() if now is None else now
    return df.filter(F.year(date) > F.year(now) - years)


def new_files(files: DataFrame, ledger: DataFrame, name: str = "file_name") -> DataFrame:
    """File names that are not in the ledger of files already taken."""
    return files.select(name).distinct().join(ledger.select(name), name, "left_anti")


def with_file_name(df: DataFrame) -> DataFrame:
    return df.withColumn("file_name", F.element_at(F.split(F.input_file_name(), "/"), -1))


def newest_monthly_file(files: DataFrame, name: str, patterns: Mapping[str, str]) -> DataFrame:
    """Newest file of each kind by the MMYY digits in its name."""
    kind = F.lit(None).cast("string")
    for label, pattern in reversed(list(patterns.items())):
        kind = F.when(F.lower(F.col(name)).rlike(pattern), label).otherwise(kind)
    digits = F.regexp_extract(name, r"(\d{4})", 1)
    month = F.try_to_timestamp(F.when(digits != "", digits), F.lit("MMyy")).cast("date")
    dated = files.withColumns({"kind": kind, "file_month": F.coalesce(month, F.lit("1900-01-01").cast("date"))})
    dated = dated.filter(F.col("kind").isNotNull())
    return keep_first(dated.select("kind", "file_month", name), ["kind"], [-F.unix_date("file_month"), F.col(name)])


def export_single(df: DataFrame, path: str, kind: str = "csv") -> None:
    """One file for a report table: its rows are computed by many tasks, and only the finished ones go to one writer."""
    writer = df.repartition(1).write.mode("overwrite")
    writer.option("header", True).csv(path) if kind == "csv" else writer.parquet(path)


def parquet_safe(df: DataFrame) -> DataFrame:
    return df.toDF(*[storage_header(c) for c in df.columns])
