"""Folders of delimited files whose formats differ from file to file.

One pass over the lines chooses delimiter, quote and encoding of every file: a
candidate scores the lines that have as many fields as the file's header or its
quote at the edge of a field. The same pass counts quotes in every chunk of some
thousand lines, so it is known in which chunks a quoted field runs over a line
break, whether a chunk begins inside one, and which line opened it.

A second pass reads the records. In chunks without such fields, which are most,
a line is a record and nothing is shuffled. The lines of the others are put
together by chunk, by the running number of quotes; the lines at the head of a
chunk that end a record of an earlier one go there. So large files are read by
many tasks, with quoted line breaks or without, and no task holds a whole split.

Nothing is cut silently: records with more fields than the header, and what does
not close its quotes, come as raw text in ``_bad_line``.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorloom.session import stored

BAD_LINE = "_bad_line"
DELIMITERS = (",", "\t", ";", "|")
QUOTES = ('"', "'")
FORMATS = tuple((d, q) for d in DELIMITERS for q in QUOTES)
LAYOUTS = 1000  # different headers in one folder at most; they become columns, which are named before reading
RECORD_LINES = 2000  # lines of one record at most; what lies beyond is quarantined line by line
CHUNK_BITS = 11  # a chunk has 2,048 lines at most
BROADCAST_CHUNKS = 100_000  # some 80 bytes each, and a row per split; more are joined
MARKS = ("﻿", "ï»¿")  # byte-order mark, also as Latin-1


def _count(text: Column, char: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, char, F.lit("")))


def _bare(text: Column) -> Column:
    """Without characters escaped by a backslash."""
    return F.when(text.contains("\\"), F.regexp_replace(text, r"(?s)\\.", "")).otherwise(text)


def _unquoted(bare: Column, quote: Column) -> Column:
    return F.when(F.contains(bare, quote), F.regexp_replace(bare, F.concat(quote, F.lit("[^"), quote, F.lit("]*"), quote), F.lit(""))).otherwise(bare)


def _sizes(unquoted: Sequence[Column]) -> list[Column]:
    """Number of fields under each format; ``unquoted`` holds the line without each kind of quoted parts."""
    return [1 + _count(unquoted[QUOTES.index(q)], F.lit(d)) for d, q in FORMATS]


def _sizes_or_quoted(value: Column, unquoted: Sequence[Column]) -> list[Column]:
    """The same, but -1 for lines with the quote at their ends or beside the delimiter: such a line may be part of a record only."""
    return [F.when(value.startswith(q) | value.endswith(q) | value.contains(d + q) | value.contains(q + d), -1).otherwise(n)
            for (d, q), n in zip(FORMATS, _sizes(unquoted))]


def _of_format(form: Column, i: int) -> Column:
    """Delimiter (0) or quote (1) of a format."""
    return F.array(*[F.lit(f[i]) for f in FORMATS])[form]


def _lines(spark: SparkSession, path: str | Sequence[str], glob: str | None) -> DataFrame:
    """(file, block, n, value, chunk): lines with their file, the place where their split begins, and an order within it that has no gaps."""
    reader = spark.read.option("recursiveFileLookup", True)
    raw = (reader.option("pathGlobFilter", glob) if glob else reader).text(path if isinstance(path, str) else list(path))
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("n"), "value").withColumn("chunk", F.shiftright("n", CHUNK_BITS))


def _decoded(value: Column, utf8: Column, encoding: str) -> Column:
    return F.when(utf8, value).otherwise(F.decode(value.cast("binary"), encoding))


def _counted(lines: DataFrame) -> DataFrame:
    """One row per chunk and number of fields under each format: lines, and for each quote the lines with an odd number of it, the first and the last."""
    value, bare = F.col("value"), F.col("bare")
    scored = (F.col("block") == 0) & (F.trim(value) != "")
    without = [F.col(f"without{i}") for i in range(len(QUOTES))]
    rows = _add_without(lines.withColumn("bare", _bare(value))).select(
        "file", "block", "chunk", "n", F.is_valid_utf8(value).alias("utf8"), F.when(scored, F.array(*_sizes_or_quoted(value, without))).alias("sizes"),
        *[(_count(bare, F.lit(q)) % 2).alias(f"odd{i}") for i, q in enumerate(QUOTES)])
    # Lines with equal numbers of fields are counted before anything is shuffled; no text is kept here, which would have to be sorted.
    at = [F.when(F.col(f"odd{i}") == 1, F.col("n")) for i in range(len(QUOTES))]
    return rows.groupBy("file", "block", "chunk", "sizes").agg(
        F.count(F.lit(1)).alias("lines"), F.min("n").alias("n"), F.bool_and("utf8").alias("utf8"), *[F.sum(f"odd{i}").alias(f"odd{i}") for i in range(len(QUOTES))],
        *[F.min(a).alias(f"first{i}") for i, a in enumerate(at)], *[F.max(a).alias(f"last{i}") for i, a in enumerate(at)])


def _add_without(df: DataFrame) -> DataFrame:
    return df.withColumns({f"without{i}": _unquoted(F.col("bare"), F.lit(q)) for i, q in enumerate(QUOTES)})


def _files(lines: DataFrame, counted: DataFrame, encoding: str) -> DataFrame:
    """One row per file: format, header and encoding."""
    first = counted.filter("block = 0").groupBy("file").agg(F.min("n").alias("n")).select("n")
    heads = lines.filter("block = 0").join(F.broadcast(first), "n", "left_semi").select("file", "value")  # a number per file, whose names the driver lists anyway
    counted = counted.groupBy("file", "sizes").agg(F.sum("lines").alias("lines"), F.bool_and("utf8").alias("utf8")).join(heads, "file")
    without = [F.col(f"without{i}") for i in range(len(QUOTES))]
    counted = _add_without(counted.withColumn("bare", _bare(F.col("value")))).withColumn("own", F.array(*_sizes(without)))
    # Equal scores go to the format that finds more fields, then to the quote that the header has, then to the first.
    marks = [_count(F.col("bare"), F.lit(q)) for _, q in FORMATS]
    fits = [F.sum(F.when(F.col("sizes")[i].isin(-1, F.col("own")[i]) & (F.col("own")[i] > 1), F.col("lines")).otherwise(0)) for i in range(len(FORMATS))]
    files = counted.withColumn("marks", F.array(*marks)).groupBy("file").agg(
        F.array(*fits).alias("fits"), F.min("own").alias("own"), F.min("marks").alias("marks"), F.min("value").alias("header"), F.bool_and("utf8").alias("utf8"))
    order = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(len(FORMATS) - 1)), lambda i: F.struct(
        F.get("fits", i), F.get("own", i), F.get("marks", i), (-i).alias("i"))))
    return files.select("file", "utf8", (-order["i"]).alias("form"), _decoded(F.col("header"), F.col("utf8"), encoding).alias("header"))


def _blocks(counted: DataFrame, files: DataFrame) -> DataFrame:
    """One row per split with its chunks in order.

    ``shift`` makes a line's ``n`` its number in the file and ``home`` is the number of the chunk's first line. A chunk that
    begins inside quotes (``opened``) knows the line that opened them, that line's chunk (``owner``) and the line that closes them.
    """
    in_file = W.partitionBy("file")
    earlier = in_file.orderBy("block", "chunk").rowsBetween(W.unboundedPreceding, -1)
    of_form = lambda name: F.array(*[F.col(f"{name}{QUOTES.index(q)}") for _, q in FORMATS])[F.col("form")]
    chunks = counted.groupBy("file", "block", "chunk").agg(
        F.sum("lines").alias("lines"), F.min("n").alias("n"), *[f(f"{name}{i}").alias(f"{name}{i}") for name, f in (
            ("odd", F.sum), ("first", F.min), ("last", F.max)) for i in range(len(QUOTES))]).join(files.select("file", "form"), "file")
    chunks = chunks.select("file", "block", "chunk", "n", "lines", *[of_form(name).alias(name) for name in ("odd", "first", "last")])
    before = F.coalesce(F.sum("odd").over(earlier), F.lit(0))
    chunks = chunks.withColumns({
        "home": F.coalesce(F.sum("lines").over(earlier), F.lit(0)), "opened": before % 2 == 1, "balanced": F.sum("odd").over(in_file) % 2 == 0})
    chunks = chunks.withColumn("shift", F.col("home") - F.col("n"))
    opener = F.max(F.when(F.col("odd") > 0, F.struct((F.col("last") + F.col("shift")).alias("opener"), F.col("home").alias("owner")))).over(earlier)
    chunks = chunks.withColumns({"by": opener, "runs_on": F.col("balanced") & ((F.col("odd") > 0) | F.col("opened"))})
    return chunks.groupBy("file", "block").agg(F.min("chunk").alias("first_chunk"), F.sort_array(F.collect_list(F.struct(
        "chunk", "runs_on", "opened", "by.opener", "by.owner", (F.col("first") + F.col("shift")).alias("closer"), "home", "shift"))).alias("chunks"))


def _joined(lines: DataFrame) -> DataFrame:
    """Records of chunks in which quoted fields hold line breaks."""
    info = lambda name: F.col("info")[name]
    # Lines that end the record of an earlier chunk go there, unless they are too far from its beginning.
    ending = info("opened") & (info("closer").isNull() | (F.col("at") <= info("closer")))
    near = F.col("at") - info("opener") < RECORD_LINES
    rows = lines.withColumn("at", F.col("n") + info("shift")).select(
        "file", "layout", "form", "text", "header_line", "at", F.when(ending & near, info("owner")).otherwise(info("home")).alias("home"),
        (ending & ~near).alias("beyond"), F.when(ending & ~near, 0).otherwise(F.col("odd_line")).alias("odd"))
    earlier = W.partitionBy("file", "home").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumns({"before": F.coalesce(F.sum("odd").over(earlier), F.lit(0)), "opener": F.max(F.when(F.col("odd") == 1, F.col("at"))).over(earlier)})
    inside = F.col("before") % 2 == 1
    rows = rows.withColumn("beyond", F.col("beyond") | (inside & (F.col("at") - F.col("opener") >= RECORD_LINES)))
    record = F.when(inside & ~F.col("beyond"), F.col("opener")).otherwise(F.col("at"))
    return rows.groupBy("file", "home", "layout", "form", "beyond", record.alias("record")).agg(
        F.sort_array(F.collect_list(F.struct("at", "text"))).alias("parts"), F.min("header_line").alias("header_line")).select(
        "file", "layout", "form", F.array_join("parts.text", "\n").alias("text"), "header_line", "beyond")


def _names(header: str, delimiter: str, quote: str) -> list[str]:
    for mark in MARKS:  # before the header or inside its first quotes
        header = header.removeprefix(mark)
    names = next(csv.reader([header], delimiter=delimiter, quotechar=quote, escapechar="\\"), [])
    for mark in MARKS:
        names[:1] = [n.removeprefix(mark) for n in names[:1]]
    names = [n.strip() for n in names]
    return [n if n and n not in names[:i] else f"{n or '_c'}{i}" for i, n in enumerate(names)]


def read_mixed(spark: SparkSession, path: str | Sequence[str], encoding: str = "ISO-8859-1", glob: str | None = "*.csv*") -> DataFrame:
    """All files below a folder as text columns, the union of their headers, with ``_bad_line`` and ``_file``.

    Every file names its columns in its first line and may have its own order of
    columns, delimiter, quote and encoding (UTF-8, or ``encoding`` where it is
    not valid UTF-8). A file whose quotes do not close is read line by line, and
    its lines with an odd number of quotes are bad. Lines that repeat the header
    and blank lines are left out; missing fields are null.
    """
    lines = _lines(spark, path, glob)
    counted = stored(_counted(lines))
    files = stored(_files(lines, counted, encoding))
    found = files.select("form", "header").distinct().limit(LAYOUTS + 1).collect()
    if len(found) > LAYOUTS:
        raise ValueError(f"more than {LAYOUTS} different headers in one folder")
    layouts = sorted((r["form"], r["header"]) for r in found)
    names = [_names(header, *FORMATS[form]) for form, header in layouts]
    every = list(dict.fromkeys(n for own in names for n in own))
    out = T.StructType([T.StructField(n, T.StringType()) for n in [*every, BAD_LINE, "_file"]])
    if not layouts:
        return spark.createDataFrame([], out)
    table = spark.createDataFrame([(i, *layout) for i, layout in enumerate(layouts)], "layout int, form int, header string")
    blocks = stored(_blocks(counted, files).join(files.join(F.broadcast(table), ["form", "header"]), "file"))  # LAYOUTS rows at most
    runs_on = lambda x: x["runs_on"]
    some, all_, chunks = blocks.agg(F.bool_or(F.exists("chunks", runs_on)), F.bool_and(F.forall("chunks", runs_on)), F.sum(F.size("chunks"))).first()
    text = _decoded(F.col("value"), F.col("utf8"), encoding)
    rows = lines.join(F.broadcast(blocks) if chunks <= BROADCAST_CHUNKS else blocks, ["file", "block"]).select(
        "file", "layout", "form", "n", F.get("chunks", (F.col("chunk") - F.col("first_chunk")).cast("int")).alias("info"),
        text.alias("text"), (text == F.col("header")).alias("header_line"),
        (_count(_bare(F.col("value")), _of_format(F.col("form"), 1)) % 2).alias("odd_line"))
    kinds = [] if all_ else [rows.filter(~F.col("info.runs_on")).select("file", "layout", "form", "text", "header_line", F.lit(False).alias("beyond"))]
    kinds += [_joined(rows.filter("info.runs_on"))] if some else []
    records = kinds[0] if len(kinds) == 1 else kinds[0].unionByName(kinds[1])
    records = records.filter(~F.col("header_line") & (F.trim("text") != "")).withColumn("bare", _bare(F.col("text")))
    sizes = F.array(*[F.lit(len(own)) for own in names])
    delimiter, quote = _of_format(F.col("form"), 0), _of_format(F.col("form"), 1)
    broken = (1 + _count(_unquoted(F.col("bare"), quote), delimiter) > sizes[F.col("layout")]) | (_count(F.col("bare"), quote) % 2 == 1) | F.col("beyond")
    records = records.withColumn("broken", broken)
    parsed, found_in = {}, {n: [] for n in every}
    for i, ((form, _), own) in enumerate(zip(layouts, names)):
        d, q = FORMATS[form]
        fields = lambda escape: F.from_csv(F.col("text"), F.lit(", ".join(f"c{k} string" for k in range(len(own)))), {
            "sep": d, "quote": q, "escape": escape, "mode": "PERMISSIVE"})
        # A quote inside quotes is doubled, or follows a backslash.
        here = (F.col("layout") == i) & ~F.col("broken")
        parsed[f"p{i}"] = F.when(here & F.col("text").contains("\\" + q), fields("\\")).when(here, fields(q))
        for k, n in enumerate(own):
            found_in[n].append(F.col(f"p{i}.c{k}"))
    return records.withColumns(parsed).select(
        *[F.coalesce(*places).alias(n) for n, places in found_in.items()], F.when(F.col("broken"), F.col("text")).alias(BAD_LINE),
        F.col("file").alias("_file"))
