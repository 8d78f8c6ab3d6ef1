"""Lines that many documents share are removed, by levelled sorted runs of line digests.

A run is a table of (key, docs), bucketed and sorted by key and split into keys
that are still open and keys that are settled, that is, found in enough
documents. Runs are ordinary bucketed tables of one database of Spark's
catalog, so the joins below merge them bucket by bucket without a shuffle.
A new batch of documents is counted by key, merge-anti-joins the settled keys of
every run (nothing more is to be learned about them), adds what the runs know
of its open keys, and becomes a run of level 0. When a level has ``fan`` runs,
they are merged into one run of the next level.

Everything is made of DataFrame functions. Only digests of lines are shuffled
(of the lines of a batch once, of shared lines once more) and every text once,
by its own digest, to meet what is to be removed from it. A line or a text with
over 1/1024 of the rows stays where it is: such keys are broadcast, 1,023 of
them per batch at most.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from donorloom.llm.common import ascii_lower, hot_share
from donorloom.session import durable, new_folder

SPACE = " \t\n\x0b\f\r"
FAN = 3  # runs of a level that are merged into one of the next
BATCHES = 4
DIGITS = 32  # hex digits of a SHA-256 kept as key: 128 bits


def split_lines(text: Column) -> Column:
    """The lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def _stripped(lines: Column) -> Column:
    return F.transform(lines, lambda line: F.btrim(line, F.lit(SPACE)))


def line_keys(text: Column, min_chars: int) -> Column:
    """Digest of every line's key, the line stripped and with A-Z lower-cased; null for keys under ``min_chars``."""
    text = text.cast("string")
    lower = F.when(F.char_length(text) == F.octet_length(text), F.lower(text)).otherwise(ascii_lower(text))
    return F.transform(_stripped(split_lines(lower)), lambda key: F.when(
        F.char_length(key) >= min_chars, F.substring(F.sha2(key, 256), 1, DIGITS)))


class LineRuns:
    """The runs of one database. With a lasting catalog, a later session goes on where this one stopped.

    ``docs`` of an entry is the number of documents known when its run was
    written, so of several entries of a key the largest holds.
    """

    def __init__(self, spark: SparkSession, database: str, min_docs: int, fan: int = FAN, buckets: int | None = None):
        self.spark, self.database, self.min_docs, self.fan = spark, database, min_docs, fan
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if not spark.catalog.databaseExists(database):
            spark.sql(f"CREATE DATABASE {database} LOCATION '{new_folder(spark, database)}'")

    def levels(self) -> dict[int, list[str]]:
        """Names of the runs by level, oldest first."""
        found: dict[int, list[str]] = {}
        for table in sorted(t.name for t in self.spark.catalog.listTables(self.database)):
            if table.startswith("run_"):
                found.setdefault(int(table.split("_")[1]), []).append(f"{self.database}.{table}")
        return found

    def _runs(self) -> list[str]:
        return [name for names in self.levels().values() for name in names]

    def _write(self, entries: DataFrame, name: str) -> str:
        state = F.when(F.col("docs") >= self.min_docs, "settled").otherwise("open")
        entries.select("key", "docs", state.alias("state")).write.partitionBy("state").bucketBy(
            self.buckets, "key").sortBy("key").saveAsTable(f"{self.database}.{name}")
        return f"{self.database}.{name}"

    def _entries(self, run: str, state: str) -> DataFrame:
        return self.spark.table(run).filter(F.col("state") == state).select("key", "docs")

    def add(self, keys: DataFrame) -> DataFrame:
        """Add a batch, ``keys(key)`` with a row for each key of each document; returns the batch's hot keys (key)."""
        number = 1 + max((int(n.rsplit("_", 1)[1]) for n in self._runs()), default=-1)
        fresh = self._write(keys.groupBy("key").agg(F.count(F.lit(1)).alias("docs")), f"batch_{number:09d}")
        counted = self.spark.table(fresh).select("key", "docs")
        hot = durable(hot_share(counted, "docs").filter(F.col("docs") >= self.min_docs).select("key"))
        batch, before = counted, []
        for run in self._runs():
            batch = batch.join(self._entries(run, "settled").select("key").hint("merge"), "key", "left_anti")
        for i, run in enumerate(self._runs()):
            known = self._entries(run, "open").withColumnRenamed("docs", f"docs_{i}")
            batch = batch.join(known.hint("merge"), "key", "left")
            before.append(F.coalesce(F.col(f"docs_{i}"), F.lit(0)))
        known = F.greatest(*before, F.lit(0), F.lit(0)) if before else F.lit(0)
        self._write(batch.select("key", (F.col("docs") + known).alias("docs")), f"run_0_{number:09d}")
        self.spark.sql(f"DROP TABLE {fresh}")
        self._compact()
        return hot

    def _compact(self) -> None:
        level = 0
        while len(names := self.levels().get(level, [])) >= self.fan:
            rows = reduce(DataFrame.unionByName, [self.spark.table(n).select("key", "docs") for n in names])
            last = names[-1].rsplit("_", 1)[1]
            self._write(rows.groupBy("key").agg(F.max("docs").alias("docs")), f"run_{level + 1}_{last}")
            for name in names:
                self.spark.sql(f"DROP TABLE {name}")
            level += 1

    def settled(self) -> DataFrame:
        """(key): each key found in ``min_docs`` documents or more, once, as it settles in one run only."""
        parts = [self._entries(run, "settled").select("key") for run in self._runs()]
        return reduce(DataFrame.unionByName, parts)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, where ``use`` names it many times or inside a function of arrays."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _kept(lines: Column, places: Column, min_chars: int) -> Column:
    """The lines whose places are not in the sorted ``places``; without places, all lines that have no key.

    What lies between two removed places is cut out as a slice, so the cost is that of one pass.
    """
    def between(z: Column) -> Column:
        gap = lambda j: F.slice(z["lines"], F.get(z["edges"], j) + 2, F.get(z["edges"], j + 1) - F.get(z["edges"], j) - 1)
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(z["edges"]) - 2), gap))

    edges = F.concat(F.array(F.lit(-1)), places, F.array(F.size(lines)))
    return F.when(places.isNull(), F.filter(lines, lambda line: F.char_length(F.btrim(line, F.lit(SPACE))) < min_chars)).otherwise(
        once(F.struct(lines.alias("lines"), edges.alias("edges")), between))


def drop_shared_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = BATCHES) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) for every row of ``docs(doc_id, text)``; other columns are left out.

    A line whose key has ``min_chars`` code points or more and is found in
    ``min_docs`` documents or more is removed from all of them. A document is a
    row: repeated rows, rows with equal ids and rows without an id count one
    each. A null text is an empty one: one empty line, which has no key and
    stays (unless ``min_chars`` is 0). Line feeds alone separate lines.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select("doc_id", text.alias("text")).withColumn(
        "t", F.when((F.length("text") > 0) | F.lit(min_chars <= 0), F.substring(F.sha2("text", 256), 1, DIGITS)))
    folder = new_folder(spark, "line-keys")
    # A batch is what some input partitions hold. Its keys are written once and read by batch, and once more at the end.
    keyed.select("t", line_keys(F.col("text"), min_chars).alias("keys"), F.pmod(F.spark_partition_id(), F.lit(batches)).alias("batch")).write.option(
        "compression", "zstd").partitionBy("batch").parquet(folder)
    narrow = spark.read.schema("t string, keys array<string>, batch int").parquet(folder)
    runs = LineRuns(spark, f"line_runs_{uuid.uuid4().hex}", min_docs)
    hot = []
    for batch in range(batches):
        own = narrow.filter(F.col("batch") == batch).select(F.explode(F.array_distinct("keys")).alias("key"))
        hot.append(runs.add(own.filter(F.col("key").isNotNull())))
    common = F.broadcast(reduce(DataFrame.unionByName, hot).distinct().withColumn("common", F.lit(True)))
    places = narrow.select("t", F.posexplode("keys").alias("place", "key")).filter(F.col("key").isNotNull()).join(common, "key", "left")
    shared = places.filter(F.col("common")).unionByName(
        places.filter(F.col("common").isNull()).join(runs.settled().hint("merge"), "key", "left_semi").select(*places.columns))
    per_text = shared.groupBy("t", "place").agg(F.count(F.lit(1)).alias("n")).groupBy("t").agg(
        F.sort_array(F.collect_list("place")).alias("places"), F.max("n").alias("n"))
    # A text with min_docs copies loses every line that has a key, so its places need not be known.
    per_text = durable(per_text.select("t", F.when(F.col("n") < min_docs, F.col("places")).alias("places"), "n", F.lit(True).alias("found")))
    copies = F.broadcast(hot_share(per_text, "n").filter(F.col("n") >= min_docs).select("t", F.lit(True).alias("often")))
    marked = keyed.join(copies, "t", "left")
    nothing = F.array().cast("array<int>")
    here = marked.filter(F.col("often") | F.col("t").isNull()).select(
        "doc_id", split_lines(F.col("text")).alias("lines"), F.when(F.col("t").isNull(), nothing).alias("places"))
    there = marked.filter(F.col("often").isNull() & F.col("t").isNotNull()).join(per_text, "t", "left").select(
        "doc_id", split_lines(F.col("text")).alias("lines"), F.when(F.col("found"), F.col("places")).otherwise(nothing).alias("places"))
    kept = here.unionByName(there).withColumn("kept", _kept(F.col("lines"), F.col("places"), min_chars))
    return kept.select("doc_id", F.array_join("kept", "\n").alias("text"), F.size("lines").cast("long").alias("n_lines"),
                       (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"))


def oracle(min_docs: int = 10, min_chars: int = 1) -> str:
    """The query's rows in SQL."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents),
l AS (SELECT r, doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key AS shared FROM k WHERE length(key) >= {min_chars} GROUP BY key HAVING count(DISTINCT r) >= {min_docs})
SELECT doc_id, count(*)::BIGINT AS n_lines, count(shared)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (shared IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON key = shared GROUP BY r, doc_id"""
