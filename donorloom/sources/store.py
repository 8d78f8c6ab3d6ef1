"""Layered Parquet tables: create, append, publish, replace partitions, upsert.

A table is a folder ``<root>/<layer>/<client>_<name>`` with a dated folder for each
whole version; a whole write makes a new one, and readers take the newest or an
earlier one. Partial writes go into the newest version by Spark's own means: rows
are added in append mode, and what an upsert or a replaced period or window
changes is made durable first and then written with dynamic partition overwrite,
so the files of all other partitions stay as they are. Upserts partition by a hash
of the key (``_hash``) and window replaces by the month of a date (``_month``); a
table with another layout is written whole once.

There is no metadata beside the data: Spark reads columns and partitions from the
files. One writer per table at a time; this is not a transaction log.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from donorloom.functions.clean import table_schema
from donorloom.operators.setops import replace_window
from donorloom.session import durable

SUFFIXES = {"gift": "gift", "donor": "donor", "source_code": "source_code", "budget": "budget",
            "transactions": "transactions", "fh_date": "fh_date", "fh_group": "fh_group"}
PARTS = 64  # hash partitions of a table with a key
HASH, MONTH = "_hash", "_month"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _folders(path: str) -> list[str]:
    """Names of what lies in a folder and is not hidden; none if there is no folder."""
    system, place = fs.FileSystem.from_uri(_uri(path))
    found = system.get_file_info(fs.FileSelector(place, allow_not_found=True))
    return sorted(f.base_name for f in found if f.base_name[0] not in "._" or f.base_name.startswith((HASH, MONTH)))


def _uri(path: str) -> str:
    if path.startswith("/"):
        return "file://" + path
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


def _hash(key: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(PARTS)).cast("int")


def _month(date: str) -> Column:
    day = F.col(date).cast("date")
    return F.year(day) * 12 + F.month(day) - 1


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str
    client: str

    def path(self, name: str, layer: str = "silver") -> str:
        return f"{self.root}/{layer}/{self.client.lower()}_{SUFFIXES.get(name, name)}"

    # ---- versions and reading ----------------------------------------------------
    def versions(self, name: str, layer: str = "silver") -> list[str]:
        """Dates of the whole versions, oldest first. What a failed write left behind has no data file and is none."""
        folder = self.path(name, layer)
        return [leaf for leaf in _folders(folder) if _folders(f"{folder}/{leaf}")]

    def exists(self, name: str, layer: str = "silver") -> bool:
        return bool(self.versions(name, layer))

    def _newest(self, name: str, layer: str, back: int = 0) -> str:
        found = self.versions(name, layer)
        if len(found) <= back:
            raise FileNotFoundError(self.path(name, layer))
        return f"{self.path(name, layer)}/{found[-1 - back]}"

    def _rows(self, version: str) -> DataFrame:
        """With the hidden partition columns. Files written before a column was added have nulls there."""
        return self.spark.read.option("mergeSchema", True).parquet(version)

    def read(self, name: str, layer: str = "silver", back: int = 0) -> DataFrame:
        """Newest version, or ``back`` whole versions earlier. Partition columns have the type that Spark infers."""
        return self._rows(self._newest(name, layer, back)).drop(HASH, MONTH)

    # ---- whole tables ------------------------------------------------------------
    def overwrite(self, df: DataFrame, name: str, layer: str = "silver", partition: Sequence[str] = ()) -> None:
        stamp = datetime.datetime.now(datetime.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
        if partition:  # rows of a partition go together, large ones split by AQE
            df = df.hint("rebalance", *[F.col(c) for c in partition])
        df.write.partitionBy(*partition).parquet(f"{self.path(name, layer)}/{stamp}")

    def create(self, name: str, definition: Mapping[str, str], layer: str = "silver") -> None:
        """Empty table from a type map, unless it exists."""
        if not self.exists(name, layer):
            self.overwrite(self.spark.createDataFrame([], table_schema(definition)), name, layer)

    def create_like(self, name: str, template: DataFrame, layer: str = "silver") -> None:
        if not self.exists(name, layer):
            self.overwrite(self.spark.createDataFrame([], template.schema), name, layer)

    def publish(self, name: str) -> None:
        """Silver to curated."""
        rows = self._rows(self._newest(name, "silver"))
        self.overwrite(rows, name, "curated", [c for c in (HASH, MONTH) if c in rows.columns])

    # ---- parts of a table --------------------------------------------------------
    def _typed(self, df: DataFrame, current: DataFrame) -> DataFrame:
        """Shared columns in the table's types."""
        kinds = dict(current.dtypes)
        return df.withColumns({c: F.col(f"`{c}`").cast(kinds[c]) for c in df.columns if c in kinds})

    def append(self, df: DataFrame, name: str, layer: str = "silver", key: Sequence[str] = (), date: str | None = None) -> None:
        """Add rows; new columns widen the table. A table that upserts or window replaces have partitioned needs its key or date."""
        if not self.exists(name, layer):
            self.overwrite(df, name, layer)
            return
        version = self._newest(name, layer)
        current = self._rows(version)
        by = [c for c in (HASH, MONTH) if c in current.columns]
        if (HASH in by) != bool(key) or (MONTH in by) != (date is not None):
            raise ValueError(f"{name} is partitioned by {by or 'nothing'}")
        rows = self._typed(df, current)
        rows = rows.withColumn(HASH, _hash(key)) if key else rows.withColumn(MONTH, _month(date)) if date else rows
        if not by:
            by = [leaf.split("=")[0] for leaf in _folders(version) if "=" in leaf][:1]
        rows.write.mode("append").partitionBy(*by).parquet(version)

    def append_aligned(self, df: DataFrame, name: str, layer: str = "silver") -> None:
        """Add distinct rows with exactly the target's columns."""
        schema = self.read(name, layer).schema
        self.append(df.select(*[
            (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema]).dropDuplicates(), name, layer)

    def seed(self, rows: DataFrame, name: str, key: Sequence[str], layer: str = "silver") -> None:
        """Add rows whose key is not there yet."""
        current = self._rows(self._newest(name, layer))
        new = rows.join(current.select(*key), list(key), "left_anti")
        self.append(new, name, layer, key if HASH in current.columns else ())

    def _replace(self, rows: DataFrame, version: str, by: str) -> None:
        """Write the partitions that ``rows`` has, and leave all others as they are."""
        rows.hint("rebalance", F.col(by)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(version)

    def replace_partition(self, df: DataFrame, name: str, column: str, layer: str = "silver") -> None:
        """Replace the partitions the frame has rows for, and only those."""
        if not self.exists(name, layer):
            self.overwrite(df, name, layer, [column])
            return
        version = self._newest(name, layer)
        if any(leaf.startswith(f"{column}=") for leaf in _folders(version)):
            self._replace(durable(df), version, column)
            return
        there = df.select(F.col(column).alias("_there")).distinct()
        kept = self.read(name, layer).join(there, F.col(column).eqNullSafe(F.col("_there")), "left_anti")
        self.overwrite(kept.unionByName(df, allowMissingColumns=True), name, layer, [column])

    def upsert(self, changes: DataFrame, name: str, key: Sequence[str], layer: str = "silver") -> None:
        """Matched keys take the new non-null values, other keys are added. Only hash partitions with changes are rewritten."""
        if not self.exists(name, layer):
            self.overwrite(changes.withColumn(HASH, _hash(key)), name, layer, [HASH])
            return
        version = self._newest(name, layer)
        current = self._rows(version)
        changes = self._typed(changes, current)
        if HASH not in current.columns:
            merged = merge_rows(current.drop(MONTH), changes, key)
            self.overwrite(merged.withColumn(HASH, _hash(key)), name, layer, [HASH])
            return
        changes = durable(changes.withColumn(HASH, _hash(key)))
        touched = [r[0] for r in changes.select(HASH).distinct().collect()]  # PARTS at most
        if touched:
            merged = merge_rows(current.filter(F.col(HASH).isin(touched)).drop(HASH), changes.drop(HASH), key)
            self._replace(durable(merged.withColumn(HASH, _hash(key))), version, HASH)

    def replace_range(self, batch: DataFrame, name: str, date: str, layer: str = "silver") -> None:
        """``replace_window`` on the table. Only months of the batch's range, and rows without a date, are rewritten.

        Months that lose all their rows are overwritten by an empty file each, after the others.
        """
        if not self.exists(name, layer):
            self.overwrite(batch.withColumn(MONTH, _month(date)), name, layer, [MONTH])
            return
        version = self._newest(name, layer)
        current = self._rows(version)
        batch = self._typed(batch, current)
        if MONTH not in current.columns:
            rows = replace_window(current.drop(HASH), batch, date)
            self.overwrite(rows.withColumn(MONTH, _month(date)), name, layer, [MONTH])
            return
        low, high = batch.agg(F.min(_month(date)), F.max(_month(date))).first()
        month = F.col(MONTH)
        inside = month.isNull() if low is None else month.isNull() | month.between(low, high)
        rows = durable(replace_window(current.filter(inside).drop(MONTH), batch, date).withColumn(MONTH, _month(date)))
        left = {NULL_FOLDER if r[0] is None else str(r[0]) for r in rows.select(MONTH).distinct().collect()}  # months of the range at most
        there = {leaf.split("=")[1] for leaf in _folders(version) if leaf.startswith(f"{MONTH}=")}
        self._replace(rows, version, MONTH)
        for value in sorted(there - left):
            if value == NULL_FOLDER or (low is not None and low <= int(value) <= high):
                self.spark.createDataFrame([], rows.drop(MONTH).schema).write.mode("overwrite").parquet(f"{version}/{MONTH}={value}")

    def vacuum(self, name: str, keep: int, layer: str = "silver") -> None:
        """Remove all but the newest ``keep`` whole versions."""
        for version in self.versions(name, layer)[:-keep]:
            system, place = fs.FileSystem.from_uri(_uri(f"{self.path(name, layer)}/{version}"))
            system.delete_dir(place)


def merge_rows(current: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Upsert as a grouping: per key the new value of each column, or the current one where it is null."""
    columns = [c for c in dict.fromkeys([*current.columns, *changes.columns]) if c not in key]

    def side(df: DataFrame, n: int) -> DataFrame:
        return df.withColumn("_side", F.lit(n))

    both = side(current, 0).unionByName(side(changes, 1), allowMissingColumns=True)
    def latest(c: str):
        seen = F.col(c).isNotNull()
        return F.max_by(F.when(seen, F.col(c)), F.when(seen, F.col("_side"))).alias(c)
    return both.groupBy(*key).agg(*[latest(c) for c in columns])
