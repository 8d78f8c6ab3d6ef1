"""Session settings the library is tested with, and the folder that all machines share.

On a cluster the submitter owns the session; these are the settings worth
having there too. Nothing in the library depends on a partition count: AQE
coalesces small shuffles and splits skewed ones.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join that feeds another keyed step may still split its hot key; the
    # extra shuffle is cheaper than one task holding a third of the rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Recording a call site for every column costs more than analysing it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "donorloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset a temporary folder serves in local mode, with one machine
    and one process; on a cluster its absence is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if named is None and context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that the driver and all executors share.")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="donorloom-"))
    return (named or context.getCheckpointDir()).rstrip("/")


def new_folder(spark: SparkSession, kind: str = "work") -> str:
    """A path in the shared folder that no other call gets."""
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Compute ``df`` now and cut its lineage by a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Compute ``df`` now, once, as Parquet in the shared folder.

    For wide tables that are read several times: smaller than a checkpoint, a reader
    takes only the columns it needs, and Spark knows the size.
    """
    folder = new_folder(df.sparkSession, "stored")
    df.write.parquet(folder, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(folder)
