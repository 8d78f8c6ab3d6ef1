"""New files as a stream: each micro-batch replaces its date window in the master table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorloom.sources.store import Store


def file_stream(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """CSV files as they arrive; the stream's own log is the ledger of files already taken.

    A trigger takes all files that are there, without a cap: a delivery replaces one
    date window, and cut into several batches each would delete the one before.
    """
    return spark.readStream.schema(schema).option("header", True).csv(folder)


def replace_into(store: Store, name: str, date: str):
    """``foreachBatch`` writer with a ledger of the batches taken, a table beside the data.

    A batch that is run again before it is in the ledger gives the same table; one
    that is in it, or older, is not taken again, so it cannot undo newer ones.
    """
    ledger = f"{name}_batches"

    def write(batch: DataFrame, number: int) -> None:
        newest = store.read(ledger).agg(F.max("batch")).first()[0] if store.exists(ledger) else None
        if newest is not None and number <= newest:
            return
        if not batch.isEmpty():
            store.replace_range(batch, name, date)
        store.append(store.spark.createDataFrame([(number,)], "batch long"), ledger)
    return write


def run_available(stream: DataFrame, store: Store, name: str, date: str, checkpoint: str) -> None:
    """Take everything that is there now, then stop. The checkpoint belongs to one table for good."""
    query = (stream.writeStream.foreachBatch(replace_into(store, name, date))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
