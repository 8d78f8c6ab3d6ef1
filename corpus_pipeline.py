"""Documents through quality, near-duplicate removal, mixing and encoding, each stage written before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from donorloom.llm import mixing, quality, sentencepieces, simhash
from donorloom.llm.common import read
from donorloom.llm.queries import PIECES, vocabulary
from donorloom.session import new_folder


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights, repeated where several epochs take them."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document: doc_id, ids, n_pieces, lossless."""
    out = sentencepieces.encode_documents(docs, vocabulary(PIECES))
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "lossless")


STAGES = [("quality", good), ("near_copies", distinct), ("mixing", mixed), ("pieces", encoded)]

#: The classifier's densities and XXH64 fingerprints have no form in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Every stage is written as Parquet to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
