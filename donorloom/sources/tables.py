"""Domain tables over the star-schema test data.

Amounts are decimals, so sums do not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def gifts(spark: SparkSession, folder: str) -> DataFrame:
    """One row per gift."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("gift_id"),
        F.col("o_custkey").alias("donor_id"),
        F.col("o_orderdate").cast("date").alias("gift_date"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("gift_amount"),
        F.col("o_orderpriority").alias("channel"),
        F.col("o_orderstatus").alias("gift_type"),
    )


def people(spark: SparkSession, folder: str) -> DataFrame:
    """Donor attributes with state and region."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(F.col("c_custkey").alias("donor_id"), F.col("c_name").alias("name"),
                F.col("c_mktsegment").alias("program"), F.col("n_name").alias("state"),
                F.col("r_name").alias("region"), F.col("c_acctbal").cast("decimal(12,2)").alias("balance"))
    )


def parts(spark: SparkSession, folder: str) -> DataFrame:
    """Source-code dimension, one row per part; several parts may share a code."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("part_id"),
        F.concat(F.regexp_replace("p_brand", "Brand#", "B"), F.substring("p_type", 1, 3),
                 F.lpad(F.col("p_size").cast("string"), 2, "0")).alias("source_code"),
        F.regexp_replace("p_brand", "Brand#", "B").alias("campaign_code"),
        F.col("p_name").alias("campaign_name"),
        F.col("p_type").alias("package_name"),
        F.col("p_size").cast("long").alias("quantity"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("package_cpp"),
    )


def mailings(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces mailed: who, when, which code, how many, what came back."""
    line = table(spark, folder, "lineitem")
    order = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return (
        line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts(spark, folder).drop("quantity"), F.col("l_partkey") == F.col("part_id"))
        .select(F.col("l_orderkey").alias("gift_id"), F.col("l_linenumber").cast("long").alias("line"),
                F.col("o_custkey").alias("donor_id"), F.col("l_partkey").alias("part_id"),
                F.col("l_suppkey").alias("list_id"), "source_code", "campaign_code", "campaign_name",
                "package_name", F.col("l_shipdate").cast("date").alias("mail_date"),
                F.col("l_quantity").cast("long").alias("quantity"),
                F.col("l_extendedprice").cast("decimal(12,2)").alias("revenue"))
    )


def recurring(spark: SparkSession, folder: str) -> DataFrame:
    """Event stream read as gifts."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("gift_id"), F.col("user_id").alias("donor_id"), F.col("ts").alias("gift_time"),
        F.col("ts").cast("date").alias("gift_date"), F.col("value").cast("decimal(12,2)").alias("gift_amount"),
        F.col("event_type").alias("gift_type"))


def raw_gifts(spark: SparkSession, folder: str) -> DataFrame:
    """Gifts as untidy text, the way files bring them: currency signs, ``nan``, blanks, ``.0`` ids."""
    key = F.col("o_orderkey")
    amount = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    return table(spark, folder, "orders").select(
        F.concat(key.cast("string"), F.lit(".0")).alias("Gift ID"),
        F.when(key % 11 == 0, F.lit("nan")).otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).alias("Donor ID"),
        F.when(key % 3 == 0, F.date_format("o_orderdate", "M/d/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("Gift Date"),
        F.when(key % 13 == 0, F.lit(" - ")).when(key % 17 == 0, F.lit(""))
        .when(key % 2 == 0, F.concat(F.lit("$"), amount)).otherwise(amount).alias("Gift Amount"),
        F.when(key % 7 == 0, F.lit("None")).otherwise(F.col("o_orderpriority")).alias("Appeal Category"),
        F.col("o_orderstatus").alias("Gift Type"),
    )
