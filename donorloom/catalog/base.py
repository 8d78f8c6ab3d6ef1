"""Registry of runnable queries with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorloom.functions.dates import fiscal_year
from donorloom.session import new_folder
from donorloom.sources import tables

START = 7  # first month of the fiscal year in the examples

# ---- shared SQL views --------------------------------------------------------------
VIEWS = {
    "gift": """gift AS (SELECT o_orderkey AS gift_id, o_custkey AS donor_id, CAST(o_orderdate AS DATE) AS gift_date,
        CAST(o_totalprice AS DECIMAL(12,2)) AS gift_amount, o_orderpriority AS channel, o_orderstatus AS gift_type,
        year(o_orderdate) + CASE WHEN month(o_orderdate) >= 7 THEN 1 ELSE 0 END AS gift_fy FROM orders)""",
    "person": """person AS (SELECT c_custkey AS donor_id, c_name AS name, c_mktsegment AS program, n_name AS state,
        r_name AS region, CAST(c_acctbal AS DECIMAL(12,2)) AS balance FROM customer
        LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)""",
    "code": """code AS (SELECT p_partkey AS part_id,
        replace(p_brand, 'Brand#', 'B') || substr(p_type, 1, 3) || lpad(CAST(p_size AS VARCHAR), 2, '0') AS source_code,
        replace(p_brand, 'Brand#', 'B') AS campaign_code, p_name AS campaign_name, p_type AS package_name,
        CAST(p_size AS BIGINT) AS quantity, CAST(p_retailprice AS DECIMAL(12,2)) AS package_cpp FROM part)""",
    "mail": """mail AS (SELECT l_orderkey AS gift_id, CAST(l_linenumber AS BIGINT) AS line, o_custkey AS donor_id,
        l_partkey AS part_id, l_suppkey AS list_id, code.source_code, code.campaign_code, code.campaign_name,
        code.package_name, CAST(l_shipdate AS DATE) AS mail_date, CAST(l_quantity AS BIGINT) AS quantity,
        CAST(l_extendedprice AS DECIMAL(12,2)) AS revenue
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN code ON l_partkey = code.part_id)""",
    "event": """event AS (SELECT event_id AS gift_id, user_id AS donor_id, ts AS gift_time, CAST(ts AS DATE) AS gift_date,
        CAST(value AS DECIMAL(12,2)) AS gift_amount, event_type AS gift_type FROM events)""",
    "raw": """raw AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) || '.0' AS gift_id,
        CASE WHEN o_orderkey % 11 = 0 THEN 'nan' ELSE CAST(o_custkey AS VARCHAR) || '.0' END AS donor_id,
        CAST(o_orderdate AS DATE) AS gift_date,
        CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 THEN 0 ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END AS gift_amount,
        CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS appeal_category, o_orderstatus AS gift_type FROM orders)""",
}
NEEDS = {"mail": ["code"]}


def with_views(*names: str, more: str = "") -> str:
    """``WITH`` clause for the named views and further definitions."""
    wanted: list[str] = []
    for name in names:
        for view in [*NEEDS.get(name, []), name]:
            if view not in wanted:
                wanted.append(view)
    parts = [VIEWS[v] for v in wanted] + ([more] if more else [])
    return "WITH " + ",\n".join(parts) + "\n"


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(f(spark, folder))
        CATALOG[name] = Query(name, run, sql)
        return f
    return register


def plain(df: DataFrame) -> DataFrame:
    """Comparable column types: whole numbers as big integers, decimals as doubles, dates as text."""
    def one(field: T.StructField):
        c = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            return c.cast("long").alias(field.name)
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            return c.cast("double").alias(field.name)
        if isinstance(kind, T.DateType):
            return c.cast("string").alias(field.name)
        if isinstance(kind, T.TimestampType):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        return c
    return df.select(*[one(f) for f in df.schema])


def newest_year(spark: SparkSession, folder: str):
    """Fiscal year of the newest gift, as a scalar subquery."""
    return tables.gifts(spark, folder).agg(F.max(fiscal_year(F.col("gift_date"), START))).scalar()


def scratch(spark: SparkSession) -> str:
    """A new folder for written tables, in the folder that all machines share."""
    return new_folder(spark)
