"""Data-quality checks. Each returns rows (dataset, check, detail, fail, level)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RESULT_KEY = ("client", "dataset", "check")


def checks_from_row(row: DataFrame, client: str, dataset: str, checks: Sequence[tuple[str, Column, Column, str]]) -> DataFrame:
    """Turn one aggregate row into result rows; a check is (name, detail text, fails, level)."""
    results = [
        F.struct(F.lit(client).alias("client"), F.lit(dataset).alias("dataset"), F.lit(name).alias("check"),
                 detail.cast("string").alias("detail"), fail.cast("int").cast("long").alias("fail"),
                 F.lit(level).alias("level"))
        for name, detail, fail, level in checks
    ]
    return row.select(F.explode(F.array(*results)).alias("x")).select("x.*")


def measured(df: DataFrame, measures: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` whose next run, a write as a rule, computes the measures in its own pass.

    Take the last step before the write: an executor lost after an earlier stage
    could have its rows counted twice.
    """
    seen = Observation()
    return df.observe(seen, *[c.alias(name) for name, c in measures.items()]), seen


def one_row(spark: SparkSession, values: Mapping[str, object]) -> DataFrame:
    """Measures as a row, to be turned into results."""
    return spark.range(1).select(*[F.lit(v).alias(name) for name, v in values.items()])


def transaction_measures(date: str = "gift_date", amount: str = "gift_amount") -> dict[str, Column]:
    """What ``transaction_checks`` and the amounts' reconciliation need of the transactions."""
    positive = F.coalesce(F.col(amount), F.lit(0)) > 0
    day = F.when(positive, F.col(date))
    return {
        "n": F.count("gift_date"), "no_donor": F.count_if(F.col("donor_id").isNull()), "no_gift": F.count_if(F.col("gift_id").isNull()),
        "low": F.min(day), "high": F.max(day), "staged": F.sum(F.when(positive, F.col(amount)))}


def amount_measures(found: Mapping[str, object], date: str = "gift_date", amount: str = "gift_amount") -> dict[str, Column]:
    """The gift table's total in the date range of the transactions."""
    if found["low"] is None:
        return {"gift": F.sum(F.lit(None).cast("decimal(38,2)"))}
    return {"gift": F.sum(F.when(F.col(date).between(F.lit(found["low"]), F.lit(found["high"])), F.col(amount)))}


def transaction_checks(trx: DataFrame, client: str, minimum: int = 100) -> DataFrame:
    """Volume and missing ids, in one pass."""
    measures = transaction_measures()
    return transaction_results(trx.agg(*[measures[c].alias(c) for c in ("n", "no_donor", "no_gift")]), client, minimum)


def transaction_results(row: DataFrame, client: str, minimum: int = 100) -> DataFrame:
    return checks_from_row(row, client, "transactions", [
        ("volume", F.concat(F.lit("Record count: "), F.col("n")), F.col("n") <= minimum, "error"),
        ("donor ids present", F.concat(F.col("no_donor"), F.lit(" records missing donor_id")), F.col("no_donor") > 0, "warning"),
        ("gift ids present", F.concat(F.col("no_gift"), F.lit(" records missing gift_id")), F.col("no_gift") > 0, "warning"),
    ])


def reconcile_amounts(staged: DataFrame, gifts: DataFrame, date: str, amount: str, client: str) -> DataFrame:
    """Staged total against the gift table in the staged date range; both sums come from one grouping."""
    positive = staged.filter(F.coalesce(F.col(amount), F.lit(0)) > 0)
    low, high = positive.agg(F.min(date)).scalar(), positive.agg(F.max(date)).scalar()
    inside = gifts.filter((F.col(date) >= low) & (F.col(date) <= high))
    both = positive.select(F.col(amount).alias("s"), F.lit(None).alias("g")).unionByName(
        inside.select(F.lit(None).alias("s"), F.col(amount).alias("g")))
    return amount_results(both.agg(F.sum("s").alias("staged"), F.sum("g").alias("gift")), client)


def amount_results(row: DataFrame, client: str) -> DataFrame:
    row = row.select(F.round("staged", 0).cast("long").alias("s"), F.round("gift", 0).cast("long").alias("g"))
    return checks_from_row(row, client, "gift", [
        ("amount compared to staged", F.concat_ws(", ", F.concat(F.lit("staged: "), F.col("s")),
                                                  F.concat(F.lit("gift: "), F.col("g"))),
         F.col("s") > F.col("g"), "warning"),
    ])


def donor_key_checks(donors: DataFrame, gifts: DataFrame, client: str) -> DataFrame:
    """Null and repeated donor keys, and the same set size as on the gifts."""
    per_key = donors.groupBy("donor_key").agg(F.count(F.lit(1)).alias("d"), F.lit(0).alias("g")).unionByName(
        gifts.groupBy("donor_key").agg(F.lit(0).cast("long").alias("d"), F.lit(1).alias("g")))
    row = per_key.agg(
        F.coalesce(F.sum(F.when(F.col("donor_key").isNull(), F.col("d"))), F.lit(0)).alias("nulls"),
        F.count_if(F.col("d") > 1).alias("repeated"),
        F.count_if((F.col("d") > 0) & F.col("donor_key").isNotNull()).alias("donors"),
        F.count_if((F.col("g") > 0) & F.col("donor_key").isNotNull()).alias("givers"))
    return checks_from_row(row, client, "donor", [
        ("null keys", F.col("nulls"), F.col("nulls") > 0, "error"),
        ("repeated keys", F.col("repeated"), F.col("repeated") > 0, "error"),
        ("keys match gifts", F.concat_ws(" vs ", "donors", "givers"), F.col("donors") != F.col("givers"), "error"),
    ])


def source_code_checks(codes: DataFrame, gifts: DataFrame, client: str) -> DataFrame:
    """Codes loaded, placeholders inserted, codes used on gifts."""
    kinds = codes.groupBy("source_code", "source").agg(F.count(F.lit(1)).alias("n"))
    filled = F.coalesce(F.col("source_code") != "", F.lit(False))
    row = kinds.agg(
        F.count_distinct(F.when(filled & (F.col("source") != "inferred from trx"), F.col("source_code"))).alias("loaded"),
        F.count_distinct(F.when(F.col("source") == "unsourced fallbacks", F.col("source_code"))).alias("placeholders"))
    used = gifts.filter(F.coalesce(F.col("source_code") != "", F.lit(False))).select("source_code").distinct()
    row = row.withColumn("used", used.agg(F.count(F.lit(1))).scalar())
    return checks_from_row(row, client, "source_code", [
        ("codes populated", F.col("loaded"), F.col("loaded") == 0, "error"),
        ("placeholders populated", F.col("placeholders"), F.col("placeholders") == 0, "error"),
        ("codes on gifts", F.col("used"), F.col("used") == 0, "warning"),
    ])


def private_columns_left(df: DataFrame, private: Sequence[str]) -> list[str]:
    """Plan-time check: private columns that are still in the frame."""
    return [c for c in df.columns if c in set(private)]


def private_columns_check(df: DataFrame, private: Sequence[str], client: str, dataset: str) -> DataFrame:
    """The same as a result row; ``detail`` lists the columns found."""
    left = private_columns_left(df, private)
    one = df.sparkSession.range(1)
    return checks_from_row(one, client, dataset, [
        ("no private columns", F.lit(", ".join(left) or "none"), F.lit(bool(left)), "error")])


def date_range_check(df: DataFrame, date: str, now: Column, client: str) -> DataFrame:
    """The newest date is in or after last month, the oldest not after the start of this year."""
    row = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    last_month = F.add_months(F.trunc(now, "month"), -1)
    good = (F.col("hi") >= last_month) & (F.col("lo") <= F.trunc(now, "year"))
    return checks_from_row(row, client, "dates", [
        ("plausible range", F.concat_ws(" to ", F.col("lo").cast("date").cast("string"), F.col("hi").cast("date").cast("string")), ~good, "error")])


def needs_rerun(new: DataFrame, curated: DataFrame, date: str) -> DataFrame:
    """One row: is there newer data than the curated table holds?"""
    newest = new.agg(F.max(date).alias("newest"))
    return newest.withColumn("curated", curated.agg(F.max(date)).scalar()).withColumn(
        "rerun", F.coalesce(F.col("curated") < F.col("newest"), F.lit(True)))


def month_passed(reported: Column, now: Column) -> Column:
    """A new complete month exists since the reported one."""
    return F.add_months(F.last_day(reported), 1) < now


def upsert_results(old: DataFrame, new: DataFrame) -> DataFrame:
    """Newer results replace those of the same client, dataset and check."""
    return old.join(new.select(*RESULT_KEY), list(RESULT_KEY), "left_anti").unionByName(new)


def failures(results: DataFrame, datasets: Sequence[str] | None = None) -> DataFrame:
    """One row: failed warnings and errors."""
    rows = results if datasets is None else results.filter(F.col("dataset").isin(*datasets))
    failed = F.col("fail") == 1
    return rows.agg(F.count_if(failed & (F.col("level") == "warning")).alias("warnings"),
                    F.count_if(failed & (F.col("level") == "error")).alias("errors"))


def column_contract(spark: SparkSession, tables: Mapping[str, Sequence[str]], client: str) -> DataFrame:
    rows = [(client, table, column) for table, columns in tables.items() for column in columns]
    return spark.createDataFrame(rows, "client string, table string, column_name string")


def status_rows(spark: SparkSession, client: str, process: str, step: str) -> DataFrame:
    return spark.range(1).select(F.lit(client).alias("client"), F.lit(process).alias("process"),
                                 F.lit(step).alias("step"), F.current_timestamp().alias("ts"))
