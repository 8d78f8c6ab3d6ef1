"""Profiles from stored sketches."""

import math

import pytest
from pyspark.sql import functions as F

from donorloom.plans import profiles

COLUMNS = ["id", "x", "none", "nan", "t", "odd name"]


@pytest.fixture(scope="module")
def table(spark):
    n = F.col("id")
    return spark.range(40000).select(
        F.when(n % 3 == 0, 0).when(n < 20, None).otherwise(n % 7).alias("part"), "id", (n / 7 - 1000).alias("x"), F.lit(None).cast("double").alias("none"),
        F.when(n % 2 == 0, F.lit(math.nan)).otherwise(n.cast("double")).alias("nan"), F.when(n % 10 != 0, (n % 100).cast("string")).alias("t"),
        F.lit("a").alias("odd name"))


def test_merged_profile(spark, table):
    """A third of all rows in one partition, null partitions and columns, not-a-number, names with a space."""
    sketches = profiles.sketch_rows(table, "part", COLUMNS)
    assert sketches.count() == 8 * len(COLUMNS)
    got = {r.column: r for r in profiles.profile(sketches, [0.0, 0.25, 0.5, 0.99, 1.0]).collect()}
    assert set(got) == set(COLUMNS) and {r.total for r in got.values()} == {40000}
    assert got["id"].distinct == pytest.approx(40000, rel=profiles.DISTINCT_BOUND)
    for q, p in zip(got["id"].quantiles, [0.0, 0.25, 0.5, 0.99, 1.0]):
        assert q / 40000 == pytest.approx(p, abs=2 * profiles.RANK_BOUND)
    assert (got["x"].low, got["x"].high) == (-1000.0, pytest.approx(39999 / 7 - 1000))
    assert (got["none"].filled, got["none"]["null"], got["none"].distinct, got["none"].quantiles) == (0, 40000, 0, None)
    assert got["nan"].filled == 40000 and got["nan"].low == 1.0 and got["nan"].high == 39999.0
    assert got["t"].filled == 36000 and got["t"].distinct == pytest.approx(90, abs=2) and got["t"].quantiles is None
    assert got["odd name"].distinct == 1


def test_merging_parts_reads_no_table_rows(spark, table):
    """Any choice of partitions gives the profile of their rows."""
    sketches = profiles.sketch_rows(table, "part", ["id", "t"])
    some = {r.column: r for r in profiles.profile(sketches.filter("part > 3"), [0.5]).collect()}
    rows = table.filter("part > 3")
    assert some["id"].total == rows.count() and some["t"].filled == rows.filter("t IS NOT NULL").count()
    exact = rows.filter(F.col("id") <= some["id"].quantiles[0]).count() / rows.count()
    assert exact == pytest.approx(0.5, abs=2 * profiles.RANK_BOUND)


def test_change_between_versions(spark, table):
    before = profiles.sketch_rows(table, "part", ["id", "x", "none", "t"])
    same = {r.column: r for r in profiles.change(before, before).collect()}
    assert same["x"]["shift"] == 0 and same["none"]["shift"] is None and same["t"]["shift"] is None
    moved = table.withColumns({"x": F.col("x") + 4000 / 7, "id": F.col("id") + 10 ** 6, "new": F.lit(1)}).drop("none")
    got = {r.column: r for r in profiles.change(before, profiles.sketch_rows(moved, "part", ["id", "x", "t", "new"])).collect()}
    assert got["x"]["shift"] == pytest.approx(0.1, abs=0.03)  # moved by a tenth of the range
    assert got["id"]["shift"] == pytest.approx(1.0, abs=0.02)
    assert got["new"].total_before is None and got["new"].total_now == 40000
    assert got["none"].total_now is None and got["none"]["shift"] is None


def test_empty_table(spark, table):
    empty = profiles.sketch_rows(table.limit(0), "part", COLUMNS)
    assert empty.count() == 0 and profiles.profile(empty, [0.5]).count() == 0 and profiles.change(empty, empty).count() == 0
