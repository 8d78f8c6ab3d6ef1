"""Connected components from links, on Spark, without bringing the links together."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorloom.llm.common import hot_share
from donorloom.session import durable

ROUNDS = 200  # far beyond the logarithmic number that is needed; an endless loop would be an error


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among the ids of one task, reduced to (id, smallest id reachable by them); such ids are left out themselves."""
    if len(a) == 0:
        return a, b
    ids, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a):]
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        while (jump := new[new]).tolist() != new.tolist():
            new = jump
        if np.array_equal(new, root):
            break
        root = new
    child = np.flatnonzero(root != np.arange(len(ids)))
    return ids[child], ids[root[child]]


def _with_least(pairs: DataFrame, least: DataFrame) -> DataFrame:
    """``pairs(u, v)`` with ``m`` of ``least(u, m, n)``. A hot u finds it in a broadcast table of 1,023 rows at most."""
    hot = F.broadcast(hot_share(least, "n").select("u", F.col("m").alias("_m")))
    marked = pairs.join(hot, "u", "left")
    there = marked.filter(F.col("_m").isNotNull()).select("u", "v", F.col("_m").alias("m"))
    return there.unionByName(marked.filter(F.col("_m").isNull()).select("u", "v").join(least.select("u", "m"), "u"))


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links(a, b)``: the smallest id reachable, which is left out itself.

    Alternates two steps until nothing changes: every node's larger neighbours
    are linked to its least neighbour (large star), then the smaller ones
    (small star). Each step is a grouping with map-side combine and a join, and
    its result is checkpointed, so a lost executor costs one step at most.
    """
    edge = lambda x, y: [F.greatest(x, y).alias("u"), F.least(x, y).alias("v")]
    edges = durable(links.filter(F.col("a") != F.col("b")).select(*edge("a", "b")).distinct())
    state = None
    for _ in range(ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("v").alias("n"))
        large = _with_least(both, least).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = durable(large.distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("v").alias("n"))
        small = _with_least(large, least).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = durable(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        state = now
    raise RuntimeError("components did not settle")
