"""Exact top-k inner products by length buckets with local cosine thresholds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from donorloom.llm.blocks import meet
from donorloom.llm.common import matrix, numbers, usable_vector
from donorloom.session import durable

BUCKETS = 24  # length buckets
SEEDS = 2048  # longest vectors that give the first threshold
INNER = 1024  # rows of a bucket handled at once in a task
COORDINATES = 3  # focus coordinates of a query
COORD_FROM = 0.6  # local cosine threshold from which coordinates prune better than lengths
ITEM_ROWS, VISITOR_ROWS = 16384, 2048
EXACT = 2.0 ** 53


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of rows, as int64; exact, and held to the range of a long where they leave it."""
    if a.shape[1] == 0:
        return np.zeros((len(a), len(b)), np.int64)
    size = lambda m: np.abs(m.astype(np.float64)).max(initial=0.0)
    if size(a) * size(b) * a.shape[1] < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    whole = a.astype(object) @ b.astype(object).T
    return np.clip(whole, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _feasible(q: np.ndarray, p: np.ndarray, t: float) -> np.ndarray:
    """Which unit rows of ``p`` may have cosine ``t`` with unit ``q``, by its largest coordinates."""
    keep = np.ones(len(p), bool)
    for f in np.argsort(-np.abs(q), kind="stable")[:COORDINATES]:
        reach = np.sqrt(max(0.0, (1 - t * t) * (1 - q[f] * q[f]))) + 1e-9
        keep &= np.abs(p[:, f] - q[f] * t) <= reach if t * t >= 1 else _between(p[:, f], q[f], t, reach)
    return keep


def _between(x: np.ndarray, q: float, t: float, reach: float) -> np.ndarray:
    low = -1.0 if q < -t else q * t - reach
    high = 1.0 if q > t else q * t + reach
    return (x >= low - 1e-9) & (x <= high + 1e-9)


def _search(k: int):
    def work(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        length = numbers(a["length"])
        order = np.argsort(-length, kind="stable")
        length, ids = length[order], numbers(a["id"])[order]
        items = matrix(a["v"], np.int64)[order]
        q, qid, salt, qlen = matrix(b["v"], np.int64), numbers(b["id"]), numbers(b["salt"]), numbers(b["length"])
        least = numbers(b["least"]).astype(np.float64)  # NaN: no threshold yet
        best = [np.zeros(0, np.int64)] * 3  # query, item, score

        def shrink(best):
            nonlocal least
            i, j, s = best
            o = np.lexsort((ids[j], -s, i))
            i, j, s = i[o], j[o], s[o]
            first = np.searchsorted(i, i, side="left")
            place = np.arange(len(i)) - first
            last = place == k - 1
            least = least.copy()
            least[i[last]] = np.fmax(least[i[last]], s[last].astype(np.float64))
            keep = place < k
            return [i[keep], j[keep], s[keep]]

        for at in range(0, len(ids), INNER):
            top = length[at]
            with np.errstate(divide="ignore", invalid="ignore"):
                local = np.where(qlen * top > 0, least / (qlen * top), np.where(least > 0, 2.0, -1.0))
                local = np.where(np.isnan(least), -1.0, local)
            live = np.flatnonzero(local <= 1 + 1e-9)
            if not len(live):
                continue
            by_coordinate = live[local[live] >= COORD_FROM]
            by_length = live[local[live] < COORD_FROM]
            part, part_length = items[at:at + INNER], length[at:at + INNER]
            new = []
            if len(by_length):
                with np.errstate(divide="ignore", invalid="ignore"):
                    floor = np.where(least[by_length] > 0, least[by_length] / qlen[by_length] * (1 - 1e-9), -1.0)
                ends = np.searchsorted(-part_length, -floor, side="right")
                end = int(ends.max())
                s = products(q[by_length], part[:end])
                own = qid[by_length][:, None] == ids[at:at + end][None]
                low = np.where(np.isnan(least[by_length]), -np.inf, least[by_length])
                if end > k:
                    ranked = np.where(own, np.iinfo(np.int64).min, s)
                    low = np.maximum(low, np.partition(ranked, end - k, axis=1)[:, end - k].astype(np.float64))
                i, j = np.nonzero((s >= low[:, None]) & ~own)
                new.append((by_length[i], j + at, s[i, j]))
            if len(by_coordinate):
                with np.errstate(divide="ignore", invalid="ignore"):
                    unit = np.nan_to_num(part / part_length[:, None])
                for i in by_coordinate:
                    j = np.flatnonzero(_feasible(q[i] / qlen[i], unit, min(1.0, float(local[i])) - 1e-9) & (ids[at:at + INNER] != qid[i]))
                    s = products(q[i:i + 1], part[j])[0]
                    ok = s >= least[i]
                    new.append((np.full(ok.sum(), i), j[ok] + at, s[ok]))
            if new:
                best = shrink([np.concatenate([best[c], *(n[c] for n in new)]) for c in range(3)])
        i, j, s = best
        return pa.table({"row": pa.array(salt[i], pa.int64()), "query_id": pa.array(qid[i], pa.int64()),
                         "vec_id": pa.array(ids[j], pa.int64()), "score": pa.array(s, pa.int64())})

    return work


def _first_threshold(seeds: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """Adds to each query the k-th best product with the longest vectors, null where there are fewer."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                dims, qid = numbers(batch.column(1)), numbers(batch.column(2))
                least = np.full(batch.num_rows, np.nan)
                for dim in np.unique(dims):
                    rows = np.flatnonzero(dims == dim)
                    sid, sv = seeds.get(int(dim), (np.zeros(0, np.int64), np.zeros((0, int(dim)))))
                    if len(sid) <= k:
                        continue
                    s = products(matrix(batch.column(3).take(pa.array(rows)), np.int64), sv).astype(np.float64)
                    s[qid[rows][:, None] == sid[None]] = -np.inf
                    kth = np.partition(s, len(sid) - k, axis=1)[:, len(sid) - k]
                    least[rows] = np.where(np.isfinite(kth), kth, np.nan)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least)], [*batch.schema.names, "least"])

    return make


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0, buckets: int = BUCKETS) -> DataFrame:
    """The ``k`` largest inner products of each query row with all other rows: query_id, rank, vec_id, score.

    ``vectors(vec_id, embedding)``; a component x counts as floor(scale * x).
    ``is_query`` is a condition on vec_id. Ties go to the smaller vec_id, and a
    row with the query's own vec_id is no candidate. Rows whose id or vector is
    null, or that hold null or non-finite components, take no part; vectors meet
    those of their own length only. Repeated rows are candidates, and queries,
    of their own: a repeated query row repeats its list. Scores beyond the range of a long are held to
    it. An empty table gives an empty result; other columns are not looked at.

    Vectors are grouped by Euclidean length. The longest ones give each query
    its first threshold; a bucket that cannot reach it is not visited. In a
    bucket, the threshold over both lengths is a local cosine: a high one prunes
    by the query's largest coordinates, a low one by length. What is left is
    verified by integer products.
    """
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), "embedding").filter("id is not null")
    rows = rows.filter(usable_vector(F.col("embedding"))).select("id", scaled.alias("v"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = durable(rows.select("id", "v", F.size("v").alias("dim"), length.alias("length"),
                               F.monotonically_increasing_id().alias("salt")))

    # The longest rows, SEEDS at most: keys first, so that only those vectors travel.
    last = rows.select("length", "salt").orderBy(F.desc("length"), "salt").limit(SEEDS).agg(
        F.min("length").alias("l"), F.max_by("salt", F.struct(-F.col("length"), "salt")).alias("s")).first()
    seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    edges: list[float] = []
    if last["l"] is not None:
        longest = rows.filter((F.col("length") > last["l"]) | ((F.col("length") == last["l"]) & (F.col("salt") <= last["s"])))
        table = longest.select("id", "dim", "v").toArrow()
        for dim in set(table["dim"].to_pylist()):
            some = table.filter(pc.equal(table["dim"], dim))
            seeds[dim] = numbers(some["id"]), matrix(some["v"], np.int64)
        points = [i / buckets for i in range(1, buckets)]
        edges = rows.agg(F.percentile_approx("length", points, 100 * buckets)).first()[0]
    bucket = F.size(F.filter(F.array(*[F.lit(e) for e in sorted(set(edges))]).cast("array<double>"), lambda e: e <= F.col("length")))
    items = rows.withColumn("bucket", bucket)

    asked = rows.filter(is_query(F.col("id"))).select("length", "dim", "id", "v", "salt")
    asked = durable(asked.mapInArrow(_first_threshold(seeds, k), "length double, dim int, id long, v array<long>, salt long, least double"))
    # One row per bucket and vector size: a bounded table.
    tops = items.groupBy("dim", "bucket").agg(F.max("length").alias("top"))
    visits = asked.join(F.broadcast(tops), "dim").filter(
        F.isnan("least") | (F.col("least") <= F.col("length") * F.col("top") * (1 + 1e-9))).drop("top")
    n = asked.count()
    found = meet(items, visits, ["dim", "bucket"], ITEM_ROWS, max(32, min(VISITOR_ROWS, -(-n // 8))), _search(k),
                 "row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
