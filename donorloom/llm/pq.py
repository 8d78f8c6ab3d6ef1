"""Near-duplicate embeddings by product quantisation over coarse inverted lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorloom.llm.blocks import meet
from donorloom.llm.common import lookup, matrix, numbers, usable_vector
from donorloom.llm.graph import components, forest
from donorloom.session import durable

COSINE = 0.95
SAMPLE = 16384  # vectors that the index is fitted on, at most about; every vector is indexed
LISTS_TO = 1024
SUBSPACES, CODES = 16, 64
ROUNDS = 8
BLOCKS = 512  # blocks wanted in all
ITEM_ROWS, VISITOR_ROWS = 2048, 8192


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one, without overflow for very large or very small components."""
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(top > 0, top, 1)
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(length > 0, length, 1)


def _reach(cosine: float) -> float:
    """Euclidean distance of unit vectors at which their cosine is ``cosine``, and a little for rounding."""
    return float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-6


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1)[None] - 2 * x @ centres.T).argmin(1)


def cluster(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Plain k-means with a seeded start; a centre that loses all its points stays."""
    centres = x[np.random.default_rng(seed).choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        near = _nearest(x, centres)
        count = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


class Index:
    """Coarse centres and codebooks of the residuals' subspaces."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.centres = cluster(sample, lists, 1)
        rest = sample - self.centres[_nearest(sample, self.centres)]
        self.parts = [p for p in np.array_split(np.arange(sample.shape[1]), SUBSPACES) if len(p)]
        self.books = [cluster(rest[:, p], CODES, 2 + i) for i, p in enumerate(self.parts)]

    def code(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and length of what the codes miss, for every row."""
        home = _nearest(x, self.centres)
        rest = x - self.centres[home]
        codes = np.stack([_nearest(rest[:, p], b) for p, b in zip(self.parts, self.books)], 1).astype(np.uint8)
        kept = np.zeros_like(rest)
        for m, (p, b) in enumerate(zip(self.parts, self.books)):
            kept[:, p] = b[codes[:, m]]
        return home, codes, np.sqrt(((rest - kept) ** 2).sum(1))

    def visits(self, x: np.ndarray, home: np.ndarray, margin: float) -> list[np.ndarray]:
        """Lists whose border is within ``margin`` of a row. Of two lists, one visits the other; all visit their own. A
        pair that is within ``margin`` has the border between its lists on its way, so the one that visits finds it."""
        c = self.centres
        d2 = (x * x).sum(1)[:, None] + (c * c).sum(1)[None] - 2 * x @ c.T
        between = np.sqrt(np.maximum(0, (c * c).sum(1)[:, None] + (c * c).sum(1)[None] - 2 * c @ c.T))
        # Not divided by the distance of the centres, which rounding may make 0.
        near = d2 - d2[np.arange(len(x)), home][:, None] <= 2 * margin * between[home] + 1e-7
        to = np.arange(len(c))[None]
        oriented = (home[:, None] < to) != ((home[:, None] + to) % 2 == 1)
        return [np.flatnonzero(r) for r in (near & oriented) | (to == home[:, None])]

    def tables(self, q: np.ndarray, of: int) -> np.ndarray:
        """Squared distances of the rows' subspaces to the codes, relative to list ``of``: (subspace, code, row)."""
        rest = q - self.centres[of]
        return np.stack([((rest[:, None, p] - b[None]) ** 2).sum(2).T if len(b) == CODES else np.pad(
            ((rest[:, None, p] - b[None]) ** 2).sum(2).T, ((0, CODES - len(b)), (0, 0)))
            for p, b in zip(self.parts, self.books)]).astype(np.float32)


def _assign(indexes: dict[int, Index], margin: float):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                dims = numbers(batch.column(2))
                for dim in np.unique(dims):
                    some = batch.take(pa.array(np.flatnonzero(dims == dim)))
                    index, x = indexes[int(dim)], unit(matrix(some.column(3)))
                    home, codes, missed = index.code(x)
                    visits = index.visits(x, home, margin)
                    ends = np.cumsum([0, *map(len, visits)])
                    yield pa.RecordBatch.from_arrays([
                        *some.columns, pa.array(home, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(missed.astype(np.float64)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(visits), pa.int32()))],
                        [*some.schema.names, "home", "codes", "missed", "lists"])

    return make


def _compare(indexes: dict[int, Index], cosine: float):
    reach = _reach(cosine)

    def work(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        dim, of = key[0].as_py(), key[1].as_py()
        index = indexes[dim]
        ids, copies, missed = numbers(a["rep"]), numbers(a["copies"]), numbers(a["missed"])
        x = unit(matrix(a["v"]))
        codes = np.frombuffer(b"".join(a["codes"].to_pylist()), np.uint8).reshape(len(ids), -1)
        q, qid, qcopies, home = unit(matrix(b["v"])), numbers(b["rep"]), numbers(b["copies"]), numbers(b["home"])
        most = ((missed + reach) ** 2 + 1e-4).astype(np.float32)
        half = codes.shape[1] // 2
        counts: dict[int, int] = {}
        found = []
        tally = (np.zeros(len(qid), np.int64), np.zeros(len(ids), np.int64))
        for at in range(0, len(qid), 256):
            table = index.tables(q[at:at + 256], of)
            # Items by rows here: one take per subspace fetches a whole line of the table.
            near = np.zeros((len(ids), table.shape[2]), np.float32)
            for m in range(half):
                near += table[m][codes[:, m]]
            j, i = np.nonzero(near <= most[:, None])
            far = near[j, i]
            for m in range(half, codes.shape[1]):
                far = far + table[m][codes[j, m], i]
            ok = far <= most[j]
            i, j = i[ok] + at, j[ok]
            ok = (home[i] != of) | (qid[i] > ids[j])
            i, j = i[ok], j[ok]
            for part in range(0, len(i), 1 << 16):
                pi, pj = i[part:part + (1 << 16)], j[part:part + (1 << 16)]
                ok = np.einsum("ij,ij->i", q[pi], x[pj]) >= cosine
                pi, pj = pi[ok], pj[ok]
                np.add.at(tally[0], pi, copies[pj])
                np.add.at(tally[1], pj, qcopies[pi])
                found.append(forest(qid[pi], ids[pj]))
        u, v = forest(*[np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k in (0, 1)])
        seen = np.concatenate([qid[tally[0] > 0], ids[tally[1] > 0]])
        n = np.concatenate([tally[0][tally[0] > 0], tally[1][tally[1] > 0]])
        node = np.concatenate([seen, u])
        return pa.table({"rep": pa.array(node, pa.int64()), "n": pa.array(np.concatenate([n, np.zeros(len(u), np.int64)]), pa.int64()),
                         "to": pa.array(np.concatenate([seen, v]), pa.int64())})

    return work


def embedding_groups(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per row of ``vectors(vec_id, embedding)``: vec_id, n_links, component_id, kept.

    Two vectors are linked if their cosine, in double precision, is ``cosine``
    or more. n_links counts the other vec_ids linked directly, exact copies
    included; component_id is the smallest vec_id reachable. Vectors that are
    null, empty, zero or hold null or non-finite components are linked with
    nothing, and so are vectors of other lengths. A row without an id takes no
    part: no links, component null, not kept. Repeated rows count once and are
    repeated in the result. An empty table gives an empty one.

    Copies are one class from the start. Coarse lists and codebooks are fitted
    on a bounded sample; every class is coded. It visits its own list and the
    lists whose border is as near as ``cosine`` allows, so no pair is lost; there, table look-ups give the
    distance to the coded items, those that can reach ``cosine`` given what
    their codes miss are kept, and exact cosines decide. A task reports counts and
    a spanning forest of its links, never all pairs.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    zero = F.forall("embedding", lambda x: x == 0)
    usable = usable_vector(F.col("embedding")) & ~F.coalesce(zero, F.lit(True)) & F.col("vec_id").isNotNull()
    rows = rows.select("vec_id", F.when(usable, F.col("embedding")).alias("v"))
    members = rows.filter("v is not null").groupBy("v", "vec_id").agg(F.count(F.lit(1)).alias("rows"))
    classes = durable(members.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                               F.sum("rows").alias("rows")).withColumn("dim", F.size("v")))
    # One small row per vector length.
    sizes = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    indexes: dict[int, Index] = {}
    for dim, n in sorted(sizes.items()):
        own = classes.filter(F.col("dim") == dim)
        part = max(1, n // SAMPLE)
        sample = own.filter(F.pmod(F.xxhash64("v", F.lit(7)), F.lit(part)) == 0) if part > 1 else own
        x = unit(matrix(sample.orderBy("rep").select("v").limit(2 * SAMPLE).toArrow()["v"]))
        indexes[dim] = Index(x, int(min(LISTS_TO, max(1, np.sqrt(n)), max(1, len(x) // 8))))
    kind = classes.schema["v"].dataType.simpleString()  # components travel in the type they came in
    held, margin = classes.sparkSession.sparkContext.broadcast(indexes), _reach(cosine)
    coded = durable(classes.select("rep", "copies", "dim", "v").mapInArrow(
        lambda it: _assign(held.value, margin)(it),
        f"rep long, copies long, dim int, v {kind}, home int, codes binary, missed double, lists array<int>"))
    items = coded.select("rep", "copies", "dim", F.col("home").alias("list"), "v", "codes", "missed", F.col("rep").alias("salt"))
    visitors = coded.select("rep", "copies", "dim", "v", "home", F.explode("lists").alias("list"), F.col("rep").alias("salt"))
    total = sum(sizes.values())
    size = lambda most: max(32, min(most, -(-total // BLOCKS)))
    met = durable(meet(items, visitors, ["dim", "list"], size(ITEM_ROWS), 8 * size(VISITOR_ROWS // 8),
                       lambda k, a, b: _compare(held.value, cosine)(k, a, b), "rep long, n long, to long"))
    root = components(met.select(F.col("rep").alias("a"), F.col("to").alias("b"))).withColumnRenamed("id", "rep")
    linked = met.groupBy("rep").agg(F.sum("n").alias("links"))
    table = classes.join(linked, "rep", "left").join(root, "rep", "left").select(
        "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("component", "rep").alias("component"), "rows")
    out = lookup(rows, table, ["v"], "rows")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
