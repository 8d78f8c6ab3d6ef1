"""SimHash near-duplicates by pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorloom.llm.blocks import meet
from donorloom.llm.common import hot_share, lookup, numbers
from donorloom.llm.graph import components, forest
from donorloom.session import durable

SHINGLE = 3
SEED = 42
NEAR = 3  # differing bits
PIVOTS = 16  # reference fingerprints
CELL = 8  # width of a grid cell, in distance to a pivot; at least 2 * NEAR + 1
GRID_FROM, GRID_TO = 3, 9  # pivots that make the grid
CELL_ROWS = 16384  # fingerprints wanted in an average grid cell
BLOCKS = 256  # blocks of either side wanted in all, so that small tables spread as well
ITEM_ROWS, VISITOR_ROWS = 4096, 16384


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints, fixed by a seed."""
    return [xxhash.xxh64_intdigest(b"pivot %d" % i, SEED) for i in range(n)]


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the words of ``text`` (A-Z lower-cased), repeats included. No word: 0.

    A bit is 1 if it is set in over half of the shingles' XXH64 values.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    whole = [b" ".join(words)] if len(words) < shingle else map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    h = np.array([xxhash.xxh64_intdigest(s, seed) for s in whole], np.uint64)
    total = np.zeros(64, np.int64)
    for at in range(0, len(h), 65536):
        part = h[at:at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` as (doc_id, fp long)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(make, "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _distance(fp: str, pivot: int):
    return F.bit_count(F.col(fp).bitwiseXOR(F.lit(_signed(pivot))))


def _verify(near: int, grid: int, refs: list[int]):
    """Pairs of one block: the table of distances to the other pivots discards, and the bits verify."""

    def work(key: tuple, a: pa.Table, b: pa.Table) -> pa.Table:
        x, xid = numbers(a["fp"]).view(np.uint64), numbers(a["rep"])
        y, yid, home = numbers(b["fp"]).view(np.uint64), numbers(b["rep"]), numbers(b["home"])
        table = lambda f: np.stack([np.bitwise_count(f ^ np.uint64(r)).astype(np.int8) for r in refs[grid:]])
        order = np.argsort(np.bitwise_count(x ^ np.uint64(refs[grid])), kind="stable")
        x, xid = x[order], xid[order]
        tx, ty = table(x), table(y)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for d in np.unique(ty[0]):
            lo, hi = np.searchsorted(tx[0], [d - near, d + near + 1])
            rows = np.flatnonzero(ty[0] == d)
            if lo == hi or not len(rows):
                continue
            for at in range(0, len(rows), 512):
                some = rows[at:at + 512]
                keep = np.ones((len(some), hi - lo), bool)
                for k in range(1, 5):
                    keep &= np.abs(ty[k, some][:, None] - tx[k, lo:hi][None]) <= near
                i, j = np.nonzero(keep)
                i, j = some[i], j + lo
                for k in range(5, len(tx)):
                    ok = np.abs(ty[k, i] - tx[k, j]) <= near
                    i, j = i[ok], j[ok]
                ok = np.bitwise_count(y[i] ^ x[j]) <= near
                ok &= (home[i] != key[0].as_py()) | (yid[i] > xid[j])
                if ok.any():
                    found.append(forest(yid[i[ok]], xid[j[ok]]))
        ends = [np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1)]
        u, v = forest(*ends)
        return pa.table({"a": pa.array(u, pa.int64()), "b": pa.array(v, pa.int64())})

    return work


def links(prints: DataFrame, near: int = NEAR) -> DataFrame:
    """Links (a, b) that join all ``prints(fp, rep)`` (unique fp) within ``near`` bits, in the same components.

    A pair within ``near`` bits differs by ``near`` at most in the distance to
    every pivot. The distances to the first pivots make a grid; a fingerprint
    waits in its own cell and visits those that its distances, give or take
    ``near``, touch. Of two cells one visits the other. The grid has more
    pivots where there are more fingerprints; in a cell the table of distances
    to the remaining pivots discards pairs before bits are compared.
    """
    if 2 * near + 1 > CELL:
        raise ValueError(f"near must be {(CELL - 1) // 2} at most")
    refs = pivots()
    n = prints.count()
    grid = min(GRID_TO, max(GRID_FROM, int(np.ceil(np.log(max(n, 1) / CELL_ROWS) / np.log(2.2)))))
    far = [_distance("fp", refs[g]) for g in range(grid)]
    cell = lambda c: F.floor(c / CELL)
    code = lambda parts: sum((p * (16 ** g) for g, p in enumerate(parts)), F.lit(0)).cast("long")
    items = prints.select("fp", "rep", F.col("fp").alias("salt"), code([cell(d) for d in far]).alias("cell"))
    home, to = F.col("home"), F.col("cell")
    visitors = items.withColumnRenamed("cell", "home")
    for g, d in enumerate(far):
        visitors = visitors.withColumn(f"c{g}", F.explode(F.array_distinct(F.array(cell(d - near), cell(d + near)))))
    visitors = visitors.select("fp", "rep", "salt", "home", code([F.col(f"c{g}") for g in range(grid)]).alias("cell"))
    visitors = visitors.filter((home == to) | ((home < to) != ((home + to) % 2 == 1)))
    size = lambda most: max(64, min(most, -(-n // BLOCKS)))
    return meet(items, visitors, ["cell"], size(ITEM_ROWS), size(VISITOR_ROWS) * 4, _verify(near, grid, refs), "a long, b long")


def simhash_groups(docs: DataFrame, near: int = NEAR) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, fp long, component_id.

    component_id is the smallest doc_id reachable over fingerprints that differ
    in ``near`` bits at most. Null and empty texts have fingerprint 0 and are
    linked like others. A row without a doc_id has a component if a row with
    one is in it, else null. Repeated rows are repeated in the result. An empty
    table gives an empty one; other columns are not looked at.
    """
    rows = durable(fingerprints(docs))
    classes = durable(rows.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")))
    found = components(links(classes.filter("rep is not null").select("fp", "rep"), near))
    root = found.withColumnRenamed("id", "rep")
    named = classes.join(root, "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"), "n")
    return lookup(rows, named, ["fp"], "n").select("doc_id", "fp", "component_id")


def hex_fingerprint(c):
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def drop_near_copies(docs: DataFrame, near: int = NEAR) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest doc_id. Columns stay as they are.

    Rows without a doc_id cannot stand for a group and stay. Of rows that repeat
    the smallest doc_id one stays.
    """
    groups = simhash_groups(docs, near)
    kept = groups.filter(F.col("doc_id") == F.col("component_id")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    kept = durable(kept.withColumnRenamed("doc_id", "_kept"))
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_id"))
    stay = rows.filter("_id is null").select("_row.*")
    once = rows.join(kept.filter("_n = 1"), F.col("_id") == F.col("_kept"), "left_semi").select("_row.*")
    # Ids that several rows carry: one row each, chosen by content. Rows of a hot id stay where they are and are reduced there.
    more = kept.filter("_n > 1").select(F.col("_kept").alias("_id"), "_n", F.lit(True).alias("_more"))
    pick = lookup(rows, more, ["_id"], "_n").filter("_more").groupBy("_id").agg(
        F.min_by("_row", F.xxhash64("_row")).alias("_row")).select("_row.*")
    return stay.unionByName(once).unionByName(pick)
