"""Vector codes from codebooks that are refined with adaptive distance bounds, in integers throughout.

Each part of each vector keeps, from one round to the next, its entry, an upper
bound of the distance to it, the ``b`` next closest entries with ordered lower
bounds, and one outer lower bound for all other entries. When entries move, the
bounds move with them. A part whose upper bound is below its first lower bound
keeps its entry without a distance; otherwise only the entries whose bounds are
reached are compared, and all of them where the outer bound is reached. Those
comparisons are exact in integers, ties to the lower index, and bounds are
rounded outwards, so codes are those of a plain assignment. ``b`` follows the
measured counts: it falls to where keeping bounds and comparing cost least.

A round is one pass over the written table of the last round; a task reads
batches, writes the same rows with new bounds, and adds its sums for each entry;
then the table before it goes, so two are held at a time.
The driver sees codebooks only (16 entries of each part).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from donorloom.llm.common import lookup, matrix, usable_vector
from donorloom.session import durable, new_folder

LIMIT = 1 << 24  # whole components are held within this; squares of 4,096 of them then fit a long
NUMBERS = 1 << 21  # numbers a task handles at a time, entries included
EXACT = 1 << 53


@dataclass(frozen=True)
class Codec:
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096
    nearest: int = 8  # entries with a bound of their own in the first round


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all rows of ``c``."""
    if x.size == 0 or c.size == 0:
        return np.zeros((len(x), len(c)), np.int64)
    top = max(int(np.abs(x).max()), int(np.abs(c).max()))
    if 4 * x.shape[1] * top * top < EXACT:  # every intermediate result is a whole number that a double holds
        a, b = x.astype(float), c.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - entry) ** 2).sum(1) for entry in c], axis=1)


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


@dataclass
class Bounds:
    """What is kept of one part of n rows: entry (n), upper (n), near (n, b), low (n, b + 1) with the outer bound last."""

    entry: np.ndarray
    upper: np.ndarray
    near: np.ndarray
    low: np.ndarray

    @classmethod
    def fresh(cls, x: np.ndarray, c: np.ndarray, b: int) -> Bounds:
        d = squares(x, c)
        order = np.argsort(d, axis=1, kind="stable").astype(np.uint8)
        roots = np.sqrt(np.take_along_axis(d, order.astype(np.intp), 1).astype(float))
        outer = _down(roots[:, b + 1]) if len(c) > b + 1 else np.full(len(x), np.inf, np.float32)
        return cls(order[:, 0], _up(roots[:, 0]), order[:, 1:b + 1], np.column_stack([_down(roots[:, 1:b + 1]), outer]))

    def narrowed(self, b: int) -> Bounds:
        """With ``b`` bounds; the outer one becomes the least of those that go."""
        if b >= self.near.shape[1]:
            return self
        low = np.column_stack([self.low[:, :b], self.low[:, b:].min(1)])
        return Bounds(self.entry, self.upper, self.near[:, :b], low)

    def moved(self, moves: np.ndarray) -> Bounds:
        """After entry i moved by ``moves[i]`` at most."""
        low = np.column_stack([self.low[:, :-1] - moves[self.near], self.low[:, -1] - moves.max()])
        low = np.minimum.accumulate(_down(low)[:, ::-1], axis=1)[:, ::-1]  # ordered again
        return Bounds(self.entry, _up(self.upper + moves[self.entry]), self.near, low)

    def verified(self, x: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Make the entries exact; returns how many bounds each row's upper bound reaches (b + 1: the outer one too)."""
        b = self.near.shape[1]
        reached = (self.low <= self.upper[:, None]).sum(1)
        self.entry, self.upper, self.near, self.low = (a.copy() for a in (self.entry, self.upper, self.near, self.low))
        for n in range(1, b + 1):
            rows = np.flatnonzero(reached == n)
            if len(rows) == 0:
                continue
            some = np.column_stack([self.entry[rows], self.near[rows, :n]])
            d = ((x[rows, None, :] - c[some]) ** 2).sum(2)
            order = np.lexsort((some, d))
            some, roots = np.take_along_axis(some, order, 1), np.sqrt(np.take_along_axis(d, order, 1).astype(float))
            self.entry[rows], self.upper[rows] = some[:, 0], _up(roots[:, 0])
            self.near[rows, :n], self.low[rows, :n] = some[:, 1:], _down(roots[:, 1:])
        rows = np.flatnonzero(reached == b + 1)
        if len(rows):
            new = Bounds.fresh(x[rows], c, b)
            self.entry[rows], self.upper[rows], self.near[rows], self.low[rows] = new.entry, new.upper, new.near, new.low
        return reached


def _pack(parts: list[Bounds], n: int) -> tuple[pa.Array, pa.Array]:
    def rows(arrays: list[np.ndarray], dtype) -> pa.Array:
        flat = np.ascontiguousarray(np.column_stack(arrays).astype(dtype)) if arrays else np.zeros((n, 0), dtype)
        return pa.array([r.tobytes() for r in flat], pa.binary())
    return (rows([np.column_stack([p.entry, p.near]) for p in parts], np.uint8),
            rows([np.column_stack([p.upper, p.low]) for p in parts], np.float32))


def _unpack(batch: pa.RecordBatch, parts: int) -> list[Bounds]:
    read = lambda name, dtype: np.frombuffer(b"".join(batch.column(name).to_pylist()), dtype).reshape(batch.num_rows, parts, -1)
    near, low = read("near", np.uint8), read("low", np.float32)
    return [Bounds(near[:, p, 0], low[:, p, 0], near[:, p, 1:], low[:, p, 1:]) for p in range(parts)]


def _slices(batches: Iterator[pa.RecordBatch], entries: int) -> Iterator[pa.RecordBatch]:
    """Batches cut by the numbers they hold, so that long vectors come in fewer rows."""
    for batch in batches:
        width = len(batch.column("v").flatten()) // max(batch.num_rows, 1)
        rows = max(1, NUMBERS // max(1, (width + 1) * entries))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _assign(batch: pa.RecordBatch, books: np.ndarray, moves: np.ndarray | None, b: int) -> tuple[np.ndarray, list[Bounds], np.ndarray]:
    """Whole parts (parts, n, width) of a batch, their bounds against ``books``, and the bounds reached (parts, n)."""
    parts, entries, width = books.shape
    flat = matrix(batch.column("v"), np.int64) if width else np.zeros((batch.num_rows, 0), np.int64)
    x = flat.reshape(batch.num_rows, parts, width).transpose(1, 0, 2)
    if moves is None:
        return x, [Bounds.fresh(x[p], books[p], b) for p in range(parts)], np.full((parts, batch.num_rows), b + 1)
    held = [old.narrowed(b).moved(moves[p]) for p, old in enumerate(_unpack(batch, parts))]
    reached = np.stack([held[p].verified(x[p], books[p]) for p in range(parts)])
    return x, held, reached


def _columns(schema: T.StructType) -> T.StructType:
    add = [T.StructField(n, k) for n, k in (
        ("near", T.BinaryType()), ("low", T.BinaryType()), ("part", T.IntegerType()), ("entry", T.IntegerType()),
        ("n", T.LongType()), ("sums", T.ArrayType(T.LongType())), ("summary", T.BooleanType()))]
    own = [T.StructField(f.name, f.dataType) for f in schema.fields if f.name in ("vec_id", "key", "v")]  # all null in a summary
    return T.StructType(own + add)


def _round(state: DataFrame, books: np.ndarray, moves: np.ndarray | None, b: int, folder: str) -> DataFrame:
    """One pass: the rows with new bounds, and per task a summary of each entry, written to ``folder``."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, levels = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64), np.zeros(b + 2, np.int64)
        kinds = None
        for batch in _slices(batches, entries):
            x, held, reached = _assign(batch, books, moves, b)
            for p, own in enumerate(held):
                counts[p] += np.bincount(own.entry, minlength=entries)
                for entry in range(entries):
                    sums[p, entry] += x[p][own.entry == entry].sum(0)
            levels += np.bincount(reached.ravel(), minlength=b + 2)
            near, low = _pack(held, batch.num_rows)
            n = batch.num_rows
            kinds = [batch.column(c).type for c in ("vec_id", "key", "v")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("key"), batch.column("v"), near, low, pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()),
                 pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64())), pa.array(np.zeros(n, bool))], names=names)
        if kinds is None:
            return
        made = [(p, e, int(counts[p, e]), sums[p, e].tolist()) for p in range(parts) for e in range(entries) if counts[p, e]]
        made.append((-1, -1, 0, levels.tolist()))
        n = len(made)
        yield pa.RecordBatch.from_arrays(
            [*[pa.nulls(n, k) for k in kinds], pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), pa.array([m[0] for m in made], pa.int32()),
             pa.array([m[1] for m in made], pa.int32()), pa.array([m[2] for m in made], pa.int64()),
             pa.array([m[3] for m in made], pa.list_(pa.int64())), pa.array(np.ones(n, bool))], names=names)

    schema = _columns(state.schema)
    names = schema.names
    state.mapInArrow(run, schema).write.partitionBy("summary").parquet(folder)
    return state.sparkSession.read.schema(schema).parquet(folder)


def _summary(rows: DataFrame) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(rows, sums by place) for every (part, entry); (-1, -1) holds the counts of reached bounds."""
    own = rows.filter("summary").select("part", "entry", "n", F.posexplode_outer("sums").alias("place", "x"))
    wide = "decimal(38,0)"
    found: dict[tuple[int, int], tuple[int, dict[int, int]]] = {}
    for r in own.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast(wide)).alias("x")).collect():
        n, places = found.setdefault((r["part"], r["entry"]), (r["n"], {}))
        if r["place"] is not None:
            places[r["place"]] = int(r["x"])
    return {k: (n, [places[i] for i in range(len(places))]) for k, (n, places) in found.items()}


def next_nearest(levels: list[int], b: int, entries: int) -> int:
    """The number of bounds, ``b`` at most, for which keeping them and comparing all entries where they fail costs least."""
    total = sum(levels)
    beyond = lambda n: sum(levels[n + 1:])
    return min(range(min(1, b), b + 1), key=lambda n: (total * n + beyond(n) * 2 * entries, n))


def _remove(folder: str) -> None:
    """Delete a table of this run in the shared folder."""
    system, place = fs.FileSystem.from_uri("file://" + folder.removeprefix("file:") if folder.startswith(("/", "file:/")) and "//" not in folder else folder)
    system.delete_dir(place)


@dataclass
class Coded:
    codes: DataFrame  # vec_id, key, code, error
    books: np.ndarray  # (parts, entries, width)
    nearest: list[int]  # b of every pass
    levels: list[list[int]]  # how many parts reached how many bounds, by round

    def books_digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def whole(vectors: DataFrame, codec: Codec) -> DataFrame:
    """(vec_id, key, v): the usable vectors in whole numbers, and the label as a text key that tells null from all others."""
    x = lambda c: F.floor(F.greatest(F.least(c.cast("double") * codec.scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int")
    return vectors.filter(usable_vector(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit("")).alias("key"),
        F.transform("embedding", x).alias("v"))


def train_and_code(vectors: DataFrame, codec: Codec = Codec()) -> Coded:
    """Codebooks of ``vectors(vec_id, embedding, label)`` after the codec's rounds, and every row's code.

    Rows with a null vector or a null or non-finite component are left out.
    Repeated rows count as often as they occur; rows without a vec_id come last
    in the order of ids, and equal ids follow the order of their vectors. Vectors
    shorter than the longest, or than a multiple of the number of parts, are
    taken as filled up with zeros. Whole components beyond 2**24 are held there.
    """
    rows = whole(vectors, codec)
    longest = rows.agg(F.max(F.size("v"))).first()[0]
    width = -(-(longest or 0) // codec.parts)
    short = codec.parts * width - F.size("v")
    rows = rows.withColumn("v", F.when(short > 0, F.concat("v", F.array_repeat(F.lit(0), short))).otherwise(F.col("v")))
    first = rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(codec.entries).collect()
    out = "vec_id long, key string, code string, error long"
    if not first:
        return Coded(rows.sparkSession.createDataFrame([], out), np.zeros((codec.parts, 0, width), np.int64), [], [])
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), codec.parts, width).transpose(1, 0, 2).copy()
    entries = len(first)
    state, moves, b = rows, None, min(codec.nearest, entries - 1)
    used, seen, folder = [], [], new_folder(rows.sparkSession, "vector-codes")
    for number in range(codec.rounds):
        written = _round(state, books, moves, b, f"{folder}/round-{number}")
        found = _summary(written)
        old = books.copy()
        for (part, entry), (n, sums) in found.items():
            if part >= 0:
                books[part, entry] = [s // n for s in sums]
        moves = _up(np.sqrt(((books - old) ** 2).sum(2).astype(float)))
        if number:  # the round before has been read for the last time
            _remove(f"{folder}/round-{number - 1}")
        state = written.filter(~F.col("summary")).select("vec_id", "key", "v", "near", "low")
        used.append(b)
        seen.append(found[(-1, -1)][1])
        if number:  # in the first round every bound is new
            b = next_nearest(seen[-1], b, entries)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, entries):
            x, held, _ = _assign(batch, books, moves, b)
            code = np.column_stack([own.entry for own in held]).astype(np.uint8)
            error = sum(((x[p] - books[p][own.entry]) ** 2).sum(1) for p, own in enumerate(held))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("key"), pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(error, pa.int64())],
                names=["vec_id", "key", "code", "error"])

    return Coded(durable(state.mapInArrow(last, out)), books, [*used, b], seen)


def vector_codes(vectors: DataFrame, codec: Codec = Codec()) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for every usable vector; see :func:`train_and_code`.

    ``code`` has two hex digits a part, ``label_error`` is the sum of errors over
    rows of equal label, rows without a label together, held to the range of a long.
    """
    coded = train_and_code(vectors, codec)
    top = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    by_label = coded.codes.groupBy("key").agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), top).cast("long").alias("label_error"), F.count(F.lit(1)).alias("n"))
    return lookup(coded.codes, by_label, ["key"], "n").select(
        "vec_id", "code", "error", "label_error", F.lit(coded.books_digest()).alias("codebooks_sha256"))


def oracle(codec: Codec = Codec()) -> str:
    """The same by plain assignment, for vectors of one length that the number of parts divides."""
    parts, entries = codec.parts, codec.entries
    steps = []
    nearest = lambda r: f"""a{r} AS MATERIALIZED (SELECT vec_id, label, part, v, min(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT
  * {entries} + e) AS m FROM x JOIN c{r} USING (part) GROUP BY ALL)"""
    for r in range(codec.rounds):
        steps += [nearest(r), f"""s{r} AS (SELECT part, m % {entries} AS e, i, sum(y)::BIGINT AS s, count(*) AS n
  FROM (SELECT part, m, unnest(v) AS y, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY ALL)""",
                  f"""n{r} AS (SELECT part, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{r} GROUP BY ALL)""",
                  f"""c{r + 1} AS MATERIALIZED (SELECT c{r}.part, c{r}.e, coalesce(n{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN n{r} USING (part, e))"""]
    last = codec.rounds
    return f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({codec.scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT vec_id, label, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS v FROM k, range({parts}) t(part)),
c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e, v AS c FROM x
  WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT {entries})),
{", ".join(steps)},
{nearest(last)},
h AS (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY part, e, i)) AS codebooks_sha256
  FROM (SELECT part, e, unnest(c) AS y, generate_subscripts(c, 1) AS i FROM c{last})),
r AS (SELECT vec_id, label, string_agg(format('{{:02x}}', m % {entries}), '' ORDER BY part) AS code, sum(m // {entries})::BIGINT AS error FROM a{last} GROUP BY vec_id, label)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM r, h"""
