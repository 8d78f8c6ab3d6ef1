"""Vector codes, periodic runs and shared lines against plain versions, and on awkward rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from donorloom.llm import line_runs, periodic, queries, vector_codes

LONG = "word " * 40_000


def plain_codes(vectors, parts=8, entries=16, rounds=6):
    """Codes, errors and codebooks of whole vectors in order of id, by comparing everything."""
    x = np.array(vectors).reshape(len(vectors), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()
    near = lambda: np.stack([((x[:, p, None] - books[p][None]) ** 2).sum(2) for p in range(parts)], 1)
    for _ in range(rounds):
        code = near().argmin(2)
        for p in range(parts):
            for e in range(len(books[p])):
                if (own := x[code[:, p] == e, p]).size:
                    books[p, e] = [sum(map(int, c)) // len(own) for c in own.T]
    d = near()
    return d.argmin(2), d.min(2).sum(1), books


VECTORS = "vec_id long, embedding array<float>, label int, key string, v int, near int, n long"


def embeddings(spark, rows):
    return spark.createDataFrame([(i, v, label, "k", 0, 0, 0) for i, v, label in rows], VECTORS)


@pytest.mark.parametrize("count, spread", [(400, 1.0), (60, 0.001), (9, 3.0)])
def test_vector_codes(spark, count, spread):
    rng = np.random.default_rng(count)
    centres = rng.normal(size=(20, 32))
    x = (centres[rng.integers(0, 20, count)] + rng.normal(size=(count, 32)) * spread * 0.3).astype(np.float32)
    x[count // 2:count // 2 + 3] = x[0]  # repeated vectors and ties between entries
    rows = [(i * 3, [float(c) for c in v], None if i % 5 == 0 else i % 4) for i, v in enumerate(x)]
    odd = [(-5, None, 1), (-4, [None] * 32, 1), (-3, [float("nan")] * 32, 1), (-2, [float("inf")] * 32, None)]
    got = {r["vec_id"]: r for r in vector_codes.vector_codes(embeddings(spark, rows + odd)).collect()}
    code, error, books = plain_codes(np.floor(x.astype(float) * 4096).astype(np.int64))
    sums = {}
    for (_, _, label), e in zip(rows, error):
        sums[label] = sums.get(label, 0) + int(e)
    digest = hashlib.sha256(",".join(str(c) for c in books.ravel()).encode()).hexdigest()
    assert len(got) == count
    for (i, _, label), c, e in zip(rows, code, error):
        r = got[i]
        assert (r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) == ("".join(f"{k:02x}" for k in c), int(e), sums[label], digest)


def test_vector_codes_on_awkward_rows(spark):
    none = vector_codes.vector_codes(embeddings(spark, []))
    assert none.collect() == [] and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    # Short vectors count as filled up with zeros, huge components are held, equal rows count each, a missing id comes last.
    rows = [(1, [1.0] * 16, 0), (1, [1.0] * 16, 0), (2, [0.5] * 3, 0), (None, [3e38] * 16, None), (4, [], 0)]
    got = vector_codes.vector_codes(embeddings(spark, rows)).collect()
    assert len(got) == 5 and all(r["error"] >= 0 and len(r["code"]) == 16 for r in got)
    assert sorted((r["vec_id"] for r in got), key=repr) == [1, 1, 2, 4, None]
    assert {r["code"] for r in got if r["vec_id"] is None} == {"04" * 8}
    only = vector_codes.vector_codes(embeddings(spark, [(7, [], None)])).collect()
    assert [(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in only] == [(7, "00" * 8, 0, 0)]


def test_bounds_hold():
    rng = np.random.default_rng(0)
    x, c = rng.integers(-9000, 9000, (500, 6)), rng.integers(-9000, 9000, (16, 6))
    bounds = vector_codes.Bounds.fresh(x, c, 5)
    for step in range(8):
        new = c + rng.integers(-400, 400, c.shape) // (step + 1)
        bounds = bounds.narrowed(5 - step // 2).moved(vector_codes._up(np.sqrt(((new - c) ** 2).sum(1).astype(float))))
        c = new
        bounds.verified(x, c)
        d = vector_codes.squares(x, c)
        assert (bounds.entry == d.argmin(1)).all() and (bounds.upper.astype(float) ** 2 * (1 + 1e-6) >= d.min(1)).all()
        root = np.sqrt(d.astype(float))
        assert (np.take_along_axis(root, bounds.near.astype(int), 1) >= bounds.low[:, :-1]).all()
        assert (np.diff(np.sort(bounds.low, axis=1)) >= 0).all()
        for i in range(len(x)):
            others = np.setdiff1d(np.arange(16), [bounds.entry[i], *bounds.near[i]])
            assert len(others) == 0 or root[i, others].min() >= bounds.low[i, -1]
    big = rng.integers(-(1 << 24), 1 << 24, (20, 512))
    assert (vector_codes.squares(big, big[:3]) == ((big[:, None] - big[None, :3]) ** 2).sum(2)).all()
    assert vector_codes.next_nearest([100, 0, 0, 0], 2, 16) == 1 and vector_codes.next_nearest([0, 0, 100, 0], 2, 16) == 2


def plain_runs(words, least=24):
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_row(doc_id, text):
    """A row of the query, from the contract's words."""
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    drop = {i for s, length, q in found for i in range(s + q, s + length)}
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    tail = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *tail, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_on_random_words():
    rng = random.Random(7)
    for _ in range(250):
        texts = []
        for _ in range(rng.randint(1, 6)):
            w = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(0, 90))]
            for _ in range(rng.randint(0, 3)):
                unit = [rng.randrange(rng.choice([2, 30])) for _ in range(rng.randint(1, 15))]
                at = rng.randint(0, len(w))
                w[at:at] = (unit * 60)[:rng.randint(2, 60)]
            texts.append(w)
        texts += [texts[0]] * rng.randint(0, 2)
        least = rng.choice([6, 12, 24, 40])
        want, at = [], 0
        for t in texts:
            want += [(s + at, s + at + length, q) for s, length, q in plain_runs(t, least)]
            at += len(t)
        ids = np.array([x for t in texts for x in t], np.int64)
        got = periodic.runs(ids, np.repeat(np.arange(len(texts)), [len(t) for t in texts]), least)
        assert list(zip(*(a.tolist() for a in got))) == sorted(want, key=lambda r: (r[0], r[2]))


def test_grammar_derives_the_words():
    rng = random.Random(8)
    ids = np.array([rng.randrange(4) for _ in range(3000)] + [0, 1, 2] * 200 + [3] * 500)
    text = np.repeat([0, 1, 2], [1000, 2500, 600])
    g = periodic.re_pair(ids, text)

    def derive(symbol):
        return [symbol] if symbol < g.words else derive(g.left[symbol - g.words]) + derive(g.right[symbol - g.words])

    assert [w for s in g.symbols.tolist() for w in derive(s)] == ids.tolist()
    assert all(ids[p:p + n].tolist() == derive(g.words + i) for i, (p, n) in enumerate(zip(g.place, g.length[g.words:])))
    inside = g.text[1:] == g.text[:-1]
    pairs = [p for p, same in zip(zip(g.symbols[:-1].tolist(), g.symbols[1:].tolist()), inside) if same]
    repeated = {p for p in pairs if pairs.count(p) > 1}
    assert all(a == b for a, b in repeated)  # only the overlapping pairs of a short power may be left
    with pytest.raises(ValueError):
        periodic.runs(ids, text, 5)


def test_long_powers_take_no_square_of_their_length():
    for words in ([0] * 300_000, [0, 1, 2] * 100_000):
        s, e, q = periodic.runs(np.array(words), np.zeros(len(words), np.int64), 24)
        assert (s.tolist(), e.tolist(), q.tolist()) == ([0], [300_000], [len(set(words))])


def test_periodic_query(spark, tmp_path):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 200))) for _ in range(150)]
    texts += [None, "", " \t\n", "word " * 900, "ü漢 " * 30, "a b\x0bc\x0c" * 12, "x y " * 11 + "x", "x y " * 12, "\x1cx\x85 " * 24]
    rows = [(i, t, 1, "c") for i, t in enumerate(texts)] + [(None, "q r s " * 10, 1, "c"), (3, texts[3], 1, "c")]
    spark.createDataFrame(rows, "doc_id long, text string, runs int, collapsed string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((plain_row(i, t) for i, t, *_ in rows), key=repr)


def test_periodic_query_on_given_texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op12_periodic_runs(spark, sf).collect()
    assert sorted(map(tuple, got)) == sorted(plain_row(r["doc_id"], r["text"]) for r in docs)
    assert any(r["n_runs"] for r in got)


def test_periodic_runs_keep_real_texts(spark):
    docs = spark.createDataFrame([(1, "go on " * 20 + "then"), (2, "a b")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in periodic.periodic_runs(docs).collect()}
    assert got[1]["collapsed"] == "go on then" and [tuple(r) for r in got[1]["runs"]] == [(0, 40, 2)]
    assert got[2]["collapsed"] == "a b" and got[2]["runs"] == []
    assert periodic.periodic_runs(docs.limit(0)).collect() == []


def plain_lines(texts, min_docs, min_chars):
    key = lambda line: line.strip(" \t\n\x0b\f\r").translate({c: c + 32 for c in range(65, 91)})
    split = [(t or "").split("\n") for t in texts]
    found = {}
    for lines in split:
        for k in {key(x) for x in lines}:
            found[k] = found.get(k, 0) + 1
    out = []
    for lines in split:
        kept = [x for x in lines if len(key(x)) < min_chars or found[key(x)] < min_docs]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


@pytest.mark.parametrize("min_docs, min_chars, batches", [(10, 1, 4), (2, 5, 1), (3, 0, 5)])
def test_shared_lines(spark, min_docs, min_chars, batches):
    rng = random.Random(min_docs * 10 + batches)
    pool = [f"line {k}" for k in range(40)] + ["", " ", "\tLine 1 ", "LINE 2\r", "ÉÀ", "éà", "\x85", "x"]
    texts = ["\n".join(rng.choice(pool) if rng.random() < 0.6 else f"own {rng.random()}" for _ in range(rng.randint(1, 12))) for _ in range(160)]
    texts += [None, "", "\n", "\n\n", "hot\nshared"] + ["hot\ncold " + "z" * 50] * 60 + ["only once\n" * 30, LONG + "\nhot"]
    rows = [(i if i % 7 else None, t, 0, 0, "k", True) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, n long, t string, often boolean").repartition(9)
    got = line_runs.drop_shared_lines(docs, min_docs, min_chars, batches)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    want = [(r[0], *w) for r, w in zip(rows, plain_lines(texts, min_docs, min_chars))]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert line_runs.drop_shared_lines(docs.limit(0), min_docs, min_chars, batches).collect() == []


def test_line_runs_are_levelled_and_merged(spark):
    runs = line_runs.LineRuns(spark, "line_runs_test", min_docs=3, fan=2, buckets=4)
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "key string")
    for batch, levels in [("aab", {0: 1}), ("abc", {1: 1}), ("ad", {0: 1, 1: 1}), ("bcd", {2: 1}), ("", {0: 1, 2: 1})]:
        runs.add(keys(*batch))
        assert {k: len(v) for k, v in runs.levels().items()} == levels
    entries = {r["key"]: r["docs"] for name in runs._runs() for r in spark.table(name).collect()}
    assert entries == {"a": 3, "b": 3, "c": 2, "d": 2}  # a was settled by the second batch, so the third did not count it
    assert sorted(r["key"] for r in runs.settled().collect()) == ["a", "b"]
    again = line_runs.LineRuns(spark, "line_runs_test", min_docs=3, fan=2)
    assert again.levels() == runs.levels()
    plan = runs.settled()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    spark.sql("DROP DATABASE line_runs_test CASCADE")
