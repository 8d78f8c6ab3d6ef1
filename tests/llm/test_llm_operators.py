"""The operators against plain versions, and on awkward rows."""

import hashlib
import io
import random
import struct

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from donorloom.llm import licenses, mixing, pq, quality, sentencepieces, simhash, tokens, topk, urls, warc
from donorloom.llm.graph import components, forest
from donorloom.llm.queries import PIECES, TOKENIZER, vocabulary

LONG = "word " * 40_000
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _row int, token string, key string, digest int, n int, fp int, cell int, id int"
TEXTS = [(1, "a b c d"), (2, "a b c d"), (2, "a b c d"), (3, None), (4, ""), (None, "x y z"), (5, LONG), (6, "ü 漢字 \x00 MIT License"), (7, "a b c d")]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en" if i else None, "src1" if i != 3 else None, 0, 0, "t", "k", 0, 0, 0, 0, 0) for i, t in TEXTS], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_components_and_forest(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(0, k) for k in range(500, 900)]
    root = list(range(1000))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    want = {x: find(x) for x in range(1000) if find(x) != x}
    got = components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r["id"]: r["component"] for r in got.collect()} == want
    ids, low = forest(*map(np.array, zip(*pairs)))
    assert dict(zip(ids.tolist(), low.tolist())) == want


VECTORS = "vec_id long, embedding array<float>, label int, bucket int, v int, length int, rep int, list int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0, 0, 0, 0, 0) for i, v in rows], VECTORS)


def test_top_k(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)) * rng.choice([0.01, 1, 30], size=(300, 1))
    x[100:200] = x[100] + rng.normal(size=(100, 8)) * 0.02
    x[250:] = x[250]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x.astype(np.float32))]
    odd = [(400, None), (401, [None] * 8), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (None, rows[0][1]), (404, [1.0, 2.0]), (420, [0.0] * 8)]
    got = topk.top_k(vectors(spark, rows + odd), lambda i: i % 20 == 0, k=5)
    ids = np.array([*range(300), 420])
    whole = np.floor(64 * np.vstack([x.astype(np.float32).astype(float), np.zeros((1, 8))])).astype(int)
    want = []
    for q in np.flatnonzero(ids % 20 == 0):
        s = whole @ whole[q]
        order = [j for j in np.lexsort((ids, -s)) if j != q][:5]
        want += [(int(ids[q]), k + 1, int(ids[j]), int(s[j])) for k, j in enumerate(order)]
    assert rows_of(got) == sorted(want, key=repr)
    assert rows_of(topk.top_k(vectors(spark, []), lambda i: i % 20 == 0)) == []
    assert topk.products(np.array([[1 << 40]]), np.array([[1 << 40]])).tolist() == [[(1 << 63) - 1]]


def test_embedding_groups(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 32))
    x = np.vstack([base, base[:10] + rng.normal(size=(10, 32)) * 0.05, base[3:4] + rng.normal(size=(60, 32)) * 0.1, base[5:6], base[5:6] * 2])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x.astype(np.float32))]
    odd = [(900, None), (901, [0.0] * 32), (902, [float("nan")] * 32), (903, []), (None, rows[5][1]), (904, [1.0, 0.0])]
    got = {r[0]: tuple(r[1:]) for r in pq.embedding_groups(vectors(spark, rows + odd + rows[5:6])).collect()}
    u = np.array([v for _, v in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    link = u @ u.T >= 0.95
    low = np.arange(len(u))
    while not np.array_equal(new := np.where(link, low[None], 10 ** 6).min(1), low):
        low = new
    for i in range(len(u)):
        assert got[i] == (int(link[i].sum()) - 1, int(low[i]), bool(low[i] == i)), i
    assert all(got[i] == (0, i, True) for i in (900, 901, 902, 903, 904)) and got[None] == (0, None, False)
    assert rows_of(pq.embedding_groups(vectors(spark, []))) == []


@pytest.mark.parametrize("dims, cosine", [(4, 0.95), (4, 0.8)])
def test_embedding_links_across_lists(spark, dims, cosine):
    x = np.random.default_rng(dims).normal(size=(1200, dims)).astype(np.float32)
    got = {r[0]: r[1:3] for r in pq.embedding_groups(vectors(spark, [(i, [float(c) for c in v]) for i, v in enumerate(x)]), cosine).collect()}
    u = pq.unit(x.astype(float))
    link = np.einsum("id,jd->ij", u, u) >= cosine
    low = np.arange(len(u))
    while not np.array_equal(new := np.where(link, low[None], 10 ** 6).min(1), low):
        low = new
    assert [got[i] for i in range(len(u))] == [(int(n) - 1, int(c)) for n, c in zip(link.sum(1), low)]


def test_quality(spark, docs, none):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(2, 8)))
    made = []
    for i in range(240):
        words = [word() for _ in range(60)]
        made.append((i, " ".join(words) + "." if i % 4 else "BUY!! " + " ".join([words[0].upper() + "!!"] * 60), int(i % 4 > 0)))
    table = spark.createDataFrame(made, "doc_id long, text string, quality int")
    got = {r["doc_id"]: r for r in quality.quality_scores(table.drop("quality"), table.select("doc_id", "quality")).collect()}
    held = [r for r in got.values() if r["held_out"]]
    assert held and sum(r["predicted"] == made[r["doc_id"]][2] for r in held) >= 0.95 * len(held)
    kept = {r["doc_id"] for r in quality.keep_good(table, table.select("doc_id", "quality")).collect()}
    assert kept == {i for i, r in got.items() if r["predicted"] == 1}
    out = quality.quality_scores(docs, spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")).collect()
    assert len(out) == len(TEXTS) and all(r["score"] == 0.5 for r in out)
    assert rows_of(quality.quality_scores(none, table.select("doc_id", "quality"))) == []


def test_simhash(spark, docs, none):
    def plain(text):
        w = (text or "").encode().lower().split()
        if not w:
            return 0
        s = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))

    text = {i: t for i, t in TEXTS}
    got = simhash.simhash_groups(docs).withColumn("h", simhash.hex_fingerprint(F.col("fp"))).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        assert r["h"] == f"{plain(text[r['doc_id']]):016x}"
    assert {r["doc_id"]: r["component_id"] for r in got} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6, 7: 1, None: None}
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 3, 5, 6, None]
    assert rows_of(simhash.simhash_groups(none)) == []


def test_simhash_links(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, *(base[:30] ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for k in (1, 2, 3, 4))]))
    table = spark.createDataFrame([(int(f.view(np.int64)), i) for i, f in enumerate(fps)], "fp long, rep long")
    got = {r["id"]: r["component"] for r in components(simhash.links(table)).collect()}
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= 3
    low = np.arange(len(fps))
    while not np.array_equal(new := np.where(near, low[None], 10 ** 6).min(1), low):
        low = new
    assert [got.get(i, i) for i in range(len(fps))] == low.tolist()


def test_urls(spark):
    pages = [(1, "http://A.example.org/en/12"), (2, "https://example.org/es/x?q=/fr/"), (3, "x.org"), (4, None), (5, "http://b.com/de/1"), (6, "ftp://y.com/fr/"),
             (7, "http://m.site.net/p"), (8, "http://site.net/login"), (9, "http://example.org"), (1, "http://A.example.org/en/12"), (None, "http://badexample.org/es/"), (10, "")]
    table = spark.createDataFrame([(*p, 1, "t") for p in pages], "page_id long, url string, _row int, token string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.url_verdicts(table).collect()}
    assert urls.url_verdicts(table).count() == len(pages)
    assert got == {
        1: ("a.example.org", "/en/12", "example.org/en/1", "block"), 2: ("example.org", "/es/x", "example.org/es/", "block"), 3: ("", "", None, "allow"),
        4: ("", "", None, "allow"), 5: ("b.com", "/de/1", "com/de/", "block"), 6: ("y.com", "/fr/", "com/fr/", "allow"), 7: ("m.site.net", "/p", None, "block"),
        8: ("site.net", "/login", None, "block"), 9: ("example.org", "", None, "allow"), None: ("badexample.org", "/es/", "org/", "allow"), 10: ("", "", None, "allow")}
    assert rows_of(urls.url_verdicts(table.limit(0))) == []
    with pytest.raises(ValueError):
        urls.url_verdicts(table, [urls.Rule("all", "x", (), "block")])


def test_tokens(spark, docs, none, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary(TOKENIZER))
    text = {i: t or "" for i, t in TEXTS}
    for _ in range(2):  # the second time from the cache
        got = tokens.token_counts(docs, vocabulary(TOKENIZER), str(tmp_path / "counts")).collect()
        assert len(got) == len(TEXTS)
        for r in got:
            n = len(library.encode(text[r["doc_id"]], add_special_tokens=False).ids)
            assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text[r["doc_id"]].encode()), n, n > 1024)
        assert spark.read.parquet(str(tmp_path / "counts")).count() == len({t for t in text.values()})
    assert rows_of(tokens.token_counts(none, vocabulary(TOKENIZER), str(tmp_path / "none"))) == []
    rng = random.Random(6)
    odd = ["".join(rng.choice("ab  \n\t'sét0²½漢. \x1c\x85<|endoftext|>") for _ in range(40)) for _ in range(300)] + ["<|endoftext|>x"]
    counter = tokens.Counter(vocabulary(TOKENIZER))
    assert counter.counts(odd) == [len(library.encode(t, add_special_tokens=False).ids) for t in odd]


def test_mixing(spark, docs, none):
    made = [(i, "w " * (i % 7), ["en", "de"][i % 2], f"src{i % 5}") for i in range(300)]
    table = spark.createDataFrame(made, "doc_id long, text string, lang string, source string")
    mix = mixing.Mix(share=900, epochs=3)
    got = mixing.mixture(table, mix).collect()
    have = sum(i % 7 for i in range(300))
    assert 0.8 * have <= sum(r["n_tokens"] for r in got) <= 0.9 * have
    leaves = {}
    for r in got:
        leaves.setdefault((r["domain"], r["language"], r["source"]), []).append(r)
    for (_, language, source), rows in leaves.items():
        own = {i for i, t, la, so in made if (la, so) == (language, source)}
        last = max(r["epoch"] for r in rows)
        for e in range(last):
            assert {r["doc_id"] for r in rows if r["epoch"] == e} == own
        order = sorted(own, key=lambda i: hashlib.md5(f"42|{last}|{i}".encode()).hexdigest())
        taken = [i for i in order if i in {r["doc_id"] for r in rows if r["epoch"] == last}]
        assert taken == order[:len(taken)]
    assert {r["source"] for r in mixing.budgets(mixing.plan(table, mix)[0], mix).collect()} == {f"src{k}" for k in range(5)}
    out = mixing.mixed(docs, mixing.Mix(share=1000))
    assert out.columns == docs.columns and out.count() > 0
    assert rows_of(mixing.mixture(none)) == [] and rows_of(mixing.mixed(none)) == []


def test_pieces(spark, docs, none):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECES))
    model = sentencepieces.load(vocabulary(PIECES))
    rng = random.Random(7)
    odd = ["".join(rng.choice("ab  the\n\té漢😀.ß") for _ in range(rng.randint(0, 80))) for _ in range(300)] + ["a" * 200, " " * 60]

    def cut(texts, variants, dropout):
        ids, ends = sentencepieces.encode(model, texts, variants, 42, dropout)
        assert sentencepieces.decode(model, ids, ends) == texts
        return [p.tolist() for p in np.split(ids, ends[:-1])] if len(texts) else []

    assert cut(odd, [0] * len(odd), 0.0) == library.encode(odd)
    assert cut(["▁ a▁b " + t for t in odd[:50]], [1] * 50, 0.2)
    some = cut(["international organisations " * 3] * 4, [0, 1, 2, 3], 0.3)
    assert len({tuple(s) for s in some}) > 1
    words = [w.replace(" ", "▁") for w in {w for t in odd for w in sentencepieces._WORD.findall(t)} if len(w) <= 48]
    keys = np.arange(len(words), dtype=np.uint64)
    flat, counts = sentencepieces._grid(model, words, keys, 0.3)
    assert [p.tolist() for p in np.split(flat, np.cumsum(counts)[:-1])] == [sentencepieces.agenda(model, w, int(k), 0.3) for w, k in zip(words, keys)]
    encoded = sentencepieces.encode_documents(docs, vocabulary(PIECES))
    got = encoded.collect()
    assert len(got) == len(TEXTS) and all(r["lossless"] for r in got)
    back = rows_of(sentencepieces.decode_documents(encoded, vocabulary(PIECES)))
    assert back == sorted(((i, t or "") for i, t in TEXTS), key=repr)
    assert rows_of(sentencepieces.encode_documents(none, vocabulary(PIECES))) == []


def test_words_beyond_every_place():
    """Characters beyond 2**22 of one word: places wrap around, and the segmentation is still whole."""
    model = sentencepieces.load(vocabulary(PIECES))
    text = "漢" * (2 ** 22 + 100) + "understanding" * 20
    ids, ends = sentencepieces.encode(model, [text], [3], 42, 0.2)
    assert sentencepieces.decode(model, ids, ends) == [text]
    place = sentencepieces._place(np.array([2 ** 23 + 5]), np.array([2 ** 23 + 6]), np.array([2 ** 23 + 7]))
    i = 2 ** 23 + 5
    assert int(place[0]) == (i << 42 ^ (i + 1) << 21 ^ (i + 2)) % 2 ** 64
    assert sentencepieces._hashed(12345 << 40) == int(sentencepieces._mix(np.array([12345 << 40], np.uint64))[0])


def test_sentencepiece_occurrences(spark):
    model = sentencepieces.load(vocabulary(PIECES))
    model.clear()
    rng = random.Random(11)
    texts = ["".join(rng.choice("ab  the\n\té漢😀.ß▁") for _ in range(rng.randint(0, 80))) for _ in range(60)]
    texts += ["international organisations " * 40, "z" * 60 + " understanding" * 9]
    for dropout in (0.1, 0.4, 0.1):  # what is remembered from before must not matter
        keys = list(range(5, 5 + len(texts)))
        ids, ends = sentencepieces.encode(model, texts, keys, 42, dropout)
        for t, k, got in zip(texts, keys, np.split(ids, ends[:-1])):
            own, want = xxhash.xxh64_intdigest(b"%d" % k, 42), []
            for number, w in enumerate(sentencepieces._WORD.findall(" " * model.prefix + t) if t else [], 1):
                key = int(sentencepieces._mix(np.array([(own + number * int(sentencepieces.STEP)) % 2 ** 64], np.uint64))[0])
                cut = np.array(sentencepieces.agenda(model, sentencepieces._spaced(w), key, dropout), np.int64)
                want += sentencepieces._with_bytes(model, [w], cut, np.array([len(cut)]))[0].tolist()
            assert got.tolist() == want
    ids, ends = sentencepieces.encode(model, [" organisations" * 3000], [1], 42, 0.1)
    starts = np.flatnonzero(model.text[model.text_at[ids]] == ord(" "))
    assert len({tuple(c.tolist()) for c in np.split(ids, starts[1:])}) > 8
    # Equal rows, hot ids, other texts of an id and rows without one are all cut in their own ways, wherever they lie.
    long = " ".join(rng.choice(["international", "understanding", "documentation"]) for _ in range(60))
    rows = [(1, long), (2, long), (1, long), (3, long), (None, long), (None, long), (4, long + " x")] + [(7, long)] * 5
    rows += [(k, "w") for k in range(100, 2200)] + [(k, long) for k in (2000, 2001)]

    def encoded(n):
        table = spark.createDataFrame(rows, "doc_id long, text string").repartition(n)
        return rows_of(sentencepieces.encode_documents(table, vocabulary(PIECES)).select("doc_id", "ids", "lossless"))

    some = encoded(3)
    assert some == encoded(5) and len(some) == len(rows) and all(r[2] for r in some)
    assert len({tuple(r[1]) for r in some if len(r[1]) > 9}) == 14
    once = rows_of(sentencepieces.encode_documents(spark.createDataFrame(rows[:2], "doc_id long, text string"), vocabulary(PIECES)))
    assert all(r in some for r in once)


def test_warc(spark, tmp_path):
    big = "x" * 150
    pages = [(5, "http://a/", big), (3, "http://b/\r\nX: y", big), (9, None, big), (9, None, big), (None, "u", big), (1, "u", None), (2, "u", None), (4, "ü", "é" * 100_000),
             (6, "", "short"), (7, "", "short")]
    table = spark.createDataFrame([(*p, 1, "d") for p in pages], "page_id long, url string, html string, n int, digest string")
    archives = warc.write_archives(table, str(tmp_path / "warc"))
    got = warc.read_archives(archives).collect()
    assert len(got) == len(pages)
    html = {p[0]: p[2] or "" for p in pages}
    for r in got:
        raw = html[r["page_id"]].encode()
        revisit = r["page_id"] in (5, 9, None)
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("revisit", 3) if revisit else ("response", None))
        assert r["payload"] is None if revisit else bytes(r["payload"]) == raw
    assert warc.archived(table.limit(0)).collect() == []


def test_warc_validation():
    raw = warc.record(1, "u", b"body", hashlib.sha256(b"body").hexdigest(), None)
    assert warc.parse(raw)[1] == b"body"
    for bad in (raw[:-1], raw + b"x", raw.replace(b"Length: 4", b"Length: 5"), raw.replace(b"WARC/1.1", b"WARC/9", 1), raw.replace(b"WARC-Date", b"Other"),
                raw.replace(b"body", b"bodx"), raw.replace(b"WARC-Date:", b"WARC-Date")):
        with pytest.raises(ValueError):
            warc.parse(bad)
    words = zstandard.ZstdCompressionDict(b"WARC/1.1 http response body " * 40, dict_type=zstandard.DICT_TYPE_RAWCONTENT).as_bytes()
    pack = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(words))
    whole = struct.pack("<II", warc.DICTIONARY, len(words)) + words + pack.compress(raw) + pack.compress(raw)
    assert list(warc.frames(io.BytesIO(whole))) == [raw, raw]
    for bad in (whole[:-3], whole[:6], whole + b"junk"):
        with pytest.raises(ValueError):
            list(warc.frames(io.BytesIO(bad)))


def test_licenses(spark, docs, none):
    text = "Under the GNU General Public License, MIT License; CC-BY-NC.\nSPDX-License-Identifier: (MIT OR GPL-2.0) AND Apache-2.0 WITH x-exception) tail"
    n, base, first, last, own, labels, score, ids = licenses.scan(text)
    assert (base, first, last, own, labels) == (3, 2, 8, "cc-by,gpl,mit", "apache,cc-by,gpl,mit,nc")
    assert score == 0.2 and ids == ["mit", "gpl-2.0", "apache-2.0"]
    assert licenses.scan("mit license mit license")[:4] == (4, 2, 0, 2)
    assert licenses.scan("mıt license")[1] == 0 and licenses.scan(None)[:4] == (0, 0, None, None)
    assert licenses.evaluate(["mit", "or", "gpl-2.0", "and", "mpl-2.0"])[0] == 1.0
    assert licenses.evaluate(["(", "mit", "or", "gpl-2.0", ")", "and", "mpl-2.0"])[0] == 0.7
    assert licenses.evaluate(["gpl-2.0", "with", "classpath"])[0] == pytest.approx(0.52)
    for bad in (["and"], ["mit", "gpl"], ["(", "mit"], ["mit", ")"], []):
        with pytest.raises(ValueError):
            licenses.to_postfix(bad)
    got = licenses.license_scan(docs).collect()
    assert len(got) == len(TEXTS) and {r["doc_id"] for r in got if r["n_base"]} == {6}
    assert rows_of(licenses.license_scan(none)) == []
