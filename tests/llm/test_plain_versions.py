"""The classifier and the licence scan against plain versions of other make, and the pipeline's stages on awkward rows."""

import math
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from donorloom.llm import licenses, quality, simhash

LONG = "word " * 40_000


# ---- classifier ---------------------------------------------------------------------------

def plain_statistics(text):
    """The sixteen statistics, counted character by character."""
    text = text or ""
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    n, m, k = max(1, len(text)), max(1, len(words)), max(1, len(lines))
    data = text.encode()
    upper = sum(65 <= b <= 90 for b in data)
    lower = sum(97 <= b <= 122 for b in data)
    lead = sum(b >= 192 for b in data)  # first bytes of characters beyond ASCII
    digits = sum(48 <= b <= 57 for b in data)
    plain = sum(chr(b) in ".,;:'\"?-()" for b in data if b < 128)
    white = sum(b in b" \t\n\x0b\x0c\r" for b in data)
    other = sum(b < 128 for b in data) - upper - lower - digits - plain - white
    share = lambda a, b: math.asin(math.sqrt(min(1.0, a / b)))
    return [
        math.log1p(len(text)), math.log1p(len(words)), math.log1p((upper + lower + lead) / m), share(sum(len(w) > 1 and w.isupper() for w in words), m),
        share(digits, n), share(other, n), share(plain, n), share(lead, n), share(len(set(words)), m), share(max([words.count(w) for w in set(words)], default=0), m),
        share(len(lines) - len(set(lines)), k), math.log1p(len(text) / k), share(sum(not w[-1].isalnum() for w in words), m),
        share(sum(w[0].isupper() for w in words), m), share(sum(len(w) > 20 for w in words), m), share(sum(a == b for a, b in zip(words, words[1:])), m)]


def plain_scores(texts, labels, shrink=0.1, floor=0.02):
    """Score by row: posterior odds of two normal densities with shrunk covariances, by determinants and solved equations."""
    x = np.array([[round(v * 1000) / 1000 for v in plain_statistics(t)] for _, t in texts])
    own = [labels.get(i) if i is not None and zlib.crc32(str(i).encode()) % 3 != 1 else None for i, _ in texts]
    groups = [x[[o == c for o in own]] for c in (0, 1)]
    means = [g.mean(0) for g in groups]
    cov = [np.cov(g.T, bias=True) for g in groups]
    n = [len(g) for g in groups]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / sum(n)
    d = x.shape[1]
    used = [(1 - shrink) * c + shrink * pooled + (floor * np.trace(pooled) / d + 1e-12) * np.eye(d) for c in cov]
    density = []
    for k in (0, 1):
        far = x - means[k]
        density.append(np.log(n[k]) - 0.5 * np.linalg.slogdet(used[k])[1] - 0.5 * np.einsum("ij,ij->i", far, np.linalg.solve(used[k], far.T).T))
    return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def test_quality_against_a_plain_discriminant(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = [tuple(r) for r in docs.collect()]
    known = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] in (0, 1)}
    odd = [(10 ** 9, None), (10 ** 9 + 1, ""), (10 ** 9 + 2, " \n\t"), (10 ** 9 + 3, "ÄÖ 漢字 ½\n" * 40), (10 ** 9 + 4, "AAA!! 12 " * 3000), (10 ** 9 + 5, "x")]
    every = rows + odd
    got = {r["doc_id"]: r for r in quality.quality_scores(spark.createDataFrame(every, "doc_id long, text string"), labels).collect()}
    want = plain_scores(every, known)
    assert len(got) == len(every) > 200
    for (i, _), score in zip(every, want):
        assert got[i]["score"] == pytest.approx(score, abs=1e-6), i
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert got[i]["predicted"] == int(got[i]["score"] >= 0.5)
    assert 0 < sum(want >= 0.5) < len(want)


# ---- licences ------------------------------------------------------------------------------

class Parser:
    """Recursive descent over tokens: or, then and, then with."""

    def __init__(self, tokens):
        self.tokens, self.at = tokens, 0

    def next(self):
        return self.tokens[self.at] if self.at < len(self.tokens) else None

    def level(self, operator, below, join):
        value = below()
        while self.next() == operator:
            self.at += 1
            value = join(value, below())
        return value

    def whole(self):
        value = self.any_of()
        if self.at < len(self.tokens):
            raise ValueError
        return value

    def any_of(self):
        return self.level("or", self.all_of, lambda a, b: (max(a[0], b[0]), a[1] + b[1]))

    def all_of(self):
        return self.level("and", self.excepted, lambda a, b: (min(a[0], b[0]), a[1] + b[1]))

    def excepted(self):
        return self.level("with", self.one, lambda a, b: (a[0] + licenses.EXCEPTION * (1 - a[0]), a[1]))

    def one(self):
        token = self.next()
        self.at += 1
        if token == "(":
            value = self.any_of()
            if self.next() != ")":
                raise ValueError
            self.at += 1
            return value
        if token is None or token in (")", "or", "and", "with"):
            raise ValueError
        return licenses.FREEDOM.get(plain_family(token), licenses.UNKNOWN), [token]


def plain_family(token):
    for start, label in licenses.FAMILIES:
        if token == start or token[:len(start) + 1] in (start + "-", start + "+"):
            return label


def plain_tokens(line):
    out, i = [], 0
    inside = set("abcdefghijklmnopqrstuvwxyz0123456789.+-:")
    while i < len(line):
        if line[i] in " \t":
            i += 1
        elif line[i] in "()":
            out.append(line[i])
            i += 1
        elif line[i] in inside - set(".+-:"):
            j = i
            while j < len(line) and line[j] in inside:
                j += 1
            out.append(line[i:j].rstrip(".:"))
            i = j
        else:
            break
    return out


def plain_scan(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c.isascii() and not (c.isdigit() or "a" <= c <= "z"):
            words += [word] if word else []
            word = ""
        else:
            word += c
    phrases = {**licenses.BASE, **licenses.MORE, **licenses.NON_COMMERCIAL}
    places = [(i, p) for p in phrases for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    base = [(i, p) for i, p in places if p in licenses.BASE]
    labels, limits, found = {phrases[p] for _, p in places}, [licenses.FREEDOM[phrases[p]] for _, p in places], []
    for part in low.split(licenses.TAG)[1:]:
        tokens = plain_tokens(part.split("\n")[0])
        while tokens:
            try:
                value, names = Parser(tokens).whole()
            except ValueError:
                tokens = tokens[:-1]
                continue
            limits.append(value)
            found += names
            labels |= {plain_family(t) for t in names} - {None}
            break
    starts = [i for i, _ in base]
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({phrases[p] for _, p in base})),
            ",".join(sorted(labels)), pytest.approx(min(limits, default=0.0)), found)


def test_licenses_against_a_plain_search(spark, sf):
    rng = random.Random(21)
    phrases = [*licenses.BASE, *licenses.MORE, *licenses.NON_COMMERCIAL]
    parts = [*phrases, *(p.upper() for p in phrases), "cc", "by", "cc by cc", "license", "gnu", "mit", "apache-license", "public", "é", "漢字", "x1"]
    tag = ["MIT", "GPL-2.0+", "Apache-2.0", "OR", "AND", "with", "(", ")", "or", "x-y", "LGPL-3.0", "CC-BY-4.0.", "Unlicense", "!", "mitx"]
    texts = []
    for _ in range(400):
        text = []
        for _ in range(rng.randint(0, 14)):
            text.append(rng.choice(parts) + rng.choice([" ", "\n", ", ", "-", "_", "\t", ""]))
            if rng.random() < 0.15:
                text.append("SPDX-License-Identifier:" + " ".join(rng.choice(tag) for _ in range(rng.randint(0, 8))) + rng.choice(["\n", " ", ""]))
        texts.append("".join(text))
    texts += [None, "", LONG + "mit license"] + [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in licenses.license_scan(table).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert got[i] == plain_scan(text), text
    assert sum(bool(g[-1]) for g in got.values()) > 50 and sum(g[1] > 1 for g in got.values()) > 50


# ---- pipeline ------------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, n_chars long, quality int, fp long, held_out boolean, score double, n int"
ROWS = [(1, "a b c d"), (2, "a b c d"), (2, "a b c d"), (3, None), (4, ""), (None, "x y z"), (None, None), (5, LONG), (6, "漢字" * 3000)]


def test_filtering_stages_on_awkward_rows(spark):
    docs = spark.createDataFrame([(i, t, None, "s", 0, 0, 0, False, 0.0, 0) for i, t in ROWS], DOCS)
    labels = spark.createDataFrame([(1, 1, 9), (None, 0, 9), (3, None, 9), (3, 0, 9)], "doc_id long, quality int, score int")
    kept = quality.keep_good(docs, labels)
    # Fewer than two examples of a class: every score is the share of class 1, so all rows fare alike.
    assert kept.columns == docs.columns and kept.count() in (0, len(ROWS))
    near = simhash.drop_near_copies(docs)
    assert near.columns == docs.columns and {r["doc_id"] for r in near.collect()} >= {1, 5, 6}
    empty = docs.limit(0)
    assert quality.keep_good(empty, labels).collect() == [] and quality.keep_good(docs, labels.limit(0)).count() == len(ROWS)
    assert simhash.drop_near_copies(empty).collect() == []


def test_pipeline_on_an_empty_table(spark, sf, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "ids", "n_pieces", "lossless"] and out.collect() == []
