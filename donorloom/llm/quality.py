"""Document quality by a regularised quadratic discriminant on document statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from donorloom.session import durable

FEATURES = ("chars", "words", "word_length", "upper", "digits", "marks", "stops", "other", "distinct", "top_word",
            "repeated_lines", "line_length", "marked_words", "capital_words", "long_words", "runs")
UNIT = 1000  # statistics are held as integers in thousandths, so sums do not depend on their order
SHRINK = 0.1  # weight of the pooled covariance in each class
FLOOR = 0.02  # weight of the pooled variances' mean, on the diagonal
MARGIN = 1e-12

_PLAIN = ".,;:'\"?-()"


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of a whole text: logarithms of sizes, arcsine roots of shares. Null is empty."""
    text = text or ""
    words = text.split()
    n, m = max(1, len(text)), max(1, len(words))
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    k = max(1, len(lines))
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    hist = np.bincount(raw, minlength=256)
    letters = hist[65:91].sum() + hist[97:123].sum() + hist[192:].sum()
    plain = sum(hist[ord(c)] for c in _PLAIN)
    digits, white = hist[48:58].sum(), hist[9:14].sum() + hist[32]
    other = hist[:128].sum() - hist[65:91].sum() - hist[97:123].sum() - plain - digits - white
    ends = sum(1 for w in words if not w[-1].isalnum())
    capitals = sum(1 for w in words if w[0].isupper())
    upper = sum(1 for w in words if w.isupper() and len(w) > 1)
    runs = sum(1 for a, b in zip(words, words[1:]) if a == b)
    log = lambda x: float(np.log1p(x))
    share = lambda a, b: float(np.arcsin(np.sqrt(min(1.0, a / b))))
    return [
        log(len(text)), log(len(words)), log(letters / m), share(upper, m), share(digits, n), share(other, n),
        share(plain, n), share(hist[192:].sum(), n), share(len(counts), m), share(max(counts.values(), default=0), m),
        share(len(lines) - len(set(lines)), k), log(len(text) / k), share(ends, m), share(capitals, m),
        share(sum(1 for w in words if len(w) > 20), m), share(runs, m),
    ]


@dataclass(frozen=True)
class Model:
    """Two Gaussian classes; the factors of their covariances are computed once and kept."""

    means: np.ndarray
    factors: tuple[np.ndarray, np.ndarray]  # inverses of the lower Cholesky factors
    offset: float  # log prior odds and half the difference of log determinants
    fitted: bool

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for rows of statistics: the sigmoid of the difference of log densities."""
        if not self.fitted:
            return np.full(len(x), self.offset)
        far = [(((x - m) @ f.T) ** 2).sum(1) for m, f in zip(self.means, self.factors)]
        return 1 / (1 + np.exp(np.clip(-(self.offset + 0.5 * (far[0] - far[1])), -700, 700)))


def fit(rows: list[tuple[int, int, np.ndarray, np.ndarray]]) -> Model:
    """From (class, number, sums, sums of products) of each class. With fewer than two rows in a class the score is
    the share of class 1, or 0.5 without any label."""
    d = len(FEATURES)
    by = {c: (n, s / UNIT, p / UNIT ** 2) for c, n, s, p in rows}
    if any(by.get(c, (0,))[0] < 2 for c in (0, 1)):
        total = sum(v[0] for v in by.values())
        return Model(np.zeros((2, d)), (np.eye(d), np.eye(d)), by.get(1, (0,))[0] / total if total else 0.5, False)
    means = np.stack([by[c][1] / by[c][0] for c in (0, 1)])
    own = [by[c][2] / by[c][0] - np.outer(means[c], means[c]) for c in (0, 1)]
    n = np.array([by[c][0] for c in (0, 1)], float)
    pooled = (n[0] * own[0] + n[1] * own[1]) / n.sum()
    ridge = FLOOR * np.trace(pooled) / d + MARGIN
    chol = [np.linalg.cholesky((1 - SHRINK) * s + SHRINK * pooled + ridge * np.eye(d)) for s in own]
    half = [np.log(np.diag(c)).sum() for c in chol]
    return Model(means, tuple(np.linalg.inv(c) for c in chol), float(np.log(n[1] / n[0]) + half[0] - half[1]), True)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def _with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, one integer per statistic) for every row of docs(doc_id, text)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column(1)]).reshape(batch.num_rows, len(FEATURES))
            x = np.round(x * UNIT).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x[:, i]) for i in range(x.shape[1]))],
                                             ["doc_id", *FEATURES])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        make, ", ".join(["doc_id long", *(f"{f} long" for f in FEATURES)]))


def training_labels(labels: DataFrame) -> DataFrame:
    """One quality, 0 or 1, per doc_id that may be learned from. Of several the largest counts."""
    rows = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("quality"))
    return rows.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max("quality").alias("quality"))


def _learn(stats: DataFrame, labels: DataFrame) -> Model:
    """Counts, sums and products per class: exact integers, added on the cluster; two rows come back."""
    d = len(FEATURES)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    got = stats.join(training_labels(labels), "doc_id").groupBy("quality").agg(
        F.count(F.lit(1)), *[F.sum(f) for f in FEATURES],
        *[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])) for i, j in pairs]).collect()
    rows = []
    for r in sorted(got):
        products = np.zeros((d, d))
        for (i, j), v in zip(pairs, r[2 + d:]):
            products[i, j] = products[j, i] = v
        rows.append((r[0], r[1], np.array(r[2:2 + d], float), products))
    return fit(rows)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, held_out, score, predicted.

    The classes are learned from ``labels(doc_id, quality)`` where crc32 of the
    id's text modulo 3 is not 1; null ids and labels other than 0 and 1 are not
    learned from. score is the probability of quality 1, predicted is 1 from 0.5
    on. Null and empty texts are scored as texts without words. Rows without an
    id are scored, held_out is false there. With fewer than two examples of a
    class every score is the share of class 1, without labels 0.5. Repeated rows
    are scored alike, an empty table gives an empty one, other columns are not
    looked at.
    """
    stats = durable(_with_statistics(docs))
    model = _learn(stats, labels)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([c.to_numpy() for c in batch.columns[1:]], 1) / UNIT
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x))], ["doc_id", "score"])

    scored = stats.mapInArrow(make, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns. See ``quality_scores``."""
    learn_from = docs.select("doc_id", "text").join(training_labels(labels).select("doc_id"), "doc_id", "left_semi")
    model = _learn(_with_statistics(learn_from), labels)

    def judge(texts: pa.Array) -> pa.Array:
        x = np.array([statistics(t.as_py()) for t in texts]).reshape(len(texts), len(FEATURES))
        return pa.array(model.scores(np.round(x * UNIT) / UNIT) >= 0.5)

    good = F.arrow_udf(judge, "boolean")
    return docs.filter(good(F.col("text").cast("string")))
