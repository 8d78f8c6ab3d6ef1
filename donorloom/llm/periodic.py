"""Runs of repeated words, found on a grammar of the texts.

A run is a stretch of consecutive words with a smallest period q that is at
least ``min_words`` and three periods long and that no neighbouring word
extends. A task takes texts of about a million characters at a time:

1. Re-Pair: pairs of neighbouring symbols that occur twice or more become
   nonterminals, the most frequent ones first; of pairs that share a symbol the
   more frequent one wins, so all places are decided in one pass, and passes go on
   until no pair repeats. The grammar is shared by the texts of the task.
2. Every run crosses a border between two symbols of a text's last sequence, or
   the border inside exactly one nonterminal on the way down to it. So runs are
   looked for at those borders only, for a nonterminal once, at one place.
3. The larger side of a run at a border holds half of it. So the words beside the
   border occur again one period away, over half a period at least. Places of
   equal stretches of 2**j words, found by doubling, give the periods to try, and
   the same ranks give how far the period holds on both sides.
4. Runs of a nonterminal are put at all places where its derivation occurs;
   intervals of one period that lie inside longer ones are dropped, and of equal
   intervals the smallest period stays.

All steps are array operations over the texts of a task; results do not depend on
which texts share one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorloom.llm.common import pieces

PERIODS = 3  # a run has three periods at least
CANDIDATES = 1 << 21  # places and periods tried at a time
RUN = "struct<start: bigint, length: bigint, period: bigint>"


@dataclass
class Grammar:
    """Symbols below ``words`` are words; symbol ``words + i`` derives ``left[i]``, ``right[i]``."""

    words: int
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray  # words that a symbol derives, of all symbols
    place: np.ndarray  # one place where nonterminal i is derived
    symbols: np.ndarray  # the last sequence
    start: np.ndarray  # where its symbols begin
    text: np.ndarray  # the text each belongs to
    levels: list[int]  # number of nonterminals after each pass


def _mixed(keys: np.ndarray) -> np.ndarray:
    """An order among equally frequent pairs that does not follow their numbers."""
    h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _odd_overlaps(same: np.ndarray) -> np.ndarray:
    """In stretches of one repeated symbol every second pair, as it overlaps the one before."""
    at = np.arange(len(same))
    begin = np.maximum.accumulate(np.where(same & ~np.r_[False, same[:-1]], at, 0))
    return same & ((at - begin) % 2 == 1)


def re_pair(ids: np.ndarray, text: np.ndarray) -> Grammar:
    """A grammar of the words ``ids`` of texts numbered by ``text``; pairs never cross from one text to the next."""
    words = int(ids.max()) + 1 if len(ids) else 0
    s, start, doc = ids.astype(np.int64), np.arange(len(ids)), text
    left, right, place, levels = [], [], [], []
    length, made = np.ones(words, np.int64), words
    while len(s) > 1:
        inside = doc[:-1] == doc[1:]
        at = np.flatnonzero(inside & ~_odd_overlaps(inside & (s[:-1] == s[1:])))
        found, group, count = np.unique(s[at] * made + s[at + 1], return_inverse=True, return_counts=True)
        rank = np.empty(len(found), np.int64)
        rank[np.lexsort((_mixed(found), -count))] = np.arange(len(found))
        often = count[group] > 1
        order = np.full(len(s) + 1, len(found))  # of the pair that begins one place before, with an edge on both sides
        order[at[often] + 1] = rank[group[often]]
        chosen = often & (order[at + 1] < order[at]) & (order[at + 1] < order[np.minimum(at + 2, len(s))])
        chosen &= np.bincount(group[chosen], minlength=len(found))[group] > 1
        at, group = at[chosen], group[chosen]
        if len(at) == 0:
            break
        _, first, number = np.unique(group, return_index=True, return_inverse=True)
        first = at[first]
        left.append(s[first])
        right.append(s[first + 1])
        place.append(start[first])
        length = np.concatenate([length, length[s[first]] + length[s[first + 1]]])
        s = s.copy()
        s[at] = made + number
        keep = np.ones(len(s), bool)
        keep[at + 1] = False
        s, start, doc = s[keep], start[keep], doc[keep]
        made += len(first)
        levels.append(made)
    flat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return Grammar(words, flat(left), flat(right), length, flat(place), s, start, doc, levels)


def repeated_ranks(ids: np.ndarray, text: np.ndarray) -> list[np.ndarray]:
    """For j = 0, 1, ...: a number for the 2**j words from each place, equal for equal ones of one text, -1 where they do not repeat."""
    n, out = len(ids), []

    def ranked(at: np.ndarray, keys: np.ndarray) -> np.ndarray:
        rank = np.full(n, -1, np.int32)
        _, group, count = np.unique(keys, return_inverse=True, return_counts=True)
        more = count[group] > 1
        rank[at[more]] = group[more]
        return rank

    rank = ranked(np.arange(n), text * (int(ids.max(initial=0)) + 1) + ids)
    step = 1
    while (rank >= 0).any():
        out.append(rank)
        at = np.flatnonzero(rank[: max(n - step, 0)] >= 0)
        at = at[(rank[at + step] >= 0) & (text[np.minimum(at + 2 * step - 1, n - 1)] == text[at]) & (at + 2 * step <= n)]
        rank = ranked(at, rank[at].astype(np.int64) * n + rank[at + step])
        step *= 2
    return out


def _forward(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray, high: np.ndarray) -> np.ndarray:
    """How many words from ``a`` and from ``b > a`` on are equal, before ``high``."""
    t = np.zeros(len(a), np.int64)
    for j in range(len(ranks) - 1, -1, -1):
        fits = b + t + (1 << j) <= high
        x, y = ranks[j][np.where(fits, a + t, 0)], ranks[j][np.where(fits, b + t, 0)]
        t += np.where(fits & (x == y) & (x >= 0), 1 << j, 0)
    return t


def _backward(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray, low: np.ndarray) -> np.ndarray:
    """How many words before ``a`` and before ``b > a`` are equal, not before ``low``."""
    t = np.zeros(len(a), np.int64)
    for j in range(len(ranks) - 1, -1, -1):
        fits = a - t - (1 << j) >= low
        x, y = ranks[j][np.where(fits, a - t - (1 << j), 0)], ranks[j][np.where(fits, b - t - (1 << j), 0)]
        t += np.where(fits & (x == y) & (x >= 0), 1 << j, 0)
    return t


def _unfold(begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i the numbers begin[i] to begin[i] + count[i] - 1, with i beside them."""
    row = np.repeat(np.arange(len(begin)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + begin[row]


def runs_at(ranks: list[np.ndarray], border: np.ndarray, low: np.ndarray, high: np.ndarray, min_words: int) -> tuple[np.ndarray, ...]:
    """(number of the border, start, end, period) of runs of ``low`` to ``high`` that cross ``border``; periods need not be smallest.

    Inside a run found before, a stretch of two of its periods or more occurs at
    multiples of the period only, and those give the same run. So the search
    goes on outside of it: texts of one repeated word cost no more than others.
    """
    n = len(ranks[0]) if ranks else 0
    found = [np.zeros((4, 0), np.int64)]
    known = np.stack([border, border, np.full(len(border), n)])  # start, end, period of the run of smallest period so far
    least = max(0, (min_words // 6).bit_length() - 1)  # a sixth of the shortest run is beside the border at least
    for j in range(least, len(ranks)):
        size, rank = 1 << j, ranks[j]
        near, far = (1 if j == least else 2 * size), 4 * size  # the periods that stretches of this size stand for
        at = np.flatnonzero(rank >= 0)
        keys = np.sort(rank[at].astype(np.int64) * n + at)
        for side in (0, -size):  # the stretch after the border, and the one before it
            own = border + side
            fits = (own >= low) & (own + size <= high)
            which = np.flatnonzero(fits & (rank[np.where(fits, own, 0)] >= 0))
            own = own[which]
            if side == 0:
                a, b = own + near, np.minimum(own + far, high[which] - size + 1)
            else:
                a, b = np.maximum(own - far + 1, low[which]), own - near + 1
            inside = (2 * known[2, which] <= size) & (own >= known[0, which]) & (own + size <= known[1, which])
            if side == 0:
                a = np.where(inside, np.maximum(a, known[1, which] - size + 1), a)
            else:
                b = np.where(inside, np.minimum(b, known[0, which]), b)
            base = rank[own].astype(np.int64) * n
            first = np.searchsorted(keys, base + a)
            count = np.maximum(np.searchsorted(keys, base + np.maximum(a, b)) - first, 0)
            edges = np.flatnonzero(np.diff(np.cumsum(count) // CANDIDATES, prepend=0))
            for x, y in zip(np.r_[0, edges], np.r_[edges, len(which)]):
                row, key = _unfold(first[x:y], count[x:y])
                row, other = which[x:y][row], keys[key] % n
                here = border[row] + side
                a0, b0 = np.minimum(here, other), np.maximum(here, other)
                s = a0 - _backward(ranks, a0, b0, low[row])
                e = b0 + _forward(ranks, a0, b0, high[row])
                good = e - s >= np.maximum(min_words, PERIODS * (b0 - a0))
                found.append(np.unique(np.stack([row, s, e, b0 - a0])[:, good], axis=1))
        row, s, e, q = np.concatenate(found, axis=1)
        order = np.lexsort((-q, row))  # of several runs of a border the last one stays, that of the smallest period
        known[:, row[order]] = s[order], e[order], q[order]
    return tuple(np.concatenate(found, axis=1))


def _derived(g: Grammar, owner: np.ndarray, s: np.ndarray, e: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of nonterminals (``owner``, relative to its place) at all places where a text derives the nonterminal."""
    order = np.argsort(owner, kind="stable")
    owner, s, e, q = owner[order], s[order], e[order], q[order]
    own = np.bincount(owner, minlength=len(g.left))
    begin = np.cumsum(own) - own
    marked = np.zeros(len(g.length), bool)  # derives a run somewhere below
    for a, b in zip([g.words, *g.levels], g.levels):
        i = slice(a - g.words, b - g.words)
        marked[a:b] = (own[i] > 0) | marked[g.left[i]] | marked[g.right[i]]
    keep = marked[g.symbols]
    symbol, place = g.symbols[keep], g.start[keep]
    out = [np.zeros((3, 0), np.int64)]
    while len(symbol):
        i = symbol - g.words
        row, run = _unfold(begin[i], own[i])
        out.append(np.stack([place[row] + s[run], place[row] + e[run], q[run]]))
        left, right = g.left[i], g.right[i]
        symbol, place = np.concatenate([left, right]), np.concatenate([place, place + g.length[left]])
        keep = marked[symbol]
        symbol, place = symbol[keep], place[keep]
    return tuple(np.concatenate(out, axis=1))


def maximal(s: np.ndarray, e: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Without intervals inside others of the same period, and of equal intervals only the smallest period; by start and period."""
    order = np.lexsort((-e, s, q))
    s, e, q = s[order], e[order], q[order]
    if len(s):
        beyond = int(e.max()) + 1
        reach = np.maximum.accumulate(q * beyond + e)
        keep = np.r_[True, (q * beyond + e)[1:] > reach[:-1]]
        s, e, q = s[keep], e[keep], q[keep]
        order = np.lexsort((q, e, s))
        s, e, q = s[order], e[order], q[order]
        keep = np.r_[True, (s[1:] != s[:-1]) | (e[1:] != e[:-1])]
        s, e, q = s[keep], e[keep], q[keep]
        order = np.lexsort((q, s))
        s, e, q = s[order], e[order], q[order]
    return s, e, q


def runs(ids: np.ndarray, text: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, as places in ``ids``, which holds the words of texts ``text`` one after the other."""
    if min_words < 2 * PERIODS:
        raise ValueError(f"runs have {2 * PERIODS} words at least")
    g = re_pair(ids, text)
    ranks = repeated_ranks(ids, text)
    n_texts = int(text[-1]) + 1 if len(text) else 0
    ends = np.searchsorted(text, np.arange(n_texts), side="right")
    begins = np.r_[0, ends[:-1]]
    beside = np.flatnonzero(g.text[1:] == g.text[:-1]) + 1
    own = np.flatnonzero(g.length[g.words:] >= min_words)
    inner = g.place[own]
    row, s, e, q = runs_at(
        ranks, np.concatenate([g.start[beside], inner + g.length[g.left[own]]]),
        np.concatenate([begins[g.text[beside]], inner]), np.concatenate([ends[g.text[beside]], inner + g.length[g.words + own]]), min_words)
    top = row < len(beside)
    nonterminal = own[row[~top] - len(beside)]
    below = _derived(g, nonterminal, s[~top] - g.place[nonterminal], e[~top] - g.place[nonterminal], q[~top])
    return maximal(*(np.concatenate(pair) for pair in zip((s[top], e[top], q[top]), below)))


def _texts(batch: pa.RecordBatch, min_words: int) -> tuple[list, list, list[str]]:
    """Offsets of the runs of each text, the runs, and the texts without what repeats."""
    split = [(t or "").encode("utf-8", "surrogatepass").split() for t in batch.column("text").to_pylist()]
    sizes = np.array([len(w) for w in split], np.int64)
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for words in split for w in words), np.int64, int(sizes.sum()))
    s, e, q = runs(ids, np.repeat(np.arange(len(split)), sizes), min_words)
    # A text's runs lie between its first place and the next text's; a word goes if it is after the first period of a run.
    ends = np.cumsum(sizes)
    offsets = np.searchsorted(s, np.r_[0, ends])
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, s + q, 1)
    np.add.at(cover, e, -1)
    stays = np.cumsum(cover)[:-1] == 0
    kept = []
    for i, words in enumerate(split):
        own = stays[ends[i] - sizes[i]:ends[i]]
        kept.append(b" ".join(words if own.all() else [w for w, k in zip(words, own.tolist()) if k]).decode("utf-8", "surrogatepass"))
    first = np.repeat(ends - sizes, np.diff(offsets))
    return offsets.tolist(), [s - first, e - s, q], kept


def periodic_runs(docs: DataFrame, min_words: int = 24) -> DataFrame:
    """(doc_id, runs, collapsed) for every row of ``docs(doc_id, text)``; other columns are left out.

    Words are what ``[\\x20\\x09-\\x0D]+`` separates. ``runs`` holds (start word,
    length, period) by start, then period; ``collapsed`` is the text without the
    words of a run after its first period, joined by one space. Null, empty and
    blank texts have no words: no runs, an empty text. Repeated rows and rows
    without an id are handled one by one.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            offsets, columns, kept = _texts(batch, min_words)
            names = ["start", "length", "period"]
            spans = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans), pa.array(kept, pa.string())],
                names=["doc_id", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        work, f"doc_id long, runs array<{RUN}>, collapsed string")
