"""Licence notices and identifier tags: Aho-Corasick search and a shunting-yard parser for expressions."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Notice phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Labels that the method adds: further notices, and families of identifiers in tags.
MORE = {
    "mozilla public license": "mpl", "bsd license": "bsd", "isc license": "isc", "eclipse public license": "epl",
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl",
    "all rights reserved": "reserved", "public domain": "public-domain",
}
NON_COMMERCIAL = {"cc by nc": "nc", "cc by nd": "nd"}
TAG = "spdx-license-identifier:"
FAMILIES = (("agpl", "agpl"), ("lgpl", "lgpl"), ("gpl", "gpl"), ("apache", "apache"), ("mit", "mit"), ("bsd", "bsd"),
            ("isc", "isc"), ("mpl", "mpl"), ("epl", "epl"), ("cc0", "public-domain"), ("unlicense", "public-domain"),
            ("cc-by", "cc-by"))
#: How freely text under a label may be reused, 0 to 1. Unknown identifiers count as UNKNOWN.
FREEDOM = {"public-domain": 1.0, "mit": 1.0, "bsd": 1.0, "isc": 1.0, "apache": 0.95, "cc-by": 0.9, "mpl": 0.7,
           "epl": 0.7, "lgpl": 0.6, "gpl": 0.4, "agpl": 0.3, "nc": 0.2, "nd": 0.2, "reserved": 0.0}
UNKNOWN = 0.5
EXCEPTION = 0.2  # what an exception ("with") gives back of the freedom that its licence takes

_GAP = re.compile("[\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+\-:]*")
RANK = {"or": 1, "and": 2, "with": 3}


@cache
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, label in {**BASE, **MORE, **NON_COMMERCIAL}.items():
        found.add_word(f" {phrase} ", (len(phrase) + 2, label, phrase in BASE))
    found.make_automaton()
    return found


@cache
def _tags() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word(TAG, TAG)
    found.make_automaton()
    return found


def family(identifier: str) -> str | None:
    return next((label for start, label in FAMILIES if identifier == start or identifier.startswith((start + "-", start + "+"))), None)


def to_postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operands in order, operators after them; raises ValueError where the expression is malformed."""
    out, held, operand = [], [], False
    for t in tokens:
        if t == "(":
            if operand:
                raise ValueError("operator missing")
            held.append(t)
        elif t == ")":
            if not operand:
                raise ValueError("operand missing")
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                raise ValueError("unbalanced")
            held.pop()
        elif t in RANK:
            if not operand:
                raise ValueError("operand missing")
            while held and held[-1] != "(" and RANK[held[-1]] >= RANK[t]:
                out.append(held.pop())
            held.append(t)
            operand = False
        else:
            if operand:
                raise ValueError("operator missing")
            out.append(t)
            operand = True
    if not operand or "(" in held:
        raise ValueError("incomplete")
    return out + held[::-1]


def evaluate(tokens: list[str]) -> tuple[float, list[str]]:
    """Freedom and identifiers of an expression: "or" takes the freer side, "and" the stricter, "with" loosens."""
    stack: list[tuple[float, list[str]]] = []
    for t in to_postfix(tokens):
        if t not in RANK:
            stack.append((FREEDOM.get(family(t) or "", UNKNOWN), [t]))
            continue
        (b, right), (a, left) = stack.pop(), stack.pop()
        if t == "or":
            stack.append((max(a, b), left + right))
        elif t == "and":
            stack.append((min(a, b), left + right))
        else:
            stack.append((a + EXCEPTION * (1 - a), left))
    return stack[0]


def _expression(text: str, at: int) -> tuple[float, list[str]] | None:
    """The expression after a tag: the longest well-formed beginning of the rest of its line."""
    end = text.find("\n", at)
    tokens = []
    place = at
    for m in _TOKEN.finditer(text, at, len(text) if end < 0 else end):
        if text[place:m.start()].strip(" \t"):
            break
        tokens.append(m.group().rstrip(".:") or m.group())
        place = m.end()
    while tokens:
        try:
            return evaluate(tokens)
        except ValueError:
            tokens.pop()
    return None


def scan(text: str | None) -> tuple[int, int, int | None, int | None, str, str, float, list[str]]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, identifiers of one whole text."""
    low = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes: A-Z only
    words = _GAP.sub(" ", low).strip(" ")
    spaced = f" {words} " if words else ""
    n_words = words.count(" ") + 1 if words else 0
    base, labels, starts, n_base = set(), set(), [], 0
    place, word = 0, 0
    hits = sorted((end - size + 1, label, own) for end, (size, label, own) in _automaton().iter(spaced)) if spaced else []
    for start, label, own in hits:
        word += spaced.count(" ", place, start)
        place = start
        labels.add(label)
        if own:
            base.add(label)
            starts.append(word)
            n_base += 1
    limits = [FREEDOM[label] for label in labels]
    identifiers: list[str] = []
    for end, tag in _tags().iter(low) if TAG in low else ():
        if (found := _expression(low, end + 1)) is not None:
            limits.append(found[0])
            identifiers += found[1]
            labels |= {f for i in found[1] if (f := family(i))}
    score = min(limits) if limits else 0.0
    return (n_words, n_base, min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), score, identifiers)


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, identifiers array<string>")


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``; see ``SCHEMA``.

    A-Z are lower-cased and words are runs of letters, digits and non-ASCII
    characters. base_labels come from the phrases in ``BASE``, whose places are
    counted; labels also hold those of ``MORE``, of non-commercial clauses and of
    the families of identifiers in tags. score is the freedom of the strictest
    notice or expression found, 0 without any. A malformed expression counts as
    far as it is well-formed. A null text is empty: no words, no labels. Repeated
    rows are repeated, an empty table gives an empty one, other columns are not
    looked at.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string())]
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in batches:
            found = list(zip(*(scan(t.as_py()) for t in batch.column(1)))) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(v), k) for v, k in zip(found, kinds))], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(make, SCHEMA)
