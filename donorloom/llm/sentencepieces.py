"""Encoding with seeded merge-dropout, and decoding, for merge-type SentencePiece models."""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorloom.llm.common import HOT_KEYS, PIECE_BYTES
from donorloom.llm.common import pieces as slices
from donorloom.session import durable

SPACE = "▁"
DROPOUT = 0.1
SEED = 42
MEMO = 600_000  # segmentations that a Python worker holds
ROWS = 4096  # texts that are encoded at once
WIDE = 48  # words of more characters go through the agenda one by one
_WORD = re.compile(f" *[^ \n{SPACE}]+| +|[\n{SPACE}]")  # no merge crosses these borders
NONE = np.int64(-1)
NOWHERE = np.uint64(2 ** 64 - 1)  # no place of a candidate
MASK, LOW = 2 ** 64 - 1, 2 ** 40 - 1
STEP = np.uint64(0x9E3779B97F4A7C15)  # between the states of splitmix64


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, a keyed hash of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Model:
    """Pieces, scores and merges of a model file, and what has been segmented so far."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        normal = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(n)]
        self.ids = {p: i for i, p in enumerate(names) if normal[i]}
        self.scores = np.array([sp.get_score(i) for i in range(n)])
        self.rank = np.unique(-self.scores, return_inverse=True)[1].tolist()  # best score first, equal for equal scores
        self.bytes = np.array([next((i for i in range(n) if sp.is_byte(i) and int(names[i][1:-1], 16) == b), -1) for b in range(256)], np.int32)
        if (self.bytes < 0).any():
            raise ValueError("the model has no byte pieces, so not every text can be decoded")
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids):
            raise ValueError("the model merges across words")
        self.prefix = sp.encode("a", out_type=str)[0].startswith(SPACE)
        self.length = [len(p) for p in names]
        self.chars = np.full(0x110000, NONE, np.int64)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.chars[ord(p)] = i
        # Pairs that merge, in an open hash table of their two ids.
        pairs = {(self.ids[p[:k]], self.ids[p[k:]]): i for p, i in self.ids.items() for k in range(1, len(p))
                 if p[:k] in self.ids and p[k:] in self.ids}
        self.pairs = pairs
        self.bits = max(4, int(len(pairs) * 4).bit_length())
        self.slot_key = np.full(1 << self.bits, NONE, np.int64)
        self.slot_value = np.zeros(1 << self.bits, np.int64)
        for (a, b), i in pairs.items():
            key = a << 32 | b
            at = int(_slot(np.array([key], np.int64), self.bits)[0])
            while self.slot_key[at] != NONE:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.slot_key[at], self.slot_value[at] = key, i
        # What ids decode to, one after another in one buffer.
        texts = [p.replace(SPACE, " ").encode() if normal[i] else b"" for i, p in enumerate(names)]
        for b, i in enumerate(self.bytes):
            texts[i] = bytes([b])
        self.text = np.frombuffer(b"".join(texts), np.uint8)
        self.text_at = np.cumsum([0, *map(len, texts)])
        self.clear()

    def clear(self) -> None:
        """Forget all segmentations. One is a word and the candidates skipped in it: ``known`` has those without skips, and
        ``child`` leads from a merge of one to that in which it is the next skip."""
        self.known: dict[str, int] = {}
        self.whole: dict[str, int] = {}  # wide words without dropout
        self.words: list[str] = []
        self.held, self.used, self.flat, self.at = 0, 0, np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64)
        # Of each segmentation: its word, the one with a skip less, the place of the last skip, merges before it.
        self.word, self.parent = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)
        self.cause, self.before = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.int32)
        # The merges after its last skip.
        self.merges, self.merge_at = 0, np.zeros(1 << 16, np.int64)
        self.place, self.child, self.of = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)

    def keep(self, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Numbers of new segmentations, without merges."""
        n, held = len(counts), self.held
        for name in ("at", "word", "parent", "cause", "before", "merge_at"):
            setattr(self, name, _room(getattr(self, name), held + n + 1))
        self.flat = _room(self.flat, self.used + len(flat))
        self.flat[self.used:self.used + len(flat)] = flat
        self.at[held + 1:held + 1 + n] = self.used + np.cumsum(counts)
        self.merge_at[held + 1:held + 1 + n] = self.merges
        self.used += len(flat)
        self.held += n
        return np.arange(held, held + n)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Id of the piece that two symbols make, NONE where they make none."""
        out = np.full(len(a), NONE, np.int64)
        todo = np.flatnonzero((a >= 0) & (b >= 0))
        key = a[todo] << 32 | b[todo]
        at = _slot(key, self.bits)
        while len(todo):
            there = self.slot_key[at]
            hit = there == key
            out[todo[hit]] = self.slot_value[at[hit]]
            on = ~hit & (there != NONE)
            todo, key, at = todo[on], key[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return out


def _room(a: np.ndarray, n: int) -> np.ndarray:
    """``a`` with room for n values at least."""
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(len(a), n - len(a)), a.dtype)])


def _slot(key: np.ndarray, bits: int) -> np.ndarray:
    return (_mix(key.view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


def _place(i: np.ndarray, j: np.ndarray, e: np.ndarray) -> np.ndarray:
    """The candidate that joins characters i..j and j..e of a word, as one number."""
    return (i.astype(np.uint64) << np.uint64(42)) ^ (j.astype(np.uint64) << np.uint64(21)) ^ e.astype(np.uint64)


def _skipped(word: np.ndarray, place: np.ndarray, dropout: float) -> np.ndarray:
    """Whether a candidate is skipped: a hash of the mixed key of a word's occurrence and the place."""
    return (_mix(word ^ place) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53 < dropout


def _hashed(x: int) -> int:
    """``_mix`` of one value."""
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def agenda(model: Model, word: str, key: int, dropout: float) -> list[int]:
    """Symbols of one word by an agenda of candidate merges: best score first, leftmost first among equals; a candidate
    whose hash says so is skipped when its turn comes. NONE stands for a character that no piece has."""
    sym = [int(model.chars[ord(c)]) for c in word]
    n = len(sym)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    word_key, limit = _hashed(key & MASK), dropout * 2.0 ** 53
    pairs, rank, queue = model.pairs, model.rank, []  # the queue holds rank of the merge and character as one number

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (m := pairs.get((sym[i], sym[j]))) is not None:
            heapq.heappush(queue, rank[m] << 40 | i)

    for i in range(n - 1):
        offer(i)
    while queue:
        first = heapq.heappop(queue)
        i = first & LOW
        j = after[i]
        m = pairs.get((sym[i], sym[j])) if j < n else None
        if m is None or rank[m] != first >> 40:
            continue  # one of the two has merged otherwise since
        e = after[j]
        # The place of the candidate as in ``_place``; from character 2**22 on its first number loses its upper bits.
        if dropout > 0 and _hashed(word_key ^ ((i << 42 ^ j << 21 ^ e) & MASK)) >> 11 < limit:
            continue
        sym[i], sym[j], after[i] = m, -2, e
        if e < n:
            before[e] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(sym[i])
        i = after[i]
    return out


def _grid(model: Model, words: list[str], keys: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """The agenda for many short words at once. Symbols of all words in one array, and their number in each."""
    mixed = _mix(keys)
    return _rounds(model, words, lambda w, place: _skipped(mixed[w], place, dropout))[:2]


def _rounds(
    model: Model, words: list[str], skipped: Callable[[np.ndarray, np.ndarray], np.ndarray],
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """In every round each word makes the first merge of its agenda that ``skipped(word, place)`` leaves. Symbols of all
    words in one array, their number in each, and the merges as words and places, those of a word in their order."""
    lengths = np.array([len(w) for w in words])
    n, wide = len(words), int(lengths.max())
    code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    inside = np.arange(wide)[None] < lengths[:, None]
    sym = np.full((n, wide + 1), NONE, np.int64)
    sym[:, :wide][inside] = model.chars[code]
    after = np.minimum(np.arange(1, wide + 2)[None], lengths[:, None] + np.zeros(wide + 1, np.int64))
    before = np.tile(np.arange(-1, wide), (n, 1))
    made = np.full((n, wide + 1), NONE, np.int64)
    score = np.full((n, wide + 1), -np.inf)
    alive = np.zeros((n, wide + 1), bool)
    alive[:, :wide] = inside

    def offer(w: np.ndarray, i: np.ndarray) -> None:
        j = after[w, i]
        m = np.where(j < lengths[w], model.merged(sym[w, i], sym[w, j]), NONE)
        e = after[w, j]
        ok = m >= 0
        ok[ok] = ~skipped(w[ok], _place(i[ok], j[ok], e[ok]))
        made[w, i] = m
        score[w, i] = np.where(ok, model.scores[m], -np.inf)

    w, i = np.nonzero(inside)
    offer(w, i)
    live = np.arange(n)
    done, places = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    while len(live):
        i = score[live].argmax(1)
        on = score[live, i] > -np.inf
        live, i = live[on], i[on]
        if not len(live):
            break
        j = after[live, i]
        e = after[live, j]
        done.append(live)
        places.append(_place(i, j, e))
        sym[live, i] = made[live, i]
        alive[live, j], score[live, j] = False, -np.inf
        after[live, i] = e
        before[live, np.minimum(e, wide)] = i
        offer(live, i)
        prior = before[live, i]
        has = prior >= 0
        offer(live[has], prior[has])
    row = np.concatenate(done)
    order = row.argsort(kind="stable")
    return sym[alive], alive.sum(1), row[order], np.concatenate(places)[order]


def _learn(model: Model, word: np.ndarray, slots: np.ndarray | None = None) -> np.ndarray:
    """Segment ``model.words[word]`` and remember them: without skips, or with those of the segmentation that the merge
    ``slots`` belongs to and that merge. Numbers of the new segmentations."""
    found = np.zeros(len(word), np.int64)
    order = np.argsort([len(model.words[w]) for w in word.tolist()], kind="stable")
    for some in np.split(order, range(4000, len(order), 4000)):
        own = word[some]
        texts = [model.words[w] for w in own.tolist()]
        parent = np.full(len(some), -1) if slots is None else model.of[slots[some]]
        skips, before = [], np.zeros(len(some), np.int64)
        if slots is not None:
            skips.append(model.place[slots[some]])
            before = model.before[parent] + slots[some] - model.merge_at[parent]
            above = parent
            while (on := model.parent[above] >= 0).any():
                skips.append(np.where(on, model.cause[above], NOWHERE))
                above = np.where(on, model.parent[above], above)
        mask = lambda w, place: np.any([s[w] == place for s in skips], axis=0) if skips else np.zeros(len(w), bool)
        flat, counts, row, place = _rounds(model, [_spaced(t) for t in texts], mask)
        if (flat < 0).any() or SPACE in texts:
            flat, counts = _with_bytes(model, texts, flat, counts)
        new = model.keep(flat, counts)
        model.word[new], model.parent[new], model.before[new] = own, parent, before
        if skips:
            model.cause[new] = skips[0]
        per = np.bincount(row, minlength=len(some))
        late = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per) >= before[row]
        row, place = row[late], place[late]
        end = model.merges + len(row)
        for name in ("place", "child", "of"):
            setattr(model, name, _room(getattr(model, name), end))
        model.place[model.merges:end], model.child[model.merges:end], model.of[model.merges:end] = place, -1, new[row]
        model.merge_at[new + 1] = model.merges + np.cumsum(per - before)
        model.merges = end
        found[some] = new
    return found


def _spaced(word: str) -> str:
    return word if word == SPACE else word.replace(" ", SPACE)


def _walk(model: Model, node: np.ndarray, keys: np.ndarray, dropout: float) -> np.ndarray:
    """From the segmentation without skips to that with the skips of each occurrence's own key."""
    node, keys, at = node.copy(), _mix(keys), np.arange(len(node))
    while len(at):
        start = model.merge_at[node[at]]
        size = model.merge_at[node[at] + 1] - start
        ends = np.cumsum(size)
        row = np.repeat(np.arange(len(at)), size)
        merge = np.arange(len(row)) + np.repeat(start - (ends - size), size)
        hit = np.flatnonzero(_skipped(keys[at][row], model.place[merge], dropout))
        first = np.diff(row[hit], prepend=-1) > 0
        at, merge = at[row[hit[first]]], merge[hit[first]]
        new = np.unique(merge[model.child[merge] < 0])
        if len(new):
            made = _learn(model, model.word[model.of[new]], new)
            model.child[new] = made
        node[at] = model.child[merge]
    return node


def _with_bytes(model: Model, words: list[str], flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters without a piece as byte pieces, and the sign for spaces, where a text holds it, as well."""
    out = np.split(flat, np.cumsum(counts)[:-1])
    for k, part in enumerate(out):
        if words[k] == SPACE:
            out[k] = model.bytes[list(SPACE.encode())].astype(np.int64)
        elif (part < 0).any():
            ids, at = [], 0
            for s in part.tolist():
                ids += [s] if s >= 0 else model.bytes[list(words[k][at].encode())].tolist()
                at += model.length[s] if s >= 0 else 1
            out[k] = np.array(ids, np.int64)
    return np.concatenate(out), np.array(list(map(len, out)), np.int64)


def encode(model: Model, texts: list[str], keys: list[int], seed: int = SEED, dropout: float = DROPOUT) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in one array, and where each text ends. Every occurrence of a word is cut by the agenda under a
    key of its own, made of the seed, the text's key and the word's number in it. What is remembered are segmentations by
    word and skipped candidates, which are the same under every key."""
    if model.held > MEMO:
        model.clear()
    begin = " " if model.prefix else ""
    words = [_WORD.findall(begin + t) if t else [] for t in texts]
    counts = np.array([len(ws) for ws in words], np.int64)
    new = list({w for ws in words for w in ws if w not in model.known and len(w) <= WIDE})
    if new:
        first = len(model.words)
        model.words += new
        model.known.update(zip(new, _learn(model, np.arange(first, first + len(new))).tolist()))
    node = np.fromiter(map(model.known.get, chain.from_iterable(words), repeat(-1)), np.int64, int(counts.sum()))
    number = np.arange(len(node)) - np.repeat(np.cumsum(counts) - counts, counts)
    own = np.fromiter((xxhash.xxh64_intdigest(b"%d" % k, seed & (2 ** 64 - 1)) for k in keys), np.uint64, len(texts))
    own = _mix(np.repeat(own, counts) + (number + 1).astype(np.uint64) * STEP)
    wide = np.flatnonzero(node < 0)
    if len(wide):
        text = np.repeat(np.arange(len(texts)), counts)
        for at in wide.tolist():
            word = words[text[at]][number[at]]
            held = None if dropout > 0 else model.whole.get(word)
            if held is None:
                ids = np.array(agenda(model, _spaced(word), int(own[at]), dropout), np.int64)
                held = int(model.keep(*_with_bytes(model, [word], ids, np.array([len(ids)])))[0])
                if dropout <= 0:
                    model.whole[word] = held
            node[at] = held
    if dropout > 0:
        node = _walk(model, node, own, dropout)
    return _gather(model.flat, model.at, np.split(node, np.cumsum(counts)[:-1]) if texts else [])


def _gather(flat: np.ndarray, at: np.ndarray, where: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows ``where`` of the lists that ``at`` cuts ``flat`` into, joined, with the end of each element of ``where``."""
    rows = np.concatenate(where) if where else np.zeros(0, np.int64)
    size = at[rows + 1] - at[rows]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    out = flat[np.arange(total) + np.repeat(at[rows] - (ends - size), size)] if total else flat[:0]
    per = np.cumsum([0, *map(len, where)])[1:]
    return out, np.concatenate([[0], ends])[per]


def decode(model: Model, ids: np.ndarray, ends: np.ndarray) -> list[str]:
    """Texts of the ids that ``ends`` cuts into documents."""
    starts = np.concatenate([[0], ends[:-1]])
    data, stop = _gather(model.text, model.text_at, [ids[a:b].astype(np.int64) for a, b in zip(starts, ends)])
    begin = np.concatenate([[0], stop[:-1]])
    skip = 1 if model.prefix else 0
    return [bytes(data[a + skip if data[a:a + 1].tobytes() == b" " else a:b]).decode("utf-8", "replace") if b > a else ""
            for a, b in zip(begin, stop)]


@cache
def load(path: str) -> Model:
    return Model(path)


def _lists(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids, pa.int32()))


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with n, the number of equal rows that a row stands for; null where equal rows stay apart, but
    in one partition. Only ids move unless some repeat; then rows of hot ids and without an id are reduced where they are,
    the others meet by id."""
    more = durable(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    if more.isEmpty():
        return docs.withColumn("n", F.lit(1).cast("long"))
    many = F.col("n") * HOT_KEYS > docs.agg(F.count(F.lit(1))).scalar()  # 1,023 ids at most
    hot = more.filter(F.col("doc_id").isNotNull() & many).select("doc_id", F.lit(True).alias("hot"))
    marked = docs.join(F.broadcast(hot), "doc_id", "left")
    apart = F.col("hot").isNotNull() | F.col("doc_id").isNull()
    heavy = marked.filter(apart).groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("n"))
    met = marked.filter(~apart).select("doc_id", "text").repartition("doc_id")
    return met.withColumn("n", F.lit(None).cast("long")).unionByName(heavy)


def encode_documents(docs: DataFrame, model: str, seed: int = SEED, dropout: float = DROPOUT) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, ids array<int>, lossless boolean.

    ``model`` is the path of a model file on every machine. Candidate merges are
    taken from an agenda, best first, and skipped where a hash of seed, doc_id,
    text, epoch, number of the word in the text and place in the word falls below
    ``dropout``; 0 gives the library's own segmentation. The epoch counts equal
    rows, so each of them is cut in its own way. lossless tells that the ids
    decode to the whole text again. A null text is taken as empty and has no ids.
    Repeated rows are repeated, an empty table gives an empty one, other columns
    are not looked at.
    """

    def hashed(value: bytes, key: int) -> int:
        return xxhash.xxh64_intdigest(value, key & (2 ** 64 - 1))

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, int]]:
        """doc_id, text and key of every row."""
        seen: dict[int, int] = {}
        for batch in slices(batches, 1):
            for d, t, n in zip(*(batch.column(k).to_pylist() for k in range(3))):
                t = t or ""
                key = hashed(t.encode(), hashed(b"" if d is None else b"%d" % d, seed))
                first = 0
                if n is None:  # equal rows that come one by one
                    n, first = 1, seen.get(key, 0)
                    seen[key] = first + 1
                for epoch in range(first, first + n):
                    yield d, t, hashed(b"%d" % epoch, key) if epoch else key

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load(model)
        held, size = [], 0
        for row in chain(copies(batches), [None]):
            if held and (row is None or size + len(row[1]) > PIECE_BYTES or len(held) == ROWS):
                docs, texts, keys = map(list, zip(*held))
                ids, ends = encode(own, texts, keys, seed, dropout)
                back = [a == b for a, b in zip(decode(own, ids, ends), texts)]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), _lists(ids, ends), pa.array(back, pa.bool_())], ["doc_id", "ids", "lossless"])
                held, size = [], 0
            if row is not None:
                held.append(row)
                size += len(row[1])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return _numbered(rows).mapInArrow(make, "doc_id long, ids array<int>, lossless boolean")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """One row per row of ``encoded(doc_id, ids)``: doc_id, text. Null ids give a null text."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load(model)
        for batch in batches:
            lists = [None if i is None else np.array(i, np.int64) for i in batch.column(1).to_pylist()]
            full = [np.zeros(0, np.int64) if i is None else i for i in lists]
            texts = decode(own, np.concatenate([np.zeros(0, np.int64), *full]), np.cumsum(list(map(len, full)))) if full else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([None if i is None else t for i, t in zip(lists, texts)], pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(make, "doc_id long, text string")
