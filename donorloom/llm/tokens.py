"""Token counts from a cache of content and tokenizer digests."""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from donorloom.llm.common import lookup, pieces
from donorloom.session import durable

LIMIT = 1024
FEW = 500_000  # misses up to this many (32 bytes each) are broadcast; more are joined
WORDS = 600_000  # counts of single words that a Python worker holds
STORED = "digest binary, n_tokens long, version string"

# Characters whose classes do not differ between Unicode versions or regex libraries; other texts go to the library whole.
USUAL = [*map(chr, [*range(9, 14), *range(0x20, 0x7F), *range(0xA0, 0x250), *range(0x2010, 0x2028), *range(0x2030, 0x203B), 0x20AC])]
UNUSUAL = re.compile(f"[^{re.escape(''.join(USUAL))}]")


def _class(kind: str) -> str:
    return re.escape("".join(c for c in USUAL if unicodedata.category(c).startswith(kind)))


LETTERS, DIGITS = _class("L"), _class("N")
# The split that byte-level BPE makes before merging, a fixed value of the format, for usual characters.
SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^\s{LETTERS}{DIGITS}]+|\s+(?!\S)|\s+")


def version_of(path: str) -> str:
    """Digest of the tokenizer's file, with the library's name: counts of another version are never used."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + tokenizers.__version__.encode()).hexdigest()


class Counter:
    """Counts tokens of texts as the library does.

    Byte-level BPE without a normaliser never merges across its split, so there
    the count of a text is the sum over its parts, each encoded by the library
    once and remembered. Texts with unusual characters or with the string of an
    added token, and all texts for other kinds of tokenizers, are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec.get("pre_tokenizer") or {}
        self.by_parts = (
            spec["model"]["type"] == "BPE" and not spec["model"].get("dropout") and spec.get("normalizer") is None
            and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True))
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.known: dict[str, int] = {}

    def _encode(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        parts = [self._parts(t) for t in texts]
        known = self.known
        if len(known) > WORDS:
            known.clear()
        new = list({w for p in parts if p is not None for w in p if w not in known})
        known.update(zip(new, self._encode(new)))
        whole = iter(self._encode([t for t, p in zip(texts, parts) if p is None]))
        return [next(whole) if p is None else sum(map(known.__getitem__, p)) for p in parts]

    def _parts(self, text: str) -> list[str] | None:
        if not self.by_parts or UNUSUAL.search(text) or any(a in text for a in self.added):
            return None
        return SPLIT.findall(text)


@cache
def _counter(path: str, version: str) -> Counter:
    return Counter(path)


def _stored(spark, folder: str) -> DataFrame:
    try:
        return spark.read.schema(STORED).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORED)


def token_counts(docs: DataFrame, tokenizer: str, stored: str, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_bytes, n_tokens, over_limit.

    ``tokenizer`` is the path of a tokenizer file on every machine, ``stored`` a
    folder that all machines share. A text (null: empty) is known there by its
    SHA-256 and the tokenizer's digest. Only distinct texts that are not stored
    are encoded, once each, and then appended. No begin, end or other special
    tokens are added, strings of such tokens in a text are read as the library
    does by default. Repeated rows are repeated, an empty table gives an empty
    one, other columns are not looked at.

    Digests travel, texts stay: the misses go to the scan of the texts, or where
    there are very many of them the two are joined on digest and row.
    """
    spark = docs.sparkSession
    version = version_of(tokenizer)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn(
        "digest", F.unhex(F.sha2("text", 256))).withColumn("row", F.xxhash64("doc_id"))
    short = durable(rows.select("doc_id", "digest", "row", F.octet_length("text").cast("long").alias("n_bytes")))
    distinct = short.groupBy("digest").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("copies"))
    before = _stored(spark, stored).filter(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    known = durable(before.join(distinct.select("digest"), "digest", "left_semi"))
    misses = durable(distinct.join(known, "digest", "left_anti").select("digest", "row"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer, version)
        for batch in pieces(batches, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counter.counts(batch.column(1).to_pylist()), pa.int64())],
                                             ["digest", "n_tokens"])

    wanted = F.broadcast(misses) if misses.count() <= FEW else misses
    new = rows.join(wanted, ["digest", "row"], "left_semi").select("digest", "text").mapInArrow(encode, "digest binary, n_tokens long")
    new = durable(new.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    new.withColumn("version", F.lit(version)).write.mode("append").parquet(stored)
    table = distinct.select("digest", "copies").join(known.unionByName(new), "digest")
    return lookup(short, table, ["digest"], "copies").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
