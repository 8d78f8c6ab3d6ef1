"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from donorloom.llm import (
    licenses, line_runs, mixing, periodic, pq, quality, sentencepieces, simhash, tokens, topk, urls, vector_codes, warc)
from donorloom.llm.common import read
from donorloom.session import new_folder

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(read(spark, folder, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op3_embedding_groups(spark: SparkSession, folder: str) -> DataFrame:
    return pq.embedding_groups(read(spark, folder, "embeddings"))


def op4_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_groups(read(spark, folder, "documents")).select(
        "doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.url_verdicts(read(spark, folder, "pages"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Starts with an empty cache, so every distinct text is encoded."""
    return tokens.token_counts(read(spark, folder, "documents"), vocabulary(TOKENIZER), new_folder(spark, "token-counts"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(read(spark, folder, "documents"))


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    encoded = sentencepieces.encode_documents(read(spark, folder, "documents"), vocabulary(PIECES))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_digest"), "lossless")


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(read(spark, folder, "pages"))


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(read(spark, folder, "documents")).drop("identifiers")


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.vector_codes(read(spark, folder, "embeddings"))


def with_periods(text: Column, doc_id: Column) -> Column:
    """The text of a document as the runs' query takes it: of every tenth document by CRC-32 of its id, the words from
    number a on repeat with period p. A null id has no CRC, so its text stays as it is; so do texts without words."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.split(F.btrim(text, F.lit(line_runs.SPACE)), r"[\x20\x09-\x0D]+")
    n = F.size(words)

    def repeated(z: Column) -> Column:
        a, p = z["a"], z["p"]
        tail = F.transform(F.sequence(F.lit(0).cast("long"), z["n"] - a - 1), lambda i: F.get(z["words"], (a + i % p).cast("int")))
        return F.array_join(F.concat(F.slice(z["words"], 1, a.cast("int")), tail), " ")

    a = g % n
    z = F.struct(words.alias("words"), n.cast("long").alias("n"), a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("p"))
    return F.when((h % 10 == 0) & (F.btrim(text, F.lit(line_runs.SPACE)) != ""), line_runs.once(z, repeated)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The greatest run is that of the greatest length / period, compared by products of whole numbers."""
    docs = read(spark, folder, "documents")
    found = periodic.periodic_runs(docs.select("doc_id", with_periods(F.col("text"), F.col("doc_id")).alias("text")))
    greater = lambda x, best: best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"])
    best = F.reduce("runs", F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), lambda best, x: F.when(greater(x, best), x).otherwise(best))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_runs.drop_shared_lines(read(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_top_k, op2_quality, op3_embedding_groups, op4_simhash_groups, op5_url_filter, op6_token_counts, op7_mixing,
    op8_sentencepiece, op9_warc, op10_licenses, op11_vector_codes, op12_periodic_runs, op13_line_dedup)}

SQL = {
    "op1_top_k": """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings),
p AS (SELECT q.vec_id AS query_id, e.vec_id, list_dot_product(q.v, e.v)::BIGINT AS score
      FROM e q JOIN e ON q.vec_id % 20 = 0 AND q.vec_id <> e.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op5_url_filter": urls.oracle(),
    "op7_mixing": mixing.oracle(),
    "op9_warc": """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS d, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) END AS first FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN first IS DISTINCT FROM page_id AND first IS NOT NULL
       THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to FROM f""",
    "op11_vector_codes": vector_codes.oracle(),
    "op13_line_dedup": line_runs.oracle(),
}
