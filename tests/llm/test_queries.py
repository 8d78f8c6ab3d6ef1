"""The registered queries against their SQL, and the pipeline against its stages' own rules."""

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from donorloom.llm import queries, simhash

TABLES = ("documents", "embeddings", "pages", "labels")


@pytest.fixture(scope="module")
def oracle(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def rows(columns, data):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(r[i] for i in at) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(name, spark, sf, oracle):
    df = queries.QUERIES[name](spark, sf)
    got = rows(df.columns, df.collect())
    assert got
    if name in queries.SQL:
        cursor = oracle.execute(queries.SQL[name])
        assert got == rows([c[0] for c in cursor.description], cursor.fetchall())


def test_registered():
    assert {*queries.QUERIES, "pipeline"} <= set(__spark_entry__.queries())


def test_pipeline(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    before = {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        after = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert after and after <= before
        if name == "near_copies":
            groups = simhash.simhash_groups(docs).collect()
            assert all(r["doc_id"] == r["component_id"] for r in groups)
        before = after
    out = corpus_pipeline.run(spark, sf)
    got = out.collect()
    assert all(r["lossless"] for r in got) and {r["doc_id"] for r in got} == before and len(got) == docs.count()
