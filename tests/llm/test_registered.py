"""Registered queries: SQL where there is some, brute force on whole small tables elsewhere, and the pipeline."""

import collections
import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402

from tagloom.llm.queries import LLM_QUERIES, LLM_SQL  # noqa: E402
from tests.llm import cases  # noqa: E402


def docs_of(spark, sf):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


def test_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES)
    assert numbers == list(range(1, 14)) and set(LLM_SQL) <= set(LLM_QUERIES)


def test_sql(spark, sf):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    for name, sql in LLM_SQL.items():
        want = con.execute(sql)
        columns = [c[0] for c in want.description]
        df = LLM_QUERIES[name](spark, sf)
        assert sorted(df.columns) == sorted(columns)
        cases.same_rows([tuple(r) for r in df.select(*columns).collect()], want.fetchall())


def test_brute_force(spark, sf):
    rows = docs_of(spark, sf)
    cases.same_rows([tuple(r) for r in LLM_QUERIES["op3_set_join"](spark, sf).collect()], cases.components(rows))
    got = LLM_QUERIES["op5_secrets"](spark, sf).collect()
    cases.same_rows([(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got], [(k, *cases.base_secrets(t)) for k, t in rows])
    got = LLM_QUERIES["op7_sentencepiece"](spark, sf).collect()
    assert len(got) == 2 * len(rows) and all(r.round_trip for r in got)


def test_pipeline(spark, sf):
    """Which documents each stage keeps, against plain versions fed with the stage's own input."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    before = docs_of(spark, sf)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        rows = out.collect()
        if name == "encoded":
            assert collections.Counter(r.doc_id for r in rows) == collections.Counter({k: 2 for k, _ in before}) and all(r.round_trip for r in rows)
            break
        assert out.columns == docs.columns
        kept = sorted(r.doc_id for r in rows)
        if name == "language":
            assert len(kept) >= 0.98 * len(before)
        elif name == "first_of_copies":
            assert kept == sorted({c for k, n, c in cases.components(before)})
        elif name == "without_benchmark":
            assert kept == sorted(r[0] for r in cases.contamination(before, items) if not r[5])
        elif name == "without_secrets":
            assert kept == sorted(k for k, _ in before)
            assert all(cases.base_secrets(r.text)[1:3] == (0, 0) and r.n_chars == len(r.text) for r in rows)
        docs = spark.createDataFrame(rows, docs.schema)
        before = [(r.doc_id, r.text) for r in rows]
