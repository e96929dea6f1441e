"""Registered queries against their SQL, and the pipeline against its stages."""

import pytest
from conftest import SMALL
from oracle import _digest

import corpus_pipeline
from opsframe.llm.catalogue import ORACLES, QUERIES


def test_names():
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in QUERIES)] == []
    assert QUERIES["pipeline"] is corpus_pipeline.run and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, duck, name):
    result = QUERIES[name](spark, SMALL)
    answer = duck.sql(ORACLES[name])
    assert sorted(result.columns) == sorted(answer.columns)
    mine = _digest(result.columns, [tuple(r) for r in result.collect()])
    theirs = _digest(answer.columns, answer.fetchall())
    assert mine[0] and mine[:2] == theirs[:2]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    left = {r.doc_id for r in docs.select("doc_id").collect()}
    repeated = docs.union(docs.limit(3)).union(docs.limit(1).selectExpr("null as doc_id", "text", "lang", "source", "n_chars"))
    repeated = repeated.union(docs.limit(1).selectExpr("-1L as doc_id", "cast(null as string) as text", "cast(null as string) as lang", "source", "n_chars"))
    for at, rows in enumerate((docs, repeated)):
        for name, stage in corpus_pipeline.STAGES:
            out = corpus_pipeline.cut_lineage(stage(spark, rows, SMALL), "stage-test")
            if name != "byte-level BPE":
                assert out.dtypes == rows.dtypes
            now = {r.doc_id for r in out.select("doc_id").collect()}
            if not at:
                assert now <= left and len(now) > 0.7 * len(left)
                left = now
            rows = out
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SMALL)
        assert empty.count() == 0
