"""Registered queries of the operators: those with SQL against it, the rest for their columns; the pipeline stage by stage."""

from __future__ import annotations

import pytest
from check import DATA, compare, database

import corpus_pipeline
from __spark_entry__ import queries
from eventmart.llm.queries import ORACLES, QUERIES

SF_DIR = f"{DATA}/sf0.001"


def test_registered():
    assert {*QUERIES, "pipeline"} <= queries().keys()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == [*range(1, 14)]


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, name):
    assert compare(database(SF_DIR), QUERIES[name](spark, SF_DIR), ORACLES[name]) is None


def test_pipeline(spark, area):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = area.table(stage(spark, docs, SF_DIR), f"stage{k}")
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert after <= before and len(after) > len(before) / 2, name
        assert docs.columns[: len(columns)] == columns
    assert docs.columns == [*columns, "slot", "shard"]
