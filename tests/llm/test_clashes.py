"""Operators that hand on whole rows keep columns whatever their names."""

from __future__ import annotations

from eventmart.llm import decontam, neardup, sharding

NAMES = ("_at", "_slot", "_gone", "_again", "_leak", "d", "l", "a", "b", "id", "root", "n")


def test_columns_with_any_name(spark, area, docs):
    text = " ".join(f"w{k}" for k in range(40))
    rows = docs((1, text), (1, text), (2, text + " more"), (3, "another text of some words"), (4, None))
    rows = rows.selectExpr("*", *[f"concat('{c}', doc_id) AS `{c}`" for c in NAMES])
    kept = neardup.keep_one(rows, area)
    assert kept.columns == rows.columns
    assert sorted((r.doc_id, r["_gone"], r["_again"]) for r in kept.collect()) == [(k, f"_gone{k}", f"_again{k}") for k in (1, 3, 4)]
    items = spark.createDataFrame([(7, text)], "item_id bigint, text string")
    clean = decontam.clean(rows, items, area)
    assert clean.columns == rows.columns and sorted((r.doc_id, r["_leak"]) for r in clean.collect()) == [(3, "_leak3"), (4, "_leak4")]
    placed = sharding.place(rows.selectExpr("*", "'old' AS shard"), sharding.shard_names(4))
    assert placed.columns == [*rows.columns, "slot", "shard"]
    assert sorted((r.doc_id, r["_at"], r["_slot"]) for r in placed.collect()) == sorted((k, f"_at{k}", f"_slot{k}") for k in (1, 1, 2, 3, 4))
    assert placed.where("shard = 'old'").count() == 0
