"""Keyed tables, registry, archive and deletion."""

from __future__ import annotations

import json

import pytest
from helpers import line, start
from pyspark.sql import functions as F

import eventmart as em
from eventmart.sources import tables

NS = 10**9
JAN, FEB = 1704067200, 1706745600  # first seconds of January and February 2024


@pytest.fixture
def warehouse(spark, tmp_path):
    return em.Warehouse(spark, str(tmp_path / "warehouse"), width=1)


def equity(spark, *rows):
    rows = [(t * NS, mode, float(v), i) for i, (mode, t, v) in enumerate(rows)]
    return spark.createDataFrame(rows, "time_ns bigint, mode string, equity double, ord bigint")


def stored(warehouse, table=em.EQUITY):
    return {(r["mode"], r.time_ns // NS): r.equity for r in warehouse.read(table).collect()}


def upsert(warehouse, rows):
    warehouse.upsert(em.EQUITY, rows, ["ord"])


def files_of(tmp_path, table):
    return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "warehouse" / table).rglob("*.parquet")}


def test_upsert_last_write_wins(spark, warehouse, tmp_path):
    first = equity(spark, ("a", JAN, 1), ("a", JAN, 2), ("b", JAN, 3), ("a", FEB, 4), ("7", JAN, 5))
    upsert(warehouse, first)
    before = files_of(tmp_path, "equity")
    expected = {("a", JAN): 2.0, ("b", JAN): 3.0, ("a", FEB): 4.0, ("7", JAN): 5.0}
    assert stored(warehouse) == expected
    upsert(warehouse, equity(spark, ("a", FEB, 9), ("a", FEB + 1, 8)))
    expected |= {("a", FEB): 9.0, ("a", FEB + 1): 8.0}
    assert stored(warehouse) == expected
    after = files_of(tmp_path, "equity")
    kept = {p for p in before if before[p] == after.get(p)}
    assert any("monthly_202401" in p for p in kept)  # January was not rewritten
    upsert(warehouse, equity(spark, ("a", FEB, 9), ("a", FEB + 1, 8)))
    assert stored(warehouse) == expected
    assert warehouse.read(em.EQUITY).count() == len(expected)


def test_upsert_reads_no_stored_row(spark, warehouse, monkeypatch):
    upsert(warehouse, equity(spark, ("a", JAN, 1)))

    def refuse(*_):
        raise AssertionError("stored rows were read")

    with monkeypatch.context() as patch:
        patch.setattr(em.Warehouse, "raw", refuse)
        patch.setattr(em.Warehouse, "stored", refuse)
        upsert(warehouse, equity(spark, ("a", JAN, 2)))
    assert stored(warehouse) == {("a", JAN): 2.0}


def test_merge(spark, warehouse, tmp_path, monkeypatch):
    rows = [(f"m{i}", JAN + i * 86400 * 20, i) for i in range(12)]
    upsert(warehouse, equity(spark, *rows))
    warehouse.merge(em.EQUITY)
    assert len(warehouse.versions(em.EQUITY)) == 1  # nothing to merge
    upsert(warehouse, equity(spark, *[(m, t, v + 1) for m, t, v in rows[:8]], ("m11", JAN, 0)))
    expected = {(m, t): float(v + (i < 8)) for i, (m, t, v) in enumerate(rows)} | {("m11", JAN): 0.0}
    assert stored(warehouse) == expected
    # a merge that dies before its version is complete, and one that dies before the older copies go
    folder = tmp_path / "warehouse" / "equity" / "version=000000000003" / "part=p_0" / "period=monthly_202401"
    folder.mkdir(parents=True)
    (folder / "torn.parquet").write_bytes(b"PAR1")
    assert stored(warehouse) == expected
    with monkeypatch.context() as patch:
        patch.setattr(tables.fs, "delete", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            warehouse.merge(em.EQUITY)
    assert stored(warehouse) == expected
    before = files_of(tmp_path, "equity")
    warehouse.merge(em.EQUITY)
    assert stored(warehouse) == expected
    assert not warehouse.repeated(em.EQUITY, warehouse.raw(em.EQUITY))
    after = files_of(tmp_path, "equity")
    assert {p for p in before if before[p] == after.get(p)}  # partitions of one version stay as they are
    plan = warehouse.read(em.EQUITY)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan  # a merged table is just read
    upsert(warehouse, equity(spark))
    assert stored(warehouse) == expected


def test_read_prunes_by_mode_and_time(spark, warehouse):
    upsert(warehouse, equity(spark, *[(m, JAN + d * 86400, d) for m in ("a", "b") for d in range(60)]))
    rows = warehouse.read(em.EQUITY, "a", start=JAN + 30 * 86400, end=JAN + 33 * 86400)
    assert sorted(r.equity for r in rows.collect()) == [30.0, 31.0, 32.0]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "part#" in plan.split("PartitionFilters")[1]


def start_facts(make_lines, *messages):
    return em.line_facts(em.parse_messages(make_lines(list(messages))))


def test_registry_row(make_lines):
    message = start("m", live="True", strand_id="s1", tuning_date_range="2020", live_=1, processed_at="old")
    message["config"]["live"] = False
    message["config_file_path"] = "/c"
    row = em.registrations(start_facts(make_lines, start("m"), message), "NOW").first()
    assert (row.component, row.designator, row.live) == ("strand_live", "s1", True)
    assert json.loads(row.data) == {
        "name": "n", "strand_id": "s1", "live_": 1, "source_file": None, "config_path": "/c",
        "designator": "strand_live", "tuning_date_range": "2020", "live": True, "processed_at": "NOW"}


def test_registry_defaults(make_lines):
    row = em.registrations(start_facts(make_lines, {"type": "strand_started"}), "NOW").first()
    assert (row["mode"], row.component, row.designator) == ("unknown", "unknown_simulation", "")
    assert json.loads(row.data) == {"source_file": None, "config_path": "", "designator": "unknown_simulation",
                                    "tuning_date_range": "", "live": False, "processed_at": "NOW"}


def test_touch_and_known_instances(spark, make_lines, warehouse):
    rows = [(m, "strand_live", "s", True, json.dumps({"name": m, "designator": "strand_live", "strand_id": "x",
                                                     "cachedStats": {"a": 1}, "processed_at": "old"}), "old")
            for m in ("used", "idle", "restarted")] + [("bare", "c", "d", False, '{"a":1}', "old"),
                                                       ("blank", "c", "d", False, "{}", "old")]
    instances = spark.createDataFrame(rows, em.INSTANCES.schema)
    lines = [line(1, mode=m) for m in ("used", "restarted", "bare", "blank", "new")] + [start("restarted")]
    facts = start_facts(make_lines, *lines)
    touched = {r["mode"]: r for r in em.touch_instances(instances, facts, "NOW").collect()}
    assert sorted(touched) == ["bare", "used"]
    assert json.loads(touched["used"].data) == {"name": "used", "designator": "strand_live", "strand_id": "x",
                                                "processed_at": "NOW"}
    assert (touched["used"].component, touched["used"].designator) == ("strand_live", "x")
    assert (touched["bare"].component, touched["bare"].designator) == ("strand_simulation", "")
    em.upsert_instances(warehouse, instances)
    em.upsert_instances(warehouse, em.registrations(start_facts(make_lines, start("used"), start("fresh")), "NOW"),
                        check_existing=True)
    stored_rows = {r["mode"]: r.processed_at for r in warehouse.read(em.INSTANCES).collect()}
    assert stored_rows == {**{m: "old" for m in ("used", "idle", "restarted", "bare", "blank")}, "fresh": "NOW"}


def archive_rows(spark, *rows):
    made = [(float(t), mode, "c", f'[{{"n":{i}}}]', src, 0.0, src, 0, i) for i, (mode, t, src) in enumerate(rows)]
    return spark.createDataFrame(made, tables.ARCHIVE_SCHEMA)


compact = em.compact


def test_compaction_accumulates_and_replaces(spark, warehouse):
    monday, sunday = 1703462400, 1704067199  # 2023-12-25 and the last second of 2023
    compact(warehouse, archive_rows(spark, ("a", monday, "f1"), ("a", sunday, "f1"), ("a", sunday + 1, "f1"), ("b", monday, "f1")))
    compact(warehouse, archive_rows(spark, ("a", monday + 5, "f2"), ("a", monday - 1, "f2")))
    compact(warehouse, archive_rows(spark, ("a", monday + 5, "f2"), ("a", monday - 1, "f2")))  # f2 once more
    rows = em.read_archive(warehouse)
    found = {(r["mode"], r.period): r.n_rows for r in em.compaction_summary(rows).collect()}
    assert found == {("a", "weekly_20231225"): 3, ("a", "weekly_20240101"): 1, ("b", "weekly_20231225"): 1,
                     ("a", "weekly_20231218"): 1}
    assert [r.src for r in em.read_archive(warehouse, "a", start=monday, end=sunday).orderBy("timestamp").collect()] == ["f1", "f2"]
    compact(warehouse, archive_rows(spark, ("a", monday, "f3")), mode="replace")
    left = {(r["mode"], r.timestamp) for r in em.read_archive(warehouse).collect()}
    assert ("a", float(monday)) in left and ("a", monday + 5.0) not in left and ("a", sunday + 1.0) in left


def archived(warehouse):
    return sorted((r["mode"], r.timestamp, r.src) for r in em.read_archive(warehouse).collect())


def test_archive_by_versions(spark, warehouse, tmp_path, monkeypatch):
    week = 7 * 86400
    compact(warehouse, archive_rows(spark, ("a", JAN, "f1"), ("a", JAN + week, "f1"), ("b", JAN, "f2")))

    def refuse(*_, **__):
        raise AssertionError("stored rows were read")

    with monkeypatch.context() as patch:
        patch.setattr(em.Warehouse, "raw", refuse)
        patch.setattr(em.Warehouse, "stored", refuse)
        compact(warehouse, archive_rows(spark, ("a", JAN + 1, "f1"), ("b", JAN + 2, "f3")))  # f1 again, without its second week
    expected = [("a", JAN + 1.0, "f1"), ("b", float(JAN), "f2"), ("b", JAN + 2.0, "f3")]
    assert archived(warehouse) == expected
    # a version that died: index and rows without the mark of completeness
    with monkeypatch.context() as patch:
        patch.setattr(tables.Warehouse, "folder", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            compact(warehouse, archive_rows(spark, ("b", JAN, "f2")), mode="replace")
    assert archived(warehouse) == expected
    table = em.archive_table()
    with monkeypatch.context() as patch:
        patch.setattr(tables.fs, "delete", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            warehouse.merge(table)
    assert archived(warehouse) == expected
    warehouse.merge(table)
    assert archived(warehouse) == expected and warehouse.raw(table).count() == 3
    compact(warehouse, archive_rows(spark), gone=spark.createDataFrame([("f2",)], "src string"))
    assert archived(warehouse) == [expected[0], expected[2]]
    warehouse.merge(table)
    assert archived(warehouse) == [expected[0], expected[2]] and warehouse.raw(table).count() == 2
    compact(warehouse, archive_rows(spark, ("b", JAN + 3, "f2")))
    assert archived(warehouse) == sorted([expected[0], expected[2], ("b", JAN + 3.0, "f2")])


def test_compaction_keeps_rows_without_a_date(spark, warehouse):
    compact(warehouse, archive_rows(spark, ("a", "nan", "f"), ("a", "inf", "f"), ("a", 1e300, "f"), ("a", JAN, "f")))
    assert em.read_archive(warehouse).count() == 4
    assert em.read_archive(warehouse, start=JAN - 1).count() == 4  # NaN sorts above every number
    assert em.read_archive(warehouse, end=JAN + 1).count() == 1


def test_compacted_files_are_sorted(spark, warehouse, tmp_path):
    compact(warehouse, archive_rows(spark, *[("hot" if i % 3 else "b", JAN + (i * 7919) % 600000, "f") for i in range(3000)]))
    import pyarrow.parquet as pq

    for path in (tmp_path / "warehouse" / "archive_week").rglob("*.parquet"):
        table = pq.ParquetFile(path).read(["mode", "timestamp"]).to_pylist()
        keys = [(r["mode"], r["timestamp"]) for r in table]
        assert keys == sorted(keys)


def test_delete_one_mode(spark, tmp_path):
    warehouse = em.Warehouse(spark, str(tmp_path / "warehouse"), width=0)  # every mode shares a partition
    upsert(warehouse, equity(spark, ("m1", JAN, 1), ("m1", FEB, 1), ("m11", JAN, 2), ("xm1", JAN, 3)))
    compact(warehouse, archive_rows(spark, ("m1", JAN, "f"), ("m11", JAN, "f")))
    dry = {r.table_name: r.n_rows for r in em.delete_mode(warehouse, "m1", grains=("week",), dry_run=True).collect()}
    assert dry == {"equity": 2, "trades": 0, "instances": 0, "archive_week": 1}
    assert len(stored(warehouse)) == 4
    done = {r.table_name: r.n_rows for r in em.delete_mode(warehouse, "m1", grains=("week",)).collect()}
    assert done == dry
    assert stored(warehouse) == {("m11", JAN): 2.0, ("xm1", JAN): 3.0}
    assert not list((tmp_path / "warehouse" / "equity").rglob("period=monthly_202402"))
    assert [r["mode"] for r in em.read_archive(warehouse).collect()] == ["m11"]


def test_partition_names(spark):
    import hashlib

    from pyspark.sql import functions as F

    from eventmart.functions.naming import output_name, partition_name

    row = spark.createDataFrame([("real_time",)], "mode string").select(
        partition_name(F.col("mode")).alias("p"), output_name(F.lit("a.b.jsnl"), F.lit("id")).alias("o")).first()
    assert row.p == "p_" + hashlib.md5(b"real_time").hexdigest()[:8]
    assert row.o == "a.b_id.parquet"


def test_stored_periods(spark, warehouse):
    table = em.archive_table("week")

    def periods():
        # NaN equals nothing, so rows are compared as text
        plain = em.read_archive(warehouse).groupBy(tables.Table.period(table).alias("period")).agg(
            F.count("*").alias("n_rows"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))
        found = em.stored_periods(warehouse)
        assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
        plan = found._jdf.queryExecution().executedPlan().toString()
        return found.count(), "PushedAggregation: [COUNT(*), MIN(timestamp), MAX(timestamp)]" in plan

    assert em.stored_periods(warehouse).count() == 0
    compact(warehouse, archive_rows(spark, ("a", JAN, "f"), ("a", JAN + 5, "f"), ("b", FEB, "f"), ("a", FEB, "g"), ("a", "nan", "g")))
    assert periods() == (3, True)
    # f is taken back by its second writing, and a week that only it had goes with it
    compact(warehouse, archive_rows(spark, ("a", FEB + 1, "f"), ("b", "inf", "f")))
    assert periods() == (2, True)
    compact(warehouse, archive_rows(spark, ("c", FEB + 2, "h"), ("c", JAN, "h")), mode="replace")
    assert periods() == (3, True)
    warehouse.merge(table)
    assert periods() == (3, True)
    assert spark.conf.get("spark.sql.sources.useV1SourceList").count("parquet") == 1  # the caller's session reads as before


def test_settled_versions_are_read_without_a_condition(spark, warehouse):
    table = em.archive_table("week")
    compact(warehouse, archive_rows(spark, ("a", JAN, "f"), ("b", FEB, "g")))
    whole, rest = warehouse.settled(table)
    assert (whole.count(), rest.count()) == (2, 0)
    compact(warehouse, archive_rows(spark, ("a", FEB, "f")))
    whole, rest = warehouse.settled(table)
    assert [r.src for r in whole.collect()] == ["f"] and [r.src for r in rest.collect()] == ["g"]
