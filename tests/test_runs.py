"""Whole runs over files: batch, repeated batch and stream."""

from __future__ import annotations

import json
import os

import model
import pytest
from test_lines import random_files

import eventmart as em
from eventmart.plans import batch
from eventmart.sources import files as sources
from eventmart.streaming import ingest

NAMES = ["dashboard_data_2024010%d_000000.jsnl" % n for n in (1, 2, 3)]


@pytest.fixture(scope="module")
def files():
    return random_files(11)


def write_files(folder, files, names=NAMES):
    folder.mkdir(exist_ok=True)
    for n, (name, lines) in enumerate(zip(names, files)):
        path = folder / name
        path.write_text("".join(text + "\n" for text in lines))
        os.utime(path, (1704000000 + n * 60,) * 2)
    return str(folder)


def contents(warehouse):
    equity = {(r["mode"], r.time_ns): r.equity for r in warehouse.read(em.EQUITY).collect()}
    trades = {(r["mode"], r.time_ns, r.data_type): r.price for r in warehouse.read(em.TRADES).collect()}
    rows = sorted((r["mode"], r.timestamp, r.value) for r in em.read_archive(warehouse).collect())
    return equity, trades, rows


def expected(files):
    kept, trades, archived, _ = model.run(files)
    return (
        {(m, int(t * 1e9)): v for m, t, v in kept},
        {(m, int(t * 1e9), kind): price for m, t, kind, price, _, _ in trades},
        sorted((m, t, json.dumps(o, separators=(",", ":"))) for m, t, o in archived),
    )


def test_batch_run(spark, tmp_path, files):
    source = write_files(tmp_path / "in", files)
    (tmp_path / "in" / "dashboard_data_20240104_000000.jsnl").write_text("")
    (tmp_path / "in" / "dashboard_data_current.jsnl").write_text(files[0][0])
    staged = spark.conf.get("spark.checkpoint.dir")
    before = {n for n in os.listdir(staged) if n.startswith("eventmart-")}  # of queries whose results may still be read
    warehouse = em.Warehouse(spark, str(tmp_path / "warehouse"), width=1)
    stats = em.run_batch(spark, source, warehouse, now="2024-05-01", processed_dir=str(tmp_path / "done"))
    counted = {r.file_name: r for r in stats.collect()}
    assert [counted[n].equity_records for n in NAMES] == [s[3] for s in model.run(files)[3]]
    assert contents(warehouse) == expected(files)
    assert sorted(os.listdir(tmp_path / "done"))[:3] == NAMES
    left = sorted(n for n in os.listdir(source) if not n.startswith("."))
    assert left == ["dashboard_data_20240104_000000.jsnl", "dashboard_data_current.jsnl"]  # empty, unfinished
    # the same content again is skipped, whether the file looks touched or not
    write_files(tmp_path / "in", files)
    os.utime(tmp_path / "in" / NAMES[0], (1, 1))
    assert em.run_batch(spark, source, warehouse, now="2024-05-02").count() == 0
    entries = [(r.file_name, r.n_lines) for r in batch.manifest(warehouse).orderBy("ingested_at", "file_name").collect()]
    assert entries == [*zip(NAMES, map(len, files)), (NAMES[0], None)]
    assert contents(warehouse) == expected(files)
    # changed content of the same length and name is read
    text = (tmp_path / "in" / NAMES[2]).read_text()
    (tmp_path / "in" / NAMES[2]).write_text(text[:-2] + " \n")
    assert em.run_batch(spark, source, warehouse, now="2024-05-03", grain=None).count() == 1
    assert {n for n in os.listdir(staged) if n.startswith("eventmart-")} <= before


def test_single_file_and_limit(spark, tmp_path, files):
    source = write_files(tmp_path / "in", files)
    warehouse = em.Warehouse(spark, str(tmp_path / "warehouse"), width=1)
    stats = em.run_batch(spark, source, warehouse, limit=1, grain=None, now="a")
    assert [r.file_name for r in stats.collect()] == NAMES[:1]
    assert not os.path.exists(tmp_path / "warehouse" / "archive_week")
    stats = em.run_batch(spark, f"{source}/{NAMES[2]}", warehouse, grain=None, now="b")
    assert [r.file_name for r in stats.collect()] == NAMES[2:]


def test_archive_waits_for_compaction(spark, tmp_path, files):
    source = write_files(tmp_path / "in", files)
    warehouse = em.Warehouse(spark, str(tmp_path / "warehouse"), width=1)
    em.run_batch(spark, source, warehouse, limit=2, grain=None, now="a")
    waiting = batch.pending_rows(warehouse)
    assert waiting.count() > 0 and em.read_archive(warehouse).count() == 0
    mode = waiting.first()["mode"]
    dry = {r.table_name: r.n_rows for r in em.delete_mode(warehouse, mode, dry_run=True).collect()}
    assert dry["archive_pending"] == waiting.where(waiting["mode"] == mode).count()
    em.run_batch(spark, source, warehouse, now="b")
    assert contents(warehouse)[2] == expected(files)[2] and batch.pending_rows(warehouse).count() == 0


def test_delete_covers_waiting_rows(spark, tmp_path, files, monkeypatch):
    source = write_files(tmp_path / "in", files)
    warehouse = em.Warehouse(spark, str(tmp_path / "warehouse"), width=1)
    em.run_batch(spark, source, warehouse, grain=None, now="a")
    rows = batch.pending_rows(warehouse)
    mode, n = rows.first()["mode"], rows.count()
    gone = rows.where(rows["mode"] == mode).count()
    delete = batch.fs.delete
    with monkeypatch.context() as patch:  # it dies when the rest is written and the older rows are still there
        patch.setattr(batch.fs, "delete", lambda spark, path: delete(spark, path) if batch.PENDING.name not in path else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            em.delete_mode(warehouse, mode)
    assert batch.pending_rows(warehouse).count() == n
    em.delete_mode(warehouse, mode)
    assert batch.pending_rows(warehouse).count() == n - gone
    # two runs with one stamp lose no waiting rows
    (tmp_path / "in" / "dashboard_data_20240105_000000.jsnl").write_text(files[0][0] + "\n" + "\n".join(files[0][1:]) + "\n")
    em.run_batch(spark, source, warehouse, grain=None, now="a")
    assert batch.pending_rows(warehouse).count() > n - gone


def test_stream_equals_batch(spark, tmp_path, files):
    source = write_files(tmp_path / "in", files)
    warehouse = em.Warehouse(spark, str(tmp_path / "stream"), width=1)
    query = em.stream_ingest(spark, source, warehouse, checkpoint=str(tmp_path / "cp"), merge_every=2, max_files=1,
                             trigger={"availableNow": True}, archive_dir=str(tmp_path / "archive"))
    query.awaitTermination()
    found = contents(warehouse)
    assert found == expected(files)
    # consumed files lie below their whole path, but for those of the newest batch
    moved = {path.name: str(path) for path in (tmp_path / "archive").rglob("*.jsnl")}
    assert set(moved) == set(NAMES[:2]) and os.listdir(source) == NAMES[2:]
    # the last batch run again, as after a failure before its commit: same state, same result
    lines = sources.with_metadata(spark.read.option("lineSep", "\n").text(f"{source}/{NAMES[2]}"))
    ingest.process_batch(warehouse, lines, 2, stream=f"-{ingest.stream_name(spark, str(tmp_path / 'cp'))}-")
    assert contents(warehouse) == found
    # what the stream has taken in is known to a batch run
    assert em.run_batch(spark, [source, *moved.values()], warehouse, now="later").count() == 0


def test_rounds_find_their_files_again(spark, tmp_path, files, monkeypatch):
    source = write_files(tmp_path / "in", files)
    warehouse = em.Warehouse(spark, str(tmp_path / "wh"), width=1)
    go = {"checkpoint": str(tmp_path / "cp"), "max_files": 1, "archive_dir": str(tmp_path / "archive")}
    whole = ingest.process_batch

    def dies(*args, **options):  # everything is written, nothing is committed
        whole(*args, **options)
        raise RuntimeError("died")

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "process_batch", dies)
        with pytest.raises(Exception, match="died"):
            em.run_in_rounds(spark, source, warehouse, **go)
    assert len(list((tmp_path / "in").glob("*.jsnl"))) == len(NAMES)
    assert em.run_in_rounds(spark, source, warehouse, **go) == len(NAMES)
    assert contents(warehouse) == expected(files)
    assert em.run_in_rounds(spark, source, warehouse, **go) == 0


def test_grown_and_undated(spark, tmp_path):
    from helpers import line, start

    def text(*lines):
        return "".join(json.dumps(x) + "\n" for x in lines)

    other = {"t": "x", "v": 1}
    name, warehouse = "dashboard_data_20240101_000000.jsnl", em.Warehouse(spark, str(tmp_path / "wh"), width=1)
    (tmp_path / "in").mkdir()
    path = tmp_path / "in" / name
    first = [start("m"), line(1.0, other, ts=1704067201.0), line(2.0, ts=1e300)]
    path.write_text(text(*first))
    (stats,) = em.run_batch(spark, str(tmp_path / "in"), warehouse, now="a").collect()
    assert (stats.equity_records, stats.undated_records, stats.skipped_equity_records) == (1, 1, 0)
    assert warehouse.read(em.EQUITY).count() == 1
    path.write_text(text(*first, line(3.0, other, ts=1704067203.0)))
    (stats,) = em.run_batch(spark, str(tmp_path / "in"), warehouse, now="b").collect()
    assert stats.total_records == 1
    path.write_text(text(start("m"), line(9.0, other, ts=1704067209.0), *first[2:], *first))  # longer, but not grown
    (stats,) = em.run_batch(spark, str(tmp_path / "in"), warehouse, now="c").collect()
    assert stats.total_records == 4
    assert sorted(r.timestamp for r in em.read_archive(warehouse).collect()) == [1704067201.0, 1704067201.0, 1704067203.0, 1704067209.0]


class Cut(em.Warehouse):
    """Dies once after each of the named tables was written."""

    left: set

    def add_version(self, table, *args, **options):
        super().add_version(table, *args, **options)
        if table.name in self.left:
            self.left.remove(table.name)
            raise InterruptedError(table.name)


def staged_facts(root):
    return [(path, os.stat(path).st_mtime_ns) for path in sorted(map(str, root.glob("runs/*/staged-*/facts/_SUCCESS")))]


def test_a_repeat_does_not_parse_again(spark, tmp_path, files):
    source = write_files(tmp_path / "in", files)
    warehouse = Cut(spark, str(tmp_path / "warehouse"), 1)
    warehouse.left = {em.EQUITY.name, em.TRADES.name}
    seen = []
    while True:
        try:
            em.run_batch(spark, source, warehouse, now="2024-05-01")
            break
        except InterruptedError:
            seen.append(staged_facts(tmp_path / "warehouse"))
    assert len(seen) == 2 and len(seen[0]) == 1 and seen[0] == seen[1]
    assert contents(warehouse) == expected(files) and not staged_facts(tmp_path / "warehouse")


def test_a_repeat_with_other_options_parses_anew(spark, tmp_path, files):
    whole = em.Warehouse(spark, str(tmp_path / "whole"), 1)
    source = write_files(tmp_path / "in", files)
    em.run_batch(spark, source, whole, now="2024-05-01", require_equity=False)
    warehouse = Cut(spark, str(tmp_path / "warehouse"), 1)
    warehouse.left = {em.EQUITY.name, em.TRADES.name}
    with pytest.raises(InterruptedError):
        em.run_batch(spark, source, warehouse, now="2024-05-01")
    with pytest.raises(InterruptedError):
        em.run_batch(spark, source, warehouse, now="2024-05-01", require_equity=False)
    assert len(staged_facts(tmp_path / "warehouse")) == 2
    em.run_batch(spark, source, warehouse, now="2024-05-01", require_equity=False)
    assert contents(warehouse) == contents(whole) and not staged_facts(tmp_path / "warehouse")


def test_a_stream_reads_few_versions(spark, tmp_path, files, monkeypatch):
    """The registry and the state of a long stream do not lie in a version for every batch; a repeat keeps the versions it began with."""
    from eventmart.plans import runs

    monkeypatch.setattr(ingest, "SMALL_EVERY", 1)
    seen, plain = [], ingest.process_batch

    def watched(warehouse, *args, **options):
        seen.append([warehouse.repeated(t, warehouse.raw(t)) for t in (em.INSTANCES, ingest.STREAM_STATE)])
        plain(warehouse, *args, **options)

    monkeypatch.setattr(ingest, "process_batch", watched)
    logs = write_files(tmp_path / "logs", files)
    merged, apart = em.Warehouse(spark, str(tmp_path / "merged"), 1), em.Warehouse(spark, str(tmp_path / "apart"), 1)
    for warehouse, every in ((merged, 144), (apart, None)):
        seen.clear()
        query = ingest.stream_ingest(spark, logs, warehouse, checkpoint=f"{warehouse.root}-checkpoint", max_files=1,
                                     trigger={"availableNow": True}, merge_every=every, now="n")
        query.awaitTermination()
        assert len(seen) == 3 and any(map(any, seen)) == (every is None)
    assert contents(merged) == contents(apart)
    rows = [sorted(map(str, w.read(em.INSTANCES).collect())) for w in (merged, apart)]
    assert rows[0] == rows[1]
    # the record of a batch that has begun
    before = apart.versions(em.INSTANCES)
    runs.begin(apart, "stream-x", "n")
    ingest.merge_small(apart, "stream-x")
    assert apart.versions(em.INSTANCES) == before
