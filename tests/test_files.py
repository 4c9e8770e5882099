"""Listing, order, content ids and the line scan."""

from __future__ import annotations

import os

import eventmart as em
from eventmart.operators.keys import ORDER


def write(folder, name, data, mtime=None):
    path = folder / name
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    if mtime:
        os.utime(path, (mtime, mtime))
    return path


def test_listing_order_and_limit(spark, tmp_path):
    write(tmp_path, "dashboard_data_20240102_000000.jsnl", "a\n")
    write(tmp_path, "dashboard_data_20240101_120000.jsnl", "b\n")
    write(tmp_path, "plain.jsnl", "c\n", mtime=1704110399)  # 2024-01-01 11:59:59
    write(tmp_path, "dashboard_data_2024011_000000.jsnl", "d\n", mtime=1704300000)  # day of seven digits
    write(tmp_path, "dashboard_data_20241301_000000.jsnl", "e\n", mtime=1704400000)  # no such month
    write(tmp_path, "dashboard_data_current.jsnl", "f\n")
    write(tmp_path, "notes.txt", "g\n")
    (tmp_path / "deeper").mkdir()
    write(tmp_path / "deeper", "dashboard_data_20200101_000000.jsnl", "h\n")
    listing = em.list_files(spark, str(tmp_path))
    names = [r.file_name for r in em.pick_files(listing).collect()]
    assert names == ["plain.jsnl", "dashboard_data_20240101_120000.jsnl", "dashboard_data_20240102_000000.jsnl",
                     "dashboard_data_2024011_000000.jsnl", "dashboard_data_20241301_000000.jsnl"]
    assert [r.file_name for r in em.pick_files(listing, 2).collect()] == names[:2]
    assert em.pick_files(listing, 0).count() == 5
    assert sorted(r.line for r in em.scan_lines(spark, str(tmp_path)).collect()) == list("abcde")


def test_scan_keeps_line_order_across_splits(spark, tmp_path):
    for n in range(2):
        write(tmp_path, f"a_b_2024010{n + 1}_000000.jsnl", "".join(f"{n} {i} {'x' * (i % 50)}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = em.scan_lines(spark, str(tmp_path))
        found = [tuple(map(int, r.line.split()[:2])) for r in lines.orderBy(*ORDER).collect()]
        assert lines.select("block").distinct().count() > 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == [(n, i) for n in range(2) for i in range(3000)]


def digest(spark, path, split="128m"):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        return em.line_digest(em.scan_lines(spark, str(path))).first().file_id
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_line_digest(spark, tmp_path):
    lines = [f"line {i * i}\n" for i in range(2000)]
    whole = write(tmp_path, "a.jsnl", "".join(lines))
    one = digest(spark, whole)
    assert digest(spark, whole, "1000") == one and digest(spark, whole, "3k") == one
    lines[3], lines[4] = lines[4], lines[3]
    swapped = digest(spark, write(tmp_path, "b.jsnl", "".join(lines)))
    lines[3], lines[4] = lines[4], lines[3]
    longer = digest(spark, write(tmp_path, "c.jsnl", "".join([*lines, "\n"])))
    assert len({one, swapped, longer}) == 3


def test_content_ids(spark, tmp_path):
    write(tmp_path, "small.jsnl", "x\n")
    write(tmp_path, "again.jsnl", "x\n")
    write(tmp_path, "unended.jsnl", "x")
    write(tmp_path, "large.jsnl", "y\n" * 100)
    write(tmp_path, "empty.jsnl", "")
    listed = em.with_file_ids(spark, em.list_files(spark, str(tmp_path)))
    ids = {r.file_name: r.file_id for r in listed.collect()}
    assert ids["small.jsnl"] == ids["again.jsnl"] and len({*ids.values()}) == 3
    assert "empty.jsnl" not in ids  # no lines: not listed
    assert all(len(i) == 32 for i in ids.values())
    manifest = spark.createDataFrame([("small.jsnl", ids["small.jsnl"]), ("large.jsnl", "other")],
                                     "file_name string, file_id string")
    assert sorted(r.file_name for r in em.new_files(listed, manifest).collect()) == ["again.jsnl", "large.jsnl", "unended.jsnl"]
    assert em.with_file_ids(spark, listed.where("false").drop("file_id")).count() == 0


def test_file_ids_do_not_depend_on_size(spark, tmp_path):
    body = ("z" * 1023 + "\n") * (1 << 16)  # 64 MB, where a single task would stop reading files whole
    for name, extra in (("a.jsnl", ""), ("b.jsnl", "1\n"), ("c.jsnl", "1\n")):
        write(tmp_path, name, body + extra)
    ids = {r.file_name: r.file_id for r in em.with_file_ids(spark, em.list_files(spark, str(tmp_path))).collect()}
    assert ids["b.jsnl"] == ids["c.jsnl"] != ids["a.jsnl"]
