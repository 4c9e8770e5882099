"""Batch runs over several folders that have files of the same name."""

from __future__ import annotations

import json
import os

from helpers import line, start

import eventmart as em


def test_equal_names_in_two_folders(spark, tmp_path):
    name, folders = "dashboard_data_20240101_000000.jsnl", [tmp_path / x for x in ("a", "b", "c")]
    bodies = [[start("m1"), line(1.0, {"t": "x", "v": 1}, mode="m1", ts=1704067201.0)],
              [start("m2"), line(2.0, {"t": "x", "v": 2}, mode="m2", ts=1704067202.0), line(3.0, mode="m2", ts=1704067203.0)],
              [start("m3"), line(4.0, {"t": "x", "v": 3}, mode="m3", ts=1704067201.0)]]
    for folder, body in zip(folders, bodies):
        folder.mkdir()
        (folder / name).write_text("".join(json.dumps(x) + "\n" for x in body))
        os.utime(folder / name, (1704100000, 1704100000))
    assert (folders[0] / name).stat().st_size == (folders[2] / name).stat().st_size  # known by name, length and time alone
    wh, done = em.Warehouse(spark, str(tmp_path / "wh")), tmp_path / "done"
    stats = em.run_batch(spark, [str(x) for x in folders[:2]], wh, processed_dir=str(done)).collect()
    assert sorted(r.total_records for r in stats) == [1, 2]  # start messages are no records
    assert len([*done.glob("*.jsnl")]) == 2
    assert [em.read_archive(wh, m, grain="week").count() for m in ("m1", "m2")] == [1, 1]
    assert em.run_batch(spark, str(folders[2]), wh).count() == 1
    assert [wh.read(em.EQUITY, m).count() for m in ("m1", "m2", "m3")] == [1, 2, 1]
    assert em.run_batch(spark, str(folders[2]), wh).count() == 0
