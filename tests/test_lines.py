"""Line rules: parse, gate, items, equity on change, counters."""

from __future__ import annotations

import json
import math
import random

import model
import pytest
from helpers import line, start
from pyspark.sql import functions as F

import eventmart as em
from eventmart.operators import gate

E1 = {"t": "e", "equity": 1}

# line -> (kind, reason, equity, number of trades, others)
CASES = [
    ("  \t\r\x1c ", ("blank", None, None, None, None)),
    ("{\"invalid_json", ("data", "bad_json", None, None, None)),
    ('{"timestamp":1} x', ("data", "bad_json", None, None, None)),
    ('{"timestamp":1}//x', ("data", "bad_json", None, None, None)),
    ("{'timestamp':1}", ("data", "bad_json", None, None, None)),
    ('{"a":1},{"b":2}', ("data", "bad_json", None, None, None)),
    ('{"a":01}', ("data", "bad_json", None, None, None)),
    ("[1]", ("data", "not_object", None, None, None)),
    ("5", ("data", "not_object", None, None, None)),
    ("null", ("data", "not_object", None, None, None)),
    ('"text"', ("data", "not_object", None, None, None)),
    ("{}", ("data", "missing", None, None, None)),
    (line(1, ts=0), ("data", "missing", None, None, None)),
    (line(1, ts=False), ("data", "missing", None, None, None)),
    (line(1, ts=True), ("data", None, 1.0, None, None)),
    (line(1, ts="0"), ("data", None, 1.0, None, None)),
    (line(1, ts=" 1_000.5 "), ("data", None, 1.0, None, None)),
    (line(1, ts="1d"), ("data", "bad_timestamp", None, None, None)),
    (line(1, ts="0x10"), ("data", "bad_timestamp", None, None, None)),
    (line(1, ts=[1]), ("data", "bad_timestamp", None, None, None)),
    (line(1, component=""), ("data", "missing", None, None, None)),
    (line(1, component="0"), ("data", None, 1.0, None, None)),
    (line(1, component=0), ("data", "missing", None, None, None)),
    (line(1, mode=[]), ("data", "missing", None, None, None)),
    (line(1, mode="[]"), ("data", None, 1.0, None, None)),
    (line(1, mode=7), ("data", None, 1.0, None, None)),
    (line(), ("data", "missing", None, None, None)),
    (line(value={}), ("data", "missing", None, None, None)),
    (line(value=""), ("data", "missing", None, None, None)),
    (line(value=7), ("data", "bad_value", None, None, None)),
    (line(value="x"), ("data", "bad_value", None, None, None)),
    (line(value=E1), ("data", None, 1.0, None, None)),
    (line(value=[{}]), ("data", None, None, None, None)),
    (line(value=[E1, "{}"]), ("data", "bad_value", None, None, None)),
    (line(value=[E1, None]), ("data", "bad_value", None, None, None)),
    (line(value=[E1, [E1]]), ("data", "bad_value", None, None, None)),
    (line("22.6000"), ("data", None, 22.6, None, None)),
    (line(True), ("data", None, 1.0, None, None)),
    (line("true"), ("data", None, None, None, None)),
    (line(0.0), ("data", None, 0.0, None, None)),
    (line(value=[{"t": "e"}]), ("data", None, 0.0, None, None)),
    (line(value=[{"t": "e", "equity": None}]), ("data", None, None, None, None)),
    (line(value=[{"t": "e", "equity": "n/a"}, {"t": "c"}]), ("data", None, None, None, None)),
    (line(2, {"t": "e", "equity": 5}, {"t": "c", "x": [1]}), ("data", None, 2.0, None, [{"t": "c", "x": [1]}])),
    (line(value=[E1, {"t": "e", "equity": "bad"}]), ("data", None, 1.0, None, None)),
    (line(1, {"t": 0}, {"t": "0"}, {"t": None}, {"t": ""}, {"x": 1}), ("data", None, 1.0, None, [{"t": "0"}])),
    (line(1, {"t": False}, {"t": 5}, {"t": True}), ("data", None, 1.0, None, [{"t": 5}, {"t": True}])),
    (line(1, {"t": {}}, {"t": {"a": 1}}), ("data", None, 1.0, None, [{"t": {"a": 1}}])),
    (line(1, {"t": "open", "price": "1.5", "instrument": "X"}, {"t": "close"}), ("data", None, 1.0, 2, None)),
    (line(1, {"t": "open", "price": None}), ("data", "bad_value", None, None, None)),
    (line(1, {"t": "adjust-open", "units": "many"}), ("data", "bad_value", None, None, None)),
    (line(None, {"t": "open", "price": 1}), ("data", None, None, None, None)),
    (json.dumps(line(1)).replace('"equity": 1', '"equity": NaN'), ("data", None, math.nan, None, None)),
    ('{"mode":"x","mode":"m","timestamp":1,"component":"c","value":[{"t":"c","t":"e","equity":3}]}',
     ("data", None, 3.0, None, None)),
    (start(), ("start", None, None, None, None)),
    (start(live="TRUE"), ("start", None, None, None, None)),
    ({"type": "ensemble_started", "mode": "m"}, ("start", None, None, None, None)),
    ({**start(), "live": None}, ("data", "missing", None, None, None)),
    ({**start(), "live": 1}, ("data", "missing", None, None, None)),
    ({**start(), "config": [1]}, ("data", "missing", None, None, None)),
    ({**line(1), "type": "strand_started", "config": None}, ("data", None, 1.0, None, None)),
]


def test_line_rules(make_lines):
    facts = em.line_facts(em.parse_messages(make_lines([text for text, _ in CASES])))
    rows = facts.orderBy("ord").collect()
    for (text, (kind, reason, equity, trades, others)), row in zip(CASES, rows, strict=True):
        shown = (text, row)
        assert (row.kind, row.reason) == (kind, reason), shown
        assert row.equity == equity or (equity is not None and math.isnan(equity) and math.isnan(row.equity)), shown
        assert (row.trades and len(row.trades)) == trades, shown
        assert (row.others and json.loads(row.others)) == others, shown


def test_invalid_utf8(spark, tmp_path):
    path = tmp_path / "a_b_20240101_000000.jsnl"
    good = json.dumps(line(1)).encode()
    path.write_bytes(good + b"\n" + good.replace(b"strand", b"\xff\xfe") + b"\n\n")
    facts = em.line_facts(em.parse_messages(em.scan_lines(spark, str(tmp_path))))
    assert [(r.kind, r.reason) for r in facts.orderBy("ord").collect()] == [
        ("data", None), ("data", "bad_json"), ("blank", None)]


def test_mode_field(make_lines):
    old = {"timestamp": 1.5, "type": "real_time_strategy", "component": "strand", "value": [E1]}
    row = em.parse_messages(make_lines([old]), mode_field="type").first()
    assert (row.reason, row["mode"]) == (None, "real_time_strategy")


def test_trade_payload_and_defaults(spark, make_lines):
    item = {"t": "open", "price": 21324.5, "id": 7}
    facts = em.line_facts(em.parse_messages(make_lines([start(), line(1, item)])))
    row = em.trades_of_line(em.gate_configs(facts, em.open_modes(facts))).first()
    assert row.data == '{"id":7,"instrument":"","price":21324.5,"profit":0.0,"units":0.0,"t":"open"}'
    assert (row.instrument, row.units, row.id, row.time_ns) == ("", 0.0, "7", 1740743175984999936)


def test_line_without_equity_can_be_kept(make_lines):
    trade = line(None, {"t": "open", "price": 1}, {"t": "c"})
    facts = em.line_facts(em.parse_messages(make_lines([trade])), require_equity=False)
    row = facts.first()
    assert (row.equity, len(row.trades), json.loads(row.others)) == (None, 1, [{"t": "c"}])


def test_candle_of_line(make_lines):
    candle = {"open": 1.5, "high": 2, "low": 1, "close": 1.75, "n": 3, "volume": 9, "timestamp": 5.0}
    lines = make_lines([start(), line(1, {"t": "c", "candle": {**candle, "open": 0}}, {"t": "c", "candle": candle}),
                        line(2)])
    facts = em.line_facts(em.parse_messages(lines), candle=True)
    rows = em.equity_with_candle(em.gate_configs(facts, em.open_modes(facts))).orderBy("ord").collect()
    assert [(r.equity, r.open, r.high, r.volume) for r in rows] == [(1.0, 1.5, 2.0, 9), (2.0, None, None, None)]


def test_items_in_order(make_lines):
    rows = em.explode_items(em.parse_messages(make_lines([line(1, {"t": "c"}, {"t": "open"}, {})]))).collect()
    assert [(r.pos, r.cls, r.tag) for r in rows] == [
        (0, "other", "c"), (1, "trade", "open"), (2, None, None), (3, "equity", "e")]


def gated(facts, instances=None):
    return em.gate_configs(facts, em.open_modes(facts, instances))


def test_gate_is_positional(spark, make_lines):
    lines = make_lines([line(1, mode="a"), start("a"), line(2, mode="a"), line(3, mode="late")],
                       [line(4, mode="a"), start("late")], [line(5, mode="late"), line(6, mode="db"), line(7, mode="empty")])
    facts = em.line_facts(em.parse_messages(lines))
    registry = spark.createDataFrame(
        [("db", '{"name":"x"}'), ("empty", "{}"), ("none", None), ("late2", "oops")], "mode string, data string")
    kept = [r.equity for r in em.equity_of_line(gated(facts, registry)).collect()]
    assert sorted(kept) == [2.0, 4.0, 5.0, 6.0]


def test_gate_without_broadcast(make_lines, monkeypatch):
    facts = em.line_facts(em.parse_messages(make_lines(*random_files(5))))
    small = gated(facts)
    monkeypatch.setattr(gate, "broadcast_if_small", lambda df: df.hint("shuffle_merge"))
    large = gated(facts)
    assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
    columns = ["file_name", "ord", "kind", "reason", "equity"]
    key = lambda r: (r.file_name, r.ord)
    assert sorted(map(key, small.collect())) == sorted(map(key, large.collect()))
    assert small.select(*columns).exceptAll(large.select(*columns)).count() == 0


def test_live_flag_is_taken_at_end_of_file(spark, make_lines):
    lines = make_lines(
        [start(live=False), line(1), start(live=True)], [line(2)], [line(3), start(live="false")], [line(4, mode="db")])
    facts = em.line_facts(em.parse_messages(lines))
    registry = spark.createDataFrame([("db", '{"a":1}', True)], "mode string, data string, live boolean")
    rows = em.equity_of_line(gated(facts, registry))
    flags = em.live_by_file(rows, facts, registry)
    found = em.attach_live(rows, flags).collect()
    assert {r.equity: r.live for r in found} == {1.0: True, 2.0: True, 3.0: False, 4.0: True}


def random_files(seed: int) -> list[list[str]]:
    """Three files of mixed good, odd and broken lines; one mode has most of them."""
    rng = random.Random(seed)
    texts = []
    for _ in range(600):
        mode = rng.choice(["hot"] * 6 + ["a", "b", "c"])
        ts = rng.choice([1704067200.5 + rng.randrange(10**6), "1704067200.25", 0, "x"] if rng.random() < 0.2 else
                        [1704067200.5 + rng.randrange(10**6)])
        items = [rng.choice([{"t": "c", "v": 1}, {"t": "open", "price": 2}, {"t": "close", "price": "?"}, {}, {"t": 0},
                             {"t": "sr", "n": "x"}]) for _ in range(rng.randrange(3))]
        equity = rng.choice([None, 1, 1, 2, "2", "3.0", "bad"])
        made = line(equity, *items, mode=mode, ts=ts)
        roll = rng.random()
        if roll < 0.05:
            texts.append(json.dumps(start(mode, live=rng.choice([True, False, "true", 3]))))
        elif roll < 0.08:
            texts.append(rng.choice(["", "  ", "{", "[]", "7", json.dumps(made) + "}"]))
        elif roll < 0.12:
            texts.append(json.dumps({**made, rng.choice(["mode", "component", "value"]): rng.choice(["", None, 0, "0", {}])}))
        else:
            texts.append(json.dumps(made))
    return [texts[:150], texts[150:400], texts[400:]]


def test_live_flags_take_two_shuffles(spark, make_lines):
    """The union of starts and rows is added up in its own tasks: one shuffle by mode and file, one by mode."""
    facts = em.line_facts(em.parse_messages(make_lines(*random_files(4))))
    rows = em.equity_of_line(facts)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = em.live_by_file(rows, facts)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert plan.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block_size", [7, 1000])
def test_run_matches_model(make_lines, seed, block_size):
    files = random_files(seed)
    kept, trades, archived, stats = model.run(files)
    facts = em.line_facts(em.parse_messages(make_lines(*files, block_size=block_size))).persist()
    checked = gated(facts)
    changes = em.equity_changes(em.equity_of_line(checked))
    found = changes.orderBy("file_ts", "block", "ord").collect()
    assert [(r["mode"], r.timestamp, r.equity) for r in found] == kept
    found = em.trades_of_line(checked).orderBy("file_ts", "block", "ord", "pos").collect()
    assert [(r["mode"], r.data_type, r.price, r.units, r.profit) for r in found] == [(t[0], *t[2:]) for t in trades]
    found = em.archive_of_line(checked).orderBy("file_ts", "block", "ord").collect()
    assert [(r["mode"], r.timestamp, json.loads(r.value)) for r in found] == archived
    counted = em.file_stats(checked, changes).orderBy("file_name").collect()
    names = ["total_records", "invalid_records", "missing_fields", "equity_records", "trade_records",
             "skipped_db_only_records", "skipped_equity_records", "empty_lines"]
    assert [tuple(r[n] for n in names) for r in counted] == stats
    facts.unpersist()


def test_on_change_with_nan_and_state(spark):
    nan = float("nan")
    values = [1.0, 1.0, nan, nan, 1.0, 2.0, 2.0, 2.0, 1.0]
    rows = [(0.0, "f", i // 2, i, "m", v) for i, v in enumerate(values)] + [(0.0, "f", 0, 100, "n", 5.0)]
    df = spark.createDataFrame(rows, "file_ts double, file_name string, block bigint, ord bigint, mode string, equity double")
    kept = lambda d: [r.ord for r in d.where("mode = 'm'").orderBy("ord").collect()]
    assert kept(em.equity_changes(df)) == [0, 2, 3, 4, 5, 8]
    assert kept(em.equity_changes(df, on_change=False)) == list(range(9))
    state = spark.createDataFrame([("m", 1.0), ("gone", 3.0)], "mode string, equity double")
    assert kept(em.equity_changes(df, state=state)) == [2, 3, 4, 5, 8]
    after = {r["mode"]: r.equity for r in em.carry_state(state, df).collect()}
    assert after == {"m": 1.0, "n": 5.0, "gone": 3.0}


def test_on_change_is_idempotent(spark):
    rows = [(0.0, "f", i // 5, i, f"m{i % 3}", float(i // 7 % 4)) for i in range(200)]
    df = spark.createDataFrame(rows, "file_ts double, file_name string, block bigint, ord bigint, mode string, equity double")
    once = em.equity_changes(df)
    assert sorted(once.collect()) == sorted(em.equity_changes(once).collect())


def test_filters_do_not_repeat_the_parse(make_lines):
    facts = em.line_facts(em.parse_messages(make_lines([line(1)]))).where((F.col("kind") == "data") & (F.col("equity") > 0))
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") <= 6
