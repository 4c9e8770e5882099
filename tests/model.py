"""The line rules once more in plain Python, for small fixtures: what a run must produce."""

from __future__ import annotations

import json

TRADES = {"open", "close", "adjust-open", "adjust-close"}


class Bad(Exception):
    pass


def number(x):
    if isinstance(x, (bool, int, float, str)):
        try:
            return float(x)
        except ValueError:
            pass
    raise Bad


def judge(text: str, open_modes: set[str]):
    """(outcome, detail) of one line; registers the mode of a start message."""
    text = text.strip()
    if not text:
        return "blank", None
    try:
        doc = json.loads(text)
    except ValueError:
        return "bad_json", None
    if not isinstance(doc, dict):
        return "not_object", None
    if doc.get("type") in ("ensemble_started", "strand_started"):
        config, live = doc.get("config", {}), doc.get("live", False)
        if isinstance(config, dict) and isinstance(live, (bool, str)):
            open_modes.add(doc.get("mode", "unknown"))
            return "start", doc
    if not all(doc.get(f) for f in ("timestamp", "mode", "component", "value")):
        return "missing", None
    if doc["mode"] not in open_modes:
        return "no_config", None
    value = doc["value"] if isinstance(doc["value"], list) else [doc["value"]]
    try:
        stamp = number(doc["timestamp"])
        equity, trades, others = None, [], []
        for item in value:
            if not isinstance(item, dict):
                raise Bad
            tag = item.get("t")
            if tag == "e":
                try:
                    equity = number(item.get("equity", 0.0))
                except Bad:
                    pass
            elif isinstance(tag, str) and tag in TRADES:
                trades.append((tag, *(number(item.get(k, 0.0)) for k in ("price", "units", "profit"))))
            elif tag:
                others.append(item)
    except Bad:
        return "bad", None
    return "ok", (doc["mode"], stamp, equity, trades, others)


def run(files: list[list[str]]):
    """(equity kept, trades, archived, counters per file) of a run over files in order."""
    open_modes, last = set(), {}
    kept, trades, archived, stats = [], [], [], []
    for lines in files:
        c = dict.fromkeys(["total", "invalid", "missing", "equity", "trades", "db_only", "same", "blank"], 0)
        for text in lines:
            outcome, found = judge(text, open_modes)
            c["blank"] += outcome == "blank"
            c["total"] += outcome not in ("blank", "bad_json", "start")
            c["invalid"] += outcome in ("bad_json", "not_object", "bad")
            c["missing"] += outcome in ("missing", "no_config")
            if outcome != "ok" or found[2] is None:
                continue
            mode, stamp, equity, line_trades, others = found
            trades += [(mode, stamp, *t) for t in line_trades]
            c["trades"] += len(line_trades)
            if others:
                archived.append((mode, stamp, others))
            c["db_only"] += not others
            if last.get(mode) is None or last[mode] != equity:
                kept.append((mode, stamp, equity))
                last[mode] = equity
                c["equity"] += 1
            else:
                c["same"] += 1
        stats.append(tuple(c.values()))
    return kept, trades, archived, stats
