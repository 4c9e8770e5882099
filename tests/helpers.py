"""Log lines for tests."""

from __future__ import annotations


def start(mode="m", live=None, **config):
    message = {"type": "strand_started", "mode": mode, "component": "strand", "config": {"name": "n", **config}}
    if live is not None:
        message["live"] = live
    return message


def line(equity=None, *items, mode="m", ts=1740743175.985, **other):
    value = [*items]
    if equity is not None:
        value.append({"t": "e", "equity": equity, "b": "paper"})
    return {"timestamp": ts, "mode": mode, "component": "strand", "value": value, **other}
