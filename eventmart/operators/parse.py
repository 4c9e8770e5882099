"""Log lines to typed, classified messages. Map-only: nothing here shuffles."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions import values as v
from eventmart.operators.keys import ORDER

# Message types that register a mode, and item tags with a meaning of their own.
START_TYPES = ["ensemble_started", "strand_started"]
EQUITY_TAG = "e"
CANDLE_TAG = "c"
TRADE_TAGS = ["open", "close", "adjust-open", "adjust-close"]

# kind:   blank | start | data
# reason: why a data line yields nothing (NULL: it is good)
BAD_JSON, NOT_OBJECT, MISSING, NO_CONFIG = "bad_json", "not_object", "missing", "no_config"
BAD_TIMESTAMP, BAD_VALUE = "bad_timestamp", "bad_value"
UNREADABLE = [BAD_JSON, NOT_OBJECT, MISSING]

# Texts that a falsy value other than "" prints as: 0, false, [] and {} look the same as their quoted forms.
_AMBIGUOUS = ["0", "0.0", "-0.0", "false", "[]", "{}"]

# Wrapped in [ ], a line with anything after its first JSON value no longer parses to one element.
_STRICT = {"allowSingleQuotes": "false"}
_LEAVES = ["equity", "price", "units", "profit", "id", "instrument"]
_ITEM = "struct<t string, {}>".format(", ".join(f"{leaf} variant" for leaf in _LEAVES))
_CANDLE = "struct<open double, high double, low double, close double, n bigint, volume bigint, timestamp double>"


def _once(rows: DataFrame) -> DataFrame:
    """Compute the columns of each row once.

    A filter or generator on parsed columns would otherwise be pushed below the parse, taking a copy
    of the whole expression with it; it does not move below this one-row generator.
    """
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def _json_fields(**fields: str):
    """The line as a list of objects with these fields."""
    schema = "array<struct<{}>>".format(", ".join(f"`{name}` {kind}" for name, kind in fields.items()))
    return F.from_json(F.concat(F.lit("["), F.col("line"), F.lit("]")), schema, _STRICT)


def parse_messages(lines: DataFrame, *, mode_field: str = "mode") -> DataFrame:
    """One row per line: ``kind``, ``reason``, the envelope, the registry row of a start message,
    and the classified items of a good data line as (pos, cls, tag, leaves).

    The usual line is read with a typed schema. A line with anything unusual in it (a number in
    quotes, a value that is no list, a falsy field) is read again as VARIANT, which tells a text from
    a number and an absent key from a null. ``mode_field`` names the key that holds the mode (older
    logs use ``type``).
    """
    steps, columns = _message_columns(mode_field)
    rows = lines
    for step in steps:
        rows = rows.withColumns(step)
    return _once(rows.select(*columns))


@lru_cache
def _message_columns(mode_field: str) -> tuple[list[dict[str, Column]], list[Column]]:
    """The columns added one after the other, and those of the result; built once per process."""
    typed = {"timestamp": "double", mode_field: "string", "component": "string", "type": "string",
             "value": f"array<{_ITEM}>"}
    loose = {"timestamp": "variant", mode_field: "variant", "component": "variant", "value": "variant"}
    asked = {"mode": "variant", "component": "variant", "live": "variant", "config": "variant",
             "config_file_path": "variant"}
    doc, exact, is_start = F.col("doc"), F.col("exact"), F.col("start").isNotNull()
    is_data = doc.isNotNull() & ~is_start
    steps = [
        {"readable": F.is_valid_utf8("line"), "line": v.strip(F.col("line"))},
        {"docs": F.when(F.col("readable") & (F.col("line") != ""), _json_fields(**typed))},
        {"doc": F.when(F.size("docs") == 1, F.col("docs")[0])},
        {"asked": F.when(doc["type"].isin(START_TYPES), _json_fields(**asked)[0])},
        {"start": _start(F.col("asked"))},
    ]
    unusual = (
        doc["timestamp"].isNull() | doc["value"].isNull()
        | F.coalesce(doc[mode_field].isin(_AMBIGUOUS), F.lit(False))
        | F.coalesce(doc["component"].isin(_AMBIGUOUS), F.lit(False))
        | F.exists(doc["value"], lambda x: x.isNull() | F.coalesce(x["t"].isin(_AMBIGUOUS), F.lit(False)))
    )
    steps.append({"exact": F.when(is_data & unusual, _json_fields(**loose)[0])})

    def either(usual, closer):
        return F.when(exact.isNull(), usual).otherwise(closer)

    value = exact["value"]
    entries = F.coalesce(v.as_list(value), F.when(v.is_object(value), F.array(value)))
    items = either(F.transform(doc["value"], _item), F.transform(entries, _loose_item))
    steps.append({
        "items": F.when(is_data, items),
        "ts": F.when(is_data, either(doc["timestamp"], v.as_float(exact["timestamp"]))),
    })
    complete = (
        either(doc["timestamp"] != 0.0, v.is_truthy(exact["timestamp"]))
        & either(F.coalesce(doc[mode_field] != "", F.lit(False)), v.is_truthy(exact[mode_field]))
        & either(F.coalesce(doc["component"] != "", F.lit(False)), v.is_truthy(exact["component"]))
        & either(F.size(doc["value"]) > 0, v.is_truthy(value))
    )
    odd = either(F.lit(False), entries.isNull() | F.exists(entries, lambda x: ~v.is_object(x)))
    # one value that is no object still counts as a line read; anything else is broken JSON
    wrapped = F.concat(F.lit("["), F.col("line"), F.lit("]"))
    one_value = F.size(F.from_json(wrapped, "array<variant>", _STRICT)) == 1
    is_blank = F.col("readable") & (F.col("line") == "")
    reason = (
        F.when(~F.col("readable"), BAD_JSON)
        .when(is_blank | is_start, F.lit(None))
        .when(doc.isNull(), F.when(one_value, NOT_OBJECT).otherwise(BAD_JSON))
        .when(~complete, MISSING)
        .when(F.col("ts").isNull(), BAD_TIMESTAMP)
        .when(odd, BAD_VALUE)
    )
    steps.append({"kind": F.when(is_blank, "blank").when(is_start, "start").otherwise("data"), "reason": reason})
    data = F.col("kind") == "data"
    good = data & F.col("reason").isNull()
    known = data & (F.col("reason").isNull() | ~F.col("reason").isin(UNREADABLE))
    columns = [
        *[F.col(c) for c in (*ORDER, "kind", "reason")],
        F.when(known, F.col("ts")).alias("timestamp"),
        F.when(known, doc[mode_field]).when(F.col("kind") == "start", F.col("start.mode")).alias("mode"),
        F.when(known, doc["component"]).alias("component"),
        F.col("start"),
        F.when(good, F.col("items")).alias("items"),
        F.when(good, F.col("line")).alias("line"),
    ]
    return steps, columns


def _start(doc: Column) -> Column:
    """The registry row a start message asks for; NULL when the line is not a valid one.

    Its configuration must be an object and its live flag, when given, a boolean or a text.
    """
    config = F.coalesce(v.as_object(doc["config"]), F.create_map().cast("map<string,variant>"))
    live_ok = doc["live"].isNull() | v.is_boolean(doc["live"]) | v.is_text(doc["live"])
    config_ok = doc["config"].isNull() | v.is_object(doc["config"])
    live = F.coalesce(F.lower(v.as_text(doc["live"])) == "true", F.lit(False))
    component = F.when(doc["component"].isNull(), "unknown").otherwise(
        F.coalesce(v.as_text(doc["component"]), F.lit("None"))
    )
    designator = F.concat(component, F.when(live, "_live").otherwise("_simulation"))
    added = {
        "source_file": F.parse_json(F.lit("null")),
        "config_path": F.coalesce(doc["config_file_path"], v.json_constant(F.lit(""))),
        "designator": v.json_constant(designator),
        "tuning_date_range": F.coalesce(F.try_element_at(config, F.lit("tuning_date_range")),
                                        v.json_constant(F.lit(""))),
        "live": live.cast("variant"),
    }
    replaced = [*added, "processed_at"]
    kept = F.map_filter(config, lambda key, _: ~key.isin(replaced))
    extra = F.create_map(*[part for key, value in added.items() for part in (F.lit(key), value)])
    strand = F.try_element_at(config, F.lit("strand_id"))
    row = F.struct(
        F.when(doc["mode"].isNull(), "unknown").otherwise(v.as_text(doc["mode"])).alias("mode"),
        designator.alias("component"),
        F.when(strand.isNull(), "").otherwise(v.as_text(strand)).alias("designator"),
        live.alias("live"),
        F.to_json(F.map_concat(kept, extra)).alias("data"),
    )
    return F.when(doc.isNotNull() & live_ok & config_ok, row)


def _entry(pos: Column, tag: Column, shown: Column, leaves) -> Column:
    cls = (
        F.when(tag == EQUITY_TAG, "equity")
        .when(tag.isin(TRADE_TAGS), "trade")
        .when(shown, "other")
    )
    return F.struct(pos.alias("pos"), cls.alias("cls"), tag.alias("tag"), *[leaves(n).alias(n) for n in _LEAVES])


def _item(x: Column, pos: Column) -> Column:
    return _entry(pos, x["t"], x["t"] != "", lambda name: x[name])


def _loose_item(x: Column, pos: Column) -> Column:
    return _entry(pos, F.try_variant_get(x, "$.t", "string"), v.is_truthy(v.field(x, "t")), lambda name: v.field(x, name))


def trade_of_item(entry: Column) -> Column:
    """Typed trade fields and the JSON payload, keys in the order id, instrument, price, profit, units, t."""
    blank = v.json_constant(F.lit(""))
    price, units, profit = (v.float_or_default(entry[key]) for key in ("price", "units", "profit"))
    payload = F.to_json(
        F.struct(
            F.coalesce(entry["id"], blank).alias("id"),
            F.coalesce(entry["instrument"], blank).alias("instrument"),
            price.alias("price"),
            profit.alias("profit"),
            units.alias("units"),
            entry["tag"].alias("t"),
        )
    )
    return F.struct(
        entry["pos"].alias("pos"),
        entry["tag"].alias("data_type"),
        v.text_or_default(entry["instrument"]).alias("instrument"),
        price.alias("price"),
        units.alias("units"),
        profit.alias("profit"),
        v.text_or_default(entry["id"]).alias("id"),
        payload.alias("data"),
    )


def line_facts(messages: DataFrame, *, require_equity: bool = True, candle: bool = False) -> DataFrame:
    """Collapse the items of each line to what the sinks need; a narrow row per line.

    ``equity`` is the last valid equity item, ``trades`` a typed list, ``others`` a JSON list. A trade
    with a price, unit or profit that is no number voids its whole line. Without a valid equity the
    line yields nothing, unless ``require_equity`` is off. ``candle`` adds the line's last candle.
    """
    steps, columns = _fact_columns(require_equity, candle)
    facts = messages
    for step in steps:
        facts = facts.withColumns(step)
    return _once(facts.select(*columns))


@lru_cache
def _fact_columns(require_equity: bool, candle: bool) -> tuple[list[dict[str, Column]], list[Column]]:
    items = F.col("items")
    equities = F.filter(
        F.transform(F.filter(items, lambda e: e["cls"] == "equity"), lambda e: v.float_or_default(e["equity"])),
        lambda x: x.isNotNull(),
    )
    trades = F.transform(F.filter(items, lambda e: e["cls"] == "trade"), trade_of_item)
    broken = F.exists("trades", lambda t: t["price"].isNull() | t["units"].isNull() | t["profit"].isNull())
    steps = [
        {"equity": F.try_element_at(equities, F.lit(-1)), "trades": trades},
        {"reason": F.when(F.coalesce(broken, F.lit(False)), BAD_VALUE).otherwise(F.col("reason"))},
    ]
    usable = items.isNotNull() & F.col("reason").isNull()
    if require_equity:
        usable = usable & F.col("equity").isNotNull()
    is_other = lambda e: e["cls"] == "other"
    # the items once more as text, only where they are stored; a lone object is a list of one
    texts = F.coalesce(_json_fields(value="array<string>")[0]["value"], F.array(_json_fields(value="string")[0]["value"]))
    others = F.when(
        usable & F.exists(items, is_other),
        F.concat(F.lit("["), F.array_join(F.filter(texts, lambda _, i: is_other(items[i])), ","), F.lit("]")),
    )
    columns = [
        *[F.col(c) for c in (*ORDER, "kind", "reason", "timestamp", "mode", "component", "start")],
        F.when(usable, F.col("equity")).alias("equity"),
        F.when(usable & (F.size("trades") > 0), F.col("trades")).alias("trades"),
        others.alias("others"),
    ]
    if candle:
        item = f"struct<t string, candle {_CANDLE}>"
        whole = F.coalesce(_json_fields(value=f"array<{item}>")[0]["value"], F.array(_json_fields(value=item)[0]["value"]))
        candles = F.filter(whole, lambda e: e["t"] == CANDLE_TAG)
        columns.append(F.when(usable, F.try_element_at(candles, F.lit(-1))["candle"]).alias("candle"))
    return steps, columns


def explode_items(messages: DataFrame) -> DataFrame:
    """One row per item of every good data line, in order, with its class (NULL class: dropped)."""
    return messages.where((F.col("kind") == "data") & F.col("reason").isNull()).select(
        *ORDER, "timestamp", "mode", "component", F.inline("items")
    )
