"""Registry of modes: start messages in, first use recorded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions import values as v
from eventmart.operators.gate import registered
from eventmart.operators.keys import ORDER, latest_by_key
from eventmart.operators.parse import UNREADABLE
from eventmart.sources.tables import INSTANCES

# Fixed value: what a registry row is called when its configuration has no designator.
DEFAULT_DESIGNATOR = "strand_simulation"


def start_messages(facts: DataFrame, now: str) -> DataFrame:
    """One registry row per start message that names a mode, with its place in the run.

    ``component`` holds the designator and ``designator`` the strand id; ``now`` is stamped on.
    """
    rows = facts.where((F.col("kind") == "start") & F.col("mode").isNotNull()).select(*ORDER, "start.*")
    stamp = F.to_json(F.struct(F.lit(now).alias("processed_at")))
    opened = F.substring(F.col("data"), F.lit(1), F.length("data") - 1)
    data = F.concat(opened, F.lit(","), F.substr(stamp, F.lit(2)))
    return rows.withColumn("data", data).withColumn("processed_at", F.lit(now))


def registrations(facts: DataFrame, now: str) -> DataFrame:
    """The last start message of each mode."""
    return latest_by_key(start_messages(facts, now), ["mode"], ORDER)


def touch_instances(instances: DataFrame, facts: DataFrame, now: str) -> DataFrame:
    """Registry rows of modes that data lines use and no start message of the run sets anew:
    cached statistics dropped, ``processed_at`` set to ``now``."""
    lines = facts.where((F.col("kind") == "data") & (F.col("reason").isNull() | ~F.col("reason").isin(UNREADABLE)))
    used = lines.select("mode").distinct()
    started = facts.where(F.col("kind") == "start").select("mode").distinct()
    rows = instances.join(registered(instances).join(used, "mode", "left_semi"), "mode", "left_semi")
    rows = rows.join(started, "mode", "left_anti")
    config = F.from_json("data", "map<string,variant>")
    kept = F.map_filter(config, lambda key, _: ~key.isin("cachedStats", "processed_at"))
    rows = rows.withColumn("config", kept)
    named = lambda key, default: F.coalesce(v.as_text(F.try_element_at("config", F.lit(key))), F.lit(default))
    stamped = F.map_concat("config", F.create_map(F.lit("processed_at"), v.json_constant(F.lit(now))))
    return rows.select(
        "mode",
        named("designator", DEFAULT_DESIGNATOR).alias("component"),
        named("strand_id", "").alias("designator"),
        "live",
        F.to_json(stamped).alias("data"),
        F.lit(now).alias("processed_at"),
    )


def register_run(warehouse, facts: DataFrame, instances: DataFrame, now: str) -> None:
    """Store what a run does to the registry: the last start message of each mode, and the modes of ``touch_instances``.

    No mode is among both, so one aggregate by mode serves for all.
    """
    rows = start_messages(facts, now).unionByName(touch_instances(instances, facts, now), allowMissingColumns=True)
    warehouse.upsert(INSTANCES, rows, ORDER)


def upsert_instances(warehouse, rows: DataFrame, *, check_existing: bool = False) -> None:
    """Store registry rows; with ``check_existing`` modes already stored stay as they are."""
    if check_existing:
        rows = rows.join(warehouse.stored(INSTANCES).select("mode"), "mode", "left_anti")
    warehouse.upsert(INSTANCES, rows.withColumn("turn", F.lit(0)), ["turn"])
