"""Configuration gate and live flag: two as-of look-ups on the mode."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.operators.keys import FILE, broadcast_if_small, position
from eventmart.operators.parse import NO_CONFIG, UNREADABLE


def first_starts(facts: DataFrame) -> DataFrame:
    """Where in the run each mode registers for the first time."""
    starts = facts.where((F.col("kind") == "start") & F.col("mode").isNotNull())
    return starts.groupBy("mode").agg(F.min(position()).alias("opens"))


def registered(instances: DataFrame) -> DataFrame:
    """Modes whose registry row holds a configuration that is not empty."""
    config = F.try_parse_json("data")
    filled = F.coalesce(F.schema_of_variant(config).startswith("OBJECT<") &
                        (F.schema_of_variant(config) != "OBJECT<>"), F.lit(False))
    return instances.where(filled).select("mode")


def open_modes(facts: DataFrame, instances: DataFrame | None = None) -> DataFrame:
    """Per mode: known before the run, and the first start message in it."""
    opens = first_starts(facts).select("mode", F.lit(False).alias("known"), "opens")
    if instances is not None:
        before = registered(instances).select("mode", F.lit(True).alias("known"))
        opens = opens.unionByName(before, allowMissingColumns=True)
    return opens.groupBy("mode").agg(F.max("known").alias("known"), F.min("opens").alias("opens"))


def gate_configs(facts: DataFrame, gates: DataFrame) -> DataFrame:
    """Data lines of a mode that is not registered before them get the reason ``no_config``.

    Once a mode is open it stays open, so its first start message decides; ``gates`` is
    ``open_modes`` staged. Lines without a mode spread over many join keys. Only ``reason`` changes, so
    filters on the other columns still reach the scan.
    """
    key = F.coalesce(F.col("mode"), F.concat(F.lit("\u0000"), (F.col("ord") % 4096).cast("string")))
    gates = broadcast_if_small(gates).select(F.col("mode").alias("gate_mode"), "known", "opens")
    joined = facts.join(gates, key == F.col("gate_mode"), "left")
    is_open = F.coalesce(F.col("known") | (F.col("opens") < position()), F.lit(False))
    needs = (F.col("kind") == "data") & (F.col("reason").isNull() | ~F.col("reason").isin(UNREADABLE))
    shut = needs & ~is_open
    gated_reason = F.when(shut, NO_CONFIG).otherwise(F.col("reason")).alias("reason")
    return joined.select(*[gated_reason if c == "reason" else c for c in facts.columns])


def accepted(facts: DataFrame) -> DataFrame:
    """Data lines that passed every check."""
    return facts.where((F.col("kind") == "data") & F.col("reason").isNull())


def live_by_file(rows: DataFrame, facts: DataFrame, instances: DataFrame | None = None) -> DataFrame:
    """(mode, file) -> live flag in force at the end of that file.

    The windows run over one row per mode and file, not over lines.
    """
    place = F.struct("block", "ord")
    starts = facts.where(F.col("kind") == "start").select("mode", *FILE, F.col("start.live").alias("live"), place.alias("place"))
    needed = rows.select("mode", *FILE)
    # one aggregate, so that the union's parts are added up before the one shuffle; rows without a place tell nothing of the flag
    files = starts.unionByName(needed, allowMissingColumns=True).groupBy("mode", *FILE).agg(F.max_by("live", "place").alias("live"))
    so_far = Window.partitionBy("mode").orderBy(*FILE).rowsBetween(Window.unboundedPreceding, 0)
    flags = files.withColumn("live", F.last("live", ignorenulls=True).over(so_far))
    if instances is not None:
        before = instances.select("mode", F.col("live").alias("live_before"))
        flags = flags.join(before, "mode", "left").withColumn("live", F.coalesce("live", "live_before"))
    return flags.select("mode", *FILE, F.coalesce("live", F.lit(False)).alias("live"))


def attach_live(rows: DataFrame, flags: DataFrame) -> DataFrame:
    """Add ``live`` to rows; ``flags`` is ``live_by_file`` staged."""
    return rows.join(broadcast_if_small(flags), ["mode", *FILE], "left")
