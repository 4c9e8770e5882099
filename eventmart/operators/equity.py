"""Equity kept on change."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.operators.keys import CHUNK, position


def equity_changes(rows: DataFrame, *, on_change: bool = True, state: DataFrame | None = None) -> DataFrame:
    """Keep a row when its mode has no earlier equity or a different one (NaN differs from all).

    Two levels, so that no task holds a whole mode: rows are compared inside one split of one file,
    and the first row of a split with the last equity of the mode's previous split, which comes from
    a table of one row per mode and split. ``state`` (mode, equity) carries on from an earlier run.
    """
    if not on_change:
        return rows
    inside = Window.partitionBy("mode", *CHUNK).orderBy("ord")
    numbered = rows.withColumn("before", F.lag("equity").over(inside)).withColumn(
        "heads", F.lag(F.lit(False), 1, True).over(inside)
    )
    across = Window.partitionBy("mode").orderBy(*CHUNK)
    ends = (
        rows.groupBy("mode", *CHUNK)
        .agg(F.max_by("equity", "ord").alias("equity"))
        .withColumn("carried", F.lag("equity").over(across))
    )
    if state is not None:
        ends = ends.join(state.select("mode", F.col("equity").alias("kept")), "mode", "left")
        ends = ends.withColumn("carried", F.coalesce("carried", "kept"))
    joined = numbered.join(ends.select("mode", *CHUNK, "carried"), ["mode", *CHUNK], "left")
    before = F.when(F.col("heads"), F.col("carried")).otherwise(F.col("before"))
    kept = before.isNull() | F.isnan("equity") | (before != F.col("equity"))
    return joined.where(kept).select(*rows.columns)


def last_equity(rows: DataFrame) -> DataFrame:
    """(mode, equity) after these rows: the state a later run starts from."""
    return rows.groupBy("mode").agg(F.max_by("equity", position()).alias("equity"))


def carry_state(state: DataFrame, rows: DataFrame) -> DataFrame:
    """The state after one more run."""
    newer = last_equity(rows)
    return newer.unionByName(state.join(newer, "mode", "left_anti").select("mode", "equity"))
