"""Archive of the other items: compaction by hour, day, week or month, and its summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions.naming import UNDATED, period_name
from eventmart.operators.keys import ORDER
from eventmart.session import footer_session
from eventmart.sources.tables import PERIOD, Warehouse, archive_table


def compact(warehouse: Warehouse, rows: DataFrame, *, grain: str = "week", mode: str = "accumulate", gone: DataFrame | None = None) -> None:
    """Write archive rows into their periods, sorted by mode and time inside each file.

    ``accumulate`` keeps what earlier runs stored in the same periods; rows of a file that is archived again replace those
    stored from it. ``replace`` leaves only this run's rows in the periods it touches. ``gone`` (src) names files whose earlier
    rows go as well. Nothing stored is read or rewritten: readers resolve the versions, and ``Warehouse.merge`` brings those of
    a period into one, as a job of its own. ``rows`` should come from a staged table: they are read once for the sources and once
    for the write.
    """
    if mode not in ("accumulate", "replace"):
        raise ValueError(f"mode must be accumulate or replace, not {mode!r}")
    table = archive_table(grain)
    warehouse.add_sources(table, warehouse.place(table, rows), ["mode", "timestamp", *ORDER], whole=mode == "replace", gone=gone)


def read_archive(warehouse: Warehouse, mode: str | None = None, *, start: float | None = None,
                 end: float | None = None, grain: str = "week") -> DataFrame:
    return warehouse.read(archive_table(grain), mode, start=start, end=end)


def stored_periods(warehouse: Warehouse, grain: str = "week") -> DataFrame:
    """Rows and time span of each stored period, as far as they can be told from the file footers alone.

    Versions from which nothing was taken back give their counts, minima and maxima by their footers, one row group at a time;
    of older versions two columns are read. So are undated rows: NaN leaves a file without a minimum. The result belongs to a session
    beside the warehouse's. After ``Warehouse.merge`` all periods that several runs wrote come from footers.
    """
    table = archive_table(grain)
    beside = Warehouse(footer_session(warehouse.spark), warehouse.root, warehouse.width)
    whole, rest = beside.settled(table)
    dated = F.col(PERIOD) != UNDATED
    span = [F.count("*").alias("n_rows"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts")]
    # an aggregate is pushed only if it goes by all partition columns, so the others go by the period alone
    found = [whole.where(dated).groupBy(*beside.layout(table)).agg(*span).drop(*beside.layout(table)[:-1])]
    found += [df.groupBy(PERIOD).agg(*span) for df in (whole.where(~dated), rest)]
    return reduce(DataFrame.unionByName, found).groupBy(PERIOD).agg(
        F.sum("n_rows").alias("n_rows"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))


def compaction_summary(rows: DataFrame, grain: str = "week") -> DataFrame:
    """Rows and time span per mode and period."""
    return rows.groupBy("mode", period_name(F.col("timestamp"), grain).alias(PERIOD)).agg(
        F.count("*").alias("n_rows"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts")
    )


def time_range(rows: DataFrame) -> DataFrame:
    return rows.agg(F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))


def modes(rows: DataFrame) -> DataFrame:
    return rows.select("mode").distinct()


def files_by_mode(rows: DataFrame) -> DataFrame:
    """One row per mode and file that holds rows of it (not a list per mode, which has no bound)."""
    return rows.groupBy("mode", "src").agg(F.count("*").alias("n_rows"))


def distinct_timestamps(facts: DataFrame) -> DataFrame:
    """Timestamps of each file's accepted lines, with or without equity."""
    good = facts.where((F.col("kind") == "data") & F.col("reason").isNull())
    return good.select("file_name", "timestamp").distinct()
