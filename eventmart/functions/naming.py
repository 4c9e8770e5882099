"""Names, keys and calendar buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How the periods of a compacted archive are named.
GRAINS = {
    "hour": ("hourly", "yyyyMMddHH"),
    "day": ("daily", "yyyyMMdd"),
    "week": ("weekly", "yyyyMMdd"),
    "month": ("monthly", "yyyyMM"),
}

# Period of rows whose timestamp has no calendar date (NaN, infinite, out of range).
UNDATED = "undated"


def partition_name(mode: Column, width: int = 8) -> Column:
    """``p_`` and the first hex digits of the md5 of the mode.

    Eight digits name one mode each; fewer put several modes in a partition, so that the number of
    partitions stays bounded however many modes there are.
    """
    return F.concat(F.lit("p_"), F.substring(F.md5(mode), 1, width))


def time_ns(timestamp: Column) -> Column:
    """Epoch seconds to whole nanoseconds, truncated; NULL when out of range."""
    return (timestamp * F.lit(1e9)).try_cast("bigint")


def file_time(file_name: Column) -> Column:
    """Epoch seconds from ``<a>_<b>_yyyyMMdd_HHmmss.<ext>``; NULL for any other name."""
    pieces = F.split(file_name, "_")
    day = F.try_element_at(pieces, F.lit(3))
    clock = F.substring_index(F.try_element_at(pieces, F.lit(4)), ".", 1)
    stamp = F.when(
        day.rlike(r"^\d{8}$") & clock.rlike(r"^\d{6}$"),
        F.try_to_timestamp(F.concat(day, clock), F.lit("yyyyMMddHHmmss")),
    )
    return epoch_seconds(stamp)


def epoch_seconds(stamp: Column) -> Column:
    return F.unix_micros(stamp) / F.lit(1e6)


def output_name(file_name: Column, file_id: Column) -> Column:
    """``{stem}_{content id}.parquet``"""
    return F.concat(F.regexp_replace(file_name, r"(?<=.)\.[^.]*$", ""), F.lit("_"), file_id, F.lit(".parquet"))


def _stamp(seconds: Column) -> Column:
    # micros must fit a BIGINT, and the year a date
    micros = (seconds * F.lit(1e6)).try_cast("bigint")
    return F.when(F.abs(seconds) < 2.5e11, F.timestamp_micros(micros))


def period_start(seconds: Column, grain: str) -> Column:
    """Start of the hour, day, week (Monday) or month that holds the moment."""
    return F.date_trunc(grain, _stamp(seconds))


def period_name(seconds: Column, grain: str) -> Column:
    """For example ``weekly_20240226``."""
    prefix, pattern = GRAINS[grain]
    text = F.date_format(period_start(seconds, grain), pattern)
    return F.coalesce(F.concat(F.lit(prefix + "_"), text), F.lit(UNDATED))


def period_of_ns(nanos: Column, grain: str) -> Column:
    prefix, pattern = GRAINS[grain]
    micros = F.floor(nanos / F.lit(1000)).cast("bigint")
    return F.concat(F.lit(prefix + "_"), F.date_format(F.date_trunc(grain, F.timestamp_micros(micros)), pattern))
