"""Accepted lines to the rows of each sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.functions.naming import time_ns
from eventmart.operators.gate import accepted
from eventmart.operators.keys import ORDER


def equity_of_line(facts: DataFrame) -> DataFrame:
    return accepted(facts).where(F.col("equity").isNotNull()).select(
        *ORDER, "timestamp", time_ns(F.col("timestamp")).alias("time_ns"), "mode", "component", "equity"
    )


def trades_of_line(facts: DataFrame) -> DataFrame:
    """Trades in line order; rows without a storable time have no key and are left out."""
    rows = accepted(facts).where(F.col("trades").isNotNull())
    rows = rows.withColumn("time_ns", time_ns(F.col("timestamp"))).where(F.col("time_ns").isNotNull())
    return rows.select(*ORDER, "time_ns", "mode", F.inline("trades"))


def archive_of_line(facts: DataFrame) -> DataFrame:
    """One row per line that holds other items; ``src`` names the file it came from."""
    return accepted(facts).where(F.col("others").isNotNull()).select(
        "timestamp", "mode", "component", F.col("others").alias("value"), F.col("file_name").alias("src"), *ORDER
    )


def equity_with_candle(facts: DataFrame) -> DataFrame:
    """Equity rows with the line's last candle, typed; facts need ``line_facts(candle=True)``."""
    rows = accepted(facts).where(F.col("equity").isNotNull())
    return rows.select(
        *ORDER, time_ns(F.col("timestamp")).alias("time_ns"), "mode", "equity", "candle.*"
    ).drop("timestamp")
