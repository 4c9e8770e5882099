"""Quality counters per file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.operators import parse as p


def file_stats(facts: DataFrame, kept: DataFrame) -> DataFrame:
    """Counters of each file from gated facts and the equity rows kept by the on-change filter.

    Start messages are not counted; broken JSON counts as invalid only. ``processed`` is total less
    invalid, missing and lines without archived items, and may be negative. ``equity_records`` are the rows that can be
    stored; those whose time is no point in time are ``undated_records``.
    """
    reason, data = F.col("reason"), F.col("kind") == "data"
    of = lambda *names: F.coalesce(reason.isin(*names), F.lit(False))
    stored = data & reason.isNull() & F.col("equity").isNotNull()
    counts = facts.groupBy("file_name").agg(
        F.count_if(data & ~of(p.BAD_JSON)).alias("total_records"),
        F.count_if(data & of(p.BAD_JSON, p.NOT_OBJECT, p.BAD_TIMESTAMP, p.BAD_VALUE)).alias("invalid_records"),
        F.count_if(data & of(p.MISSING, p.NO_CONFIG)).alias("missing_fields"),
        F.count_if(stored).alias("with_equity"),
        F.coalesce(F.sum(F.when(stored & F.col("trades").isNotNull(), F.size("trades"))), F.lit(0)).alias("trade_records"),
        F.count_if(stored & F.col("others").isNull()).alias("skipped_db_only_records"),
        F.count_if(stored & F.col("others").isNotNull()).alias("archived_rows"),
        F.count_if(F.col("kind") == "blank").alias("empty_lines"),
    )
    changes = kept.groupBy("file_name").agg(F.count("time_ns").alias("kept"), F.count_if(F.col("time_ns").isNull()).alias("undated"))
    kept_rows, undated = F.coalesce("kept", F.lit(0)), F.coalesce("undated", F.lit(0))
    return counts.join(changes, "file_name", "left").select(
        "file_name",
        "total_records",
        "invalid_records",
        "missing_fields",
        kept_rows.alias("equity_records"),
        "trade_records",
        "skipped_db_only_records",
        (F.col("with_equity") - kept_rows - undated).alias("skipped_equity_records"),
        "empty_lines",
        "archived_rows",
        (F.col("total_records") - F.col("invalid_records") - F.col("missing_fields")
         - F.col("skipped_db_only_records")).alias("processed"),
        undated.alias("undated_records"),
    )
