"""Line order, last-write-wins and size-checked broadcasts: shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A file, a split of that file, a line in that split: the total order of lines in a run.
FILE = ["file_ts", "file_name"]
CHUNK = [*FILE, "block"]
ORDER = [*CHUNK, "ord"]

BROADCAST_LIMIT = 64 * 1024 * 1024


def position(columns: list[str] = ORDER) -> Column:
    return F.struct(*columns)


def latest_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of every key. Aggregated before the shuffle, so a hot key stays small."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"newest.`{c}`").alias(c) for c in rest])


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Broadcast hint only when the measured size is under the limit.

    Above it the frame is returned as it is: the join then shuffles, and adaptive execution splits
    the hot keys of the large side. Pass a staged table, since the measurement is a job of its own.
    """
    width = sum(
        (F.coalesce(F.octet_length(c), F.lit(0)) + 16 if t == "string" else F.lit(16) for c, t in df.dtypes),
        F.lit(16),
    )
    size = df.agg(F.sum(width)).first()[0] or 0
    return F.broadcast(df) if size <= limit else df
