"""What the operators of this folder share: sessions, staged tables, words and hashes in numpy."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.operators.keys import BROADCAST_LIMIT
from eventmart.session import Staging

# executors need not have this package installed: its functions travel with the task
cloudpickle.register_pickle_by_value(sys.modules["eventmart.llm"])

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # whole texts of any length go to Python: a batch is bounded by bytes, not only by rows
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    # shuffle files go when the action that made them ends; every later step reads a written table
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def prepare(spark: SparkSession) -> Staging:
    """Set what the operators rely on; the area for the tables that they write in between."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return Staging(spark)


def load(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


BITMAP = 1 << 15  # places of one of Spark's bitmaps
SPARSE = 16  # places for each id


def sift(rows: DataFrame, key: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts: those whose ``key`` may be among ``ids`` (id), and those whose key is not.

    The first part has every row with one of the ids, and about one in SPARSE of the others: a join with the ids that follows
    need not shuffle the rest. The ids travel as bitmaps, two bytes for each; where these are no small broadcast, all rows are in
    the first part. Pass staged ids, since they are counted first.
    """
    maps = max(1, -(-ids.count() * SPARSE // BITMAP))
    if maps * BITMAP // 8 > BROADCAST_LIMIT:
        return rows, rows.limit(0)
    number, bits, place = (next(n for k in range(len(rows.columns) + 1) if (n := f"_sift_{x}{k}") not in rows.columns) for x in "nbp")
    of = lambda c: F.pmod(F.xxhash64(F.col(c).cast("bigint")), F.lit(maps * BITMAP))
    marked = ids.select(of("id").alias(place)).select(F.expr(f"{place} div {BITMAP}").alias(number), (F.col(place) % BITMAP).alias(place))
    marked = marked.repartition(number).groupBy(number).agg(F.bitmap_construct_agg(place).alias(bits))
    placed = rows.withColumn(place, of(key)).withColumn(number, F.expr(f"{place} div {BITMAP}")).withColumn(place, F.col(place) % BITMAP)
    byte = f"int(conv(hex(substr({bits}, int({place} div 8) + 1, 1)), 16, 10))"
    joined = placed.join(F.broadcast(marked), number, "left")
    found = F.coalesce(F.expr(f"shiftright({byte}, int({place} % 8)) % 2 = 1"), F.lit(False))
    return joined.where(found).select(rows.columns), joined.where(~found).select(rows.columns)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing step: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * M2
    x ^= x >> np.uint64(27)
    x *= M1
    return x ^ (x >> np.uint64(31))


def split_words(text: str, lower: bool = False) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; ``lower`` changes A-Z only."""
    data = text.encode()
    return (data.lower() if lower else data).split()


class WordHash(dict):
    """64-bit hashes of words, remembered until ``limit`` words are held."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def windows_of(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` neighbours; a shorter sequence counts as one run."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(size, n)
    out = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        out = mix(out * M1 + hashes[i : n - size + 1 + i])
    return out
