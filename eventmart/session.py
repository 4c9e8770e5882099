"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from eventmart.sources import fs

# Runtime SQL settings the operators rely on.
SETTINGS = {
    # calendar buckets follow the session zone; one zone for every run of a warehouse
    "spark.sql.session.timeZone": "UTC",
    # JSON objects may repeat a key: the last one counts
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_local_roots: dict[str, tempfile.TemporaryDirectory] = {}


def configure(spark: SparkSession, time_zone: str = "UTC") -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", time_zone)
    return spark


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` whose counts, minima and maxima of Parquet columns come from the file footers.

    Spark pushes aggregates only into the newer kind of file source, and both settings hold for all that a session reads.
    """
    beside = configure(spark.newSession(), spark.conf.get("spark.sql.session.timeZone"))
    older = [name for name in beside.conf.get("spark.sql.sources.useV1SourceList").split(",") if name.strip() != "parquet"]
    beside.conf.set("spark.sql.sources.useV1SourceList", ",".join(older))
    beside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return beside


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may leave it unset; it then gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.TemporaryDirectory(prefix="eventmart-")
    return _local_roots[app].name


class Staging:
    """Parquet tables that cut lineage: written once, read by every later step with column pruning.

    Unlike cached blocks they outlive the executor that wrote them.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{staging_root(spark)}/eventmart-{uuid.uuid4().hex}"
        # what a query's result still reads cannot be dropped by the query: it goes when the driver ends
        fs.delete_on_exit(spark, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.mode("errorifexists").option("compression", "snappy").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def forget(self, *names: str) -> None:
        """Delete tables that nothing reads any more, so that a long job does not hold all its steps on disk."""
        for name in names:
            fs.delete(self.spark, self.path(name))

    def drop(self) -> None:
        fs.delete(self.spark, self.root)


class Resumable(Staging):
    """Staged tables in a folder that outlives a job that died: those that are complete are not made again."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        if not fs.exists(self.spark, f"{path}/_SUCCESS"):
            df.write.mode("overwrite").option("compression", "snappy").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession):
    """Staged tables for the length of one job."""
    area = Staging(spark)
    try:
        yield area
    finally:
        area.drop()
