"""Parquet tables of a warehouse: fixed schemas, partition layout, keyed upsert, reads, merges and deletes."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.naming import UNDATED, partition_name, period_name, period_of_ns
from eventmart.operators.keys import broadcast_if_small, latest_by_key
from eventmart.sources import fs

# Partition columns: hash of the mode, then the period of the row's time; keyed tables have a version above them.
PART, PERIOD, VERSION = "part", "period", "version"


@dataclass(frozen=True)
class Table:
    name: str
    schema: str
    keys: tuple[str, ...]
    time: str | None = None  # time_ns, timestamp or None (no period)
    grain: str = "month"
    by_source: bool = False  # rows go by the file they came from instead of by keys: a file's newest version counts

    @property
    def partitions(self) -> list[str]:
        return [PART, PERIOD] if self.time else [PART]

    @property
    def columns(self) -> list[str]:
        return [field.split()[0] for field in self.schema.split(", ")]

    def period(self) -> Column:
        column = F.col(self.time)
        return period_of_ns(column, self.grain) if self.time == "time_ns" else period_name(column, self.grain)


EQUITY = Table("equity", "time_ns bigint, mode string, equity double", ("mode", "time_ns"), "time_ns")
TRADES = Table(
    "trades",
    "time_ns bigint, mode string, data_type string, instrument string, price double, units double, "
    "profit double, id string, data string",
    ("mode", "time_ns", "data_type"),
    "time_ns",
)
INSTANCES = Table(
    "instances",
    "mode string, component string, designator string, live boolean, data string, processed_at string",
    ("mode",),
)
# The last equity of each mode as the stream left it; a batch adds the modes it saw.
STREAM_STATE = Table("stream_state", "mode string, equity double", ("mode",))
ARCHIVE_SCHEMA = (
    "timestamp double, mode string, component string, value string, src string, file_ts double, "
    "file_name string, block bigint, ord bigint"
)


# What a version of an archive takes back of older ones: a source, or a partition with all its rows.
INDEX = f"src string, {PART} string, {PERIOD} string"


def archive_table(grain: str = "week") -> Table:
    return Table(f"archive_{grain}", ARCHIVE_SCHEMA, ("src", "block", "ord"), "timestamp", grain, by_source=True)


class Warehouse:
    """Where the tables live.

    An upsert of a keyed table writes its rows as a new version, ``version=N/part=.../period=...``, and reads nothing
    that is stored. Readers keep the newest row of each key. ``merge`` writes the resolved rows of the partitions that
    occur in several versions as the next version and then drops the older copies; as a merge is a version like any
    other, a reader sees the same rows before it, after it and after one that died half way.

    The archive is kept in the same way, by sources: beside each version lies an index of the sources that it holds anew and
    of the partitions that it holds whole, and rows of older versions that an index takes back are not read.

    ``width`` hex digits of the mode's md5 name a partition: 16 ** width partitions per period
    however many modes there are. Eight digits give every mode partitions of its own.
    """

    def __init__(self, spark: SparkSession, root: str, width: int = 2):
        self.spark = spark
        self.root = root.rstrip("/")
        self.width = width

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.name}"

    def exists(self, table: Table) -> bool:
        return fs.exists(self.spark, self.path(table))

    def folder(self, table: Table, version: str) -> str:
        return f"{self.path(table)}/{VERSION}={version}"

    def versions(self, table: Table) -> list[str]:
        """Complete versions, oldest first; what a run that died left behind is not among them."""
        names = [n.split("=")[1] for n in fs.list_names(self.spark, self.path(table)) if n.startswith(f"{VERSION}=")]
        return [n for n in names if fs.exists(self.spark, f"{self.folder(table, n)}/_SUCCESS")]

    def newest(self, table: Table) -> str:
        """The newest complete version, or "" where there is none: what ``stored`` can be read as of."""
        return max(self.versions(table), default="")

    def layout(self, table: Table) -> list[str]:
        return [VERSION, *table.partitions]

    def raw(self, table: Table, as_of: str | None = None, since: str = "") -> DataFrame:
        """All rows of all versions, from ``since`` up to ``as_of``, with their partition columns; an empty frame when there are none."""
        schema = ", ".join([table.schema, *[f"{c} string" for c in self.layout(table)]])
        paths = [self.folder(table, n) for n in self.versions(table) if n >= since and (as_of is None or n <= as_of)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(*paths)

    def repeated(self, table: Table, rows: DataFrame) -> list[str]:
        """Partitions of ``raw`` rows that occur in several versions, from the file index alone."""
        held = {tuple(file.split("/")[-len(self.layout(table)) - 1:-1]) for file in rows.inputFiles()}
        times = Counter(below for _, *rest in held for below in ["/".join(part.split("=", 1)[1] for part in rest)])
        return sorted(below for below, n in times.items() if n > 1)

    def stored(self, table: Table, as_of: str | None = None) -> DataFrame:
        """The newest row of every key with its partition columns; an empty frame when the table is not there yet.

        Only partitions that occur in several versions are resolved, by one aggregate; a merged table is just read. With
        ``as_of`` the rows are those that were stored when that version was the newest; a merge since then hides them.
        """
        rows = self.raw(table, as_of)
        if table.by_source:
            return self.newest_of_sources(table, rows, as_of).drop(VERSION)
        open_parts = self.repeated(table, rows)
        if not open_parts:
            return rows.drop(VERSION)
        repeated = F.concat_ws("/", *table.partitions).isin(open_parts)
        # the time of a key decides its period and its mode the part: rows of one key share the partition
        newest = latest_by_key(rows.where(repeated), [*table.keys, *table.partitions], [VERSION])
        return rows.where(~repeated).unionByName(newest).drop(VERSION)

    def index_path(self, table: Table, version: str = "") -> str:
        return f"{self.path(table)}_index" + (f"/{VERSION}={version}" if version else "")

    def taken_back(self, table: Table, as_of: str | None = None) -> list[tuple[list[str], DataFrame]]:
        """What later versions of an archive take back: keys, and a frame of them with the version ``since`` which they count.

        The index has a row per version and source, not per archived row. Empty where nothing is taken back.
        """
        versions = [n for n in self.versions(table) if as_of is None or n <= as_of]
        held = [self.index_path(table, n) for n in versions if fs.exists(self.spark, self.index_path(table, n))]
        if len(versions) < 2 or not held:
            return []
        index = self.spark.read.schema(f"{INDEX}, {VERSION} string").option("basePath", self.index_path(table)).parquet(*held)
        found = []
        for keys in (["src"], table.partitions):
            back = index.where(F.col(keys[0]).isNotNull()).groupBy(*keys).agg(F.max(VERSION).alias("since"))
            back = back.where(F.col("since") > versions[0])  # the oldest version has nothing to take back
            if back.limit(1).count():
                found.append((keys, back))
        return found

    def settled(self, table: Table) -> tuple[DataFrame, DataFrame]:
        """The stored rows of an archive in two parts: whole versions from which nothing was taken back, and what is left of older ones.

        The first part is read without a join or a condition, so that aggregates can be pushed into it.
        """
        since = max([back.agg(F.max("since")).first()[0] for _, back in self.taken_back(table)], default="")
        older = [n for n in self.versions(table) if n < since]
        rest = self.newest_of_sources(table, self.raw(table, older[-1])) if older else self.raw(table, "")
        return self.raw(table, since=since), rest

    def newest_of_sources(self, table: Table, rows: DataFrame, as_of: str | None = None) -> DataFrame:
        """``raw`` rows less those that a later version has taken back: by their source, or with their whole partition."""
        for keys, back in self.taken_back(table, as_of):
            rows = rows.join(broadcast_if_small(back), keys, "left").where(F.col("since").isNull() | (F.col(VERSION) >= F.col("since"))).drop("since")
        return rows

    def read(self, table: Table, mode: str | None = None, *, start: float | None = None,
             end: float | None = None) -> DataFrame:
        """Rows of one mode, and of [start, end) seconds, with partition pruning on both."""
        rows = self.stored(table)
        if mode is not None:
            rows = rows.where((F.col(PART) == self.part(F.lit(mode))) & (F.col("mode") == mode))
        if table.time:
            nanos = table.time == "time_ns"
            for bound, keep in ((start, "__ge__"), (end, "__lt__")):
                if bound is None:
                    continue
                at = F.lit(int(bound * 1e9)) if nanos else F.lit(float(bound))
                rows = rows.where(getattr(F.col(table.time), keep)(at))
                moment = period_name(F.lit(float(bound)), table.grain)
                in_range = F.col(PERIOD) >= moment if keep == "__ge__" else F.col(PERIOD) <= moment
                rows = rows.where(in_range | (F.col(PERIOD) == UNDATED))
        return rows.select(*table.columns)

    def part(self, mode: Column) -> Column:
        return partition_name(mode, self.width)

    def place(self, table: Table, rows: DataFrame) -> DataFrame:
        """Table columns and the partition each row belongs to."""
        rows = rows.select(*table.columns).withColumn(PART, self.part(F.coalesce("mode", F.lit(""))))
        return rows.withColumn(PERIOD, table.period()) if table.time else rows

    def write(self, table: Table, placed: DataFrame, order: list[str] | None = None) -> None:
        """Replace exactly the partitions that occur in ``placed``; each file is sorted by ``order``.

        The rebalance puts a small partition into one file and splits a hot one over many tasks, by
        the input tasks its rows come from: files of a hot period follow the order of the log files.
        """
        order = order or [c for c in ("mode", table.time) if c]
        columns = self.layout(table)
        (
            placed.hint("rebalance", *[F.col(c) for c in columns])
            .sortWithinPartitions(*columns, *order)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "snappy")
            .partitionBy(*columns)
            .parquet(self.path(table))
        )

    def touched(self, table: Table, keys: DataFrame, rows: DataFrame) -> DataFrame:
        """Stored ``rows`` of the partitions that occur in ``keys``; only those are read.

        The driver lists them, however many: they are no more than the folders in its file index.
        """
        columns = [c for c in self.layout(table) if c in keys.columns]
        listed = ["/".join(row) for row in keys.select(*columns).distinct().collect()]
        # one membership test over the partition columns alone, so that it prunes directories
        return rows.where(F.concat_ws("/", *columns).isin(listed))

    def add_version(self, table: Table, placed: DataFrame, order: list[str] | None = None, index: DataFrame | None = None) -> None:
        """Write rows as the newest version; it counts once it is complete, and its index lies there before."""
        names = [n.split("=")[1] for n in fs.list_names(self.spark, self.path(table)) if n.startswith(f"{VERSION}=")]
        version = f"{max(map(int, names), default=0) + 1:012d}"
        if index is not None:
            # of a version that died before it was complete there may be one already
            index.hint("rebalance").write.mode("overwrite").parquet(self.index_path(table, version))
        order = order or [c for c in ("mode", table.time) if c]
        # a hot partition is split by the input tasks its rows come from: its files follow the order of the log files; all files
        # have the columns in one order, since Spark takes footers' statistics by position
        (
            placed.select(*table.columns, *table.partitions).hint("rebalance", *[F.col(c) for c in table.partitions])
            .sortWithinPartitions(*table.partitions, *order)
            .write.mode("errorifexists")
            .option("compression", "snappy")
            .partitionBy(*table.partitions)
            .parquet(self.folder(table, version))
        )

    def add_sources(self, table: Table, placed: DataFrame, order: list[str], *, whole: bool = False, gone: DataFrame | None = None) -> None:
        """Write the rows of some sources as a version that takes back what older versions hold of the same sources.

        ``gone`` (src) are further sources to take back. With ``whole`` the version also takes back all that older ones hold
        in the partitions it touches. No stored row is read.
        """
        sources = placed.select("src")
        sources = sources.unionByName(gone.select("src")) if gone is not None else sources
        index = sources.distinct().select("src", *[F.lit(None).cast("string").alias(c) for c in table.partitions])
        if whole:
            index = index.unionByName(placed.select(F.lit(None).cast("string").alias("src"), *table.partitions).distinct())
        self.add_version(table, placed, order, index)

    def upsert(self, table: Table, incoming: DataFrame, order: list[str]) -> None:
        """Insert rows, replacing those with the same key; among equal incoming keys the last one wins.

        No stored row is read. Running it again changes nothing that a reader sees.
        """
        self.add_version(table, self.place(table, latest_by_key(incoming.select(*table.columns, *order), list(table.keys), order)))

    def merge(self, table: Table) -> None:
        """Bring the partitions that occur in several versions into one; a job of its own, for when no reader is active.

        Only those partitions are read and written, and those from which rows of an archive were taken back. The older copies
        go after the merged version is complete.
        """
        rows = self.raw(table)
        parts = set(self.repeated(table, rows))
        for keys, back in self.taken_back(table) if table.by_source else []:
            lost = rows.join(broadcast_if_small(back), keys).where(F.col(VERSION) < F.col("since")).select(*table.partitions).distinct()
            parts |= {"/".join(row) for row in lost.collect()}  # no more than the folders in the file index
        old = self.versions(table) if parts else []
        if parts:
            merged = self.stored(table).where(F.concat_ws("/", *table.partitions).isin(sorted(parts)))
            index = self.spark.createDataFrame([(None, *part.split("/")) for part in parts], INDEX) if table.by_source else None
            self.add_version(table, merged, index=index)
        for version in old:
            for part in parts:
                below = "/".join(f"{c}={v}" for c, v in zip(table.partitions, part.split("/")))
                fs.delete(self.spark, f"{self.folder(table, version)}/{below}")
        whole = self.versions(table)
        for name in fs.list_names(self.spark, self.path(table)):  # left behind by runs that died
            if name.startswith(f"{VERSION}=") and name.split("=")[1] not in whole:
                fs.delete(self.spark, f"{self.path(table)}/{name}")
        for version in old if table.by_source else []:
            # all that it took back is gone by now; its rows may have moved on as well
            if not any("=" in name and not self.is_bare(table, version, name) for name in fs.list_names(self.spark, self.folder(table, version))):
                fs.delete(self.spark, self.folder(table, version))
                fs.delete(self.spark, self.index_path(table, version))

    def is_bare(self, table: Table, version: str, name: str) -> bool:
        """Whether a folder of a version holds no partition any more."""
        return not fs.list_names(self.spark, f"{self.folder(table, version)}/{name}")

    def delete_mode(self, table: Table, mode: str) -> None:
        """Drop the rows of one mode: rewrite the partitions it shares, remove those it has alone."""
        if not self.exists(table):
            return
        columns = self.layout(table)
        here = self.raw(table).where(F.col(PART) == self.part(F.lit(mode)))
        mine = F.col("mode") == mode
        shared = here.groupBy(*columns).agg(
            F.count_if(mine).alias("mine"), F.count_if(~mine).alias("others")
        ).where("mine > 0").collect()
        rewrite = [row for row in shared if row["others"]]
        if rewrite:
            keys = self.spark.createDataFrame([[r[c] for c in columns] for r in rewrite],
                                              ", ".join(f"{c} string" for c in columns))
            self.write(table, self.touched(table, keys, here).where(~mine))
        for row in shared:
            if not row["others"]:
                folder = "/".join(f"{c}={row[c]}" for c in columns)
                fs.delete(self.spark, f"{self.path(table)}/{folder}")
