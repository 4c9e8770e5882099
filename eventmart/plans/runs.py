"""Run records: what a run saw when it began, so that a repeat of it judges every line as the first attempt did."""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame

from eventmart.session import Resumable
from eventmart.sources import files, fs
from eventmart.sources.tables import INSTANCES, STREAM_STATE, Warehouse

RECORD = "registry string, state string, now string"
STAGED = "staged-"  # how the folders begin that hold what a run has staged
FACTS = "facts"  # the table of parsed lines among it


@dataclass(frozen=True)
class Run:
    """``registry`` and ``state`` are the versions of the registry and the stream's state that the run began with, ``now`` its stamp."""

    name: str
    registry: str
    state: str
    now: str


def run_path(warehouse: Warehouse, name: str = "") -> str:
    return f"{warehouse.root}/runs" + (f"/run={name}" if name else "")


def new_name(now: str) -> str:
    """A name that no other run has, however often a stamp is used."""
    return "".join(c for c in now if c.isalnum()) + uuid.uuid4().hex[:12]


def recorded(warehouse: Warehouse, name: str) -> Run | None:
    """The run of this name, if it has begun; a record that is not complete does not count, as nothing was written after it."""
    path = f"{run_path(warehouse, name)}/record"
    if not fs.exists(warehouse.spark, f"{path}/_SUCCESS"):
        return None
    row = warehouse.spark.read.schema(RECORD).parquet(path).first()
    return Run(name, row.registry, row.state, row.now)


def begin(warehouse: Warehouse, name: str, now: str, fresh: DataFrame | None = None) -> Run:
    """Enter a run, with the files that it is to take in; a run of this name that has begun goes on as it was entered."""
    run = recorded(warehouse, name)
    if run:
        return run
    if fresh is not None:
        fresh.write.mode("overwrite").parquet(f"{run_path(warehouse, name)}/files")
    run = Run(name, warehouse.newest(INSTANCES), warehouse.newest(STREAM_STATE), now)
    record = warehouse.spark.createDataFrame([(run.registry, run.state, now)], RECORD).coalesce(1)
    record.write.mode("overwrite").parquet(f"{run_path(warehouse, name)}/record")
    return run


def files_of(warehouse: Warehouse, run: Run) -> DataFrame:
    """The files that a run was entered with."""
    return warehouse.spark.read.parquet(f"{run_path(warehouse, run.name)}/files")


def held(warehouse: Warehouse, run: Run, *made_of) -> Resumable:
    """The tables that a run has staged from its lines, so that a repeat of it need not parse them again.

    ``made_of`` tells all that they follow from beside the run's record: a repeat for which it differs begins anew. So does one
    that died before the parsed lines were whole.
    """
    key = hashlib.md5(repr(made_of).encode()).hexdigest()
    area = Resumable(warehouse.spark, f"{run_path(warehouse, run.name)}/{STAGED}{key}")
    if not fs.exists(warehouse.spark, f"{area.path(FACTS)}/_SUCCESS"):
        area.drop()
    return area


def unfinished(warehouse: Warehouse) -> list[Run]:
    """Batch runs that began and did not end, oldest first. One writer at a time: none of them is still at work."""
    names = [n.removeprefix("run=") for n in fs.list_names(warehouse.spark, run_path(warehouse)) if n.startswith("run=")]
    batch = [n for n in names if fs.exists(warehouse.spark, f"{run_path(warehouse, n)}/files")]
    return [run for run in (recorded(warehouse, n) for n in sorted(batch)) if run]


def finish(warehouse: Warehouse, run: Run) -> None:
    fs.delete(warehouse.spark, run_path(warehouse, run.name))


def manifest_path(warehouse: Warehouse, name: str = "") -> str:
    return f"{warehouse.root}/ingest_manifest" + (f"/run={name}" if name else "")


def manifest(warehouse: Warehouse, but: str | None = None) -> DataFrame:
    """All files taken in, by batch runs and streams; ``but`` leaves out what one run entered itself."""
    spark, path = warehouse.spark, manifest_path(warehouse)
    if not fs.exists(spark, path):
        return spark.createDataFrame([], files.MANIFEST)
    entries = spark.read.schema(files.MANIFEST).option("recursiveFileLookup", "true").parquet(path)
    if but is not None:
        entries = entries.where(f"not contains(_metadata.file_path, '/run={but}/')")
    return entries


def enter(warehouse: Warehouse, run: Run, entry: DataFrame) -> None:
    """Enter the files of a run; a repeat replaces its entry."""
    entry.hint("rebalance").write.mode("overwrite").parquet(manifest_path(warehouse, run.name))


def entered(warehouse: Warehouse, run: Run) -> bool:
    return fs.exists(warehouse.spark, f"{manifest_path(warehouse, run.name)}/_SUCCESS")
