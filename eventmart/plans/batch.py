"""One ingest run: log lines in, tables updated."""

from __future__ import annotations

import hashlib
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.operators.archive import compact
from eventmart.operators.equity import equity_changes
from eventmart.operators.gate import attach_live, gate_configs, live_by_file, open_modes
from eventmart.operators.keys import ORDER, broadcast_if_small
from eventmart.operators.parse import line_facts, parse_messages
from eventmart.operators.registry import register_run
from eventmart.operators.rows import archive_of_line, equity_of_line, trades_of_line
from eventmart.operators.stats import file_stats
from eventmart.plans import runs
from eventmart.plans.runs import manifest  # noqa: F401
from eventmart.session import Staging, staging
from eventmart.sources import files as sources
from eventmart.sources import fs
from eventmart.sources.tables import ARCHIVE_SCHEMA, EQUITY, INSTANCES, STREAM_STATE, TRADES, Table, Warehouse, archive_table

STATS = Table(
    "file_stats",
    "file_name string, total_records bigint, invalid_records bigint, missing_fields bigint, equity_records bigint, "
    "trade_records bigint, skipped_db_only_records bigint, skipped_equity_records bigint, empty_lines bigint, "
    "archived_rows bigint, processed bigint, undated_records bigint, live_records bigint",
    ("file_name",),
)


# Options of a run that what it stages from its lines depends on.
LINE_OPTIONS = ["on_change", "require_equity", "mode_field"]

# Archive rows of runs that did not compact; the next run that does takes them in.
PENDING = Table("archive_pending", ARCHIVE_SCHEMA, ("src", "block", "ord"))
REST = "rest"  # how the names of folders begin that hold what a deletion left


def pending_path(warehouse: Warehouse, run: str = "") -> str:
    return f"{warehouse.root}/{PENDING.name}" + (f"/run={run}" if run else "")


def pending_rows(warehouse: Warehouse) -> DataFrame:
    """Archive rows that wait for a compaction; a row that a deletion was copying when it died counts once."""
    spark, path = warehouse.spark, pending_path(warehouse)
    folders = [n for n in fs.list_names(spark, path) if fs.exists(spark, f"{path}/{n}/_SUCCESS")]
    if not folders:
        return spark.createDataFrame([], PENDING.schema)
    rows = spark.read.schema(PENDING.schema).option("recursiveFileLookup", "true").parquet(*[f"{path}/{n}" for n in folders]).select(*PENDING.columns)
    copying = len(folders) > 1 and any(n.startswith(f"run={REST}") for n in folders)
    return rows.dropDuplicates(list(PENDING.keys)) if copying else rows


def compact_pending(warehouse: Warehouse, rows: DataFrame, area: Staging, *, grain: str, mode: str = "accumulate") -> None:
    """Compact ``rows`` and those that wait. The waiting rows go last, so a run that dies before takes them in again, to the same result."""
    compact(warehouse, area.table(pending_rows(warehouse).unionByName(rows), "archive_rows"), grain=grain, mode=mode)
    fs.delete(warehouse.spark, pending_path(warehouse))


def timestamp_now() -> str:
    return datetime.now(timezone.utc).isoformat()


def ingest_lines(warehouse: Warehouse, lines: DataFrame, area: Staging, *, now: str, run: str,
                 on_change: bool = True, require_equity: bool = True, mode_field: str = "mode",
                 grain: str | None = "week", archive_mode: str = "accumulate", state: DataFrame | None = None,
                 names: DataFrame | None = None, registry: str | None = None, held: Staging | None = None) -> tuple[DataFrame, DataFrame]:
    """Parse lines once and feed every table from the staged result.

    Returns (counters per file, equity rows of accepted lines before the on-change filter).
    ``names`` maps file names to archive sources. With ``grain`` None archive rows wait for the next run that compacts. ``run`` is a
    name that no other run has. Every write is an upsert, so a run that died half way is repaired by running it again under its name, with ``registry``, the version of the
    registry that it began with: lines are then judged by what was known before the run. What follows from the lines alone is staged in
    ``held`` (unset: ``area``), where a repeat may find it.
    """
    held = held or area
    messages = parse_messages(lines, mode_field=mode_field)
    facts = held.table(line_facts(messages, require_equity=require_equity), runs.FACTS)
    instances = held.table(warehouse.stored(INSTANCES, as_of=registry).select(*INSTANCES.columns), "instances_before")
    gated = gate_configs(facts, held.table(open_modes(facts, instances), "gates"))
    equity = equity_of_line(gated)
    kept = held.table(equity_changes(equity, on_change=on_change, state=state), "kept")
    flags = held.table(live_by_file(kept, facts, instances), "flags")

    register_run(warehouse, facts, instances, now)
    warehouse.upsert(EQUITY, kept.where(F.col("time_ns").isNotNull()), ORDER)
    warehouse.upsert(TRADES, trades_of_line(gated), [*ORDER, "pos"])
    rows = archive_of_line(gated)
    if names is not None:
        rows = rows.drop("src").join(broadcast_if_small(names), "file_name", "left")
    rows = rows.select(*PENDING.columns)
    if grain:
        compact_pending(warehouse, rows, area, grain=grain, mode=archive_mode)
    else:
        rows.write.mode("overwrite").parquet(pending_path(warehouse, run))

    live = attach_live(kept, flags).groupBy("file_name").agg(F.count_if("live").alias("live_records"))
    stats = file_stats(gated, kept).join(live, "file_name", "left").fillna(0, ["live_records"])
    path = f"{warehouse.root}/{STATS.name}/run={run}"
    stats.hint("rebalance").write.mode("overwrite").parquet(path)
    return warehouse.spark.read.schema(STATS.schema).parquet(path), equity


def run_batch(spark: SparkSession, source: str | list[str], warehouse: Warehouse, *, limit: int | None = None,
              glob: str = sources.LOG_GLOB, processed_dir: str | None = None, now: str | None = None,
              **options) -> DataFrame:
    """Ingest the new log files of a directory, or the given files, in the order of their names.

    A file ingested before with the same content is skipped; files unchanged since then are not even read. Of a file that has
    grown only the new lines are taken in; one that changed otherwise is taken in whole, beside what it held. Files are told apart by path: where several folders have files of one name, the folder follows the name in the counters and order columns.
    ``limit`` takes the first n of the others; ``processed_dir`` moves files there afterwards (unset: they stay). A run that died
    is finished first, with the files, the stamp and the registry that it began with. Further options as for ``ingest_lines``.
    Returns the counters of each file read.
    """
    now = now or timestamp_now()
    stats = None
    for run in runs.unfinished(warehouse):
        with staging(spark) as area:
            held = [r.path for r in runs.files_of(warehouse, run).select("path").toLocalIterator() if fs.exists(spark, r.path)]
            same = sources.list_files(spark, held, glob="*", exclude="\u0000").select("uri", "length", "mtime") if held else None
            fresh = runs.files_of(warehouse, run)
            # files that changed or went since are left to a later run
            fresh = fresh.join(same, ["uri", "length", "mtime"], "left_semi") if held else fresh.limit(0)
            found = take_in(warehouse, run, area.table(fresh, "fresh"), area, processed_dir=processed_dir, **options)
            stats = found if stats is None else stats.unionByName(found)
    with staging(spark) as area:
        known = runs.manifest(warehouse)
        changed = sources.changed_files(sources.list_files(spark, source, glob=glob), known)
        picked = area.table(sources.with_file_ids(spark, area.table(sources.pick_files(changed, limit), "picked")), "files")
        picked = picked if "lines_id" in picked.columns else picked.selectExpr("*", "string(null) AS lines_id", "bigint(null) AS line_count")
        fresh = area.table(sources.output_names(sources.once(sources.new_files(picked, known))), "new")
        skip = area.table(sources.grown(spark, fresh, known), "grown") if fs.exists(spark, runs.manifest_path(warehouse)) else None
        fresh = fresh.join(skip, "uri", "left") if skip is not None else fresh.withColumn("skip", F.lit(None).cast("bigint"))
        fresh = fresh.select("path", F.lit(True).alias("fresh"), "src", F.coalesce("skip", F.lit(0)).alias("skip"))
        # a file seen before that only looks changed is entered again
        run = runs.begin(warehouse, runs.new_name(now), now, picked.join(fresh, "path", "left"))
        found = take_in(warehouse, run, area.table(runs.files_of(warehouse, run), "fresh"), area, processed_dir=processed_dir, **options)
        return found if stats is None else stats.unionByName(found)


def take_in(warehouse: Warehouse, run: runs.Run, files: DataFrame, area: Staging, *, processed_dir: str | None = None, **options) -> DataFrame:
    """Ingest the fresh ones of ``files``, enter all of them in the manifest, move them and end the run."""
    spark = warehouse.spark
    fresh = files.where("fresh")
    repeated = sources.repeated_names(fresh)
    key = sources.file_key(F.col("file_name"), F.col("uri"), repeated)
    stats = spark.createDataFrame([], STATS.schema)
    if not runs.entered(warehouse, run):
        # the driver holds one path per file, as the scan's own file index does
        listed = sorted(tuple(row) for row in fresh.select("path", "length", "mtime", "skip").toLocalIterator())
        paths = [path for path, *_ in listed]
        counted = spark.createDataFrame([], "_key string, n_lines bigint")
        if paths:
            lines = sources.scan_lines(spark, paths, glob="*", repeated=repeated)
            skip = fresh.select(key.alias("file_name"), "skip").where("skip > 0")
            if skip.limit(1).count():
                tails = sources.numbered(lines).join(broadcast_if_small(skip), "file_name", "left")
                lines = tails.where(F.col("skip").isNull() | (F.col("number") >= F.col("skip"))).select(*lines.columns)
            # a state given by the caller may be another one in a repeat
            given = options.get("state") is not None
            held = area if given else runs.held(warehouse, run, listed, *[options.get(name) for name in LINE_OPTIONS])
            stats, _ = ingest_lines(warehouse, lines, area, now=run.now, run=run.name, registry=run.registry, held=held,
                                    names=fresh.select(key.alias("file_name"), "src"), **options)
            facts = spark.read.parquet(held.path(runs.FACTS))
            counted = facts.groupBy(F.col("file_name").alias("_key")).agg(F.count("*").alias("n_lines"))
        entry = files.withColumn("_key", key).join(counted, "_key", "left").withColumn("ingested_at", F.lit(run.now))
        runs.enter(warehouse, run, entry.select(*[field.split()[0] for field in sources.MANIFEST.split(", ")]))
    if processed_dir:
        move_files(spark, [row.path for row in files.select("path").toLocalIterator()], processed_dir, run.now)
    runs.finish(warehouse, run)
    return stats


def move_files(spark: SparkSession, paths: list[str], processed_dir: str, now: str) -> None:
    fs.make_dirs(spark, processed_dir)
    for path in paths:
        if not fs.exists(spark, path):  # moved before the run died
            continue
        target = f"{processed_dir.rstrip('/')}/{path.rsplit('/', 1)[-1]}"
        if fs.exists(spark, target):  # a file of another folder, or an earlier one
            stem, dot, ending = target.rpartition(".")
            target = f"{stem}_{hashlib.md5(f'{now} {path}'.encode()).hexdigest()}{dot}{ending}" if dot else f"{target}_{now}"
        fs.rename(spark, path, target)


def delete_mode(warehouse: Warehouse, mode: str, *, grains: tuple[str, ...] = ("hour", "day", "week", "month"),
                dry_run: bool = False) -> DataFrame:
    """Remove one mode from every table; with ``dry_run`` only count what would go.

    Returns (table_name, n_rows) as counted before the removal.
    """
    tables = [TRADES, INSTANCES, EQUITY, *[archive_table(grain) for grain in grains]]  # counted in the answer
    counts = None
    for table in tables:
        one = warehouse.read(table, mode).agg(F.count("*").alias("n_rows"))
        one = one.select(F.lit(table.name).alias("table_name"), "n_rows")
        counts = one if counts is None else counts.unionByName(one)
    waiting = pending_rows(warehouse)
    if waiting.where(F.col("mode") == mode).limit(1).count():
        one = waiting.where(F.col("mode") == mode).agg(F.count("*").alias("n_rows"))
        counts = counts.unionByName(one.select(F.lit(PENDING.name).alias("table_name"), "n_rows"))
    if dry_run:
        return counts
    # one row per table, kept because the rows counted are about to go
    counted = warehouse.spark.createDataFrame(counts.collect(), "table_name string, n_rows bigint")
    for table in (*tables, STREAM_STATE):
        warehouse.delete_mode(table, mode)
    with staging(warehouse.spark) as area:
        left = area.table(waiting.where(~F.col("mode").eqNullSafe(mode)), "pending")
        # a folder of its own, complete before any other goes: what an earlier deletion left may lie nowhere else
        rest = f"{REST}-{uuid.uuid4().hex}"
        left.write.mode("errorifexists").parquet(pending_path(warehouse, rest))
        for name in fs.list_names(warehouse.spark, pending_path(warehouse)):
            if name != f"run={rest}":
                fs.delete(warehouse.spark, f"{pending_path(warehouse)}/{name}")
    return counted


def export_jdbc(rows: DataFrame, url: str, table: str, *, batch_size: int = 1000, **options) -> None:
    """Append rows to a relational table; needs that database's driver on the class path."""
    writer = rows.write.format("jdbc").options(url=url, dbtable=table, batchsize=batch_size, **options)
    writer.mode("append").save()
