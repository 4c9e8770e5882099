"""Continuous ingest: the batch run over micro-batches of new files, with durable on-change state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from eventmart.operators.equity import last_equity
from eventmart.operators.keys import broadcast_if_small
from eventmart.plans import runs
from eventmart.plans.batch import LINE_OPTIONS, ingest_lines, timestamp_now
from eventmart.session import staging
from eventmart.sources import files, fs
from eventmart.sources.tables import EQUITY, INSTANCES, STREAM_STATE, TRADES, Warehouse, archive_table


# Batches after which the registry and the state are merged, so that a batch does not read a version for each one before it.
SMALL_EVERY = 8


def merge_small(warehouse: Warehouse, name: str) -> None:
    """Merge the registry and the state, of which every batch reads all versions.

    Not before a batch that is a repeat, nor while a batch run lies unfinished: these need the versions that they began with.
    """
    if runs.recorded(warehouse, name) is None and not runs.unfinished(warehouse):
        for table in (INSTANCES, STREAM_STATE):
            warehouse.merge(table)


def process_batch(warehouse: Warehouse, lines: DataFrame, batch: int, *, stream: str = "", **options) -> None:
    """One micro-batch: the registry and the state are those that it began with, every write is an upsert.

    Files that a batch run or an earlier batch has taken in are left out, by the one manifest of all runs; ``lines`` without
    the columns of ``with_metadata`` are taken as they are. A batch that is run again after a failure judges as the first time.
    """
    spark = warehouse.spark
    options = {"now": timestamp_now(), **options}
    run = runs.begin(warehouse, batch_name(stream, batch), options.pop("now"))
    with staging(spark) as area:
        # a repeated batch has the same files, but lines without them may be others
        held = runs.held(warehouse, run, *[options.get(name) for name in LINE_OPTIONS]) if "uri" in lines.columns else area
        before = held.table(warehouse.stored(STREAM_STATE, as_of=run.state).select("mode", "equity"), "state_before")
        ordered, taken, names = files.order_lines(lines), None, None
        if "uri" in lines.columns:
            known = runs.manifest(warehouse, but=run.name)
            listed = held.table(files.changed_files(files.files_of_lines(lines), known), "listed")
            digests = files.line_digest(ordered).withColumnRenamed("file_id", "lines_id")
            taken = held.table(listed.join(digests, "file_name").withColumn("file_id", files.content_id()), "taken")
            names = held.table(files.output_names(files.new_files(taken, known)).select("file_name", "src"), "names")
            ordered = ordered.join(broadcast_if_small(names.select("file_name")), "file_name", "left_semi").select(*ordered.columns)
        _, equity = ingest_lines(
            warehouse, ordered, area, run=run.name, now=run.now, registry=run.registry, state=before, names=names, held=held, **options,
        )
        if taken is not None:
            lines_read = spark.read.parquet(held.path(runs.FACTS)).groupBy("file_name").agg(F.count("*").alias("n_lines"))
            entry = taken.join(lines_read, "file_name", "left").withColumn("ingested_at", F.lit(run.now))
            runs.enter(warehouse, run, entry.select(*[field.split()[0] for field in files.MANIFEST.split(", ")]))
        # only modes that the batch saw: the state is not rewritten
        warehouse.upsert(STREAM_STATE, last_equity(equity).withColumn("turn", F.lit(0)), ["turn"])
        held.drop()
        # the records of the two newest batches cover a repeated one
        for old in range(max(0, batch - 3), batch - 1):
            fs.delete(spark, runs.run_path(warehouse, batch_name(stream, old)))


def batch_name(stream: str, batch: int) -> str:
    return f"stream{stream}{batch:010d}"


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint keeps for its stream: batches of another checkpoint have the same numbers."""
    found = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").select(F.get_json_object("value", "$.id").alias("id")).first()
    return found.id


def stream_ingest(spark: SparkSession, source: str, warehouse: Warehouse, *, checkpoint: str,
                  glob: str = files.LOG_GLOB, trigger: dict | None = None, max_files: int | None = None,
                  archive_dir: str | None = None, merge_every: int | None = 144, **options) -> StreamingQuery:
    """Start the stream. ``trigger`` defaults to every ten minutes; ``max_files`` bounds a batch;
    ``archive_dir`` takes consumed files, each below its whole path; after every ``merge_every`` batches, a day of them, the
    keyed tables are merged, the registry and the state every ``SMALL_EVERY`` batches (None: never, when a job of its own does it). Files are taken in order of modification time.

    Spark's file source moves a file only after its batch is committed, in threads of its own
    (``spark.sql.streaming.fileSource.cleaner.numThreads``), so a batch that is run again still finds its files.
    Those of the newest batch stay until the next one begins.
    """
    reader = spark.readStream.format("text").option("lineSep", "\n").option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    # the same files as in a batch run; lines of the file that is still being written are left out by its name
    lines = files.with_metadata(reader.load(source))

    def run(batch_lines: DataFrame, batch: int) -> None:
        stream = f"-{stream_name(spark, checkpoint)}-"
        if merge_every and batch and batch % SMALL_EVERY == 0:
            merge_small(warehouse, batch_name(stream, batch))
        process_batch(warehouse, batch_lines, batch, stream=stream, **options)
        if merge_every and batch % merge_every == merge_every - 1:
            grain = options.get("grain", "week")
            for table in (EQUITY, TRADES, INSTANCES, STREAM_STATE, *([archive_table(grain)] if grain else [])):
                warehouse.merge(table)

    return (
        lines.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 minutes"}))
        .start()
    )


def run_in_rounds(spark: SparkSession, source: str, warehouse: Warehouse, *, checkpoint: str, max_files: int = 1000, **options) -> int:
    """Take in all files that lie in ``source`` now, at most ``max_files`` at a time, and return the number of rounds.

    For a backlog that one batch run should not stage whole: a round stages the lines of its own files only, and the on-change state
    and the registry go from round to round, so the tables are those of one run over files whose names follow their times.
    A call that died goes on with the round it was in, under ``checkpoint``. Options as for ``stream_ingest``.
    """
    query = stream_ingest(spark, source, warehouse, checkpoint=checkpoint, max_files=max_files, trigger={"availableNow": True}, **options)
    query.awaitTermination()
    return len({progress["batchId"] for progress in query.recentProgress if progress["numInputRows"]})
