"""Queries over the given tables, one per operator; each reads all of ``events`` as log lines."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.naming import output_name, partition_name
from eventmart.operators import archive, gate, registry, rows
from eventmart.operators.equity import equity_changes, last_equity
from eventmart.operators.keys import ORDER, latest_by_key
from eventmart.operators.parse import explode_items, line_facts, parse_messages
from eventmart.operators.stats import file_stats
from eventmart.plans.batch import delete_mode, run_batch
from eventmart.plans.synth import event_lines, load_events, write_log_files
from eventmart.session import Staging, configure
from eventmart.sources import files, fs
from eventmart.sources.tables import EQUITY, INSTANCES, TRADES, Warehouse, archive_table
from eventmart.streaming.ingest import run_in_rounds, stream_ingest

HALF = "2024-01-16"  # the run is cut here where a query needs an earlier and a later one
LATE = "2024-01-29"  # a short later run, in which many modes use their earlier registration
NOW, LATER = "2024-02-01T00:00:00", "2024-02-02T00:00:00"
SLICE = ("u1", 1704412800.0, 1706140800.0)  # mode, [from, to) in epoch seconds
FIRST_FILES = 7


class Run:
    """The staged start of a query: facts, gates and gated facts of the log lines."""

    def __init__(self, spark: SparkSession, sf_dir: str, *, noisy: bool = False, since: str | None = None,
                 instances: DataFrame | None = None, candle: bool = False):
        self.spark = configure(spark)
        self.area = Staging(spark)
        self.events = load_events(spark, sf_dir)
        self.instances = instances
        picked = self.events.where(F.col("ts") >= F.lit(since).cast("timestamp")) if since else self.events
        self.lines = event_lines(picked, noisy=noisy)
        self.facts = self.area.table(line_facts(parse_messages(self.lines), candle=candle), "facts")
        self.gated = gate.gate_configs(self.facts, self.area.table(gate.open_modes(self.facts, instances), "gates"))

    def warehouse(self, width: int = 1) -> Warehouse:
        return Warehouse(self.spark, self.area.path("warehouse"), width)


def before_half() -> Column:
    return F.col("file_ts") < F.unix_timestamp(F.lit(HALF), "yyyy-MM-dd")


def earlier_instances(spark: SparkSession, sf_dir: str, until: str = HALF) -> DataFrame:
    """The registry as the days before ``until`` leave it."""
    configure(spark)
    area = Staging(spark)
    earlier = load_events(spark, sf_dir).where(F.col("ts") < F.lit(until).cast("timestamp"))
    facts = area.table(line_facts(parse_messages(event_lines(earlier))), "facts")
    return area.table(registry.registrations(facts, NOW).select(*INSTANCES.columns), "instances")


def equity_rows(df: DataFrame) -> DataFrame:
    return df.select("mode", "time_ns", "equity")


def equity_on_change(spark, sf_dir):
    return equity_rows(equity_changes(rows.equity_of_line(Run(spark, sf_dir).gated)))


def equity_all(spark, sf_dir):
    return equity_rows(equity_changes(rows.equity_of_line(Run(spark, sf_dir).gated), on_change=False))


def equity_resume(spark, sf_dir):
    """Two runs, the second one starting from the state the first one left."""
    run = Run(spark, sf_dir)
    equity = run.area.table(rows.equity_of_line(run.gated), "equity")
    first = equity.where(before_half())
    state = run.area.table(last_equity(first), "state")
    later = equity_changes(equity.where(~before_half()), state=state)
    return equity_rows(equity_changes(first).unionByName(later))


def noisy_equity(spark, sf_dir):
    return equity_rows(equity_changes(rows.equity_of_line(Run(spark, sf_dir, noisy=True).gated)))


def line_stats(spark, sf_dir):
    run = Run(spark, sf_dir, noisy=True)
    return file_stats(run.gated, equity_changes(rows.equity_of_line(run.gated)))


def line_reasons(spark, sf_dir):
    facts = Run(spark, sf_dir, noisy=True).gated
    return facts.groupBy("kind", F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"))


def _kept_dropped(gated: DataFrame) -> DataFrame:
    return gated.where("kind = 'data'").groupBy("mode").agg(
        F.count_if(F.col("reason").isNull()).alias("n_kept"), F.count_if(F.col("reason") == "no_config").alias("n_dropped")
    )


def config_gate(spark, sf_dir):
    return _kept_dropped(Run(spark, sf_dir).gated)


def registry_gate(spark, sf_dir):
    """The later days alone, gated by the registry of the earlier ones and their own start messages."""
    return _kept_dropped(Run(spark, sf_dir, since=HALF, instances=earlier_instances(spark, sf_dir)).gated)


def live_as_of(spark, sf_dir):
    run = Run(spark, sf_dir)
    equity = run.area.table(rows.equity_of_line(run.gated), "equity")
    flags = run.area.table(gate.live_by_file(equity, run.facts), "flags")
    return gate.attach_live(equity, flags).select("mode", "time_ns", F.col("live").cast("string").alias("live"))


def live_after_registry(spark, sf_dir):
    """Equity rows per live flag of the later days, the registry supplying flags set before them."""
    instances = earlier_instances(spark, sf_dir)
    run = Run(spark, sf_dir, since=HALF, instances=instances)
    equity = run.area.table(rows.equity_of_line(run.gated), "equity")
    flags = run.area.table(gate.live_by_file(equity, run.facts, instances), "flags")
    live = gate.attach_live(equity, flags).withColumn("live", F.col("live").cast("string"))
    return live.groupBy("mode", "live").agg(F.count("*").alias("n_rows"))


def item_classes(spark, sf_dir):
    configure(spark)
    items = explode_items(parse_messages(event_lines(load_events(spark, sf_dir), noisy=True)))
    return items.groupBy(F.coalesce("cls", F.lit("dropped")).alias("cls"), "tag").agg(F.count("*").alias("n"))


def trades(spark, sf_dir):
    found = rows.trades_of_line(Run(spark, sf_dir).gated)
    last = latest_by_key(found, list(TRADES.keys), [*ORDER, "pos"])
    return last.select(*[c for c in TRADES.columns if c != "data"])


def trade_table(spark, sf_dir):
    """Trades stored twice, with keys cut to the hour of the day so that later ones replace earlier ones."""
    run = Run(spark, sf_dir)
    found = rows.trades_of_line(run.gated).withColumn("time_ns", _hour_of_day())
    warehouse = run.warehouse()
    for part in (found.where(before_half()), found.where(~before_half())):
        warehouse.upsert(TRADES, part, [*ORDER, "pos"])
    return warehouse.read(TRADES).select(
        "mode", "time_ns", "data_type", "price", F.get_json_object("data", "$.id").alias("payload_id")
    )


def _hour_of_day() -> Column:
    hour = 3600 * 10**9
    return (F.floor(F.col("time_ns") / hour) % 24 * hour).cast("bigint")


def upsert_equity(spark, sf_dir):
    run = Run(spark, sf_dir)
    found = rows.equity_of_line(run.gated).withColumn("time_ns", _hour_of_day())
    warehouse = run.warehouse()
    for part in (found.where(before_half()), found.where(~before_half())):
        warehouse.upsert(EQUITY, part, ORDER)
    return warehouse.read(EQUITY).select("mode", "time_ns", "equity")


def upsert_merged(spark, sf_dir):
    """The same two upserts, merged, then the last days once more: a merged version of all keys and one of a few above it."""
    run = Run(spark, sf_dir)
    found = rows.equity_of_line(run.gated).withColumn("time_ns", _hour_of_day())
    warehouse = run.warehouse()
    for part in (found.where(before_half()), found.where(~before_half())):
        warehouse.upsert(EQUITY, part, ORDER)
    warehouse.merge(EQUITY)
    last = F.col("file_ts") >= F.unix_timestamp(F.lit(LATE), "yyyy-MM-dd")
    warehouse.upsert(EQUITY, found.where(last), ORDER)
    return warehouse.read(EQUITY).select("mode", "time_ns", "equity")


def archive_rows(spark, sf_dir):
    found = rows.archive_of_line(Run(spark, sf_dir).gated)
    candle = lambda key: F.get_json_object("value", f"$[0].candle.{key}")
    return found.select(
        "timestamp", "mode", "component", "src",
        candle("close").cast("double").alias("close"), candle("volume").cast("bigint").alias("volume"),
        F.json_array_length("value").cast("bigint").alias("n_items"),
    )


def registered_modes(spark, sf_dir):
    instances = registry.registrations(Run(spark, sf_dir).facts, NOW)
    data = lambda key: F.get_json_object("data", f"$.{key}").alias(f"data_{key}")
    return instances.select(
        "mode", "component", "designator", F.col("live").cast("string").alias("live"), "processed_at",
        data("config_path"), data("designator"), data("strand_id"), data("live"), data("processed_at"),
    )


def registry_touch(spark, sf_dir):
    instances = earlier_instances(spark, sf_dir, LATE)
    run = Run(spark, sf_dir, since=LATE, instances=instances)
    touched = registry.touch_instances(instances, run.facts, "2024-03-01")
    return touched.select(
        "mode", "component", "designator", "processed_at",
        F.coalesce(F.get_json_object("data", "$.cachedStats"), F.lit("none")).alias("cached_stats"),
        F.get_json_object("data", "$.processed_at").alias("data_processed_at"),
    )


def known_instances(spark, sf_dir):
    """A second registration that skips the modes already stored."""
    run = Run(spark, sf_dir)
    warehouse = run.warehouse()
    registry.upsert_instances(warehouse, earlier_instances(spark, sf_dir))
    latest = registry.registrations(run.facts, NOW)
    registry.upsert_instances(warehouse, latest, check_existing=True)
    return warehouse.read(INSTANCES).select("mode", "component", "designator")


def compacted(spark, sf_dir, grain: str = "week", merged: bool = False):
    """The archive written by two runs, read back and summed up per mode and period."""
    run = Run(spark, sf_dir)
    warehouse = run.warehouse(width=1 if grain in ("week", "month") else 0)
    found = rows.archive_of_line(run.gated)
    # a period cut by HALF must keep the rows of both runs
    for part in (found.where(before_half()), found.where(~before_half())):
        archive.compact(warehouse, part, grain=grain)
    if merged:
        warehouse.merge(archive_table(grain))
    return archive.compaction_summary(archive.read_archive(warehouse, grain=grain), grain)


def stored_time_range(spark, sf_dir):
    """The archive of two runs, the second one's rows summed up from the footers of its files."""
    run = Run(spark, sf_dir)
    warehouse = run.warehouse(width=1)
    found = rows.archive_of_line(run.gated)
    for part in (found.where(before_half()), found.where(~before_half())):
        archive.compact(warehouse, part)
    return archive.stored_periods(warehouse)


def archive_slice(spark, sf_dir):
    run = Run(spark, sf_dir)
    warehouse = run.warehouse()
    archive.compact(warehouse, rows.archive_of_line(run.gated))
    mode, start, end = SLICE
    return archive.read_archive(warehouse, mode, start=start, end=end).select("timestamp", "mode", "src")


def _archived(spark, sf_dir):
    return rows.archive_of_line(Run(spark, sf_dir).gated)


def archive_time_range(spark, sf_dir):
    return archive.time_range(_archived(spark, sf_dir))


def archive_modes(spark, sf_dir):
    return archive.modes(_archived(spark, sf_dir))


def mode_files(spark, sf_dir):
    return archive.files_by_mode(_archived(spark, sf_dir))


def distinct_ts(spark, sf_dir):
    stamps = archive.distinct_timestamps(Run(spark, sf_dir).gated)
    return stamps.groupBy("file_name").agg(F.count("*").alias("n_timestamps"))


def equity_with_candle(spark, sf_dir):
    found = rows.equity_with_candle(Run(spark, sf_dir, candle=True).gated)
    return found.select("mode", "time_ns", "equity", "open", "high", "low", "close", "volume")


def _day_listing(events: DataFrame) -> DataFrame:
    """One log file per day; the content id stands for the events of the day."""
    day = F.date_trunc("day", F.col("ts"))
    days = events.groupBy(day.alias("day")).agg(F.count("*").alias("n"), F.sum("event_id").alias("total"))
    stamp = F.date_format("day", "yyyyMMdd")
    odd = F.dayofmonth("day") % 2 == 1
    return days.select(
        "day",
        F.when(odd, F.concat(F.lit("export-"), stamp, F.lit(".jsnl")))
        .otherwise(F.concat(F.lit("dashboard_data_"), stamp, F.lit("_060000.jsnl"))).alias("file_name"),
        (F.unix_timestamp("day") + 3600).cast("double").alias("mtime"),
        F.md5(F.concat_ws(":", stamp, F.col("n").cast("string"), F.col("total").cast("string"))).alias("file_id"),
    )


def first_files(spark, sf_dir):
    configure(spark)
    listing = files.with_file_ts(_day_listing(load_events(spark, sf_dir)))
    return files.pick_files(listing, FIRST_FILES).select("file_name", "file_ts")


def not_yet_ingested(spark, sf_dir):
    """Days whose content changed since they were ingested: errors were added from HALF on."""
    configure(spark)
    events = load_events(spark, sf_dir)
    known = events.where((F.col("ts") < F.lit(HALF).cast("timestamp")) | (F.col("event_type") != "error"))
    fresh = files.new_files(_day_listing(events), _day_listing(known))
    return fresh.select("file_name", "file_id", output_name(F.col("file_name"), F.col("file_id")).alias("src"))


def partition_names(spark, sf_dir):
    configure(spark)
    mode = F.concat(F.lit("u"), F.col("user_id"))
    modes = load_events(spark, sf_dir).select(mode.alias("mode")).distinct()
    return modes.select("mode", partition_name(F.col("mode")).alias("partition_name"))


def _filled(spark, sf_dir) -> Warehouse:
    run = Run(spark, sf_dir)
    warehouse = run.warehouse()
    registry.upsert_instances(warehouse, registry.registrations(run.facts, NOW))
    warehouse.upsert(EQUITY, rows.equity_of_line(run.gated), ORDER)
    warehouse.upsert(TRADES, rows.trades_of_line(run.gated), [*ORDER, "pos"])
    archive.compact(warehouse, rows.archive_of_line(run.gated))
    return warehouse


def delete_one_mode(spark, sf_dir):
    """Rows per mode and table after one mode was deleted everywhere."""
    warehouse = _filled(spark, sf_dir)
    delete_mode(warehouse, SLICE[0], grains=("week",))
    left = [
        warehouse.read(table).groupBy("mode").agg(F.count("*").alias("n_rows"))
        .select(F.lit(table.name).alias("table_name"), "mode", "n_rows")
        for table in (EQUITY, TRADES, INSTANCES, archive_table("week"))
    ]
    return reduce(DataFrame.unionByName, left)


def delete_dry_run(spark, sf_dir):
    return delete_mode(_filled(spark, sf_dir), SLICE[0], grains=("week",), dry_run=True)


def _log_directory(spark, sf_dir, area: Staging) -> str:
    configure(spark)
    write_log_files(spark, event_lines(load_events(spark, sf_dir)), area.path("input"))
    return area.path("input/logs")


def batch_on_change(spark, sf_dir):
    """The whole ingest run over real log files; the equity table it leaves."""
    area = Staging(spark)
    warehouse = Warehouse(spark, area.path("warehouse"), 1)
    run_batch(spark, _log_directory(spark, sf_dir, area), warehouse, now=NOW)
    return warehouse.read(EQUITY).select("mode", "time_ns", "equity")


def stream_on_change(spark, sf_dir):
    """The same files as a stream of micro-batches."""
    area = Staging(spark)
    warehouse = Warehouse(spark, area.path("warehouse"), 1)
    logs = _log_directory(spark, sf_dir, area)
    query = stream_ingest(spark, logs, warehouse, checkpoint=area.path("checkpoint"), max_files=12,
                          trigger={"availableNow": True}, now=NOW)
    query.awaitTermination()
    return warehouse.read(EQUITY).select("mode", "time_ns", "equity")


def batch_in_rounds(spark, sf_dir):
    """The same files in rounds of at most ten, moved away as further rounds follow."""
    area = Staging(spark)
    warehouse = Warehouse(spark, area.path("warehouse"), 1)
    logs = _log_directory(spark, sf_dir, area)
    run_in_rounds(spark, logs, warehouse, checkpoint=area.path("checkpoint"), max_files=10, archive_dir=area.path("moved"), now=NOW)
    return warehouse.read(EQUITY).select("mode", "time_ns", "equity")


class Death(Exception):
    """A run that is cut off."""


class DyingWarehouse(Warehouse):
    """Dies once after each of its tables was written, in the order in which a run writes them."""

    def __init__(self, *args):
        super().__init__(*args)
        self.left = {INSTANCES.name, EQUITY.name, TRADES.name, archive_table().name}

    def add_version(self, table, *args, **options):
        super().add_version(table, *args, **options)
        if table.name in self.left:
            self.left.remove(table.name)
            raise Death(table.name)


def batch_repeat(spark, sf_dir):
    """The whole run, cut off after every sink in turn and started again: registered modes must not be known earlier than at first."""
    area = Staging(spark)
    warehouse = DyingWarehouse(spark, area.path("warehouse"), 1)
    logs = _log_directory(spark, sf_dir, area)
    while True:
        try:
            run_batch(spark, logs, warehouse, now=NOW)
            break
        except Death:
            continue
    return warehouse.read(EQUITY).select("mode", "time_ns", "equity")


def stream_repeat(spark, sf_dir):
    """The same for the first micro-batch of a stream that is started again from its checkpoint."""
    area = Staging(spark)
    warehouse = DyingWarehouse(spark, area.path("warehouse"), 1)
    logs = _log_directory(spark, sf_dir, area)
    while True:
        query = stream_ingest(spark, logs, warehouse, checkpoint=area.path("checkpoint"), max_files=12, trigger={"availableNow": True}, now=NOW)
        try:
            query.awaitTermination()
            break
        except StreamingQueryException:
            if query.exception() and "Death" not in str(query.exception()):
                raise
    return warehouse.read(EQUITY).select("mode", "time_ns", "equity")


def stream_then_batch(spark, sf_dir):
    """A batch run after the stream finds nothing new: rows per table afterwards, and files that it read."""
    area = Staging(spark)
    warehouse = Warehouse(spark, area.path("warehouse"), 1)
    logs = _log_directory(spark, sf_dir, area)
    stream_ingest(spark, logs, warehouse, checkpoint=area.path("checkpoint"), max_files=12, trigger={"availableNow": True}, now=NOW).awaitTermination()
    again = run_batch(spark, logs, warehouse, now=LATER).groupBy().agg(F.count("*").alias("n_rows")).select(F.lit("files").alias("table_name"), "n_rows")
    counts = [warehouse.read(t).groupBy().agg(F.count("*").alias("n_rows")).select(F.lit(t.name).alias("table_name"), "n_rows")
              for t in (TRADES, INSTANCES, archive_table())]
    return reduce(DataFrame.unionByName, counts, again)


def grown_files(spark, sf_dir):
    """Files that grow between two runs: the archive holds each line once."""
    area = Staging(spark)
    warehouse = Warehouse(spark, area.path("warehouse"), 1)
    configure(spark)
    lines = event_lines(load_events(spark, sf_dir))
    # at first each day's file ends at noon
    stamp = F.get_json_object("line", "$.timestamp").cast("double")
    morning = F.coalesce(stamp - F.col("file_ts") < 43200, F.lit(False))
    write_log_files(spark, _begin_of_files(lines, morning), area.path("morning"))
    run_batch(spark, area.path("morning/logs"), warehouse, now=NOW)
    write_log_files(spark, lines, area.path("evening"))
    for name in fs.list_names(spark, area.path("evening/logs")):
        fs.delete(spark, area.path(f"morning/logs/{name}"))
        fs.rename(spark, area.path(f"evening/logs/{name}"), area.path(f"morning/logs/{name}"))
    run_batch(spark, area.path("morning/logs"), warehouse, now=LATER)
    return archive.read_archive(warehouse).select("timestamp", "mode")


def _begin_of_files(lines: DataFrame, early: Column) -> DataFrame:
    """The lines of each file up to its last ``early`` one."""
    last = lines.where(early).groupBy("file_name").agg(F.max("ord").alias("last"))
    return lines.join(F.broadcast(last), "file_name").where("ord <= last").select(*lines.columns)


QUERIES = {
    "equity_on_change": equity_on_change,
    "equity_all": equity_all,
    "equity_resume": equity_resume,
    "equity_noisy": noisy_equity,
    "line_stats": line_stats,
    "line_reasons": line_reasons,
    "config_gate": config_gate,
    "registry_gate": registry_gate,
    "live_as_of": live_as_of,
    "live_after_registry": live_after_registry,
    "item_classes": item_classes,
    "trades": trades,
    "trade_table": trade_table,
    "upsert_equity": upsert_equity,
    "upsert_merged": upsert_merged,
    "archive_rows": archive_rows,
    "registry": registered_modes,
    "registry_touch": registry_touch,
    "registry_known": known_instances,
    "compact_hour": partial(compacted, grain="hour"),
    "compact_day": partial(compacted, grain="day"),
    "compact_week": partial(compacted, grain="week"),
    "compact_month": partial(compacted, grain="month"),
    "compact_merged": partial(compacted, merged=True),
    "stored_time_range": stored_time_range,
    "archive_slice": archive_slice,
    "time_range": archive_time_range,
    "modes": archive_modes,
    "mode_files": mode_files,
    "distinct_ts": distinct_ts,
    "equity_with_candle": equity_with_candle,
    "pick_files": first_files,
    "new_files": not_yet_ingested,
    "partition_names": partition_names,
    "delete_mode": delete_one_mode,
    "delete_mode_dry": delete_dry_run,
    "batch_on_change": batch_on_change,
    "stream_on_change": stream_on_change,
    "batch_in_rounds": batch_in_rounds,
    "batch_repeat": batch_repeat,
    "stream_repeat": stream_repeat,
    "stream_then_batch": stream_then_batch,
    "grown_files": grown_files,
}
