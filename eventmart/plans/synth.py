"""The ``events`` table written out as log lines, so that the whole parse path runs on given data.

mode = ``u<user_id>``; file = the day; order in a file = ``event_id``. A ``signup`` is a start message
(live when ``event_id`` is even). Every other event is a data line whose items are: equity
(``floor(value / 10)`` as text) unless the type is ``error``; an ``open`` trade at ``value`` for a
``purchase``; a candle for a ``view`` or an ``error``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.functions.naming import epoch_seconds
from eventmart.sources import fs

# Lines per split when no file layout gives one.
SPLIT_LINES = 1_000_000
# Lines that one task is to parse.
TASK_LINES = 100_000

# Malformed variants of a data line, by the event's property k (see ``noisy``).
NOISE = {
    0: "blank line",
    1: "broken JSON",
    2: "text after the object",
    3: "no component",
    4: "timestamp 0",
    5: "timestamp that is no number",
    6: "JSON list instead of an object",
    7: "item that is no object",
    8: "trade price that is no number",
    9: "equity that is no number",
    10: "equity key missing",
    11: "value is one object",
    12: "timestamp as text",
    13: "empty value list",
    14: "value is a number",
    15: "item tag 0",
}


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    # splits without a row group's begin hold no rows, and a row group of compact rows makes very many lines: rows are dealt anew
    tasks = -(-events.count() // TASK_LINES)  # from the footers
    return events.repartition(max(tasks, spark.sparkContext.defaultParallelism))


def _json(*columns: Column) -> Column:
    return F.to_json(F.struct(*columns))


def event_lines(events: DataFrame, *, noisy: bool = False) -> DataFrame:
    mode = F.concat(F.lit("u"), F.col("user_id"))
    seconds = epoch_seconds(F.col("ts"))
    amount = F.floor(F.col("value") / 10).cast("string")
    kind = F.col("event_type")

    equity = F.when(kind != "error", _json(F.lit("e").alias("t"), amount.alias("equity"), F.lit("paper").alias("b")))
    trade = F.when(
        kind == "purchase",
        _json(
            F.lit("open").alias("t"),
            F.lit("NAS100_USD").alias("instrument"),
            F.col("value").alias("price"),
            F.lit(1.0).alias("units"),
            F.lit(0.0).alias("profit"),
            F.col("event_id").cast("string").alias("id"),
        ),
    )
    candle = F.when(
        kind.isin("view", "error"),
        _json(
            F.lit("c").alias("t"),
            F.struct(
                F.col("value").alias("open"), (F.col("value") + 1).alias("high"),
                (F.col("value") - 1).alias("low"), F.col("value").alias("close"),
                F.col("event_id").alias("volume"), seconds.alias("timestamp"),
            ).alias("candle"),
        ),
    )
    items = F.array_compact(F.array(candle, equity, trade))
    value = F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    stamp = seconds.cast("string")

    def data_line(value=value, stamp=stamp, component='"component":"strand",'):
        return F.concat(
            F.lit('{"timestamp":'), stamp, F.lit(',"mode":"'), mode, F.lit('",' + component + '"value":'), value, F.lit("}")
        )

    start = F.concat(
        F.lit('{"type":"strand_started","mode":"'), mode,
        F.lit('","component":"strand","config_file_path":"/etc/strand.json","live":'),
        F.when(F.col("event_id") % 2 == 0, "true").otherwise("false"),
        F.lit(',"config":{"name":"s","strand_id":"'), F.col("event_id").cast("string"),
        F.lit('","cachedStats":{"n":1}}}'),
    )
    line = data_line()
    if noisy:
        one = F.lit('{"t":"e","equity":"1"}')
        with_item = lambda extra: F.concat(F.lit('[{"t":"e","equity":1},'), F.lit(extra), F.lit("]"))
        variants = {
            0: F.lit(" \t\r"),
            1: F.lit('{"timestamp": 1, '),
            2: F.concat(line, F.lit(" x")),
            3: data_line(component=""),
            4: data_line(stamp=F.lit("0")),
            5: data_line(stamp=F.lit('"soon"')),
            6: F.concat(F.lit("["), line, F.lit("]")),
            7: data_line(value=with_item('"e"')),
            8: data_line(value=with_item('{"t":"close","price":"n/a"}')),
            9: data_line(value=F.lit('[{"t":"e","equity":"n/a"},{"t":"c"},{"t":"open"}]')),
            10: data_line(value=F.lit('[{"t":"e"},{"t":"c"}]')),
            11: data_line(value=one),
            12: data_line(stamp=F.concat(F.lit('"'), stamp, F.lit('"'))),
            13: data_line(value=F.lit("[]")),
            14: data_line(value=F.lit("7")),
            15: data_line(value=with_item('{"t":0},{"t":"0"}')),
        }
        k = F.get_json_object("props", "$.k").cast("int")
        for number, text in variants.items():
            line = F.when(k == number, text).otherwise(line)
    day = F.date_trunc("day", F.col("ts"))
    return events.select(
        epoch_seconds(day).alias("file_ts"),
        F.date_format(day, "'dashboard_data_'yyyyMMdd'_000000.jsnl'").alias("file_name"),
        F.expr(f"event_id div {SPLIT_LINES}").alias("block"),
        F.col("event_id").alias("ord"),
        F.when(kind == "signup", start).otherwise(line).alias("line"),
    )


def write_log_files(spark: SparkSession, lines: DataFrame, directory: str) -> None:
    """Text files of at most SPLIT_LINES lines, named and modified in the order of the lines."""
    parted = f"{directory}/by_name"
    stem = F.regexp_replace("file_name", r"\.jsnl$", "")
    name = F.concat(stem, F.lit("_"), F.lpad(F.col("block").cast("string"), 12, "0"), F.lit(".jsnl"))
    stamped = lines.withColumn("name", F.concat_ws("@", name, F.col("file_ts").cast("bigint")))
    (
        stamped.repartition("name").sortWithinPartitions("name", "block", "ord")
        .select("line", "name").write.partitionBy("name").text(parted)
    )
    fs.make_dirs(spark, f"{directory}/logs")
    folders = [n for n in fs.list_names(spark, parted) if n.startswith("name=")]
    for number, folder in enumerate(folders):
        file_name, seconds = folder.removeprefix("name=").split("@")
        (written,) = [n for n in fs.list_names(spark, f"{parted}/{folder}") if n.startswith("part-")]
        target = f"{directory}/logs/{file_name}"
        fs.rename(spark, f"{parted}/{folder}/{written}", target)
        fs.set_modified(spark, target, int(seconds) * 1000 + number)
