"""How the given events are dealt over tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventmart.plans import synth


def test_a_large_row_group_is_dealt_over_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(synth, "TASK_LINES", 1000, raising=False)
    rows = spark.range(20_000).selectExpr("id AS event_id", "timestamp_seconds(id) AS ts", "id AS user_id", "'view' AS event_type", "1.5D AS value", "md5(string(id)) AS props")
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    # more splits than cores, of which one has all rows
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.parquet(f"{tmp_path}/events.parquet").rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
        found = synth.load_events(spark, str(tmp_path))
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) <= 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
