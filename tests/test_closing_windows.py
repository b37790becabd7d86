"""The traffic twin emits every window of its log, the last ones too."""

from datetime import datetime

from pyspark.sql import functions as F

from strata.plans import catalog, derive


def _events(spark, path, rows):
    spark.createDataFrame(rows, "event_id long, user_id long, ts string, event_type string, value double").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{path}/events.parquet")


def test_last_windows_are_emitted(spark, tmp_dir):
    _events(spark, tmp_dir, [(1, 1, "2024-01-01 00:00:05", "click", 1.0), (2, 1, "2024-01-01 00:10:00", "click", 2.0),
                             (3, 2, "2024-01-01 05:00:00", "view", 1.0), (4, 1, "2024-01-01 05:59:59.999999", "view", 4.0)])
    rows = catalog.QUERIES["stream_traffic_window"](spark, tmp_dir).collect()
    assert sorted((r.stt, r.ch, r.is_new, r.uv_ct, r.pv_ct, r.dur_sum) for r in rows) == [
        ("2024-01-01 00:00:00", "click", "0", 0, 1, 2000), ("2024-01-01 00:00:00", "click", "1", 1, 1, 1000),
        ("2024-01-01 05:00:00", "view", "0", 0, 1, 4000), ("2024-01-01 05:00:00", "view", "1", 1, 1, 1000)]
    assert catalog.ORACLE["stream_traffic_window"] == catalog.ORACLE["traffic_window"]


def test_end_record(spark):
    events = spark.createDataFrame([(datetime(2024, 1, 1),), (None,)], "ts timestamp_ntz")
    assert [r.ts for r in derive.page_log_end(events, "1 HOUR").collect()] == [datetime(2024, 1, 1, 1)]
    assert derive.page_log_end(events.where("ts IS NULL"), "1 HOUR").count() == 0
