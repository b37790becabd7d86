"""Dynamic fan-out: each routed row lands in the table its ``sink_table`` names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.batch_log import BatchLog


def destinations(spark: SparkSession, base: str) -> BatchLog:
    """All destinations in one log, a folder each. The greatest numeric ``ts`` of a key
    wins, equal times by ``tie``; the payload stays one map."""
    return BatchLog(spark, base, ["pk_value"], order=["ts", "tie"], parts=["sink_table"])


def write_destinations(routed: DataFrame, base: str, batch_id: int, run: str | None = None) -> None:
    """One micro-batch's routed rows (``sink_table, pk_value, type, ts, data``) in one
    write, however many destinations they name. ``delete`` rows remove their key."""
    rows = routed.select("sink_table", "pk_value", F.col("ts").try_cast("bigint").alias("ts"),
                         F.xxhash64(F.to_json("data"), "type").alias("tie"), "type", "data")
    destinations(routed.sparkSession, base).append(rows, batch_id, F.col("type") == "delete", run)


def read_destination(spark: SparkSession, base: str, table: str, columns: list[str],
                     key: str | None = None) -> DataFrame:
    """The current rows of one destination: a string column per name in ``columns``
    (NULL where a payload lacks it), and the key's value as ``key`` if given."""
    rows = destinations(spark, base).read("pk_value STRING, data MAP<STRING,STRING>",
                                          where=F.col("part_sink_table") == table)
    named = [F.element_at("data", F.lit(c)).alias(c) for c in dict.fromkeys(columns)]
    return rows.select(*([F.col("pk_value").alias(key)] if key else []), *named)
