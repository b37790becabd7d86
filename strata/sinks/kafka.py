"""Message-log sinks: plain JSON records and upsert (keyed, tombstone) records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_records(df: DataFrame, key_cols: Sequence[str] = ()) -> DataFrame:
    """``value = to_json(row)`` and, when given, ``key = to_json(key columns)``."""
    cols = [F.to_json(F.struct(*df.columns)).alias("value")]
    if key_cols:
        cols.insert(0, F.to_json(F.struct(*key_cols)).alias("key"))
    return df.select(*cols)


def upsert_records(df: DataFrame, key_cols: Sequence[str], is_delete: Column | None = None) -> DataFrame:
    """Upsert form: key = primary key as JSON; value = row as JSON, or NULL (a
    tombstone) for deletes, so a compacted topic keeps the latest row per key."""
    value = F.to_json(F.struct(*df.columns))
    if is_delete is not None:
        value = F.when(is_delete, F.lit(None).cast("string")).otherwise(value)
    return df.select(F.to_json(F.struct(*key_cols)).alias("key"), value.alias("value"))


def write_stream(records: DataFrame, servers: str, topic: str, checkpoint: str, trigger_s: int = 5):
    """At-least-once delivery; replays are made harmless by keyed consumers."""
    return (records.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .option("checkpointLocation", checkpoint)
            .trigger(processingTime=f"{trigger_s} seconds")
            .start())
