"""Message-log sources (Kafka). Endpoints and topics are parameters only.

The Kafka connector jar is not bundled here; these readers are what a job
passes to ``readStream`` on a cluster that has it. Offsets live in the
query checkpoint, not in the consumer group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import schemas


def read_strings(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
                 read_committed: bool = False, options: dict[str, str] | None = None) -> DataFrame:
    """Topic as ``value STRING`` plus record metadata. A NULL message stays a
    NULL value (tolerated downstream, never a failure)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if read_committed:
        reader = reader.option("kafka.isolation.level", "read_committed")
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load().select(
        "topic", "partition", "offset", "timestamp",
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def read_change_envelopes(spark: SparkSession, servers: str, topic: str, **kw) -> DataFrame:
    """Change envelopes (``database, table, type, ts, data, old``) with the
    record position as a unique order and the processing time."""
    raw = read_strings(spark, servers, topic, **kw)
    parsed = raw.select("partition", "offset",
                        F.from_json("value", schemas.ENVELOPE).alias("e"))
    return (parsed.where(F.col("e").isNotNull())
                  .select("e.*", "partition", "offset", F.current_timestamp().alias("proc_time")))

