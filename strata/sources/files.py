"""File sources: driver tables as batch frames or as streams, and text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def as_log_records(df: DataFrame, topic: str, key: Column, value: Column,
                   offset: Column, timestamp: Column, partition: Column | None = None) -> DataFrame:
    """Rows in the shape a message source delivers: ``topic, partition, offset,
    timestamp, key, value`` with binary key and value (NULL-tolerant)."""
    return df.select(
        F.lit(topic).alias("topic"),
        (partition if partition is not None else F.lit(0)).alias("partition"),
        offset.alias("offset"), timestamp.alias("timestamp"),
        key.cast("string").cast("binary").alias("key"),
        value.cast("string").cast("binary").alias("value"))


def read_table_stream(spark: SparkSession, sf_dir: str, name: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """One driver table as a streaming source (file source over its folder,
    restricted to the table's file). The schema is taken from the batch read so
    the stream needs no inference."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").schema
    reader = (spark.readStream.schema(schema)
              .option("pathGlobFilter", f"{name}.parquet"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(sf_dir)


def read_text_stream(spark: SparkSession, path: str) -> DataFrame:
    """Delimited text lines as a stream (``value STRING``): the replacement for
    a socket text source."""
    return spark.readStream.text(path)
