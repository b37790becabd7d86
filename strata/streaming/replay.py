"""Replay a table as an ordered file stream (the stand-in for a message log).

``replayed`` writes a frame in a few contiguous ranges of an order column, one
after another, and opens the folder as a file stream that delivers one range per
micro-batch, oldest first. Rows without an order are dealt over files by one write,
with a file for each core and micro-batch. It is a harness for tests and for the registered
twins; the jobs themselves take any stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.session import scratch_path
from strata.sinks.batch_log import parquet_or_none

ROWS_PER_FILE = 500_000


def _number(df: DataFrame, col: str):
    dtype = df.schema[col].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp"))
    return F.col(col).cast("double")


def _dealt(df: DataFrame, path: str, slices: int) -> int:
    """Write ``df`` shuffled, and return the number of files. Each task deals its rows in
    the order of their hash to all files in turn, so equal rows spread, too."""
    spark = df.sparkSession
    parts = slices * spark.sparkContext.defaultParallelism
    df.repartition(parts).write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
    return len(spark.read.schema(df.schema).parquet(path).inputFiles())


def replayed(df: DataFrame, order: str | None, name: str, slices: int = 4) -> DataFrame:
    """``df`` as a stream of ``slices`` micro-batches in the order of ``order``, each
    of one file per ``ROWS_PER_FILE`` rows of the table; without an order, rows
    arrive shuffled, in ``slices`` micro-batches at most."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if order is None:
        files = _dealt(df, path, slices)
        return opened(spark, path, df.schema, max(1, -(-files // slices)))
    placed = df.withColumn("_x", _number(df, order)).persist()
    try:
        lo, hi, n = placed.agg(F.min("_x"), F.max("_x"), F.count(F.lit(1))).first()
        files = max(1, -(-n // (ROWS_PER_FILE * slices)))
        width = max((float(hi) - float(lo)) / slices, 1e-9) if lo is not None else 1.0
        number = F.coalesce(F.least(F.floor((F.col("_x") - F.lit(lo or 0)) / F.lit(width)),
                                    F.lit(slices - 1)), F.lit(0))
        for i in range(slices):
            placed.where(number == i).drop("_x").repartition(files).write.mode("append").parquet(path)
    finally:
        placed.unpersist()
    return opened(spark, path, df.schema, files)


def opened(spark: SparkSession, path: str, schema: T.StructType, files: int = 1) -> DataFrame:
    """A folder of Parquet files as a stream of ``files`` files per micro-batch."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path))


def drain(query: StreamingQuery) -> None:
    """Wait until an ``availableNow`` query has taken everything, and stop it."""
    try:
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    finally:
        query.stop()


def written(spark: SparkSession, path: str, like: T.StructType | str) -> DataFrame:
    """What a job wrote to ``path``; empty when there was no batch."""
    out = parquet_or_none(spark, path)
    if out is None:
        return spark.createDataFrame([], like)
    return out.drop("batch") if "batch" in out.columns else out
