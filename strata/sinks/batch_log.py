"""Results of a streaming query as one Parquet folder per micro-batch.

A batch writes its own rows only, with overwrite, so a replayed batch replaces its
folder and never duplicates. Folders are named by the query's id and the batch's
number: a query with a new checkpoint, which counts from 0 again, replaces nothing.
A read folds the rows per key with plain aggregates: the row of the greatest
``order`` in whatever batch it came (equal orders: the later batch), the row of the
least, or the sum of ``measures``.

The row is one struct column, so no column of it can clash with the log's own.
Nothing is compacted: a job that has run long may write ``read()`` as the first
batch of a new log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEED = -1  # batch number of rows loaded before the stream


def query_id(spark: SparkSession) -> str:
    """Inside ``foreachBatch``: the id of the streaming query, kept over restarts."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def parquet_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """What is at ``path``; None without a folder or without any file in it."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as e:
        # A streaming sink's empty folder is reported without a condition.
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA") or "infer schema" in str(e):
            return None
        raise


class BatchLog:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = (),
                 measures: Sequence[str] | None = None, pick: str = "last", parts: Sequence[str] = ()):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.order, self.parts = list(keys), list(order), list(parts)
        self.measures = None if measures is None else list(measures)
        self.pick = pick

    def append(self, batch: DataFrame, batch_id: int, is_delete: Column | None = None,
               run: str | None = None) -> None:
        """Store one micro-batch; ``parts`` columns become folders, in the same write."""
        kept = [c for c in batch.columns if c not in self.parts]
        gone = F.coalesce(F.lit(False) if is_delete is None else is_delete, F.lit(False))
        rows = batch.select(F.struct(*kept).alias("row"), gone.alias("gone"),
                            *[F.col(p).alias(f"part_{p}") for p in self.parts])
        writer = rows.write.mode("overwrite")
        if self.parts:
            writer = writer.partitionBy(*[f"part_{p}" for p in self.parts])
        writer.parquet(f"{self.path}/run=q-{query_id(self.spark) if run is None else run}/batch={batch_id}")

    def seed(self, rows: DataFrame) -> None:
        """Load rows that precede every batch. Seeding again replaces them, so a
        preload that broke off is simply repeated."""
        self.append(rows, SEED, run="seed")

    def read(self, empty: str | None = None, before: int | None = None,
             where: Column | None = None) -> DataFrame:
        """The folded rows; ``before`` reads only the batches below that number,
        ``where`` only some ``parts`` (named ``part_<column>``). A log without rows is
        an error unless ``empty`` gives its columns."""
        log = parquet_or_none(self.spark, self.path)
        if log is None:
            if empty is None:
                raise ValueError(f"no batch in the log at {self.path}")
            return self.spark.createDataFrame([], empty)
        log = log if where is None else log.where(where)
        log = log if before is None else log.where(F.col("batch") < before)
        keys = [F.col(f"row.{k}").alias(k) for k in self.keys]
        if self.measures is not None:
            kinds = {f.name: f.dataType for f in log.schema["row"].dataType.fields}
            others = [c for c in kinds if c not in (*self.keys, *self.measures)]
            return log.groupBy(*keys).agg(
                *[F.sum(f"row.{m}").cast(kinds[m]).alias(m) for m in self.measures],
                *[F.max(f"row.{c}").alias(c) for c in others])
        best = F.min_by if self.pick == "first" else F.max_by
        order = F.struct(*[F.col(f"row.{c}") for c in self.order], "batch")
        picked = log.groupBy(*keys).agg(best(F.struct("row", "gone"), order).alias("at_end"))
        return picked.where(~F.col("at_end.gone")).select("at_end.row.*")
