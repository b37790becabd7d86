"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import checkpoint_root, scratch_path

# The white space that ends a word (space, tab to carriage return).
WORD_BREAK_CLASS = "[ \\t-\\r]+"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that no column of ``df`` has, whatever its letter case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def whole_text(col: str | Column) -> Column:
    """The text itself; a null text is empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the maximal runs of non-white-space characters."""
    return F.array_remove(F.split(text, WORD_BREAK_CLASS, -1), "")


def computed(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """``df`` with the column ``name`` worked out once per row. A one-element
    ``explode`` stands between the expression and its users: the optimizer
    copies a projected expression into every filter above it, and a copied
    word split inside a lambda would run once per element."""
    return df.select("*", F.explode(F.array(expr)).alias(name))


def durable(df: DataFrame) -> DataFrame:
    """``df.checkpoint()`` in the shared folder: the rows are computed once and
    survive the loss of executors, and later plans start from the files."""
    sc = df.sparkSession.sparkContext
    root = checkpoint_root(df.sparkSession)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return df.checkpoint(eager=True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of each query inside as soon as it ends,
    so that a chain of written tables needs the disk of its largest step only."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read again; later
    plans read only the columns they need."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def to_arrow_schema(spark: SparkSession, ddl: str):
    """The Arrow schema of the rows that ``ddl`` describes."""
    from pyspark.sql.pandas.types import to_arrow_schema as converted
    return converted(spark.createDataFrame([], ddl).schema)
