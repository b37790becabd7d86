"""The keyed state of a streaming query: read from its checkpoint as a table, and lists
whose elements each pack many values."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a query: id, name, stores, partitions, batches held."""
    return spark.read.format("state-metadata").load(checkpoint)


def rows(spark: SparkSession, checkpoint: str, operator: int = 0, variable: str | None = None,
         side: str | None = None, batch: int | None = None) -> DataFrame:
    """What an operator holds after its last batch (or ``batch``): key and value.
    ``variable`` names a state variable of ``transformWithState``, ``side`` a side of a
    stream-stream join."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    for name, value in (("stateVarName", variable), ("joinSide", side), ("batchId", batch)):
        reader = reader if value is None else reader.option(name, value)
    return reader.load(checkpoint)


def pack(values: list) -> tuple[bytes]:
    """An element of a list state ``packed BINARY`` that holds all ``values``."""
    return (pickle.dumps(values),)


def unpack(packed) -> Iterator:
    """The values of all elements of such a list state."""
    for (element,) in packed.get():
        yield from pickle.loads(element)
