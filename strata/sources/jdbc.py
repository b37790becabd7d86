"""Relational sources: the routing config and lookup dictionaries.

Connection URL and credentials are parameters (never literals in code).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None) -> DataFrame:
    return spark.read.jdbc(url, table, properties=properties or {})


def read_live_config(spark: SparkSession, url: str, table: str = "table_process",
                     properties: dict[str, str] | None = None, live_type: str = "dim") -> DataFrame:
    """Config rows of one sink type; the filter is pushed into the database
    query (``PushedFilters``) and every column is read."""
    return read_table(spark, url, table, properties).where(F.col("sink_type") == live_type)


class Refreshing:
    """A small table re-read when older than ``max_age_s`` (0 = every call).

    Meant for ``foreachBatch``: call ``get()`` at the start of each batch so
    rows added to the source since the last read are seen, with staleness
    bounded by ``max_age_s``. The previous copy is unpersisted on refresh.
    """

    def __init__(self, loader, max_age_s: float = 3600.0, clock=time.monotonic):
        self.loader = loader
        self.max_age_s = max_age_s
        self.clock = clock
        self._df: DataFrame | None = None
        self._at = 0.0

    def get(self, *args) -> DataFrame:
        """The table; ``args`` (such as a micro-batch's session) go to the loader."""
        now = self.clock()
        if self._df is None or now - self._at >= self.max_age_s:
            fresh = self.loader(*args).persist()
            if self._df is not None:
                self._df.unpersist()
            self._df, self._at = fresh, now
        return self._df
