"""Broadcast only behind a checked size bound, with a shuffle join beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default bounds of a broadcast side; dictionaries and config tables sit far
# below them, fact-sized tables far above.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def fits(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and their text is at most
    ``max_bytes`` long. ``limit(max_rows + 1)`` bounds the work on a huge table."""
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when both bounds hold, else ``df`` unchanged so the
    planner keeps a shuffle (or AQE's own runtime choice)."""
    return F.broadcast(df) if fits(df, max_rows) else df
