"""Deterministic inputs derived from the driver tables.

The driver data has no envelopes, page logs or config tables, so each
registered query derives its input from a real table here. Every derivation is
a projection (no sampling, no caps), so its work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def page_log_json(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``events`` as raw page-log records (column ``value``, and columns to ``keep``). The
    previous page is named unless the view starts a session (first view, or 30 minutes
    of silence)."""
    from strata.operators.traffic import page_view_flags
    views = page_view_flags(page_log(events))
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return views.select(F.to_json(F.struct(
        F.struct(F.col("mid").cast("string").alias("mid"), "vc", "ch", "ar").alias("common"),
        F.struct(F.when(F.col("sv") == 0, "page").alias("last_page_id"), "during_time").alias("page"),
        F.floor(us / 1000).alias("ts"), F.pmod(us, F.lit(1000)).cast("int").alias("us"),
        F.col("event_id").alias("id"))).alias("value"), *keep)


def page_log_end(events: DataFrame, after: str) -> DataFrame:
    """The record that ends a page log, ``after`` (an interval) behind its last view: it
    moves the watermark past all windows that hold views. None for a log without times."""
    end = events.agg((F.max("ts") + F.expr(f"INTERVAL {after}")).alias("ts")).where(F.col("ts").isNotNull())
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return end.select(F.to_json(F.struct(
        F.struct(F.lit("end of log").alias("mid")).alias("common"), ms.alias("ts"))).alias("value"), "ts")


def change_records(events: DataFrame) -> DataFrame:
    """``events`` as the log of a table keyed by ``id`` (the user): records ``op, before,
    after, pos``. ``signup`` gives the user's row another key, ``error`` deletes it."""
    def row(key: Column) -> Column:
        return F.struct(key.alias("id"), "event_id", "event_type", "value")

    own, moved = F.col("user_id"), -F.col("user_id") - 1
    op = F.when(F.col("event_type") == "error", "d").when(F.col("event_type") == "signup", "u").when(
        F.col("event_type") == "view", "c").otherwise("u")
    return events.select(
        op.alias("op"), F.when(op.isin("u", "d"), row(own)).alias("before"),
        F.when(op != "d", row(F.when(F.col("event_type") == "signup", moved).otherwise(own))).alias("after"),
        F.col("event_id").alias("pos"))


def page_log(events: DataFrame) -> DataFrame:
    """``events`` read as a page log: device ``mid``, dimensions and duration.

    vc = app version (user_id mod 3), ch = channel (event_type),
    ar = area (user_id mod 5), during_time = value in milliseconds.
    """
    return events.select(
        "event_id", "ts",
        F.col("user_id").alias("mid"),
        F.concat(F.lit("v"), (F.col("user_id") % 3).cast("string")).alias("vc"),
        F.col("event_type").alias("ch"),
        F.concat(F.lit("ar"), (F.col("user_id") % 5).cast("string")).alias("ar"),
        F.round(F.col("value") * 1000).cast("long").alias("during_time"),
    )


def envelope(table: str, type_: Column | str, ts: Column, data: dict[str, Column],
             old: dict[str, Column] | None = None, database: str = "shop") -> list[Column]:
    """Columns of a change envelope (database, table, type, ts, data, old)."""
    def as_map(cols: dict[str, Column] | None) -> Column:
        if cols is None:
            return F.lit(None).cast("map<string,string>")
        parts: list[Column] = []
        for k, v in cols.items():
            parts += [F.lit(k), v.cast("string")]
        return F.create_map(*parts)

    return [
        F.lit(database).alias("database"),
        F.lit(table).alias("table"),
        (F.lit(type_) if isinstance(type_, str) else type_).alias("type"),
        ts.cast("string").alias("ts"),
        as_map(data).alias("data"),
        as_map(old).alias("old"),
    ]


def table_envelopes(df: DataFrame, table: str, ts: Column) -> DataFrame:
    """Every row of ``df`` as an ``insert`` envelope whose payload holds all
    columns (a snapshot read of the table)."""
    data = {c: F.col(c) for c in df.columns}
    return df.select(*envelope(table, "insert", ts, data))
