"""Change-data-capture apply: latest row per key, deletes removed.

All of it is ``max_by(payload, struct(order...))`` per key: a partial
aggregate, so even a key holding a third of all changes is reduced on the map
side before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   first: bool = False) -> DataFrame:
    """The row with the greatest ``order`` per key, or with ``first`` the least
    (``order`` should end in a unique tiebreaker so the winner is defined)."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by if first else F.max_by
    best = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_latest"))
    return best.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in rest]).select(*df.columns)


def apply_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str],
                  is_delete: Column) -> DataFrame:
    """Current state of a keyed table from its change log: the latest change
    per key, dropped when that change is a delete."""
    tagged = changes.withColumn("_is_delete", is_delete)
    return latest_per_key(tagged, keys, order).where(~F.col("_is_delete")).drop("_is_delete")


def record_actions(records: DataFrame, key: str) -> DataFrame:
    """What change records (``op``, ``before`` and ``after`` structs, log position
    ``pos``) do to a table keyed by ``key``: the last (``pos``, ``rank``, ``row``) per key,
    ``row`` NULL for a removal.

    A snapshot's rows have ``op`` 'r' and the log position at which their read began.
    Whatever the log says of their key from there on may be in them already or not;
    it is applied after them (``rank``), so a snapshot row never beats a change read
    meanwhile, and changes from before the position lose to it. An update removes the
    ``before`` key first, so a changed key leaves nothing behind."""
    row_type = records.schema["after"].dataType

    def act(row: str, rank: int, put: bool) -> Column:
        return F.struct(F.col(f"{row}.{key}").alias(key), F.lit(rank).alias("rank"),
                        (F.col(row) if put else F.lit(None).cast(row_type)).alias("row"))

    read, drop, put = act("after", 0, True), act("before", 1, False), act("after", 2, True)
    actions = F.when(F.col("op") == "r", F.array(read)).when(F.col("op") == "d", F.array(drop)).when(
        F.col("op") == "u", F.array(drop, put)).otherwise(F.array(put))
    each = records.select("pos", F.explode(actions).alias("a")).select("pos", "a.*")
    return latest_per_key(each.where(F.col(key).isNotNull()), [key], ["pos", "rank"])


def apply_records(records: DataFrame, key: str) -> DataFrame:
    """The table that a snapshot and the log give, in whatever order they came."""
    return record_actions(records, key).where(F.col("row").isNotNull()).select("row.*")


def config_state(cdc: DataFrame, live_type: str | None = "dim") -> DataFrame:
    """Current routing config from its change log (``op, before, after, ts_ms, seq``).

    ``r``/``c`` put ``after``; ``d`` removes ``before``; ``u`` removes the
    ``before`` key and puts ``after``, so a renamed ``source_table`` or a move
    from ``dim`` to another type leaves nothing behind. Only rows whose
    ``sink_type`` is ``live_type`` are kept.

    With ``live_type=None`` the latest *action* per key is returned instead
    (``source_table, ts_ms, seq, rank, row``; ``row`` NULL for a removal), for
    applying a batch of changes to a stored config table.
    """
    put = F.struct(F.col("after.source_table").alias("key"), F.lit(1).alias("rank"),
                   F.col("after").alias("row"))
    remove = F.struct(F.col("before.source_table").alias("key"), F.lit(0).alias("rank"),
                      F.lit(None).cast(cdc.schema["after"].dataType).alias("row"))
    actions = F.when(F.col("op") == "d", F.array(remove)) \
               .when(F.col("op") == "u", F.array(remove, put)) \
               .otherwise(F.array(put))
    exploded = cdc.select("ts_ms", "seq", F.explode(actions).alias("a")).select(
        F.col("a.key").alias("source_table"), "ts_ms", "seq",
        F.col("a.rank").alias("rank"), F.col("a.row").alias("row"))
    latest = latest_per_key(exploded.where(F.col("source_table").isNotNull()),
                            ["source_table"], ["ts_ms", "seq", "rank"])
    if live_type is None:
        return latest
    return (latest.where(F.col("row").isNotNull() & (F.col("row.sink_type") == live_type))
                  .select("row.*"))
