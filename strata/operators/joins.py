"""Event-time interval join and keyed equi-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.sizing import broadcast_if_small


def _micros(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_ts: str, right_ts: str, lower_s: float, upper_s: float) -> DataFrame:
    """Inner join where ``right_ts`` lies in ``[left_ts + lower, left_ts + upper]``
    (both bounds inclusive) and the keys are equal.

    The equi-key is widened with a time bucket of width ``upper - lower``: a left
    row is copied to the (at most two) buckets its range touches, a right row
    sits in one bucket, so every pair meets exactly once and a hot key is spread
    over its time buckets instead of one task.
    """
    width = max(int(round((upper_s - lower_s) * 1_000_000)), 1)
    lo = int(round(lower_s * 1_000_000))
    hi = int(round(upper_s * 1_000_000))
    lt = _micros(left_ts)
    rt = _micros(right_ts)
    lb = left.withColumn("_ij_b", F.explode(F.sequence(
        F.floor((lt + F.lit(lo)) / F.lit(width)), F.floor((lt + F.lit(hi)) / F.lit(width)))))
    rb = right.withColumn("_ij_rb", F.floor(rt / F.lit(width)))
    # The range is stated on the event-time columns themselves, so a streaming
    # join can derive its state-eviction bounds from the watermarks.
    cond = ((F.col(left_key) == F.col(right_key)) & (F.col("_ij_b") == F.col("_ij_rb"))
            & (F.col(right_ts) >= F.col(left_ts) + F.make_dt_interval(secs=F.lit(lower_s)))
            & (F.col(right_ts) <= F.col(left_ts) + F.make_dt_interval(secs=F.lit(upper_s))))
    return lb.join(rb, cond, "inner").drop("_ij_b", "_ij_rb")


def outer_interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_ts: str,
                        right_ts: str, lower_s: float, upper_s: float, how: str = "full") -> DataFrame:
    """The same range as an outer join: rows without a partner are padded with nulls.
    The key is not widened (a left row copied to two buckets would be padded twice).
    On streams, watermarks on both sides bound the state and time the padding."""
    # Interval literals: only from these does Spark derive the state's bounds.
    low, high = (F.col(left_ts) + F.expr(f"INTERVAL '{s:.6f}' SECOND") for s in (lower_s, upper_s))
    return left.join(right, (F.col(left_key) == F.col(right_key)) & (F.col(right_ts) >= low)
                     & (F.col(right_ts) <= high), how)


def keyed_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
               how: str = "inner", broadcast_max_rows: int | None = None) -> DataFrame:
    """Equi-join of two streams' tables on one key (inner, left, right, full).

    A side that the join type allows to be broadcast (right for inner/left,
    left for right) is broadcast only after its row count is checked against
    ``broadcast_max_rows``; otherwise the planner shuffles both sides and AQE
    splits skewed partitions at run time.
    """
    if broadcast_max_rows is not None:
        if how in ("inner", "left"):
            right = broadcast_if_small(right, broadcast_max_rows)
        elif how == "right":
            left = broadcast_if_small(left, broadcast_max_rows)
    columns = [*left.columns, *right.columns]
    same = F.col(left_key) == F.col(right_key)
    if how == "inner" or len({c.lower() for c in columns}) < len(columns):
        return left.join(right, same, how)
    # Rows with a NULL key match nothing. Joined, they would all hash to one task;
    # the outer side's are padded and added instead.
    out = left.where(F.col(left_key).isNotNull()).join(
        right.where(F.col(right_key).isNotNull()), same, how).select(*columns)
    if how in ("left", "full"):
        out = out.unionByName(left.where(F.col(left_key).isNull()).select(
            "*", *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right.columns]))
    if how in ("right", "full"):
        out = out.unionByName(right.where(F.col(right_key).isNull()).select(
            "*", *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns]))
    return out
