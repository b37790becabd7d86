"""Traffic and trade aggregates of the DWS layer (batch form).

The streaming forms (``strata.streaming.stateful`` for the keyed state,
``strata.streaming.jobs`` for the windows) reuse these measure definitions;
only state handling differs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.sequence import with_previous, with_running_max

STAMP = "yyyy-MM-dd HH:mm:ss"


def _interval(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")


def page_view_flags(df: DataFrame, mid: str = "mid", ts: str = "ts",
                    tiebreak: str = "event_id", session_gap: str = "30 MINUTES",
                    last_page: str | None = None, chunks: int | None = None) -> DataFrame:
    """Per page view: ``is_new`` ('1' on the device's first view ever),
    ``uv`` (1 on its first view of the day) and ``sv`` (1 when a session starts).

    A session starts when the log carries no previous page (``last_page`` NULL)
    or, for logs without that field, after more than ``session_gap`` of silence.
    The previous view per device comes from the skew-safe ``with_previous``.
    """
    flagged = with_previous(df, [mid], [ts, tiebreak], [ts], prefix="_prev_", chunks=chunks)
    prev = F.col(f"_prev_{ts}")
    first = prev.isNull()
    if last_page is not None:
        session_start = F.col(last_page).isNull()
    else:
        session_start = first | (F.col(ts) > prev + _interval(session_gap))
    return flagged.withColumns({
        "is_new": F.when(first, F.lit("1")).otherwise(F.lit("0")),
        "uv": (first | (F.to_date(prev) != F.to_date(F.col(ts)))).cast("long"),
        "sv": session_start.cast("long"),
    }).drop(f"_prev_{ts}")


def window_bounds(w: str = "w") -> tuple[Column, Column, Column]:
    """``stt``/``edt`` strings and the epoch-millisecond version stamp ``ts``
    (window end) of a window struct column."""
    return (F.date_format(F.col(f"{w}.start"), STAMP).alias("stt"),
            F.date_format(F.col(f"{w}.end"), STAMP).alias("edt"),
            F.unix_millis(F.col(f"{w}.end").cast("timestamp")).alias("ts"))


def traffic_window(flagged: DataFrame, size: str = "10 seconds",
                   dims: Sequence[str] = ("vc", "ch", "ar", "is_new"),
                   ts: str = "ts", dur: str = "during_time") -> DataFrame:
    """Tumbling event-time window of pv/uv/sv/duration per dimension tuple.

    Output follows the traffic result: ``stt, edt, <dims>, uv_ct, sv_ct, pv_ct,
    dur_sum, ts``. Every measure is a partial (map-side) sum.
    """
    agg = flagged.groupBy(F.window(F.col(ts), size).alias("w"), *dims).agg(
        F.sum("uv").cast("long").alias("uv_ct"),
        F.sum("sv").cast("long").alias("sv_ct"),
        F.count(F.lit(1)).alias("pv_ct"),
        F.sum(dur).cast("long").alias("dur_sum"),
    )
    stt, edt, stamp = window_bounds()
    return agg.select(stt, edt, *dims, "uv_ct", "sv_ct", "pv_ct", "dur_sum", stamp)


def uv_first_visit(df: DataFrame, mid: str = "mid", ts: str = "ts",
                   tiebreak: str = "event_id", carry: Sequence[str] = ()) -> DataFrame:
    """First view per device and calendar day.

    ``min(struct(ts, tiebreak, ...))`` is a partial aggregate, so a hot device
    is reduced on the map side instead of landing whole in one task.
    """
    first = df.groupBy(F.col(mid), F.to_date(F.col(ts)).alias("dt")).agg(
        F.min(F.struct(F.col(ts), F.col(tiebreak), *[F.col(c) for c in carry])).alias("f"))
    return first.select(
        mid, F.date_format("dt", "yyyy-MM-dd").alias("dt"),
        F.col(f"f.{ts}").alias(ts), F.col(f"f.{tiebreak}").alias(tiebreak),
        *[F.col(f"f.{c}").alias(c) for c in carry])


def sku_order_window(lines: DataFrame, ts: str, sku: str, amount: Column,
                     size: str = "7 days") -> DataFrame:
    """Order amount (exact DECIMAL sum, returned as DOUBLE) and line count per
    SKU and tumbling window. Windows start at the Unix epoch."""
    agg = lines.groupBy(F.window(F.col(ts), size).alias("w"), F.col(sku).alias("sku_id")).agg(
        F.sum(amount).cast("double").alias("order_amount"),
        F.count(F.lit(1)).alias("order_ct"))
    stt, edt, stamp = window_bounds()
    return agg.select(stt, edt, "sku_id", "order_amount", "order_ct", stamp)


def late_rows(df: DataFrame, arrival: Sequence[str], ts: str = "ts",
              lateness: str = "6 HOURS", chunks: int | None = None) -> DataFrame:
    """Rows whose event time is more than ``lateness`` behind the largest event
    time seen so far in arrival order: the rows a watermark of that delay drops.
    Returns the input columns plus ``max_seen``."""
    seen = with_running_max(df, arrival, ts, out="max_seen", chunks=chunks)
    return seen.where(F.col(ts) < F.col("max_seen") - _interval(lateness))


def sessions(views: DataFrame, gap: str = "30 minutes", mid: str = "mid", ts: str = "ts",
             dur: str = "during_time") -> DataFrame:
    """Sessions per device: views less than ``gap`` apart merge (``session_window``).
    ``edt`` is the last view's time plus the gap. Batch, or a watermarked stream."""
    agg = views.groupBy(F.session_window(F.col(ts), gap).alias("w"), F.col(mid).alias("mid")).agg(
        F.count(F.lit(1)).alias("pv_ct"), F.sum(dur).cast("long").alias("dur_sum"))
    return agg.select("mid", F.col("w.start").cast("timestamp_ntz").alias("stt"),
                      F.col("w.end").cast("timestamp_ntz").alias("edt"), "pv_ct", "dur_sum")
