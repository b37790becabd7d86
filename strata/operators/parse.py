"""ODS → DWD parsing: JSON envelopes, dirty-record split, control filter, CSV."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.functions import json as jsonf
from strata.functions.text import parse_fields

# Control records the snapshot tool writes around a bootstrap.
CONTROL_TYPES = ("bootstrap-start", "bootstrap-complete")


def flag_dirty(raw: DataFrame, value: str = "value") -> DataFrame:
    """Add ``is_dirty``: the value is not a JSON object. NULL messages are
    dropped (there is nothing to keep), empty text is dirty."""
    return (raw.where(F.col(value).isNotNull())
               .withColumn("is_dirty", ~jsonf.is_json_object(F.col(value))))


def split_dirty(raw: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(clean, dirty): the main output and the side output with the original
    text. Write both from one ``foreachBatch`` over a persisted frame so the
    input is read once (``strata.sinks.side_output``)."""
    flagged = flag_dirty(raw, value)
    return (flagged.where(~F.col("is_dirty")).drop("is_dirty"),
            flagged.where(F.col("is_dirty")).drop("is_dirty"))


def parse_envelopes(raw: DataFrame, value: str = "value", strict: bool = False) -> DataFrame:
    """Raw text → typed change envelopes (``database, table, type, ts, data, old``).

    One parse per record. Records that do not parse, or parse without a
    ``table`` (nothing can be routed without it), are skipped; ``strict``
    fails the job on malformed text instead. Send raw text through
    ``split_dirty`` first to keep the rejects.
    """
    parsed = raw.select(jsonf.parse(F.col(value), schemas.ENVELOPE, strict).alias("e"))
    return parsed.where(F.col("e.table").isNotNull()).select("e.*")


def drop_control_records(envelopes: DataFrame, type_col: str = "type") -> DataFrame:
    """Drop bootstrap start/complete markers; keep everything else, NULL
    types included (a bare ``NOT IN`` would drop those)."""
    return envelopes.where(~F.coalesce(F.col(type_col), F.lit("")).isin(*CONTROL_TYPES))


def parse_delimited(lines: DataFrame, fields: Sequence[tuple[str, str]], value: str = "value",
                    sep: str = ",", strict: bool = True) -> DataFrame:
    """One typed row per delimited line (the socket/text demo sources)."""
    return lines.select(*parse_fields(F.col(value), fields, sep, strict))


def parse_page_log(raw: DataFrame, value: str = "value") -> DataFrame:
    """Page-log JSON (``common``, ``page``, ``ts`` in epoch ms) → the columns
    the traffic operators use: ``mid, vc, ch, ar, is_new_flag, last_page_id,
    during_time, ts`` (event time as TIMESTAMP_NTZ at UTC) plus ``log_ms`` and
    ``log_id`` (the record's id, or a hash of it) as tiebreakers. Records
    without a device id are skipped; ``split_dirty`` keeps malformed ones."""
    log = raw.select(jsonf.parse(F.col(value), schemas.PAGE_LOG).alias("p"),
                     F.xxhash64(F.col(value)).alias("h"))
    micros = F.col("p.ts") * 1000 + F.coalesce("p.us", F.lit(0))
    return log.where(F.col("p.common.mid").isNotNull()).select(
        F.col("p.common.mid").alias("mid"), F.col("p.common.vc").alias("vc"),
        F.col("p.common.ch").alias("ch"), F.col("p.common.ar").alias("ar"),
        F.col("p.common.is_new").alias("is_new_flag"),
        F.col("p.page.last_page_id").alias("last_page_id"),
        F.col("p.page.during_time").alias("during_time"),
        F.timestamp_micros(micros).cast("timestamp_ntz").alias("ts"),
        F.col("p.ts").alias("log_ms"), F.coalesce("p.id", "h").alias("log_id"))
