"""Main output and side output of one micro-batch, from a single read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.parse import flag_dirty


def dirty_split_writer(clean_path: str, dirty_path: str, value: str = "value",
                       dirty_columns: tuple[str, ...] = ()):
    """``foreachBatch`` function: flag each record once (persisted), then write
    the JSON objects to ``clean_path`` and the original text of everything else
    (plus any ``dirty_columns``, e.g. a record id) to ``dirty_path``. Output
    folders are per batch id, so a replayed batch overwrites its own files
    instead of duplicating them."""
    def write(batch: DataFrame, batch_id: int) -> None:
        flagged = flag_dirty(batch, value).persist()
        try:
            (flagged.where(~F.col("is_dirty")).drop("is_dirty")
                    .write.mode("overwrite").parquet(f"{clean_path}/batch={batch_id}"))
            (flagged.where(F.col("is_dirty")).select(*dirty_columns, value)
                    .write.mode("overwrite").parquet(f"{dirty_path}/batch={batch_id}"))
        finally:
            flagged.unpersist()
    return write
