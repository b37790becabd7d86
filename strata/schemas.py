"""Schemas of the records the warehouse jobs exchange (DDL strings)."""

from __future__ import annotations

from pyspark.sql.types import StructType


def names(ddl: str) -> list[str]:
    """Column names of a DDL string."""
    return StructType.fromDDL(ddl).names

# change envelope of a business table (one per row change).
ENVELOPE = ("database STRING, `table` STRING, type STRING, ts STRING, "
            "data MAP<STRING,STRING>, old MAP<STRING,STRING>")

# one row of the routing config table.
CONFIG_ROW = ("source_table STRING, source_type STRING, sink_table STRING, "
              "sink_type STRING, sink_columns STRING, sink_pk STRING, sink_extend STRING")

# change record of the config table; ts_ms and seq order the log.
CONFIG_CDC = f"op STRING, before STRUCT<{CONFIG_ROW}>, after STRUCT<{CONFIG_ROW}>, ts_ms BIGINT, seq BIGINT"

# cart-add fact (output of the cart job), every column a string.
CART_FACT = ("id STRING, user_id STRING, sku_id STRING, sku_num STRING, ts STRING, "
             "source_type STRING, source_type_name STRING")

# F8: page log; only common.mid is fixed by the source jobs, the rest is our convention:
# ts in milliseconds, us the microseconds within it, id a tiebreaker (both optional).
PAGE_LOG = ("common STRUCT<mid STRING, vc STRING, ch STRING, ar STRING, is_new STRING>, "
            "page STRUCT<last_page_id STRING, during_time BIGINT>, ts BIGINT, us INT, id BIGINT")
