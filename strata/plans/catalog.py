"""Registered queries: each derives its input from the driver tables, runs the
library operators and returns a DataFrame; ``ORACLE`` holds the equivalent
DuckDB SQL over the same tables (omitted where SQL cannot express it)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import traffic
from strata.plans import derive
from strata.session import configure, load_table, scratch_path, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run
    return wrap


# --------------------------------------------------------------------------
# DWS traffic window
# --------------------------------------------------------------------------

_FLAGS_SQL = """
WITH e AS (
  SELECT event_id, ts, user_id AS mid,
         'v' || CAST(user_id % 3 AS VARCHAR) AS vc, event_type AS ch,
         'ar' || CAST(user_id % 5 AS VARCHAR) AS ar,
         CAST(round(value * 1000) AS BIGINT) AS during_time,
         lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts
  FROM events
), f AS (
  SELECT *,
         CASE WHEN prev_ts IS NULL THEN '1' ELSE '0' END AS is_new,
         CASE WHEN prev_ts IS NULL OR CAST(prev_ts AS DATE) <> CAST(ts AS DATE) THEN 1 ELSE 0 END AS uv,
         CASE WHEN prev_ts IS NULL OR ts > prev_ts + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS sv
  FROM e
)
"""


@register("traffic_window", _FLAGS_SQL + """
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS stt,
       strftime(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS edt,
       vc, ch, ar, is_new,
       CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(sv) AS BIGINT) AS sv_ct,
       CAST(count(*) AS BIGINT) AS pv_ct, CAST(sum(during_time) AS BIGINT) AS dur_sum,
       epoch_ms(time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR) AS ts
FROM f
GROUP BY ALL
""")
def traffic_window_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1 h tumbling traffic window over the page log derived from ``events``."""
    log = derive.page_log(load_table(spark, sf_dir, "events"))
    flagged = traffic.page_view_flags(log, mid="mid", ts="ts", tiebreak="event_id")
    return traffic.traffic_window(flagged, size="1 hour")


# --------------------------------------------------------------------------
# Sources and parsing (ODS → DWD)
# --------------------------------------------------------------------------

@register("src_events", """
SELECT 'topic_log' AS topic, CAST(user_id AS VARCHAR) AS key, props AS value,
       event_id AS "offset", ts AS "timestamp"
FROM events
""")
def src_events_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw log records (binary value decoded to text, as a string
    source does), with the record's key, offset and timestamp."""
    from strata.sources.files import as_log_records
    records = as_log_records(load_table(spark, sf_dir, "events"), topic="topic_log",
                             key=F.col("user_id"), value=F.col("props"),
                             offset=F.col("event_id"), timestamp=F.col("ts"))
    return records.select("topic", F.col("key").cast("string").alias("key"),
                          F.col("value").cast("string").alias("value"), "offset", "timestamp")


@register("json_parse", """
SELECT event_id, CAST(user_id AS VARCHAR) AS mid, event_type AS ch,
       CAST(round(value * 1000) AS BIGINT) AS during_time, epoch_us(ts) // 1000 AS ts_ms,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k
FROM events
""")
def json_parse_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page-log JSON built from ``events``, parsed back with a declared schema;
    nested paths (``common.mid``) and the ``props`` payload read as typed values."""
    from strata import schemas
    from strata.functions import json as jsonf
    ev = spread(load_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value",
                                                           "ts", "props"))
    raw = ev.select("event_id", "props", F.to_json(F.struct(
        F.struct(F.col("user_id").cast("string").alias("mid"),
                 F.col("event_type").alias("ch")).alias("common"),
        F.struct(F.round(F.col("value") * 1000).cast("long").alias("during_time")).alias("page"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"))).alias("value"))
    log = raw.select("event_id", jsonf.parse(F.col("value"), schemas.PAGE_LOG).alias("p"),
                     jsonf.parse(F.col("props"), "k INT").alias("props"))
    return log.select("event_id", F.col("p.common.mid").alias("mid"),
                      F.col("p.common.ch").alias("ch"),
                      F.col("p.page.during_time").alias("during_time"),
                      F.col("p.ts").alias("ts_ms"), F.col("props.k").alias("k"))


_DIRTY_VALUE = """CASE event_id % 7 WHEN 0 THEN substr(props, 1, length(props) - 1)
                    WHEN 1 THEN '[1]' WHEN 2 THEN '' WHEN 3 THEN '{}' ELSE props END"""


@register("dirty_split", f"""
SELECT event_id, value,
       NOT (CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' ELSE false END) AS is_dirty
FROM (SELECT event_id, {_DIRTY_VALUE} AS value FROM events)
""")
def dirty_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log with truncated, non-object and empty records mixed in; every
    record labelled clean or dirty (the side-output split)."""
    from strata.operators.parse import flag_dirty
    ev = spread(load_table(spark, sf_dir, "events").select("event_id", "props"))
    raw = ev.select("event_id", F.expr(_DIRTY_VALUE).alias("value"))
    return flag_dirty(raw, "value")


_ENVELOPE_TYPE = """CASE event_type WHEN 'view' THEN 'insert' WHEN 'click' THEN 'update'
     WHEN 'purchase' THEN 'delete'
     WHEN 'signup' THEN (CASE event_id % 3 WHEN 0 THEN 'bootstrap-start'
                                           WHEN 1 THEN 'bootstrap-insert'
                                           ELSE 'bootstrap-complete' END)
     ELSE NULL END"""


@register("control_filter", f"""
SELECT event_id, type FROM (SELECT event_id, {_ENVELOPE_TYPE} AS type FROM events)
WHERE coalesce(type, '') NOT IN ('bootstrap-start', 'bootstrap-complete')
""")
def control_filter_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change envelopes with bootstrap markers and NULL types; markers drop,
    NULL types stay."""
    from strata.operators.parse import drop_control_records
    ev = load_table(spark, sf_dir, "events")
    env = ev.select("event_id", F.expr(_ENVELOPE_TYPE).alias("type"))
    return drop_control_records(env)


@register("csv_parse", """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
""")
def csv_parse_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``supplier`` written as comma lines (with a trailing separator) and read
    back with a strict typed parse."""
    from strata.operators.parse import parse_delimited
    sup = load_table(spark, sf_dir, "supplier")
    lines = sup.select(F.concat(F.concat_ws(",", "s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
                                F.lit(",")).alias("value"))
    return parse_delimited(lines, [("s_suppkey", "bigint"), ("s_name", "string"),
                                   ("s_nationkey", "int"), ("s_acctbal", "double")])


@register("date_functions", """
SELECT o_orderkey,
       epoch_ms(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) - 28800000 AS ts_ms,
       strftime(o_orderdate, '%Y-%m-%d') AS dt,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS dt_full,
       strftime(o_orderdate - INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS dt_utc
FROM orders
""")
def date_functions_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as ``yyyy-MM-dd`` text at +08:00 → epoch ms → formatted back
    at +08:00 (round trip) and at UTC."""
    from strata.functions import dates
    o = load_table(spark, sf_dir, "orders")
    ms = o.select("o_orderkey", dates.to_ts(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("ts_ms"))
    return ms.select("o_orderkey", "ts_ms", dates.to_date(F.col("ts_ms")).alias("dt"),
                     dates.to_ymd_hms(F.col("ts_ms")).alias("dt_full"),
                     dates.to_ymd_hms(F.col("ts_ms"), "+00:00").alias("dt_utc"))


@register("change_envelope", """
SELECT 'orders' AS table_name,
       CASE o_orderstatus WHEN 'F' THEN 'update' WHEN 'O' THEN 'insert' ELSE 'delete' END AS type,
       CAST(CAST(epoch(o_orderdate) AS BIGINT) AS VARCHAR) AS ts,
       o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CASE WHEN o_orderstatus = 'F' THEN 'O' END AS old_status
FROM orders
""")
def change_envelope_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` serialised as JSON change envelopes and parsed back through the
    envelope schema (map payloads read by key)."""
    from strata.operators.parse import parse_envelopes
    from strata.plans.derive import envelope
    o = spread(load_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"))
    typ = (F.when(F.col("o_orderstatus") == "F", "update")
            .when(F.col("o_orderstatus") == "O", "insert").otherwise("delete"))
    cols = envelope("orders", typ, F.unix_seconds(F.col("o_orderdate").cast("timestamp")),
                    {c: F.col(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")},
                    old=None)
    env = o.select(*cols[:5], F.when(F.col("o_orderstatus") == "F",
                                     F.create_map(F.lit("o_orderstatus"), F.lit("O"))).alias("old"))
    raw = env.select(F.to_json(F.struct(*env.columns)).alias("value"))
    e = parse_envelopes(raw)
    return e.select(F.col("table").alias("table_name"), "type", "ts",
                    F.col("data")["o_orderkey"].cast("bigint").alias("o_orderkey"),
                    F.col("data")["o_custkey"].cast("bigint").alias("o_custkey"),
                    F.col("data")["o_orderstatus"].alias("o_orderstatus"),
                    F.col("data")["o_totalprice"].cast("double").alias("o_totalprice"),
                    F.col("old")["o_orderstatus"].alias("old_status"))


# --------------------------------------------------------------------------
# CDC apply, config state, dimension routing and upserts (DIM)
# --------------------------------------------------------------------------

@register("cdc_apply", """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1 AND event_type <> 'error'
""")
def cdc_apply_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as the change log of a table keyed by ``user_id`` (``error``
    rows are deletes): the surviving current rows."""
    from strata.operators.cdc import apply_changes
    ev = load_table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return apply_changes(ev, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")


_CONFIG_LOG_SQL = """
WITH c AS (
  SELECT event_id AS seq, epoch_us(ts) // 1000 AS ts_ms, event_type,
         'tbl_' || CAST(user_id AS VARCHAR) AS k,
         CASE event_type WHEN 'view' THEN 'r' WHEN 'click' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         CASE WHEN event_type = 'purchase' THEN 'tbl_' || CAST(user_id AS VARCHAR) || '_r'
              ELSE 'tbl_' || CAST(user_id AS VARCHAR) END AS after_key,
         CASE WHEN value < 50 THEN 'dim' ELSE 'dwd' END AS sink_type,
         CASE event_id % 3 WHEN 0 THEN 'id,' || event_type || ',k,'
                           WHEN 1 THEN 'id, k' ELSE 'id,k' END AS sink_columns,
         CASE WHEN event_id % 2 = 0 THEN NULL ELSE 'k' END AS sink_pk,
         CASE WHEN event_id % 5 = 0 THEN 'SALT_BUCKETS = 4' END AS sink_extend
  FROM events
), actions AS (
  SELECT k AS source_table, ts_ms, seq, 0 AS rnk, NULL AS source_type, NULL AS sink_table,
         NULL AS sink_type, NULL AS sink_columns, NULL AS sink_pk, NULL AS sink_extend
  FROM c WHERE op IN ('u', 'd')
  UNION ALL
  SELECT after_key, ts_ms, seq, 1, event_type, 'dim_' || after_key, sink_type, sink_columns,
         sink_pk, sink_extend
  FROM c WHERE op <> 'd'
), config AS (
  SELECT source_table, source_type, sink_table, sink_type, sink_columns, sink_pk, sink_extend
  FROM (SELECT *, row_number() OVER (PARTITION BY source_table
                                     ORDER BY ts_ms DESC, seq DESC, rnk DESC) AS rn
        FROM actions)
  WHERE rn = 1 AND rnk = 1 AND sink_type = 'dim'
)
"""


def _config_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The routing config's change log, derived from ``events``: one change per
    event on table ``tbl_<user>`` (r/c/u/d by event type; purchases rename the
    table), with dim/dwd types, odd column lists and missing keys mixed in."""
    ev = load_table(spark, sf_dir, "events")
    k = F.concat(F.lit("tbl_"), F.col("user_id").cast("string"))
    op = (F.when(F.col("event_type") == "view", "r").when(F.col("event_type") == "click", "c")
           .when(F.col("event_type") == "error", "d").otherwise("u"))
    after_key = F.when(F.col("event_type") == "purchase", F.concat(k, F.lit("_r"))).otherwise(k)
    cols = (F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("id,"), F.col("event_type"), F.lit(",k,")))
             .when(F.col("event_id") % 3 == 1, F.lit("id, k")).otherwise(F.lit("id,k")))
    after = F.struct(
        after_key.alias("source_table"), F.col("event_type").alias("source_type"),
        F.concat(F.lit("dim_"), after_key).alias("sink_table"),
        F.when(F.col("value") < 50, "dim").otherwise("dwd").alias("sink_type"),
        cols.alias("sink_columns"),
        F.when(F.col("event_id") % 2 == 0, F.lit(None)).otherwise(F.lit("k")).alias("sink_pk"),
        F.when(F.col("event_id") % 5 == 0, F.lit("SALT_BUCKETS = 4")).alias("sink_extend"))
    before = F.struct(k.alias("source_table"), F.lit(None).cast("string").alias("source_type"),
                      F.lit(None).cast("string").alias("sink_table"), F.lit("dim").alias("sink_type"),
                      F.lit(None).cast("string").alias("sink_columns"),
                      F.lit(None).cast("string").alias("sink_pk"),
                      F.lit(None).cast("string").alias("sink_extend"))
    return ev.select(
        op.alias("op"),
        F.when(op.isin("u", "d"), before).alias("before"),
        F.when(op != "d", after).alias("after"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        F.col("event_id").alias("seq"))


@register("config_preload", _CONFIG_LOG_SQL + """
SELECT * FROM config
""")
def config_preload_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live dimension config (``sink_type = 'dim'``) from the config change log:
    the table loaded before routing starts."""
    from strata.operators.cdc import config_state
    return config_state(_config_log(spark, sf_dir))


@register("dim_schema", _CONFIG_LOG_SQL + """
SELECT sink_table, CAST(i - 1 AS INTEGER) AS ordinal, cols[i] AS column_name,
       cols[i] = coalesce(sink_pk, 'id') AS is_pk, coalesce(sink_extend, '') AS sink_extend
FROM (SELECT *, string_split(rtrim(sink_columns, ','), ',') AS cols FROM config) AS t,
     LATERAL (SELECT unnest(range(1, len(t.cols) + 1)) AS i)
""")
def dim_schema_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension table schemas (column, position, key flag) from the live config."""
    from strata.operators.cdc import config_state
    from strata.operators.dim import table_columns
    return table_columns(config_state(_config_log(spark, sf_dir)))


_ROUTE_CONFIG_LOG = [
    # op, source_table, sink_table, sink_type, sink_columns, sink_pk, seq
    ("r", "nation", "dim_nation", "dim", "n_nationkey,n_name,n_regionkey", "n_nationkey", 1),
    ("r", "region", "dim_region", "dim", "r_regionkey,r_name", None, 2),
    ("r", "supplier", "dim_supplier", "dim", "s_suppkey,s_name, s_nationkey", "s_suppkey", 3),
    ("r", "customer", "dwd_customer", "dwd", "c_custkey,c_name", "c_custkey", 4),
    ("c", "orders", "dim_orders", "dim", "o_orderkey", "o_orderkey", 5),
    ("d", "orders", "dim_orders", "dim", "o_orderkey", "o_orderkey", 6),
]


def _route_config(spark: SparkSession) -> DataFrame:
    """Config change log for routing the driver tables; applied to its state."""
    from strata import schemas
    from strata.operators.cdc import config_state
    rows = []
    for op, src, sink, typ, cols, pk, seq in _ROUTE_CONFIG_LOG:
        row = (src, None, sink, typ, cols, pk, None)
        rows.append((op, row if op in ("u", "d") else None, row if op != "d" else None, seq, seq))
    return config_state(spark.createDataFrame(rows, schemas.CONFIG_CDC))


def _table_envelopes(spark: SparkSession, sf_dir: str, tables: list[str]) -> DataFrame:
    from functools import reduce
    frames = []
    for t in tables:
        df = load_table(spark, sf_dir, t)
        frames.append(derive.table_envelopes(df, t, F.lit(0)))
    return reduce(DataFrame.unionByName, frames)


@register("dim_route", """
WITH routed AS (
  SELECT 'dim_nation' AS sink_table, 'n_nationkey' AS sink_pk, CAST(n_nationkey AS VARCHAR) AS pk_value,
         CAST(n_nationkey AS VARCHAR) AS a, n_name AS b, CAST(n_regionkey AS VARCHAR) AS c FROM nation
)
SELECT sink_table, sink_pk, 'insert' AS type, pk_value, 'n_nationkey' AS column_name, a AS column_value FROM routed
UNION ALL SELECT sink_table, sink_pk, 'insert', pk_value, 'n_name', b FROM routed
UNION ALL SELECT sink_table, sink_pk, 'insert', pk_value, 'n_regionkey', c FROM routed
UNION ALL SELECT 'dim_region', 'id', 'insert', NULL, 'r_regionkey', CAST(r_regionkey AS VARCHAR) FROM region
UNION ALL SELECT 'dim_region', 'id', 'insert', NULL, 'r_name', r_name FROM region
UNION ALL SELECT 'dim_supplier', 's_suppkey', 'insert', CAST(s_suppkey AS VARCHAR), 's_suppkey',
                 CAST(s_suppkey AS VARCHAR) FROM supplier
UNION ALL SELECT 'dim_supplier', 's_suppkey', 'insert', CAST(s_suppkey AS VARCHAR), 's_name', s_name FROM supplier
""")
def dim_route_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert envelopes of nation, region, supplier, customer and orders routed
    by the live config: customer is not a dimension and orders was deleted from
    the config, so both drop; payloads are pruned to the configured columns
    (``" s_nationkey"`` with its space matches nothing). Shown one row per kept
    column."""
    from strata.operators.dim import route
    env = _table_envelopes(spark, sf_dir, ["nation", "region", "supplier", "customer", "orders"])
    routed = route(env, _route_config(spark))
    return routed.select("sink_table", "sink_pk", "type", "pk_value",
                         F.explode("data").alias("column_name", "column_value"))


@register("upsert_latest", """
SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1
""")
def upsert_latest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order upserted under key ``o_custkey`` in two batches, the newer orders
    first; the log then gives the latest row per key."""
    from strata.sinks.batch_log import BatchLog
    o = load_table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    order = ["o_orderdate", "o_orderkey"]
    table = BatchLog(spark, scratch_path(spark, "upsert"), ["o_custkey"], order)
    newest = F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")
    table.append(o.where(newest), 0)
    table.append(o.where(~newest), 1)
    return table.read()


@register("dim_upsert", """
SELECT 'dim_customer_order' AS sink_table, CAST(o_custkey AS VARCHAR) AS pk_value,
       CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders)
WHERE rn = 1 AND o_orderstatus <> 'P'
""")
def dim_upsert_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order changes routed to a customer-keyed dimension and upserted; status
    ``P`` arrives as a delete. The result is the dimension table's final state."""
    from strata import schemas
    from strata.operators.cdc import config_state
    from strata.operators.dim import route
    from strata.sinks.batch_log import BatchLog
    o = spread(load_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"))
    typ = F.when(F.col("o_orderstatus") == "P", "delete").otherwise("update")
    cols = derive.envelope("customer_order", typ, F.unix_seconds(F.col("o_orderdate").cast("timestamp")),
                           {c: F.col(c) for c in ("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")})
    env = o.select(*cols, F.col("o_orderkey").alias("seq"))
    cfg_row = ("customer_order", None, "dim_customer_order", "dim",
               "o_custkey,o_orderkey,o_orderstatus,o_totalprice", "o_custkey", None)
    cfg = config_state(spark.createDataFrame([("r", None, cfg_row, 1, 1)], schemas.CONFIG_CDC))
    routed = route(env, cfg)
    # The sink orders by the numeric time, then by a tie column: the order key.
    log = BatchLog(spark, scratch_path(spark, "dim-upsert"), ["sink_table", "pk_value"], order=["at", "seq"])
    rows = routed.select("sink_table", "pk_value", "type", "data", F.col("ts").cast("bigint").alias("at"),
                         F.col("data")["o_orderkey"].cast("bigint").alias("seq"))
    half = F.col("seq") % 2 == 0
    log.append(rows.where(half), 0, is_delete=F.col("type") == "delete")
    log.append(rows.where(~half), 1, is_delete=F.col("type") == "delete")
    return log.read().select("sink_table", "pk_value",
                             F.col("data")["o_orderkey"].alias("o_orderkey"),
                             F.col("data")["o_orderstatus"].alias("o_orderstatus"),
                             F.col("data")["o_totalprice"].alias("o_totalprice"))


# --------------------------------------------------------------------------
# Cart-add fact and dictionary lookup (DWD)
# --------------------------------------------------------------------------

_LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity",
               "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]

_CART_SQL = f"""
WITH s AS (
  SELECT l_partkey, l_suppkey, l_shipdate, CAST(l_quantity AS INTEGER) AS q,
         row_number() OVER (PARTITION BY l_partkey ORDER BY {", ".join(_LINE_ORDER)}) AS rk,
         lag(CAST(l_quantity AS INTEGER)) OVER (PARTITION BY l_partkey ORDER BY {", ".join(_LINE_ORDER)}) AS p
  FROM lineitem
), cart AS (
  SELECT CAST(l_partkey AS VARCHAR) AS id, CAST(l_suppkey AS VARCHAR) AS user_id,
         CAST(l_partkey AS VARCHAR) AS sku_id,
         CAST(CASE WHEN p IS NULL THEN q ELSE q - p END AS VARCHAR) AS sku_num,
         CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR) AS ts,
         CAST(l_partkey AS VARCHAR) AS source_type, l_partkey, rk
  FROM s WHERE p IS NULL OR q > p
), named AS (
  SELECT cart.*, p_brand AS source_type_name
  FROM cart JOIN part ON cart.l_partkey = part.p_partkey AND part.p_size < 20
)
"""


def _cart_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as the change log of carts: per part (cart = sku), line items
    in ship order are successive counts; the first is an insert, the rest
    updates carrying the previous count as ``old``."""
    from strata.operators.sequence import with_previous
    li = load_table(spark, sf_dir, "lineitem").select("l_partkey", *_LINE_ORDER)
    # The streaming twin breaks ties of equal times by the line's own order.
    li = li.withColumns({"q": F.col("l_quantity").cast("int"), "line": F.struct(*_LINE_ORDER)})
    prev = with_previous(li, ["l_partkey"], _LINE_ORDER, ["q"], prefix="prev_")
    data = {"id": F.col("l_partkey"), "user_id": F.col("l_suppkey"), "sku_id": F.col("l_partkey"),
            "sku_num": F.col("q"), "source_type": F.col("l_partkey")}
    typ = F.when(F.col("prev_q").isNull(), "insert").otherwise("update")
    old = F.when(F.col("prev_q").isNotNull(),
                 F.create_map(F.lit("sku_num"), F.col("prev_q").cast("string")))
    cols = derive.envelope("cart_info", typ, F.unix_seconds(F.col("l_shipdate").cast("timestamp")), data)
    return prev.select(*cols[:5], old.alias("old"), "line")


@register("cart_add", _CART_SQL + """
SELECT id, user_id, sku_id, sku_num, source_type, ts FROM cart
""")
def cart_add_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cart additions from before/after deltas (inserts and increases only)."""
    from strata.operators.fact import cart_add
    return cart_add(_cart_envelopes(spark, sf_dir))


@register("cart_add_sql", _CART_SQL + """
SELECT id, user_id, sku_id, sku_num, ts, source_type, source_type_name FROM named
""")
def cart_add_sql_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cart additions and their names from SQL text over views."""
    from strata import statements
    return statements.named_cart(statements.cart_add(_cart_envelopes(spark, sf_dir)), _dictionary(spark, sf_dir))


def _dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as dictionary rows (code = part key, name = brand). Parts of size 20
    and more carry a code that no fact has, so some lookups find nothing."""
    code = F.col("p_partkey").cast("string")
    return load_table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") < 20, code).otherwise(F.concat(F.lit("x"), code)).alias("dic_code"),
        F.col("p_brand").alias("dic_name"))


@register("lookup_join", _CART_SQL + """
SELECT id, user_id, sku_id, sku_num, ts, source_type, source_type_name FROM named
""")
def lookup_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cart additions joined to a dictionary; additions without an entry drop."""
    from strata import schemas
    from strata.operators.fact import cart_add, lookup
    joined = lookup(cart_add(_cart_envelopes(spark, sf_dir)), _dictionary(spark, sf_dir))
    return joined.select(*schemas.names(schemas.CART_FACT))


# --------------------------------------------------------------------------
# Joins
# --------------------------------------------------------------------------

@register("interval_join", """
SELECT c.user_id, c.event_id AS click_id, p.event_id AS purchase_id, c.ts AS click_ts, p.ts AS purchase_ts
FROM events c JOIN events p
  ON c.user_id = p.user_id
 AND p.ts BETWEEN c.ts - INTERVAL 10 MINUTE AND c.ts + INTERVAL 10 MINUTE
WHERE c.event_type = 'click' AND p.event_type = 'purchase'
""")
def interval_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks joined to the same user's purchases within ±10 minutes (inclusive)."""
    from strata.operators.joins import interval_join
    ev = load_table(spark, sf_dir, "events")
    clicks = ev.where(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"))
    buys = ev.where(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("p_user_id"), F.col("event_id").alias("purchase_id"),
        F.col("ts").alias("purchase_ts"))
    j = interval_join(clicks, buys, "user_id", "p_user_id", "click_ts", "purchase_ts", -600, 600)
    return j.select("user_id", "click_id", "purchase_id", "click_ts", "purchase_ts")


def _emp_dept(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Join sides over whole tables: orders and customers on a derived key. Every
    seventh order and every fifth customer get a key that the other side lacks."""
    o = load_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, -F.col("o_custkey"))
        .otherwise(F.col("o_custkey")).alias("o_custkey"), "o_totalprice")
    c = load_table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 5 == 0, F.col("c_custkey") + 1_000_000_000)
        .otherwise(F.col("c_custkey")).alias("c_custkey"), "c_name")
    return o, c


_JOIN_SQL = """
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_custkey, c.c_name
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN -o_custkey ELSE o_custkey END AS o_custkey,
             o_totalprice FROM orders) o
{how} JOIN (SELECT CASE WHEN c_custkey % 5 = 0 THEN c_custkey + 1000000000 ELSE c_custkey END AS c_custkey,
                   c_name FROM customer) c
  ON o.o_custkey = c.c_custkey
"""


def _join_query(how: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        from strata.operators.joins import keyed_join
        o, c = _emp_dept(spark, sf_dir)
        j = keyed_join(o, c, "o_custkey", "c_custkey", how)
        return j.select("o_orderkey", "o_custkey", "o_totalprice", "c_custkey", "c_name")
    q.__doc__ = f"Orders ⋈ customers on the customer key, {how} join."
    return q


for _how, _sql_how in (("inner", "INNER"), ("left", "LEFT"), ("right", "RIGHT"), ("full", "FULL OUTER")):
    register(f"{_how}_join", _JOIN_SQL.format(how=_sql_how))(_join_query(_how))


# --------------------------------------------------------------------------
# DWS windows, first visits, late rows
# --------------------------------------------------------------------------

@register("uv_first_visit", """
SELECT mid, dt, ts, event_id, ch FROM (
  SELECT user_id AS mid, strftime(ts, '%Y-%m-%d') AS dt, ts, event_id, event_type AS ch,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
  FROM events) WHERE rn = 1
""")
def uv_first_visit_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First page view per device and day (the unique-visitor record)."""
    log = derive.page_log(load_table(spark, sf_dir, "events"))
    return traffic.uv_first_visit(log, carry=["ch"])


@register("sku_order_window", """
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS stt,
       strftime(w + INTERVAL 7 DAY, '%Y-%m-%d %H:%M:%S') AS edt,
       l_partkey AS sku_id,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE)
         AS order_amount,
       count(*) AS order_ct,
       epoch_ms(w + INTERVAL 7 DAY) AS ts
FROM (SELECT *, time_bucket(INTERVAL 7 DAY, l_shipdate, TIMESTAMP '1970-01-01') AS w FROM lineitem)
GROUP BY w, l_partkey
""")
def sku_order_window_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly (epoch-aligned) order amount and line count per sku."""
    li = spread(load_table(spark, sf_dir, "lineitem").select(
        "l_shipdate", "l_partkey", "l_extendedprice", "l_discount"))
    amount = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    return traffic.sku_order_window(li, "l_shipdate", "l_partkey", amount, "7 days")


@register("late_rows", """
SELECT event_id, ts, max_seen FROM (
  SELECT event_id, ts, max(ts) OVER (ORDER BY event_id + (event_id * 7919) % 97, event_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS max_seen
  FROM events) WHERE ts < max_seen - INTERVAL 6 HOUR
""")
def late_rows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events replayed in a shuffled arrival order: the rows more than 6 h behind
    the largest event time seen before them (what a 6 h watermark drops)."""
    ev = load_table(spark, sf_dir, "events").select("event_id", "ts")
    arrived = ev.withColumn("arrival", F.col("event_id") + (F.col("event_id") * 7919) % 97)
    late = traffic.late_rows(arrived, ["arrival", "event_id"], "ts", "6 HOURS")
    return late.select("event_id", "ts", "max_seen")


# --------------------------------------------------------------------------
# Streaming twins: the jobs over replayed tables, run until nothing is left
# --------------------------------------------------------------------------

def _sql_of(name: str) -> str:
    return ORACLE[name]


def _run(start, spark: SparkSession, name: str, *args, **options) -> str:
    """Run a job over what its streams hold; returns its folder."""
    from strata.streaming.jobs import ONCE
    from strata.streaming.replay import drain
    path = scratch_path(spark, name)
    drain(start(*args, path=path, checkpoint=f"{path}-checkpoint", trigger=ONCE, **options))
    return path


# Groups over which keyed state deals its keys or devices.
STATE_GROUPS = 512


def _page_log_stream(spark: SparkSession, sf_dir: str, end_after: str | None = None) -> DataFrame:
    """The page log's records as a stream in the order of their time; with
    ``end_after`` a last record comes that long after all others."""
    from strata.streaming.replay import replayed
    events = load_table(spark, sf_dir, "events")
    raw = derive.page_log_json(events, keep=("ts",))
    if end_after is not None:
        raw = raw.unionByName(derive.page_log_end(events, end_after))
    return replayed(raw, "ts", "page-log").select("value")


# What is behind the final watermark, ten seconds before the largest event time.
_PASSED = "(SELECT epoch_ms(max(ts)) - 10000 FROM events)"


@register("stream_traffic_window", _sql_of("traffic_window"))
def stream_traffic_window_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming traffic window over page-log JSON: keyed first visits feed the window
    aggregate, and every window is emitted when it closes. The log's end record closes
    the last windows; its own stays open and is never emitted."""
    from strata.streaming import jobs
    stream = _page_log_stream(spark, sf_dir, end_after="1 HOUR 10 SECONDS")
    path = _run(jobs.traffic_window, spark, "traffic", stream, size="1 hour", groups=STATE_GROUPS)
    return spark.read.parquet(path)


@register("stream_uv_first_visit", _sql_of("uv_first_visit"))
def stream_uv_first_visit_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming first visit per device and day, from keyed state."""
    from strata.streaming import jobs
    path = _run(jobs.first_visit_log, spark, "first-visit", _page_log_stream(spark, sf_dir), groups=STATE_GROUPS)
    return spark.read.parquet(path).select(
        F.col("mid").cast("bigint").alias("mid"), F.date_format("ts", "yyyy-MM-dd").alias("dt"),
        F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("log_id").alias("event_id"), "ch")


_SESSION_SQL = """
WITH e AS (
  SELECT user_id AS mid, ts, event_id, CAST(round(value * 1000) AS BIGINT) AS during_time,
         lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts
  FROM events
), s AS (
  SELECT *, count(*) FILTER (prev_ts IS NULL OR ts >= prev_ts + INTERVAL 30 MINUTE)
              OVER (PARTITION BY mid ORDER BY ts, event_id) AS session
  FROM e
)
SELECT mid, min(ts) AS stt, max(ts) + INTERVAL 30 MINUTE AS edt, count(*) AS pv_ct,
       CAST(sum(during_time) AS BIGINT) AS dur_sum
FROM s GROUP BY mid, session
"""


@register("session_window", _SESSION_SQL)
def session_window_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions per device, parted by 30 minutes of silence."""
    return traffic.sessions(derive.page_log(load_table(spark, sf_dir, "events")))


@register("stream_session_window", f"""
SELECT * FROM ({_SESSION_SQL}) WHERE epoch_ms(edt) <= {_PASSED}
""")
def stream_session_window_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sessions over the page-log stream, each once the watermark passed it."""
    from strata.streaming import jobs
    path = _run(jobs.device_sessions, spark, "sessions", _page_log_stream(spark, sf_dir))
    return spark.read.parquet(path).withColumn("mid", F.col("mid").cast("bigint"))


# Records arrive up to eight days after their time, in eight batches.
_ARRIVAL = "epoch_ms(ts) + (event_id * 7919) % 97 * 7200000"

_VERSIONS_SQL = f"""
WITH e AS (
  SELECT event_id, ts, epoch_ms(ts) AS ms, epoch_ms(time_bucket(INTERVAL 1 HOUR, ts)) AS w,
         'v' || CAST(user_id % 3 AS VARCHAR) AS vc, CAST(round(value * 1000) AS BIGINT) AS dur, {_ARRIVAL} AS x
  FROM events
), placed AS (
  SELECT *, least(floor((CAST(x AS DOUBLE) - (SELECT min(x) FROM e))
                        / ((SELECT CAST(max(x) AS DOUBLE) - min(x) FROM e) / 8)), 7) AS b FROM e
), marks AS (
  -- The watermark of a batch: the largest time of the batches before it.
  SELECT n AS b, coalesce((SELECT max(ms) FROM placed WHERE placed.b < n), 0) AS wm FROM range(9) r(n)
), judged AS (
  SELECT placed.*, w + 3600000 + 518400000 <= wm AS is_late FROM placed JOIN marks USING (b)
), sums AS (
  SELECT w, vc, b, count(*) AS n, sum(dur) AS dur FROM judged WHERE NOT is_late GROUP BY ALL
), closing AS (
  SELECT w, vc, (SELECT min(b) FROM marks WHERE w + 3600000 <= wm) AS c
  FROM (SELECT DISTINCT w, vc FROM sums)
), fired AS (
  SELECT w, vc, b FROM sums JOIN closing USING (w, vc) WHERE b >= c
  UNION
  SELECT w, vc, c FROM closing WHERE c IS NOT NULL AND EXISTS (
    SELECT 1 FROM sums s WHERE (s.w, s.vc) = (closing.w, closing.vc) AND s.b < c)
)
SELECT 'window' AS kind, strftime(epoch_ms(CAST(w AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS stt, vc,
       CAST(row_number() OVER (PARTITION BY w, vc ORDER BY fired.b) AS INTEGER) AS version,
       CAST((SELECT sum(n) FROM sums s WHERE (s.w, s.vc) = (fired.w, fired.vc)
             AND s.b <= fired.b) AS BIGINT) AS pv_ct,
       CAST((SELECT sum(dur) FROM sums s WHERE (s.w, s.vc) = (fired.w, fired.vc)
             AND s.b <= fired.b) AS BIGINT) AS dur_sum, CAST(NULL AS BIGINT) AS log_id
FROM fired
UNION ALL
SELECT 'late', strftime(epoch_ms(CAST(w AS BIGINT)), '%Y-%m-%d %H:%M:%S'), vc, NULL, NULL, NULL, event_id
FROM judged WHERE is_late
"""


@register("stream_window_versions", _VERSIONS_SQL)
def stream_window_versions_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows that close, are corrected for six days, and set later rows
    aside: every version of every window, and the late rows."""
    from strata.streaming import jobs
    from strata.streaming.replay import replayed
    raw = derive.page_log_json(load_table(spark, sf_dir, "events"), keep=("ts", "event_id"))
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    arrived = raw.select("value", (ms + (F.col("event_id") * 7919) % 97 * 7200000).alias("x"))
    path = _run(jobs.traffic_versions, spark, "versions", replayed(arrived, "x", "late-log", slices=8),
                size="1 hour", lateness="6 days", dims=["vc"])
    return spark.read.parquet(path).select("kind", "stt", "vc", "version", "pv_ct", "dur_sum", "log_id")


@register("stream_interval_join", _sql_of("interval_join"))
def stream_interval_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming click/purchase interval join with watermarks on both sides."""
    from strata.streaming import jobs
    from strata.streaming.replay import replayed
    ev = load_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    stream = replayed(ev, "ts", "clicks-and-purchases")
    clicks = stream.where(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts"))
    buys = stream.where(F.col("event_type") == "purchase").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"))
    path = _run(jobs.click_purchase_join, spark, "click-purchase", clicks, buys)
    return spark.read.parquet(path)


_OUTER_SQL = """
WITH c AS (SELECT user_id, event_id AS click_id, ts AS click_ts FROM events WHERE event_type = 'click'),
     p AS (SELECT user_id, event_id AS purchase_id, ts AS purchase_ts FROM events WHERE event_type = 'purchase')
SELECT coalesce(c.user_id, p.user_id) AS user_id, click_id, purchase_id, click_ts, purchase_ts
FROM c FULL JOIN p ON c.user_id = p.user_id
 AND purchase_ts BETWEEN click_ts - INTERVAL 10 MINUTE AND click_ts + INTERVAL 10 MINUTE
"""


def _clicks_and_buys(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (df.where(F.col("event_type") == "click").select(
                "user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts")),
            df.where(F.col("event_type") == "purchase").select(
                "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts")))


@register("full_interval_join", _OUTER_SQL)
def full_interval_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks and the same user's purchases within ±10 minutes, either alone as well."""
    from strata.operators.joins import outer_interval_join
    clicks, buys = _clicks_and_buys(load_table(spark, sf_dir, "events"))
    joined = outer_interval_join(clicks, buys.withColumnRenamed("user_id", "p_user_id"), "user_id", "p_user_id",
                                 "click_ts", "purchase_ts", -600, 600)
    return joined.select(F.coalesce("user_id", "p_user_id").alias("user_id"), "click_id", "purchase_id",
                         "click_ts", "purchase_ts")


@register("stream_full_interval_join", f"""
WITH mark AS (
  SELECT least(max(ts) FILTER (event_type = 'click'), max(ts) FILTER (event_type = 'purchase'))
         - INTERVAL 1 MINUTE - INTERVAL 10 MINUTE AS passed FROM events
)
SELECT o.* FROM ({_OUTER_SQL}) o, mark
WHERE (click_id IS NOT NULL AND purchase_id IS NOT NULL) OR coalesce(click_ts, purchase_ts) < passed
""")
def stream_full_interval_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream: pairs as they meet, and what the watermark left alone."""
    from strata.streaming import jobs
    from strata.streaming.replay import replayed
    ev = load_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    stream = replayed(ev, "ts", "clicks-or-purchases")
    path = _run(jobs.outer_click_purchase_join, spark, "click-or-purchase", *_clicks_and_buys(stream))
    return spark.read.parquet(path)


@register("stream_dim_route", """
SELECT sink_table, pk_value, column_name, column_value FROM (
""" + _sql_of("dim_route") + """
) WHERE pk_value IS NOT NULL
UNION ALL SELECT 'reject: no key', NULL, 'rows', CAST(count(*) AS VARCHAR) FROM region
UNION ALL SELECT 'reject: malformed', NULL, 'rows', '1'
""")
def stream_dim_route_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming dimension routing: the configuration is preloaded and then changed
    by its own stream; envelopes arrive shuffled on another and land in one table
    per destination. Region rows lack the key their configuration names, and one
    record is malformed: both are counted from the rejects."""
    from strata import schemas
    from strata.streaming import jobs
    from strata.streaming.replay import drain, replayed
    rows = []
    for op, src, sink, typ, cols, pk, seq in _ROUTE_CONFIG_LOG:
        row = (src, None, sink, typ, cols, pk, None)
        rows.append((op, row if op in ("u", "d") else None, row if op != "d" else None, seq, seq))
    log = spark.createDataFrame(rows, schemas.CONFIG_CDC)
    path = scratch_path(spark, "dim-route")
    jobs.preload_config(spark, path, log.where("seq <= 3"))
    later = log.where("seq > 3").select(F.to_json(F.struct(*log.columns)).alias("value"), "seq")
    drain(jobs.config_changes(replayed(later, "seq", "config", slices=2), path, f"{path}-config-ckpt", jobs.ONCE))
    env = _table_envelopes(spark, sf_dir, ["nation", "region", "supplier", "customer", "orders"])
    raw = env.select(F.to_json(F.struct(*env.columns)).alias("value")).unionByName(
        spark.createDataFrame([("{bad",)], "value string"))
    drain(jobs.dimension_routing(replayed(raw, None, "dim-data"), path, f"{path}-data-ckpt", jobs.ONCE))
    out = None
    for table in ("dim_nation", "dim_supplier"):
        d = jobs.read_dimension(spark, path, table, key="pk_value")
        cols = [c for c in d.columns if c != "pk_value"]
        long = d.select(F.lit(table).alias("sink_table"), "pk_value", F.explode(F.map_from_arrays(
            F.array(*map(F.lit, cols)), F.array(*map(F.col, cols)))).alias("column_name", "column_value"))
        long = long.where("column_value IS NOT NULL")
        out = long if out is None else out.unionByName(long)
    rejects = spark.read.parquet(f"{path}/rejects").groupBy("reason").count().select(
        F.concat(F.lit("reject: "), "reason").alias("sink_table"), F.lit(None).cast("string").alias("pk_value"),
        F.lit("rows").alias("column_name"), F.col("count").cast("string").alias("column_value"))
    return out.unionByName(rejects)


@register("stream_dim_catalog", """
SELECT 'dim_order' AS sink_table, CAST(o_custkey AS VARCHAR) AS k, CAST(o_orderkey AS VARCHAR) AS ts,
       o_orderstatus AS batch, CAST(o_totalprice AS VARCHAR) AS amount
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders)
WHERE rn = 1 AND o_orderstatus <> 'P'
UNION ALL SELECT 'dim_customer', CAST(c_custkey AS VARCHAR), NULL, c_name, CAST(c_acctbal AS VARCHAR) FROM customer
""")
def stream_dim_catalog_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer and customers, arriving shuffled, routed into the catalog
    tables that the configuration creates; the rows of ``spark.table``. Some columns
    are named as the sink's own once were (``ts``, ``batch``)."""
    import uuid

    from strata import schemas
    from strata.sinks.catalog_tables import read_table
    from strata.streaming import jobs
    from strata.streaming.replay import drain, replayed
    path = scratch_path(spark, "dim-catalog")
    database = f"strata_{uuid.uuid4().hex[:12]}"
    rows = [("r", None, ("orders", None, "dim_order", "dim", "k,ts,batch,amount", "k", None), 1, 1),
            ("r", None, ("customer", None, "dim_customer", "dim", "k,batch,amount", "k", None), 1, 2)]
    jobs.preload_config(spark, path, spark.createDataFrame(rows, schemas.CONFIG_CDC))
    o, c = load_table(spark, sf_dir, "orders"), load_table(spark, sf_dir, "customer")
    # The time orders a customer's orders by date, then by key.
    at = F.unix_seconds(F.col("o_orderdate").cast("timestamp")) * 1_000_000_000 + F.col("o_orderkey")
    gone = F.when(F.col("o_orderstatus") == "P", "delete").otherwise("update")
    env = o.select(*derive.envelope("orders", gone, at, {
        "k": F.col("o_custkey"), "ts": F.col("o_orderkey"), "batch": F.col("o_orderstatus"),
        "amount": F.col("o_totalprice")})).unionByName(c.select(*derive.envelope("customer", "insert", F.lit(1), {
            "k": F.col("c_custkey"), "batch": F.col("c_name"), "amount": F.col("c_acctbal")})))
    raw = env.select(F.to_json(F.struct(*env.columns)).alias("value"))
    drain(jobs.dimension_routing(replayed(raw, None, "dim-catalog-data"), path, f"{path}-ckpt", jobs.ONCE, database))
    orders = read_table(spark, database, "dim_order")
    customers = read_table(spark, database, "dim_customer").withColumn("ts", F.lit(None).cast("string"))
    return orders.select(F.lit("dim_order").alias("sink_table"), "*").unionByName(
        customers.select(F.lit("dim_customer").alias("sink_table"), "*"))


_RECORDS_SQL = """
WITH a AS (
  SELECT user_id AS id, event_id AS pos, 1 AS rnk, event_id, event_type, value, true AS gone
  FROM events WHERE event_type <> 'view'
  UNION ALL
  SELECT CASE WHEN event_type = 'signup' THEN -user_id - 1 ELSE user_id END, event_id, 2, event_id, event_type,
         value, false
  FROM events WHERE event_type <> 'error'
)
SELECT id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos DESC, rnk DESC) AS rn FROM a) WHERE rn = 1 AND NOT gone
"""


def _snapshot_and_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot read in four parts while the table changed, and the log from where
    the read of the first began. Each part holds a state later than the position
    it is filed under, as its read took time."""
    from strata.operators.cdc import apply_records
    log = derive.change_records(load_table(spark, sf_dir, "events"))
    last = log.agg(F.max("pos")).first()[0] or 0
    parts = []
    for k in range(4):
        low, seen = last * (2 + k) // 10, last * (3 + k) // 10
        state = apply_records(log.where(F.col("pos") <= seen), "id").where(F.pmod("id", F.lit(4)) == k)
        row = F.struct("id", "event_id", "event_type", "value")
        parts.append(state.select(F.lit("r").alias("op"), F.lit(None).cast(log.schema["before"].dataType).alias(
            "before"), row.alias("after"), F.lit(low).cast("long").alias("pos")))
    out = log.where(F.col("pos") > last * 2 // 10)
    for part in parts:
        out = out.unionByName(part)
    return out


@register("snapshot_log", _RECORDS_SQL)
def snapshot_log_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table from its snapshot and the log since: what the whole log would give."""
    from strata.operators.cdc import apply_records
    return apply_records(_snapshot_and_log(spark, sf_dir), "id")


@register("stream_snapshot_log", _RECORDS_SQL)
def stream_snapshot_log_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records as one stream, snapshot rows and changes shuffled."""
    from strata.streaming import jobs
    from strata.streaming.replay import replayed
    path = _run(jobs.apply_records, spark, "records", replayed(_snapshot_and_log(spark, sf_dir), None, "records"),
                key="id")
    return jobs.read_records(spark, path, "id")


def _changelog_query(how: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        from strata.streaming import jobs
        from strata.streaming.replay import replayed
        o, c = _emp_dept(spark, sf_dir)
        path = _run(jobs.changelog_join, spark, f"changelog-{how}", replayed(o, None, "orders"),
                    replayed(c, None, "customers"), "o_custkey", "c_custkey", how=how, groups=STATE_GROUPS)
        return jobs.read_join(spark, path)
    q.__doc__ = f"Retracting {how} join of order and customer streams; the materialized changelog."
    return q


for _how in ("left", "right", "full"):
    register(f"stream_{_how}_changelog", _sql_of(f"{_how}_join"))(_changelog_query(_how))


@register("stream_inner_join", _sql_of("inner_join"))
def stream_inner_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unbounded inner join of two streams (Spark's own stream-stream join)."""
    from strata.streaming import jobs
    from strata.streaming.replay import replayed
    o, c = _emp_dept(spark, sf_dir)
    path = _run(jobs.inner_join, spark, "inner-join", replayed(o, None, "orders"),
                replayed(c, None, "customers"), "o_custkey", "c_custkey")
    return spark.read.parquet(path)


def _cart_job(spark: SparkSession, sf_dir: str) -> str:
    from strata.streaming import jobs
    from strata.streaming.replay import replayed
    env = _cart_envelopes(spark, sf_dir)
    return _run(jobs.cart_fact, spark, "cart", replayed(env, None, "cart-envelopes"),
                lambda: _dictionary(spark, sf_dir), tie="line")


@register("stream_lookup_join", _sql_of("lookup_join"))
def stream_lookup_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming cart-add facts with the dictionary read anew for every micro-batch
    (processing-time lookup): the append log of facts."""
    return spark.read.parquet(f"{_cart_job(spark, sf_dir)}/facts").drop("batch")


@register("stream_cart_fact", _CART_SQL + """
SELECT id, user_id, sku_id, sku_num, ts, source_type, source_type_name
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rk DESC) AS last FROM named) WHERE last = 1
""")
def stream_cart_fact_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same job's upserted fact: the latest addition per cart id."""
    from strata.streaming import jobs
    return jobs.read_cart(spark, _cart_job(spark, sf_dir))


@register("stream_cart_sql", _sql_of("cart_add_sql"))
def stream_cart_sql_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cart job as SQL text: a statement over a streaming view, then one over each
    micro-batch and a dictionary that is read again when it is an hour old."""
    from strata.sources.jdbc import Refreshing
    from strata.streaming import jobs
    from strata.streaming.replay import replayed
    dictionary = Refreshing(lambda session: _dictionary(session, sf_dir))
    path = _run(jobs.cart_statements, spark, "cart-sql", replayed(
        _cart_envelopes(spark, sf_dir), None, "cart-envelopes"), dictionary.get)
    return spark.read.parquet(path).drop("batch")


@register("stream_sku_order_window", _sql_of("sku_order_window"))
def stream_sku_order_window_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly sku order window with Spark's watermarked streaming aggregation."""
    from strata.streaming import jobs
    from strata.streaming.replay import replayed
    lines = load_table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_shipdate", "l_extendedprice", "l_discount")
    path = _run(jobs.sku_order_window, spark, "sku-window", replayed(lines, "l_shipdate", "sku-lines"))
    return jobs.read_sku_orders(spark, path)


@register("stream_cdc_apply", _sql_of("cdc_apply"))
def stream_cdc_apply_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` change log, arriving shuffled, applied micro-batch by
    micro-batch to a log (``error`` rows delete their key)."""
    from strata.sinks.batch_log import BatchLog
    from strata.streaming import jobs
    from strata.streaming.replay import replayed
    ev = load_table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    order = ["ts", "event_id"]
    path = _run(jobs.apply_change_stream, spark, "cdc", replayed(ev, None, "changes"), keys=["user_id"],
                order=order, is_delete=F.col("event_type") == "error")
    return BatchLog(spark, path, ["user_id"], order).read()


@register("stream_late_rows", _sql_of("late_rows"))
def stream_late_rows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows of the shuffled arrival order written to a side output."""
    from strata.streaming import jobs
    from strata.streaming.replay import replayed
    ev = load_table(spark, sf_dir, "events").select("event_id", "ts")
    arrived = ev.withColumn("arrival", F.col("event_id") + (F.col("event_id") * 7919) % 97)
    path = _run(jobs.late_side_output, spark, "late", replayed(arrived, "arrival", "arrivals"),
                arrival=["arrival", "event_id"], ts="ts")
    return spark.read.parquet(f"{path}/late").select("event_id", "ts", "max_seen")


@register("stream_dirty_split", _sql_of("dirty_split"))
def stream_dirty_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log as a stream: each micro-batch is read once and split into
    the clean main output and the dirty side output (original text kept)."""
    from strata.streaming import jobs
    from strata.streaming.replay import replayed, written
    ev = load_table(spark, sf_dir, "events").select("event_id", "props")
    raw = ev.select("event_id", F.expr(_DIRTY_VALUE).alias("value"))
    path = _run(jobs.dirty_split, spark, "log-split", replayed(raw, "event_id", "raw-log"), keep=("event_id",))
    clean = written(spark, f"{path}/clean", raw.schema)
    dirty = written(spark, f"{path}/dirty", raw.schema)
    return (clean.select("event_id", "value", F.lit(False).alias("is_dirty"))
                 .unionByName(dirty.select("event_id", "value", F.lit(True).alias("is_dirty"))))
