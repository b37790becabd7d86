"""Streaming jobs: source stream → operators → sink.

Each job takes streaming DataFrames, the folders to write and the checkpoint to
keep, and returns the started ``StreamingQuery``. Started again with the same
folders it goes on where it stopped. Without a trigger it runs micro-batches as
data arrive; ``ONCE`` takes what is there and ends. Readers of the results are
beside the jobs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata import schemas, statements
from strata.functions import json as jsonf
from strata.operators import traffic
from strata.operators.cdc import config_state, record_actions
from strata.operators.dim import route
from strata.operators.fact import cart_add, lookup
from strata.operators.joins import interval_join, outer_interval_join
from strata.operators.parse import drop_control_records, parse_envelopes, parse_page_log
from strata.operators.sequence import with_running_max
from strata.sinks.batch_log import BatchLog
from strata.sinks.catalog_tables import configured, create_tables, upsert
from strata.sinks.fan_out import read_destination, write_destinations
from strata.sinks.side_output import dirty_split_writer
from strata.streaming.changelog import changes, materialize
from strata.streaming.stateful import closing_windows, first_visits

ONCE = {"availableNow": True}
TRAFFIC_DIMS = ["vc", "ch", "ar"]


def _start(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
           trigger: dict | None, mode: str = "append") -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).foreachBatch(sink).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def _append(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None,
            by: str | None = None) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint)
    writer = writer.partitionBy(by) if by else writer
    return (writer.trigger(**trigger) if trigger else writer).start()


# --------------------------------------------------------------------------
# Raw logs
# --------------------------------------------------------------------------

def dirty_split(raw: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                value: str = "value", keep: tuple[str, ...] = ()) -> StreamingQuery:
    """The raw log split into ``path/clean`` and ``path/dirty`` from one read of
    each micro-batch."""
    write = dirty_split_writer(f"{path}/clean", f"{path}/dirty", value, dirty_columns=keep)
    return _start(raw, write, checkpoint, trigger)


# --------------------------------------------------------------------------
# Traffic
# --------------------------------------------------------------------------

def _views(raw: DataFrame) -> DataFrame:
    return parse_page_log(raw).withColumn("ts", F.col("ts").cast("timestamp"))


def _session_start() -> Column:
    """A view without a previous page starts a session."""
    return F.when(F.col("last_page_id").isNull(), 1).otherwise(0)


def page_log_rejects(raw: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """The records that are no page views (the traffic jobs skip them)."""
    ok = jsonf.parse(F.col("value"), schemas.PAGE_LOG)["common"]["mid"].isNotNull()
    return _append(raw.where(~F.coalesce(ok, F.lit(False))), path, checkpoint, trigger)


def traffic_window(raw: DataFrame, path: str, checkpoint: str, size: str = "10 seconds",
                   delay: str = "10 seconds", trigger: dict | None = None,
                   groups: int | None = None) -> StreamingQuery:
    """Page-log JSON to windowed pv/uv/sv/duration, each window once, when the
    watermark has passed its end.

    Keyed state knows each device's first views and feeds the window aggregate. All
    views go to the aggregate directly, as known devices' and without visitors, so a
    hot window is summed before the shuffle. A first view adds its visitor, and a
    device's very first moves from the known to the new devices. ``groups``: see
    ``first_visits``."""
    views = _views(raw)
    plain = views.withWatermark("ts", delay).select(
        "ts", *TRAFFIC_DIMS, F.lit("0").alias("is_new"), F.lit(0).alias("uv"), _session_start().alias("sv"),
        F.lit(1).alias("pv"), "during_time")

    def part(is_new: str, uv: int, sign: int) -> Column:
        return F.struct(F.lit(is_new).alias("is_new"), F.lit(uv).alias("uv"), (_session_start() * sign).alias("sv"),
                        F.lit(sign).alias("pv"), (F.col("during_time") * sign).alias("during_time"))

    firsts = first_visits(views, delay, groups).select("ts", *TRAFFIC_DIMS, F.explode(F.when(
        F.col("is_new") == "1", F.array(part("1", 1, 1), part("0", 0, -1))).otherwise(
        F.array(part("0", 1, 0)))).alias("p")).select("ts", *TRAFFIC_DIMS, "p.*")
    agg = plain.unionByName(firsts).groupBy(F.window("ts", size).alias("w"), *TRAFFIC_DIMS, "is_new").agg(
        F.sum("uv").cast("long").alias("uv_ct"), F.sum("sv").cast("long").alias("sv_ct"),
        F.sum("pv").cast("long").alias("pv_ct"), F.sum("during_time").cast("long").alias("dur_sum"))
    stt, edt, stamp = traffic.window_bounds()
    return _append(agg.where("pv_ct > 0").select(stt, edt, *TRAFFIC_DIMS, "is_new", "uv_ct", "sv_ct", "pv_ct",
                                                 "dur_sum", stamp), path, checkpoint, trigger)


def first_visit_log(raw: DataFrame, path: str, checkpoint: str, delay: str = "10 seconds",
                    trigger: dict | None = None, groups: int | None = None) -> StreamingQuery:
    """The first view per device and day, appended as it is found."""
    return _append(first_visits(_views(raw), delay, groups), path, checkpoint, trigger)


def traffic_versions(raw: DataFrame, path: str, checkpoint: str, size: str = "10 seconds",
                     lateness: str = "1 minute", delay: str = "0 seconds",
                     trigger: dict | None = None, dims: list[str] | None = None) -> StreamingQuery:
    """Windows of views and durations that are emitted when they close, anew for rows
    up to ``lateness`` later (``path/kind=window``, by version); later rows are set
    aside (``path/kind=late``)."""
    found = closing_windows(_views(raw), size, lateness, delay, dims or TRAFFIC_DIMS, ["during_time"])
    return _append(found.withColumnRenamed("during_time", "dur_sum"), path, checkpoint, trigger, by="kind")


def device_sessions(raw: DataFrame, path: str, checkpoint: str, gap: str = "30 minutes",
                    delay: str = "10 seconds", trigger: dict | None = None) -> StreamingQuery:
    """Sessions per device, each appended once the watermark has passed its end."""
    found = traffic.sessions(_views(raw).withWatermark("ts", delay), gap)
    return _append(found, path, checkpoint, trigger)


# --------------------------------------------------------------------------
# Joins
# --------------------------------------------------------------------------

def click_purchase_join(clicks: DataFrame, buys: DataFrame, path: str, checkpoint: str,
                        bound_s: float = 600, delay: str = "1 minute",
                        trigger: dict | None = None) -> StreamingQuery:
    """Stream-stream interval join with watermarks on both sides (``user_id,
    click_id, click_ts`` and ``user_id, purchase_id, purchase_ts``)."""
    left = clicks.withColumn("click_ts", F.col("click_ts").cast("timestamp")).withWatermark("click_ts", delay)
    right = buys.withColumnRenamed("user_id", "p_user_id").withColumn(
        "purchase_ts", F.col("purchase_ts").cast("timestamp")).withWatermark("purchase_ts", delay)
    joined = interval_join(left, right, "user_id", "p_user_id", "click_ts", "purchase_ts",
                           -bound_s, bound_s).select(
        "user_id", "click_id", "purchase_id",
        F.col("click_ts").cast("timestamp_ntz").alias("click_ts"),
        F.col("purchase_ts").cast("timestamp_ntz").alias("purchase_ts"))
    return _append(joined, path, checkpoint, trigger)


def inner_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, path: str,
               checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Unbounded inner join: Spark's own stream-stream join, appended to ``path``."""
    return _append(left.join(right, F.col(left_key) == F.col(right_key)), path, checkpoint, trigger)


def outer_click_purchase_join(clicks: DataFrame, buys: DataFrame, path: str, checkpoint: str,
                              bound_s: float = 600, delay: str = "1 minute",
                              trigger: dict | None = None) -> StreamingQuery:
    """The same range as a full outer join: a row that the watermark has left without
    a partner is padded with nulls, and state behind the watermark goes."""
    left = clicks.withColumn("click_ts", F.col("click_ts").cast("timestamp")).withWatermark("click_ts", delay)
    right = buys.withColumnRenamed("user_id", "p_user_id").withColumn(
        "purchase_ts", F.col("purchase_ts").cast("timestamp")).withWatermark("purchase_ts", delay)
    joined = outer_interval_join(left, right, "user_id", "p_user_id", "click_ts", "purchase_ts", -bound_s, bound_s)
    return _append(joined.select(
        F.coalesce("user_id", "p_user_id").alias("user_id"), "click_id", "purchase_id",
        F.col("click_ts").cast("timestamp_ntz").alias("click_ts"),
        F.col("purchase_ts").cast("timestamp_ntz").alias("purchase_ts")), path, checkpoint, trigger)


def changelog_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, path: str,
                   checkpoint: str, how: str = "left", trigger: dict | None = None,
                   ttl_s: float | None = None, salts: int = 1, groups: int | None = None) -> StreamingQuery:
    """Retracting join (inner, left, right, full): its changes, appended to ``path``.
    With a time to live the query runs until stopped: Spark then asks for expired
    state in ever new batches, which ``ONCE`` would wait for."""
    if ttl_s is not None and trigger == ONCE:
        raise ValueError("a join with a time to live needs a trigger that goes on")
    return _append(changes(left, right, left_key, right_key, how, ttl_s, salts, groups), path, checkpoint, trigger)


def read_join(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of a changelog join."""
    found = spark.read.parquet(path)
    return materialize(found, [c for c in found.columns if c != "op"])


# --------------------------------------------------------------------------
# Dimensions
# --------------------------------------------------------------------------

def _config(spark: SparkSession, path: str) -> BatchLog:
    return BatchLog(spark, f"{path}/config", ["source_table"], order=["ts_ms", "seq", "rank"])


_ACTION = f"source_table STRING, ts_ms LONG, seq LONG, rank INT, row STRUCT<{schemas.CONFIG_ROW}>"


def preload_config(spark: SparkSession, path: str, changes: DataFrame) -> None:
    """Load the configuration as it stands (change records ``op, before, after,
    ts_ms, seq``) before the jobs start, so that no data precede it. A preload that
    broke off is repeated; it never undoes a later change."""
    _config(spark, path).seed(config_state(changes, live_type=None))


def config_changes(raw: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                   database: str | None = None) -> StreamingQuery:
    """The stream of configuration changes (JSON ``value``): kept in the config
    log; with ``database``, destination tables are created or grown as each
    batch asks for. Malformed records go to ``path/config_rejects``."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        parsed = batch.select("value", jsonf.parse(F.col("value"), schemas.CONFIG_CDC).alias("c")).persist()
        try:
            ok = F.coalesce(F.col("c.op").isNotNull(), F.lit(False))
            parsed.where(~ok).select("value").write.mode("overwrite").parquet(
                f"{path}/config_rejects/batch={batch_id}")
            _config(spark, path).append(config_state(parsed.where(ok).select("c.*"), live_type=None), batch_id)
            if database:
                create_tables(read_config(spark, path), database, f"{path}/tables")
        finally:
            parsed.unpersist()
    return _start(raw, sink, checkpoint, trigger)


def read_config(spark: SparkSession, path: str, live_type: str = "dim") -> DataFrame:
    """The live configuration rows."""
    return _config(spark, path).read(_ACTION).where(F.col("row.sink_type") == live_type).select("row.*")


def dimension_routing(raw: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                      database: str | None = None) -> StreamingQuery:
    """Business change envelopes (JSON ``value``) routed by the configuration as it
    stands at each micro-batch, into ``path/dim``: one write for all destinations.
    With ``database`` they also land in the catalog tables that the configuration
    creates. Malformed records and rows without a key go to ``path/rejects``."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        raw_rows = batch.select("value").persist()
        config = read_config(spark, path).persist()
        routed = route(drop_control_records(parse_envelopes(raw_rows)), config).persist()
        try:
            bad = jsonf.parse(F.col("value"), schemas.ENVELOPE)["table"].isNull()
            rejects = raw_rows.where(F.coalesce(bad, F.lit(True))).select(
                "value", F.lit("malformed").alias("reason"))
            keyless = routed.where(F.col("pk_value").isNull()).select(
                F.to_json(F.struct("sink_table", "sink_pk", "type", "ts", "data")).alias("value"),
                F.lit("no key").alias("reason"))
            rejects.unionByName(keyless).write.mode("overwrite").parquet(f"{path}/rejects/batch={batch_id}")
            keyed = routed.where(F.col("pk_value").isNotNull())
            write_destinations(keyed, f"{path}/dim", batch_id)
            if database:
                wanted = create_tables(config, database, f"{path}/tables")
                for r in keyed.select("sink_table").distinct().collect():  # config-sized
                    if r.sink_table in wanted:
                        upsert(keyed.where(F.col("sink_table") == r.sink_table), database, r.sink_table,
                               f"{path}/staging")
        finally:
            for df in (routed, config, raw_rows):
                df.unpersist()
    return _start(raw, sink, checkpoint, trigger)


def read_dimension(spark: SparkSession, path: str, table: str, key: str | None = None) -> DataFrame:
    """The current rows of one destination: its configured string columns, and the
    key's value as ``key`` if given."""
    columns = configured(read_config(spark, path)).get(table, ("id", []))[1]
    return read_destination(spark, f"{path}/dim", table, columns, key)


# --------------------------------------------------------------------------
# Facts and windows
# --------------------------------------------------------------------------

def cart_fact(envelopes: DataFrame, dictionary: Callable[[], DataFrame], path: str, checkpoint: str,
              trigger: dict | None = None, tie: str | None = None) -> StreamingQuery:
    """Cart-add facts joined to the dictionary as it stands when the micro-batch is
    processed. Every fact is appended to ``path/facts/batch=<id>``; the latest
    per ``id`` (by numeric ``ts``, then the column ``tie``) is kept in
    ``path/by_id``. Rows with a count that is no number go to ``path/rejects``."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        facts, rejects = cart_add(batch, carry=(tie,) if tie else (), rejects=True)
        rejects.write.mode("overwrite").parquet(f"{path}/rejects/batch={batch_id}")
        named = lookup(facts, dictionary()).persist()
        try:
            columns = schemas.names(schemas.CART_FACT)
            named.select(*columns).write.mode("overwrite").parquet(f"{path}/facts/batch={batch_id}")
            _by_id(spark, path).append(named.select(*columns, F.col("ts").try_cast("bigint").alias("at"), (
                F.col(tie) if tie else F.xxhash64(*columns)).alias("tie")), batch_id)
        finally:
            named.unpersist()
    return _start(envelopes, sink, checkpoint, trigger)


def cart_statements(envelopes: DataFrame, dictionary: Callable[[SparkSession], DataFrame], path: str, checkpoint: str,
                    trigger: dict | None = None) -> StreamingQuery:
    """The cart facts from SQL text: additions by a statement over a streaming view,
    names by a statement over each micro-batch and the dictionary as it then stands
    (asked for with the batch's session, where its views are)."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        statements.named_cart(batch, dictionary(batch.sparkSession)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return _start(statements.cart_add(envelopes), sink, checkpoint, trigger)


def read_cart(spark: SparkSession, path: str) -> DataFrame:
    """The latest fact per id."""
    return _by_id(spark, path).read().drop("at", "tie")


def _by_id(spark: SparkSession, path: str) -> BatchLog:
    return BatchLog(spark, f"{path}/by_id", ["id"], order=["at", "tie"])


def sku_order_window(lines: DataFrame, path: str, checkpoint: str, size: str = "7 days",
                     delay: str = "1 day", trigger: dict | None = None) -> StreamingQuery:
    """Watermarked event-time window aggregate (Spark's own streaming state) in
    update mode; the latest version of every window is kept in a log."""
    amount = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    agg = (lines.withColumn("et", F.col("l_shipdate").cast("timestamp")).withWatermark("et", delay)
           .groupBy(F.window("et", size).alias("w"), F.col("l_partkey").alias("sku_id"))
           .agg(F.sum(amount).alias("amount"), F.count(F.lit(1)).alias("order_ct")))
    result = agg.select(
        F.date_format("w.start", traffic.STAMP).alias("stt"), F.date_format("w.end", traffic.STAMP).alias("edt"),
        "sku_id", F.col("amount").cast("double").alias("order_amount"), "order_ct",
        F.unix_millis("w.end").alias("ts"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        _sku_log(batch.sparkSession, path).append(batch, batch_id)
    return _start(result, sink, checkpoint, trigger, mode="update")


def _sku_log(spark: SparkSession, path: str) -> BatchLog:
    return BatchLog(spark, path, ["stt", "sku_id"])


def read_sku_orders(spark: SparkSession, path: str) -> DataFrame:
    return _sku_log(spark, path).read()


def apply_change_stream(changes: DataFrame, path: str, checkpoint: str, keys: list[str],
                        order: list[str], is_delete: Column, trigger: dict | None = None) -> StreamingQuery:
    """A change log applied batch by batch (upsert, delete) to a keyed log. The
    greatest ``order`` of a key wins, in whatever batch it arrives."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        BatchLog(batch.sparkSession, path, keys, order).append(batch, batch_id, is_delete)
    return _start(changes, sink, checkpoint, trigger)


def _records(spark: SparkSession, path: str, key: str) -> BatchLog:
    return BatchLog(spark, path, [key], order=["pos", "rank"])


def apply_records(records: DataFrame, path: str, checkpoint: str, key: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Change records (``op, before, after, pos``), a snapshot's among them, applied
    in any order of arrival: what ``operators.cdc.apply_records`` does to a table."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        _records(batch.sparkSession, path, key).append(
            record_actions(batch, key), batch_id, F.col("row").isNull())
    return _start(records, sink, checkpoint, trigger)


def read_records(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The table that ``apply_records`` keeps."""
    return _records(spark, path, key).read().select("row.*")


def late_side_output(rows: DataFrame, path: str, checkpoint: str, arrival: list[str], ts: str,
                     lateness: str = "6 HOURS", trigger: dict | None = None) -> StreamingQuery:
    """Rows arriving more than ``lateness`` behind the largest event time seen
    so far, written to ``path/late`` instead of silently dropped.

    The largest event time of earlier batches is kept in a one-row log; inside a
    batch the running maximum follows the arrival order."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kind = batch.schema[ts].dataType.simpleString()
        seen = BatchLog(spark, f"{path}/seen", ["name"], order=["top"])
        top = seen.read(f"name STRING, top {kind}", before=batch_id).select(
            F.col("top").cast("string")).first()
        running = with_running_max(batch, arrival, ts, out="max_seen")
        if top is not None:
            running = running.withColumn("max_seen", F.greatest("max_seen", F.lit(top["top"]).cast(kind)))
        running = running.persist()
        try:
            (running.where(F.col(ts) < F.col("max_seen") - F.expr(f"INTERVAL {lateness}"))
                    .write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}"))
            seen.append(running.agg(F.max("max_seen").alias("top")).where("top is not null").select(
                F.lit("top").alias("name"), "top"), batch_id)
        finally:
            running.unpersist()
    return _start(rows, sink, checkpoint, trigger)
