"""Restart from a checkpoint: each job stopped after part of its input and started
again on the rest ends with the batch answer."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.operators import traffic
from strata.operators.cdc import apply_changes
from strata.operators.fact import cart_add, lookup
from strata.operators.joins import interval_join, keyed_join
from strata.plans import catalog, derive
from strata.session import load_table
from strata.sinks.batch_log import BatchLog
from strata.streaming import jobs
from strata.streaming.replay import drain


def in_two_runs(spark, tmp_dir, tables, start, order=None):
    """Run ``start(streams..., path, checkpoint, trigger)`` on the first part of each
    table, then again on all of it; returns the folder."""
    path, checkpoint = f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    for part in (0, 1):
        streams = []
        for k, df in enumerate(tables):
            half = F.pmod(F.xxhash64(F.to_json(F.struct(*df.columns))), F.lit(2)) if order is None else (
                F.col(order) >= df.agg(F.percentile(F.unix_micros(F.col(order).cast("timestamp")), 0.5)
                                       .cast("long").alias("m")).select(F.timestamp_micros("m").cast(
                                           "timestamp_ntz")).first()[0]).cast("int")
            df.where(half == part).coalesce(2).write.mode("append").parquet(f"{tmp_dir}/src{k}")
            streams.append(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
                           .parquet(f"{tmp_dir}/src{k}"))
        drain(start(*streams, path=path, checkpoint=checkpoint, trigger=jobs.ONCE))
    return path


def same(a, b):
    a, b = a.select(*sorted(a.columns)), b.select(*sorted(b.columns))
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def test_traffic(spark, tmp_dir):
    events = load_table(spark, SF_SMALL, "events")
    raw = derive.page_log_json(events, keep=("ts",))
    path = in_two_runs(spark, tmp_dir, [raw],
                       lambda s, **k: jobs.traffic_window(s.select("value"), size="1 hour", **k), order="ts")
    # All windows but those that the last watermark has not passed.
    last = events.agg(F.max(F.unix_millis(F.col("ts").cast("timestamp")))).first()[0] - 10_000
    log = derive.page_log(events)
    same(spark.read.parquet(path),
         traffic.traffic_window(traffic.page_view_flags(log), "1 hour").where(F.col("ts") <= last))


def test_cart_fact(spark, tmp_dir):
    env = catalog._cart_envelopes(spark, SF_SMALL)
    dic = catalog._dictionary(spark, SF_SMALL)
    path = in_two_runs(spark, tmp_dir, [env], lambda s, **k: jobs.cart_fact(s, lambda: dic, tie="line", **k))
    facts = spark.read.parquet(f"{path}/facts").drop("batch")
    same(facts, lookup(cart_add(env), dic).select(*facts.columns))


def test_interval_join(spark, tmp_dir):
    ev = load_table(spark, SF_SMALL, "events").select("event_id", "ts", "user_id", "event_type")

    def sides(df):
        return (df.where("event_type = 'click'").selectExpr("user_id", "event_id click_id", "ts click_ts"),
                df.where("event_type = 'purchase'").selectExpr("user_id", "event_id purchase_id", "ts purchase_ts"))

    path = in_two_runs(spark, tmp_dir, [ev], lambda s, **k: jobs.click_purchase_join(*sides(s), **k), order="ts")
    clicks, buys = sides(ev)
    want = interval_join(clicks, buys.withColumnRenamed("user_id", "p"), "user_id", "p", "click_ts", "purchase_ts",
                         -600, 600).drop("p")
    same(spark.read.parquet(path), want)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_changelog_joins(spark, tmp_dir, how):
    o, c = catalog._emp_dept(spark, SF_SMALL)
    path = in_two_runs(spark, tmp_dir, [o, c], lambda a, b, **k: jobs.changelog_join(
        a, b, "o_custkey", "c_custkey", how=how, **k))
    same(jobs.read_join(spark, path), keyed_join(o, c, "o_custkey", "c_custkey", how))


def test_inner_join(spark, tmp_dir):
    o, c = catalog._emp_dept(spark, SF_SMALL)
    path = in_two_runs(spark, tmp_dir, [o, c], lambda a, b, **k: jobs.inner_join(a, b, "o_custkey", "c_custkey", **k))
    same(spark.read.parquet(path), keyed_join(o, c, "o_custkey", "c_custkey"))


def test_cdc(spark, tmp_dir):
    ev = load_table(spark, SF_SMALL, "events").select("user_id", "event_id", "ts", "event_type", "value")
    gone, order = F.col("event_type") == "error", ["ts", "event_id"]
    path = in_two_runs(spark, tmp_dir, [ev], lambda s, **k: jobs.apply_change_stream(
        s, keys=["user_id"], order=order, is_delete=gone, **k))
    same(BatchLog(spark, path, ["user_id"], order).read(), apply_changes(ev, ["user_id"], order, gone))


def test_sku_window(spark, tmp_dir):
    li = load_table(spark, SF_SMALL, "lineitem").select("l_partkey", "l_shipdate", "l_extendedprice", "l_discount")
    path = in_two_runs(spark, tmp_dir, [li], lambda s, **k: jobs.sku_order_window(s, **k, delay="4000 days"),
                       order="l_shipdate")
    same(jobs.read_sku_orders(spark, path), catalog.QUERIES["sku_order_window"](spark, SF_SMALL))


def test_late_rows(spark, tmp_dir):
    rows = spark.createDataFrame([(i, 100 - i) for i in range(40)], "arrival long, ms long").select(
        "arrival", F.timestamp_seconds(F.col("ms") * 3600).cast("timestamp_ntz").alias("ts"))
    path, src = f"{tmp_dir}/late", f"{tmp_dir}/src"
    for part in (rows.where("arrival < 20"), rows.where("arrival >= 20")):
        part.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(rows.schema).parquet(src)
        drain(jobs.late_side_output(stream, path, f"{tmp_dir}/ck", ["arrival"], "ts", trigger=jobs.ONCE))
    late = spark.read.parquet(f"{path}/late")
    assert sorted(r.arrival for r in late.collect()) == list(range(7, 40))
