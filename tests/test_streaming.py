"""Streaming operators: text-stream interval join (emp/dept lines) and the
retracting changelog join."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators.joins import interval_join
from strata.operators.parse import parse_delimited
from strata.sinks.batch_log import parquet_or_none
from strata.streaming import jobs, state
from strata.streaming.changelog import materialize


def _write_lines(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_text_stream_interval_join_f9_f10(spark, tmp_dir):
    emp_dir, dept_dir = f"{tmp_dir}/emp", f"{tmp_dir}/dept"
    _write_lines(emp_dir, "a.txt", ["1,alice,10,100000", "2,bob,20,100000"])
    _write_lines(dept_dir, "a.txt", ["10,ops,95000", "10,eng,105000", "10,late,94999", "10,early,105001",
                                     "30,none,100000"])
    emp = parse_delimited(spark.readStream.text(emp_dir),
                          [("empno", "int"), ("ename", "string"), ("deptno", "int"), ("ts", "bigint")])
    dept = parse_delimited(spark.readStream.text(dept_dir),
                           [("d_deptno", "int"), ("dname", "string"), ("d_ts", "bigint")])
    emp = emp.withColumn("ets", F.timestamp_millis("ts")).withWatermark("ets", "0 seconds")
    dept = dept.withColumn("dts", F.timestamp_millis("d_ts")).withWatermark("dts", "0 seconds")
    joined = interval_join(emp, dept, "deptno", "d_deptno", "ets", "dts", -5, 5)
    q = (joined.select("empno", "dname").writeStream.format("memory").queryName("ij_test")
         .option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.empno, r.dname) for r in spark.sql("SELECT * FROM ij_test").collect())
    assert got == [(1, "eng"), (1, "ops")]


def _batches(spark, tmp_dir, name, parts):
    """A stream with one micro-batch per part (a part may be empty)."""
    for df in parts:
        df.coalesce(1).write.mode("append").parquet(f"{tmp_dir}/{name}")
    return spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/{name}")


def _changelog(spark, tmp_dir, steps, how="left", **options):
    """Feed (left rows, right rows) steps one after another; the changes so far."""
    from strata.streaming.replay import drain
    ldl, rdl = "o_orderkey long, o_custkey long, at timestamp", "c_custkey long, c_name string, big long"
    for left, right in steps:
        spark.createDataFrame(left, ldl).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/l")
        spark.createDataFrame(right, rdl).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/r")
        streams = [spark.readStream.schema(d).parquet(f"{tmp_dir}/{n}") for d, n in ((ldl, "l"), (rdl, "r"))]
        drain(jobs.changelog_join(*streams, "o_custkey", "c_custkey", f"{tmp_dir}/j", f"{tmp_dir}/ck", how,
                                  jobs.ONCE, **options))
    return spark.read.parquet(f"{tmp_dir}/j")


STEPS = [([(1, 10, None), (2, 10, None), (4, 40, None), (5, None, None)], []), ([], [(10, "c10", 1)]),
         ([(3, 10, None)], [(None, "nobody", 2)])]


@pytest.mark.parametrize("salts", [1, 3])
def test_changelog_left_join_retracts(spark, tmp_dir, salts):
    # orders 1 and 2 of customer 10 arrive before it; order 3 after; order 4 has no customer.
    changes = _changelog(spark, tmp_dir, STEPS, salts=salts)
    ops = sorted(((r.op, r.o_orderkey, r.c_name) for r in changes.collect()), key=str)
    assert ops == sorted([("+I", 1, None), ("+I", 2, None), ("-D", 1, None), ("-D", 2, None), ("+I", 5, None),
                          ("+I", 1, "c10"), ("+I", 2, "c10"), ("+I", 3, "c10"), ("+I", 4, None)], key=str)
    assert sorted(((r.o_orderkey, r.c_name) for r in jobs.read_join(spark, f"{tmp_dir}/j").collect()), key=str) == [
        (1, "c10"), (2, "c10"), (3, "c10"), (4, None), (5, None)]


def test_changelog_state_holds_rows_by_key(spark, tmp_dir):
    """The state after each batch; rows with a NULL key are not kept."""
    _changelog(spark, tmp_dir, STEPS)
    held = state.rows(spark, f"{tmp_dir}/ck", variable="left_rows")
    assert sorted((r.key.key, r.list_element.o_orderkey) for r in held.collect()) == [
        (10, 1), (10, 2), (10, 3), (40, 4)]
    assert [r.list_element.c_name for r in state.rows(
        spark, f"{tmp_dir}/ck", variable="right_rows").collect()] == ["c10"]
    assert state.rows(spark, f"{tmp_dir}/ck", variable="left_rows", batch=0).count() == 3
    assert [r.operatorName for r in state.operators(spark, f"{tmp_dir}/ck").collect()] == [
        "transformWithStateInPySparkExec"]


def test_changelog_full_join_keeps_types(spark, tmp_dir):
    from datetime import datetime
    big, at = 2 ** 53 + 1, datetime(2024, 1, 2, 3, 4, 5)
    steps = [([], [(7, "c7", big)]), ([(big, 8, at)], []), ([(1, 7, at)], []), ([], [(8, "c8", None)])]
    _changelog(spark, tmp_dir, steps, how="full")
    rows = sorted(jobs.read_join(spark, f"{tmp_dir}/j").collect())
    assert [(r.o_orderkey, r.at, r.c_name, r.big) for r in rows] == [(1, at, "c7", big), (big, at, "c8", None)]
    with pytest.raises(ValueError, match="salted"):
        _changelog(spark, f"{tmp_dir}/s", steps[:1], how="full", salts=2)


def _until(query, done, seconds=60):
    import time
    end = time.time() + seconds
    while not done():
        assert query.isActive and time.time() < end, query.exception()
        time.sleep(0.5)


def test_changelog_idle_rows_leave_the_state(spark, tmp_dir):
    """With a time to live the query runs on; rows idle that long are gone from the
    store, and what they emitted is not retracted."""
    ldl, rdl = "a long, k long", "k2 long, n string"
    spark.createDataFrame([(1, 10)], ldl).coalesce(1).write.parquet(f"{tmp_dir}/l")
    spark.createDataFrame([], rdl).coalesce(1).write.parquet(f"{tmp_dir}/r")
    left, right = (spark.readStream.schema(d).parquet(f"{tmp_dir}/{n}") for d, n in ((ldl, "l"), (rdl, "r")))
    with pytest.raises(ValueError, match="trigger"):
        jobs.changelog_join(left, right, "k", "k2", f"{tmp_dir}/j", f"{tmp_dir}/ck", trigger=jobs.ONCE, ttl_s=4)
    q = jobs.changelog_join(left, right, "k", "k2", f"{tmp_dir}/j", f"{tmp_dir}/ck",
                            trigger={"processingTime": "1 second"}, ttl_s=4)

    def out():
        found = parquet_or_none(spark, f"{tmp_dir}/j")
        return [] if found is None else sorted(((r.op, r.a, r.n) for r in found.collect()), key=str)

    def held():
        return state.rows(spark, f"{tmp_dir}/ck", variable="left_rows").count()
    try:
        _until(q, lambda: out() == [("+I", 1, None)])
        _until(q, lambda: held() == 0)
        spark.createDataFrame([(10, "late")], rdl).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/r")
        spark.createDataFrame([(2, 10)], ldl).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/l")
        _until(q, lambda: ("+I", 2, "late") in out())
    finally:
        q.stop()
    assert not q.isActive
    assert [r for r in out() if r[1] == 1] == [("+I", 1, None)]


def _page(mid, ts, last=None, **common):
    import json
    return (json.dumps({"common": {"mid": mid, **common}, "page": {"last_page_id": last, "during_time": 5}, "ts": ts}),)


DAY, HOUR, MINUTE = 86_400_000, 3_600_000, 60_000


def test_traffic_windows_close_and_rejects(spark, tmp_dir):
    from strata.streaming.replay import drain
    t = 10 * DAY + 22 * HOUR
    parts = [[_page("m-1", t, ch="a"), _page("m-1", t + 1, "p", ch="a"), _page("m-2", t, ch="a")],
             [_page("m-1", t + 3 * HOUR, ch="a"), ("{bad",), ("{}",)],       # the next day: a visitor again
             [_page("m-1", t + 3 * HOUR + 1, "p", ch="a")],
             [_page("m-2", t + 10, ch="a")],                                 # behind the watermark: dropped
             [_page("m-3", t + 9 * HOUR, ch="a")]]
    stream = _batches(spark, tmp_dir, "raw", [spark.createDataFrame(p, "value string") for p in parts])
    drain(jobs.traffic_window(stream, f"{tmp_dir}/t", f"{tmp_dir}/ck", "1 hour", trigger=jobs.ONCE))
    rows = sorted((r.stt[-8:], r.is_new, r.uv_ct, r.sv_ct, r.pv_ct, r.dur_sum)
                  for r in spark.read.parquet(f"{tmp_dir}/t").collect())
    assert rows == [("01:00:00", "0", 1, 1, 2, 10), ("22:00:00", "0", 0, 0, 1, 5), ("22:00:00", "1", 2, 2, 2, 10)]
    drain(jobs.page_log_rejects(stream, f"{tmp_dir}/bad", f"{tmp_dir}/ck2", jobs.ONCE))
    assert sorted(r.value for r in spark.read.parquet(f"{tmp_dir}/bad").collect()) == ["{bad", "{}"]
    names = [r.operatorName for r in state.operators(spark, f"{tmp_dir}/ck").collect()]
    assert sorted(names) == ["stateStoreSave", "transformWithStateInPySparkExec"]
    devices = {r.operatorName: r.operatorId for r in state.operators(spark, f"{tmp_dir}/ck").collect()}
    op = devices["transformWithStateInPySparkExec"]
    # Every device is known; only days that the watermark has not left are held.
    assert sorted(r.key.mid for r in state.rows(spark, f"{tmp_dir}/ck", op, "known").collect()) == ["m-1", "m-2", "m-3"]
    days = [(r.key.mid, r.user_map_key.day) for r in state.rows(spark, f"{tmp_dir}/ck", op, "days").collect()]
    assert sorted(days) == [("m-1", 11), ("m-3", 11)]


def test_windows_are_corrected_and_then_set_late_rows_aside(spark, tmp_dir):
    from strata.streaming.replay import drain
    t = 10 * DAY
    parts = [[_page("m", t, ch="a"), _page("m", t + 2 * HOUR, ch="a")],
             [_page("m", t + 1, ch="a"), _page("m", t + 30 * MINUTE, ch="b")],   # closed, within the lateness
             [_page("m", t + 5 * HOUR, ch="a")],
             [_page("m", t + 2, ch="a"), _page("m", t + 5 * HOUR + 1, ch="a")]]  # too late; open
    stream = _batches(spark, tmp_dir, "raw", [spark.createDataFrame(p, "value string") for p in parts])
    drain(jobs.traffic_versions(stream, f"{tmp_dir}/v", f"{tmp_dir}/ck", "1 hour", "3 hours", trigger=jobs.ONCE))
    found = spark.read.parquet(f"{tmp_dir}/v")
    got = sorted((r.stt[-8:], r.ch, r.version, r.pv_ct, r.dur_sum) for r in found.where("kind = 'window'").collect())
    assert got == [("00:00:00", "a", 1, 2, 10), ("00:00:00", "b", 1, 1, 5), ("02:00:00", "a", 1, 1, 5)]
    late = found.where("kind = 'late'").collect()
    assert [(r.ch, r.late_ts.hour, r.late_ts.microsecond) for r in late] == [("a", 0, 2000)]
    # Windows past their lateness are gone from the store; two are still open or correctable.
    held = state.rows(spark, f"{tmp_dir}/ck", variable="window").collect()
    assert sorted((r.key.w - t) // HOUR for r in held) == [2, 5]


def test_sessions_and_outer_join_state(spark, tmp_dir):
    from strata.streaming.replay import drain
    t = 10 * DAY
    views = [[_page("m", t), _page("m", t + 20 * MINUTE)], [_page("m", t + 40 * MINUTE), _page("n", t + 41 * MINUTE)],
             [_page("m", t + 5 * HOUR)], [_page("x", t + 6 * HOUR)]]
    stream = _batches(spark, tmp_dir, "raw", [spark.createDataFrame(p, "value string") for p in views])
    drain(jobs.device_sessions(stream, f"{tmp_dir}/s", f"{tmp_dir}/ck", trigger=jobs.ONCE))
    assert sorted((r.mid, r.pv_ct, (r.edt - r.stt).seconds // 60) for r in spark.read.parquet(
        f"{tmp_dir}/s").collect()) == [("m", 1, 30), ("m", 3, 70), ("n", 1, 30)]

    ddl = "user_id long, event_id long, ts timestamp, kind string"
    base = 1_700_000_000

    def at(s):
        from datetime import datetime, timezone
        return datetime.fromtimestamp(base + s, timezone.utc)
    parts = [[(1, 1, at(0), "c"), (1, 2, at(5), "p"), (2, 3, at(1), "c"), (3, 4, at(2), "p")],
             [(9, 8, at(9000), "c"), (9, 9, at(9001), "p")], [(8, 10, at(9002), "c"), (7, 11, at(9003), "p")]]
    ev = _batches(spark, tmp_dir, "ev", [spark.createDataFrame(p, ddl) for p in parts])
    clicks = ev.where("kind = 'c'").selectExpr("user_id", "event_id click_id", "ts click_ts")
    buys = ev.where("kind = 'p'").selectExpr("user_id", "event_id purchase_id", "ts purchase_ts")
    drain(jobs.outer_click_purchase_join(clicks, buys, f"{tmp_dir}/f", f"{tmp_dir}/ck2", trigger=jobs.ONCE))
    got = {(r.user_id, r.click_id, r.purchase_id) for r in spark.read.parquet(f"{tmp_dir}/f").collect()}
    assert got == {(1, 1, 2), (2, 3, None), (3, None, 4), (9, 8, 9)}
    # Only rows that can still find a partner are held.
    left = state.rows(spark, f"{tmp_dir}/ck2", side="left").select("value.click_id").collect()
    assert sorted(r.click_id for r in left) == [8, 10]


def test_inner_interval_and_window_state_is_evicted(spark, tmp_dir):
    """J3 and A3: after the watermark has passed, the stores hold recent rows only."""
    from strata.streaming.replay import drain
    ddl = "user_id long, event_id long, ts timestamp, kind string"
    from datetime import datetime, timedelta
    d = datetime(2024, 1, 1)
    parts = [[(1, 1, d, "c"), (1, 2, d + timedelta(seconds=5), "p")],
             [(9, 8, d + timedelta(hours=3), "c"), (9, 9, d + timedelta(hours=3), "p")],
             [(8, 10, d + timedelta(hours=3, seconds=1), "c"), (8, 11, d + timedelta(hours=3, seconds=1), "p")]]
    ev = _batches(spark, tmp_dir, "ev", [spark.createDataFrame(p, ddl) for p in parts])
    clicks = ev.where("kind = 'c'").selectExpr("user_id", "event_id click_id", "ts click_ts")
    buys = ev.where("kind = 'p'").selectExpr("user_id", "event_id purchase_id", "ts purchase_ts")
    drain(jobs.click_purchase_join(clicks, buys, f"{tmp_dir}/f", f"{tmp_dir}/ck", trigger=jobs.ONCE))
    assert spark.read.parquet(f"{tmp_dir}/f").count() == 3
    left = state.rows(spark, f"{tmp_dir}/ck", side="left").select("value.click_id").distinct().collect()
    assert sorted(r.click_id for r in left) == [8, 10]

    lines = [[(1, d, 1.0, 0.0)], [(2, d + timedelta(days=40), 1.0, 0.0)], [(3, d + timedelta(days=41), 1.0, 0.0)]]
    ldl = "l_partkey long, l_shipdate timestamp_ntz, l_extendedprice double, l_discount double"
    li = _batches(spark, tmp_dir, "li", [spark.createDataFrame(p, ldl) for p in lines])
    drain(jobs.sku_order_window(li, f"{tmp_dir}/w", f"{tmp_dir}/ck2", trigger=jobs.ONCE))
    held = state.rows(spark, f"{tmp_dir}/ck2").collect()
    assert sorted(r.key.l_partkey for r in held) == [2, 3]
    assert jobs.read_sku_orders(spark, f"{tmp_dir}/w").count() == 3


def test_snapshot_rows_never_beat_changes_read_meanwhile(spark, tmp_dir):
    from strata.operators.cdc import apply_records
    from strata.streaming.replay import drain
    row = "struct<id long, v string>"
    ddl = f"op string, before {row}, after {row}, pos long"
    log = [("r", None, (1, "read"), 10), ("r", None, (2, "read"), 10), ("r", None, (3, "read"), 20),
           ("c", None, (1, "before the read"), 9), ("u", (1, "read"), (1, "meanwhile"), 11),
           ("d", (2, "read"), None, 12), ("u", (3, "x"), (3, "in the read"), 20), ("u", (3, "y"), (33, "moved"), 21),
           ("c", None, (4, "new"), 22), ("d", (5, "never seen"), None, 23), ("c", None, (None, "no key"), 24)]
    want = [(1, "meanwhile"), (4, "new"), (33, "moved")]
    import random
    for seed in range(3):
        random.Random(seed).shuffle(log)
        assert sorted(map(tuple, apply_records(spark.createDataFrame(log, ddl), "id").collect())) == want
    stream = _batches(spark, tmp_dir, "rec", [spark.createDataFrame([r], ddl) for r in log])
    drain(jobs.apply_records(stream, f"{tmp_dir}/t", f"{tmp_dir}/ck", "id", jobs.ONCE))
    assert sorted(map(tuple, jobs.read_records(spark, f"{tmp_dir}/t", "id").collect())) == want


def test_statements_take_values_as_parameters(spark):
    from strata import schemas, statements
    rows = [("d", "cart_info' OR '1'='1", "insert", "1", {"id": "1", "sku_num": "2", "source_type": "s"}, None),
            ("d", "cart_info", "insert", "1", {"id": "2", "sku_num": "many", "source_type": "s"}, None),
            ("d", "cart_info", "update", "1", {"id": "3", "sku_num": "5", "source_type": "s"}, {"sku_num": "3"})]
    env = spark.createDataFrame(rows, schemas.ENVELOPE)
    assert [(r.id, r.sku_num) for r in statements.cart_add(env).collect()] == [("3", "2")]
    assert [r.id for r in statements.cart_add(env, "cart_info' OR '1'='1").collect()] == ["1"]


def test_cart_rejects_and_numeric_order(spark, tmp_dir):
    from strata import schemas
    from strata.streaming.replay import drain
    dic = spark.createDataFrame([("s", "search")], "dic_code string, dic_name string")

    def cart(ts, num, typ="insert", old=None):
        data = {"id": "1", "user_id": "u", "sku_id": "k", "sku_num": num, "source_type": "s"}
        return ("shop", "cart_info", typ, ts, data, old)

    rows = [[cart("10", "2")], [cart("9", "1"), cart("11", "many"), cart("12", "5", "update", {"sku_num": "x"})]]
    stream = _batches(spark, tmp_dir, "env", [spark.createDataFrame(r, schemas.ENVELOPE) for r in rows])
    drain(jobs.cart_fact(stream, lambda: dic, f"{tmp_dir}/f", f"{tmp_dir}/ck", jobs.ONCE))
    assert [(r.ts, r.sku_num, r.source_type_name) for r in jobs.read_cart(spark, f"{tmp_dir}/f").collect()] == [
        ("10", "2", "search")]
    assert spark.read.parquet(f"{tmp_dir}/f/rejects").count() == 2


def test_materialize_counts(spark):
    ch = spark.createDataFrame([("+I", 1), ("+I", 1), ("-D", 1), ("+I", 2), ("-D", 2)], "op string, x int")
    assert [r.x for r in materialize(ch, ["x"]).collect()] == [1]


def test_dirty_split_side_output_stream(spark, tmp_dir):
    from strata.sinks.side_output import dirty_split_writer
    _write_lines(f"{tmp_dir}/raw", "a.txt", ['{"common":{"mid":"1"}}', "{bad", "[1]", '{"a":2}', ""])
    stream = spark.readStream.text(f"{tmp_dir}/raw")
    write = dirty_split_writer(f"{tmp_dir}/clean", f"{tmp_dir}/dirty")
    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{tmp_dir}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    write(spark.read.text(f"{tmp_dir}/raw"), 0)    # a replayed batch 0 replaces its own output
    clean = sorted(r.value for r in spark.read.parquet(f"{tmp_dir}/clean").collect())
    dirty = sorted(r.value for r in spark.read.parquet(f"{tmp_dir}/dirty").collect())
    assert clean == ['{"a":2}', '{"common":{"mid":"1"}}']
    assert dirty == ["", "[1]", "{bad"]


def test_interval_join_late_row_after_watermark(spark, tmp_dir):
    """an employee row that arrives after both sides' watermarks passed its
    range finds no partner, although matching dept rows were seen earlier."""
    emp_dir, dept_dir = f"{tmp_dir}/emp", f"{tmp_dir}/dept"
    _write_lines(emp_dir, "1.txt", ["1,alice,10,100000"])
    _write_lines(dept_dir, "1.txt", ["10,a,94000", "10,b,95000", "10,c,100000"])

    def run():
        emp = parse_delimited(spark.readStream.text(emp_dir),
                              [("empno", "int"), ("ename", "string"), ("deptno", "int"), ("ts", "bigint")])
        dept = parse_delimited(spark.readStream.text(dept_dir),
                               [("d_deptno", "int"), ("dname", "string"), ("d_ts", "bigint")])
        emp = emp.withColumn("ets", F.timestamp_millis("ts")).withWatermark("ets", "0 seconds")
        dept = dept.withColumn("dts", F.timestamp_millis("d_ts")).withWatermark("dts", "0 seconds")
        j = interval_join(emp, dept, "deptno", "d_deptno", "ets", "dts", -5, 5).select("empno", "dname")
        q = (j.writeStream.format("parquet").option("path", f"{tmp_dir}/out")
             .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
        q.awaitTermination()

    run()
    _write_lines(emp_dir, "2.txt", ["2,late,10,97000"])       # both sides are already past 100 s
    _write_lines(dept_dir, "2.txt", ["10,d,200000"])
    run()
    got = sorted((r.empno, r.dname) for r in spark.read.parquet(f"{tmp_dir}/out").collect())
    assert got == [(1, "b"), (1, "c")]
