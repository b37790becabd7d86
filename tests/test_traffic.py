"""F8 page-log edges for the traffic flags and window; F4 dictionary freshness."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import traffic


def _log(spark, rows):
    data = [(i, dt.datetime.fromisoformat(ts), mid, "v1", "web", "ar1", dur) for i, ts, mid, dur in rows]
    return spark.createDataFrame(data, "event_id long, ts timestamp_ntz, mid long, vc string, ch string, "
                                       "ar string, during_time long")


def test_flags_same_day_midnight_gap_and_order(spark):
    log = _log(spark, [
        (4, "2024-01-02 00:05:00", 1, 10),   # after midnight: new day -> uv, and 13 h gap -> sv
        (1, "2024-01-01 10:00:00", 1, 10),   # first ever (arrives out of order)
        (2, "2024-01-01 10:20:00", 1, 10),   # same day, inside the gap
        (3, "2024-01-01 11:00:01", 1, 10),   # same day, gap > 30 min -> new session
        (5, "2024-01-01 10:00:00", 2, 10),
    ])
    got = {r.event_id: (r.is_new, r.uv, r.sv) for r in traffic.page_view_flags(log).collect()}
    assert got == {1: ("1", 1, 1), 2: ("0", 0, 0), 3: ("0", 0, 1), 4: ("0", 1, 1), 5: ("1", 1, 1)}


def test_window_measures(spark):
    log = _log(spark, [(1, "2024-01-01 10:00:01", 1, 5), (2, "2024-01-01 10:00:03", 1, 7),
                       (3, "2024-01-01 10:00:12", 1, 1)])
    out = traffic.traffic_window(traffic.page_view_flags(log), "10 seconds").orderBy("stt", "is_new").collect()
    # is_new is a dimension: the device's first view forms its own row.
    assert [(r.stt, r.edt, r.is_new, r.pv_ct, r.uv_ct, r.sv_ct, r.dur_sum) for r in out] == [
        ("2024-01-01 10:00:00", "2024-01-01 10:00:10", "0", 1, 0, 0, 7),
        ("2024-01-01 10:00:00", "2024-01-01 10:00:10", "1", 1, 1, 1, 5),
        ("2024-01-01 10:00:10", "2024-01-01 10:00:20", "0", 1, 0, 0, 1)]


def test_session_start_from_last_page(spark):
    log = _log(spark, [(1, "2024-01-01 10:00:00", 1, 1), (2, "2024-01-01 10:00:05", 1, 1)]) \
        .withColumn("last_page_id", F.when(F.col("event_id") == 2, "home"))
    got = {r.event_id: r.sv for r in traffic.page_view_flags(log, last_page="last_page_id").collect()}
    assert got == {1: 1, 2: 0}


def test_refreshing_dictionary_sees_new_rows(spark, tmp_dir):
    from strata.sources.jdbc import Refreshing
    path = f"{tmp_dir}/dic"
    spark.createDataFrame([("1", "a")], "dic_code string, dic_name string").write.parquet(path)
    now = [0.0]
    dic = Refreshing(lambda: spark.read.parquet(path), max_age_s=60, clock=lambda: now[0])
    assert dic.get().count() == 1
    # Another system adds a code (a write through this session would refresh
    # Spark's cache of the path by itself).
    import pyarrow as pa
    import pyarrow.parquet as pq
    pq.write_table(pa.table({"dic_code": ["2"], "dic_name": ["b"]}), f"{path}/added.parquet")
    assert dic.get().count() == 1      # within max age: cached copy
    now[0] = 61.0
    assert dic.get().count() == 2      # expired: re-read sees the new code


def test_page_log_json_to_window(spark):
    from strata.operators.parse import parse_page_log
    lines = [
        '{"common":{"mid":"m1","vc":"v1","ch":"web","ar":"1","is_new":"1"},"page":{"during_time":100},"ts":1704103200000}',
        '{"common":{"mid":"m1","vc":"v1","ch":"web","ar":"1","is_new":"1"},"page":{"last_page_id":"home","during_time":50},"ts":1704103205000}',
        '{"common":{"vc":"v1"},"page":{"during_time":1},"ts":1704103206000}',
        "{bad",
    ]
    log = parse_page_log(spark.createDataFrame([(v,) for v in lines], "value string"))
    assert log.count() == 2
    flagged = traffic.page_view_flags(log, tiebreak="log_ms", last_page="last_page_id")
    out = traffic.traffic_window(flagged, "10 seconds").collect()
    assert [(r.stt, r.pv_ct, r.uv_ct, r.sv_ct, r.dur_sum) for r in out if r.is_new == "1"] == [
        ("2024-01-01 10:00:00", 1, 1, 1, 100)]
    assert sum(r.pv_ct for r in out) == 2 and sum(r.sv_ct for r in out) == 1
