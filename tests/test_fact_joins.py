"""P4-P6 cart-add deltas, J1 lookup, J3 interval join bounds, J4-J7 joins."""

import datetime as dt

from pyspark.sql import functions as F

from strata import schemas
from strata.operators.fact import cart_add, lookup
from strata.operators.joins import interval_join, keyed_join


def _cart(spark, rows):
    full = [("shop", "cart_info", t, ts, d, o) for t, ts, d, o in rows]
    return spark.createDataFrame(full, schemas.ENVELOPE)


def _d(i, n, src="2401"):
    return {"id": i, "user_id": "u", "sku_id": "s", "sku_num": n, "source_type": src}


def test_cart_add_f5(spark):
    env = _cart(spark, [
        ("insert", "1", _d("1", "2"), None),
        ("update", "2", _d("2", "5"), {"sku_num": "3"}),     # increase by 2
        ("update", "3", _d("3", "1"), {"sku_num": "3"}),     # decrease: dropped
        ("update", "4", _d("4", "3"), {"sku_num": "3"}),     # equal: dropped
        ("update", "5", _d("5", "9"), {"other": "x"}),       # no old count: dropped
        ("update", "6", _d("6", "x"), {"sku_num": "1"}),     # not a number: dropped
        ("delete", "7", _d("7", "1"), None),
    ])
    got = {r.id: r.sku_num for r in cart_add(env).collect()}
    assert got == {"1": "2", "2": "2"}


def test_lookup_inner_drops_missing_and_duplicates_repeat(spark):
    facts = spark.createDataFrame([("1", "2401"), ("2", "9999")], "id string, source_type string")
    dic = spark.createDataFrame([("2401", "search"), ("2401", "search-dup")], "dic_code string, dic_name string")
    got = sorted((r.id, r.source_type_name) for r in lookup(facts, dic).collect())
    assert got == [("1", "search"), ("1", "search-dup")]


def _ts(s):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)


def test_interval_join_bounds_inclusive(spark):
    emp = spark.createDataFrame([(1, 10, _ts(100))], "empno int, deptno int, ets timestamp_ntz")
    dept = spark.createDataFrame([(10, "a", _ts(95)), (10, "b", _ts(105)), (10, "c", _ts(94.999)),
                                  (10, "d", _ts(105.001)), (20, "e", _ts(100))],
                                 "d_deptno int, dname string, dts timestamp_ntz")
    got = sorted(r.dname for r in interval_join(emp, dept, "deptno", "d_deptno", "ets", "dts", -5, 5).collect())
    assert got == ["a", "b"]


def test_interval_join_hot_key_matches_brute_force(spark):
    ev = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 17).alias("k"),
        F.col("id").alias("lid"),
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(secs=(F.col("id") * 37) % 3600)).cast(
            "timestamp_ntz").alias("ts"))
    left = ev.where(F.col("lid") % 2 == 0)
    right = ev.where(F.col("lid") % 2 == 1).select(F.col("k").alias("rk"), F.col("lid").alias("rid"),
                                                    F.col("ts").alias("rts"))
    got = interval_join(left, right, "k", "rk", "ts", "rts", -60, 30).select("lid", "rid")
    want = left.join(right, (F.col("k") == F.col("rk")) & (F.col("rts") >= F.col("ts") - F.expr("INTERVAL 60 SECONDS"))
                     & (F.col("rts") <= F.col("ts") + F.expr("INTERVAL 30 SECONDS"))).select("lid", "rid")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_keyed_join_types(spark):
    emp = spark.createDataFrame([(1, 10), (2, 30)], "empno int, deptno int")
    dept = spark.createDataFrame([(10, "a"), (20, "b")], "d_deptno int, dname string")
    n = {how: keyed_join(emp, dept, "deptno", "d_deptno", how, broadcast_max_rows=100).count()
         for how in ("inner", "left", "right", "full")}
    assert n == {"inner": 1, "left": 2, "right": 2, "full": 3}


def test_outer_joins_pad_null_keys(spark):
    emp = spark.createDataFrame([(1, 10), (2, None), (3, None)], "empno int, deptno int")
    dept = spark.createDataFrame([(10, "a"), (None, "b")], "d_deptno int, dname string")
    for how, n in (("left", 3), ("right", 2), ("full", 4), ("inner", 1)):
        got = keyed_join(emp, dept, "deptno", "d_deptno", how)
        want = emp.join(dept, F.col("deptno") == F.col("d_deptno"), how)
        assert got.count() == n and got.exceptAll(want).count() == 0


def test_facts_as_a_named_view(spark):
    env = _cart(spark, [("insert", "1", _d("1", "2"), None), ("update", "2", _d("2", "5"), {"sku_num": "3"})])
    cart_add(env).createOrReplaceTempView("cart_add_view")
    assert [r.n for r in spark.sql("SELECT sum(CAST(sku_num AS INT)) AS n FROM cart_add_view").collect()] == [4]


def test_cart_add_rejects(spark):
    env = _cart(spark, [("insert", "1", _d("1", "x"), None), ("update", "2", _d("2", "5"), {"sku_num": "y"}),
                        ("insert", "3", _d("3", "1"), None)])
    facts, rejects = cart_add(env, rejects=True)
    assert [r.id for r in facts.collect()] == ["3"] and rejects.count() == 2
