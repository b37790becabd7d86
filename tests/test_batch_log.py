"""K3/K4 result logs and catalog tables: order, deletes, replay, restart, names."""

import uuid

import pytest
from pyspark.sql import functions as F

from strata import schemas
from strata.sinks import catalog_tables, fan_out
from strata.sinks.batch_log import BatchLog


def rows(spark, data, ddl="k string, v string, ts long"):
    return spark.createDataFrame(data, ddl)


def state(log, **options):
    return {r.k: r.v for r in log.read(**options).collect()}


def test_order_beats_arrival_over_batches(spark, tmp_dir):
    log = BatchLog(spark, f"{tmp_dir}/o", ["k"], ["ts"])
    log.append(rows(spark, [("a", "new", 9), ("b", "x", 9)]), 0)
    log.append(rows(spark, [("a", "old", 2)]), 1)          # an older change, later
    assert state(log) == {"a": "new", "b": "x"}
    log.append(rows(spark, [("b", None, 10)]), 2, is_delete=F.lit(True))
    log.append(rows(spark, [("b", "before its delete", 8)]), 3)
    assert state(log) == {"a": "new"}
    log.append(rows(spark, [("a", "same time, later", 9)]), 4)
    assert state(log) == {"a": "same time, later"}
    assert state(log, before=1) == {"a": "new", "b": "x"}


def test_shuffled_rows_of_one_batch(spark, tmp_dir):
    data = [("a", str(i), i) for i in range(20)]
    for n, order in enumerate((data, data[::-1])):
        log = BatchLog(spark, f"{tmp_dir}/t{n}", ["k"], ["ts"])
        log.append(rows(spark, order).repartition(5), 0)
        assert state(log) == {"a": "19"}


def test_replay_replaces_and_other_queries_add(spark, tmp_dir):
    log = BatchLog(spark, f"{tmp_dir}/r", ["k"], measures=["n"])
    one = [rows(spark, [("a", n)], "k string, n long") for n in (1, 2, 5)]
    log.append(one[0], 0, run="q-1")
    log.append(one[1], 1, run="q-1")
    log.append(one[1], 1, run="q-1")                       # replay of batch 1
    assert log.read().first().n == 3
    log.append(one[2], 0, run="q-2")                       # a new checkpoint counts from 0
    assert log.read().first().n == 8


def test_seed_is_repeated_and_loses_to_the_stream(spark, tmp_dir):
    log = BatchLog(spark, f"{tmp_dir}/s", ["k"], ["ts"])
    log.seed(rows(spark, [("a", "half", 1)]))              # broke off
    log.seed(rows(spark, [("a", "seed", 1), ("b", "seed", 1)]))
    assert state(log) == {"a": "seed", "b": "seed"}
    log.append(rows(spark, [("a", "stream", 1)]), 0)
    log.seed(rows(spark, [("a", "seed", 1), ("b", "seed", 1)]))
    assert state(log) == {"a": "stream", "b": "seed"}


def test_columns_named_like_the_logs_own(spark, tmp_dir):
    ddl = "row string, gone boolean, batch string, run int, at_end int, part_x string, _del int"
    log = BatchLog(spark, f"{tmp_dir}/n", ["row"], ["at_end"])
    log.append(rows(spark, [("a", True, "b9", 7, 1, "p", 3)], ddl), 0)
    assert [tuple(r) for r in log.read().collect()] == [("a", True, "b9", 7, 1, "p", 3)]


def test_empty_and_growing(spark, tmp_dir):
    log = BatchLog(spark, f"{tmp_dir}/e", ["k"], ["ts"])
    with pytest.raises(ValueError):
        log.read()
    assert log.read("k string").count() == 0
    log.append(rows(spark, []), 0)
    log.append(rows(spark, [("a", "x", 1)]), 1)
    log.append(rows(spark, [("b", "y", 1, 5)], "k string, v string, ts long, more int"), 2)
    assert {r.k: r.more for r in log.read().collect()} == {"a": None, "b": 5}


ROUTED = "sink_table string, pk_value string, type string, ts string, data map<string,string>"


def test_fan_out_is_one_write_and_keeps_every_column(spark, tmp_dir):
    data = {"id": "1", "ts": "777", "batch": "b9", "pk_value": "p", "tie": "t", "_del": "d", "name": "n"}
    many = [(f"dim_{i}", "1", "insert", "5", data) for i in range(30)]
    counts = []
    for n, frame in enumerate((many[:1], many)):
        spark.sparkContext.setJobGroup(f"fan-{tmp_dir}-{n}", "")
        fan_out.write_destinations(spark.createDataFrame(frame, ROUTED).coalesce(1), f"{tmp_dir}/d{n}", 0)
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fan-{tmp_dir}-{n}")))
    spark.sparkContext.setJobGroup("tests", "")
    assert counts[0] == counts[1]
    got = fan_out.read_destination(spark, f"{tmp_dir}/d1", "dim_7", list(data), key="key")
    assert got.first().asDict() == {"key": "1", **data}
    fan_out.write_destinations(spark.createDataFrame(
        [("dim_7", "1", "update", "4", {"name": "older"}), ("dim_8", "1", "delete", "6", None),
         ("dim_9", "1", "update", "many", {"name": "no time"})], ROUTED), f"{tmp_dir}/d1", 1)
    names = {t: [r.name for r in fan_out.read_destination(spark, f"{tmp_dir}/d1", t, ["name"]).collect()]
             for t in ("dim_7", "dim_8", "dim_9", "dim_none")}
    assert names == {"dim_7": ["n"], "dim_8": [], "dim_9": ["n"], "dim_none": []}


def config(spark, columns, pk="id", table="dim_a"):
    return spark.createDataFrame([("a", None, table, "dim", columns, pk, None)], schemas.CONFIG_ROW)


def test_catalog_table_upserts(spark, tmp_dir):
    db = f"strata_{uuid.uuid4().hex[:10]}"
    wanted = catalog_tables.create_tables(config(spark, "id,ts,change,name"), db, f"{tmp_dir}/it's")
    assert wanted == {"dim_a": ("id", ["id", "ts", "change", "name"])}

    def put(*data):
        catalog_tables.upsert(spark.createDataFrame(data, ROUTED), db, "dim_a", f"{tmp_dir}/staging")

    def now():
        return {r.id: (r.ts, r.change, r.name) for r in catalog_tables.read_table(spark, db, "dim_a").collect()}

    def row(i, ts, name, op="update"):
        return ("dim_a", str(i), op, str(ts), {"id": str(i), "ts": "t", "change": "c", "name": name})

    put(*[row(i, 5, "first") for i in range(100)])
    assert len(now()) == 100
    put(row(3, 9, "newer"), row(4, 2, "older"), row(5, 6, None, "delete"))
    want = {str(i): ("t", "c", "first") for i in range(100) if i != 5} | {"3": ("t", "c", "newer")}
    assert now() == want                       # other keys, in their buckets or not, are as they were
    put(row(3, 9, "newer"), row(5, 5, "before its delete"))
    assert now() == want                       # replay, and an older change of a deleted key
    catalog_tables.create_tables(config(spark, "id,ts,change,name,more"), db, f"{tmp_dir}/it's")
    put(("dim_a", "3", "update", "10", {"id": "3", "more": "m"}))
    got = {r.id: (r.name, r.more) for r in catalog_tables.read_table(spark, db, "dim_a").collect()}
    assert got["3"] == (None, "m") and got["4"] == ("first", None) and len(got) == 99
    with pytest.raises(ValueError, match="its own"):
        catalog_tables.create_tables(config(spark, "id,_change"), db, f"{tmp_dir}/it's")
    assert spark.conf.get(catalog_tables.OVERWRITE, "static").lower() == "static"
