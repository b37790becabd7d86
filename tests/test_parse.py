"""P1-P3, P13, S7: JSON parsing, dirty split, control filter, delimited text."""

import pytest
from pyspark.sql import functions as F

from strata.functions.text import split_list
from strata.operators.parse import (drop_control_records, flag_dirty, parse_delimited,
                                    parse_envelopes, split_dirty)

F7 = [('{"a":1}', False), ("{bad", True), ("", True), ("null", True), ("[1]", True), ("1", True),
      ("{'a':1}", True), ("{a:1}", True), ('{"a":1,"a":2}', True), ("{}", False),
      ('{"a":1} trailing', False)]  # trailing text is accepted by the strict parser too


def test_dirty_flags_f7(spark):
    df = spark.createDataFrame([(v,) for v, _ in F7] + [(None,)], "value string")
    got = {r["value"]: r["is_dirty"] for r in flag_dirty(df).collect()}
    assert None not in got  # NULL messages are dropped
    assert got == {v: d for v, d in F7}


def test_split_dirty_keeps_original_text(spark):
    df = spark.createDataFrame([('{"a":1}',), ("{bad",)], "value string")
    clean, dirty = split_dirty(df)
    assert [r.value for r in clean.collect()] == ['{"a":1}']
    assert [r.value for r in dirty.collect()] == ["{bad"]


def test_control_filter_keeps_null_type(spark):
    types = ["insert", "update", "delete", "bootstrap-start", "bootstrap-insert", "bootstrap-complete", None]
    df = spark.createDataFrame([(t,) for t in types], "type string")
    kept = [r.type for r in drop_control_records(df).collect()]
    assert sorted(kept, key=str) == sorted(["insert", "update", "delete", "bootstrap-insert", None], key=str)


@pytest.mark.parametrize("text,want", [
    ("a,b,", ["a", "b"]), (",,", []), ("", [""]), ("id, tm_name", ["id", " tm_name"]),
    (",a", ["", "a"]), ("a,,b", ["a", "", "b"]), ("a", ["a"]),
])
def test_split_list_like_jvm_split(spark, text, want):
    got = spark.createDataFrame([(text,)], "s string").select(split_list(F.col("s")).alias("a")).first().a
    assert got == want


EMP = [("empno", "int"), ("ename", "string"), ("deptno", "int"), ("ts", "bigint")]


def test_parse_delimited_typed(spark):
    lines = spark.createDataFrame([("7,alice,10,5000",), ("8,bob,20,6000,",)], "value string")
    rows = parse_delimited(lines, EMP).collect()
    assert [tuple(r) for r in rows] == [(7, "alice", 10, 5000), (8, "bob", 20, 6000)]


def test_parse_delimited_strict_and_lenient(spark):
    lines = spark.createDataFrame([("x,alice,10,5000",)], "value string")
    with pytest.raises(Exception):
        parse_delimited(lines, EMP, strict=True).collect()
    assert parse_delimited(lines, EMP, strict=False).first().empno is None


def test_envelope_map_access(spark):
    raw = spark.createDataFrame([
        ('{"database":"shop","table":"cart_info","type":"insert","ts":"1","data":{"id":"1"},"old":null}',),
        ("not json",)], "value string")
    env = parse_envelopes(raw)
    assert env.count() == 1
    row = env.select(F.col("data")["id"].alias("id"), F.col("data")["missing"].alias("m")).first()
    assert (row.id, row.m) == ("1", None)
