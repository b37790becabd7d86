"""Keyed state dealt over groups gives what state per key gives."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata.streaming import jobs, state
from strata.streaming.replay import drain

BIG, AT = 2 ** 53 + 1, datetime(2024, 1, 2, 3, 4, 5, 678901)
LEFT, RIGHT = "a long, k long, at timestamp, d double", "k2 long, n string, big long"
STEPS = [([(1, 10, AT, 0.1), (2, 10, None, None), (4, 40, AT, 1e300), (5, None, AT, float("nan"))], []),
         ([], [(10, "c\"10\n", BIG), (11, None, None)]), ([(3, 10, AT, 3.0), (BIG, 11, AT, 4.0)], [(None, "nobody", 2)]),
         ([(6, 70, None, None)], [(70, "", 1), (10, "again", 1)])]


def _changes(spark, path, how, **options):
    for left, right in STEPS:
        spark.createDataFrame(left, LEFT).coalesce(1).write.mode("append").parquet(f"{path}/l")
        spark.createDataFrame(right, RIGHT).coalesce(1).write.mode("append").parquet(f"{path}/r")
        streams = [spark.readStream.schema(d).parquet(f"{path}/{n}") for d, n in ((LEFT, "l"), (RIGHT, "r"))]
        drain(jobs.changelog_join(*streams, "k", "k2", f"{path}/j", f"{path}/ck", how, jobs.ONCE, **options))
    return spark.read.parquet(f"{path}/j")


@pytest.mark.parametrize("how, salts", [("left", 3), ("full", 1)])
def test_grouped_changelog(spark, tmp_dir, how, salts):
    grouped = _changes(spark, f"{tmp_dir}/g", how, groups=2, salts=salts)
    single = _changes(spark, f"{tmp_dir}/s", how)
    assert grouped.schema == single.schema
    assert sorted(map(str, grouped.collect())) == sorted(map(str, single.collect()))
    # One element per group, salt and batch, whatever the number of keys and rows.
    held = state.rows(spark, f"{tmp_dir}/g/ck", variable="left_rows")
    assert held.select("key.slot").distinct().count() <= 2 * salts


def test_groups_need_plain_columns(spark, tmp_dir):
    left = spark.readStream.schema("a array<int>, k long").parquet(tmp_dir)
    with pytest.raises(ValueError, match="grouped"):
        jobs.changelog_join(left, spark.readStream.schema(RIGHT).parquet(tmp_dir), "k", "k2", f"{tmp_dir}/j",
                            f"{tmp_dir}/ck", groups=2)


DAY, HOUR = 86_400_000, 3_600_000


def _page(mid, ts, n, last=None):
    return (json.dumps({"common": {"mid": mid, "ch": "a"}, "page": {"last_page_id": last, "during_time": n},
                        "ts": ts, "us": n % 1000, "id": BIG + n}),)


def test_grouped_first_visits(spark, tmp_dir):
    t = 10 * DAY + 22 * HOUR
    parts = [[_page(f"m-{i % 5}", t + i, i, "p" if i % 3 else None) for i in range(40)],
             [_page(f"m-{i % 7}", t + 3 * HOUR - i, i) for i in range(20)],
             [_page("m-1", t, 1), _page("m-9", t + 4 * HOUR, 2)], [_page("m-1", t + 60 * HOUR, 3)]]
    for p in parts:
        spark.createDataFrame(p, "value string").coalesce(1).write.mode("append").parquet(f"{tmp_dir}/raw")
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/raw")
    found = {}
    for name, options in (("g", {"groups": 2}), ("s", {})):
        drain(jobs.first_visit_log(stream, f"{tmp_dir}/{name}", f"{tmp_dir}/ck-{name}", trigger=jobs.ONCE, **options))
        drain(jobs.traffic_window(stream, f"{tmp_dir}/w{name}", f"{tmp_dir}/ck-w{name}", "1 hour", trigger=jobs.ONCE,
                                  **options))
        found[name] = [sorted(map(str, spark.read.parquet(f"{tmp_dir}/{p}").collect())) for p in (name, f"w{name}")]
    assert found["g"] == found["s"] and len(found["g"][0]) > 10
    # Every device is known; only days that the watermark has not left are held.
    known, days = (list(state.unpack(_List(state.rows(spark, f"{tmp_dir}/ck-g", variable=v)))) for v in ("known", "days"))
    assert sorted(known) == sorted([*(f"m-{i}" for i in range(7)), "m-9"])
    assert sorted(days) == [("m-1", 13)]


class _List:
    def __init__(self, held):
        self.held = held

    def get(self):
        return [(bytes(r.list_element.packed),) for r in self.held.select(F.col("list_element")).collect()]
