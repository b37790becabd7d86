"""Date helpers at a fixed +08:00 offset."""

import pytest
from pyspark.sql import functions as F

from strata.functions import dates


def test_to_ts_date_and_full(spark):
    df = spark.createDataFrame([("2023-03-18", "2023-03-18 08:00:00")], "d string, f string")
    r = df.select(dates.to_ts(F.col("d")).alias("a"), dates.to_ts(F.col("f"), is_full=True).alias("b")).first()
    assert r.a == 1679068800000
    assert r.b == 1679068800000 + 8 * 3600 * 1000


def test_round_trip_formats(spark):
    df = spark.createDataFrame([(1679068800000,)], "ms long")
    r = df.select(dates.to_date(F.col("ms")).alias("d"), dates.to_ymd_hms(F.col("ms")).alias("f"),
                  dates.to_ymd_hms(F.col("ms"), "+00:00").alias("u")).first()
    assert (r.d, r.f, r.u) == ("2023-03-18", "2023-03-18 00:00:00", "2023-03-17 16:00:00")


def test_bad_text(spark):
    df = spark.createDataFrame([("18/03/2023",)], "d string")
    with pytest.raises(Exception):
        df.select(dates.to_ts(F.col("d"))).collect()
    assert df.select(dates.to_ts(F.col("d"), strict=False).alias("x")).first().x is None
