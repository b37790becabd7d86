"""Session helpers: checkpoint folder, broadcast guard, spreading small scans."""

from pyspark.sql import functions as F

from strata.operators.sizing import broadcast_if_small, fits
from strata.session import checkpoint_root, spread


def test_checkpoint_root_prefers_cluster_setting(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    root = checkpoint_root(spark)
    if configured:
        assert root == configured.rstrip("/")
    else:
        assert root  # chosen once for local runs
    assert checkpoint_root(spark) == root


def test_broadcast_only_behind_row_check(spark):
    small = spark.range(3).withColumnRenamed("id", "k")
    assert fits(small, 3) and not fits(small, 2)
    big = spark.range(1000).withColumnRenamed("id", "k")
    facts = spark.range(10_000).select((F.col("id") % 5).alias("k"))
    hinted = facts.join(broadcast_if_small(small, 10), "k")
    plain = facts.join(broadcast_if_small(big, 10), "k")
    assert "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in plain._jdf.queryExecution().analyzed().toString().lower()
    assert hinted.count() == 6_000


def test_spread_only_when_fewer_partitions_than_cores(spark):
    one = spark.range(100).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100).repartition(spark.sparkContext.defaultParallelism * 2)
    assert spread(many) is many
