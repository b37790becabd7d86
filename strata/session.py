"""Session defaults, the shared checkpoint folder and the table loader."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. They are runtime-settable SQL confs, so they are
# applied to whatever session the caller passes in; no second session is built.
SESSION_DEFAULTS = {
    # Event time and every fixed-offset date helper assume a UTC session.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keyed streaming state spills to disk instead of living on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Checkpoint each batch's state changes instead of a full snapshot.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SESSION_DEFAULTS`` to ``spark`` and return it."""
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream state and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; that value always wins.
    Only when it is unset (local runs and tests) a folder is chosen here and
    registered on the context, so later calls agree.
    """
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # setCheckpointDir adds a per-application sub folder; its parent is ours.
        return os.path.dirname(current.rstrip("/"))
    master = sc.master or ""
    if master == "local" or master.startswith("local["):
        base = tempfile.mkdtemp(prefix="strata-ckpt-")
    else:
        # A cluster without spark.checkpoint.dir: the warehouse, if it is shared
        # storage. A folder on each machine's own disk would lose rows silently.
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if "://" not in warehouse or warehouse.startswith("file:"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = f"{warehouse.rstrip('/')}/_strata_checkpoints"
    sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; column pruning and filters push into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Spread rows over all cores when the input arrived in fewer partitions
    than there are cores (a small table or one big row group is one scan
    task). On large inputs the scan already has more tasks than cores and this
    is a no-op. Apply it after projection and filters, before per-row work."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
