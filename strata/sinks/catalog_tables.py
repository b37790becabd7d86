"""Dimension rows in the catalog tables that the configuration creates.

A table has the configured columns, all STRING, and two of its own: ``change``
(time, tie and whether the key is deleted) and ``bucket`` (of the key's hash), with
underscores in front until they clash with no configured column. A micro-batch
replaces only the buckets of its keys, by Spark's dynamic partition overwrite. Stored
rows take part by their ``change``, so an older change in a later batch loses, a
deleted key stays deleted, and a replayed batch changes nothing.

An overwrite is not atomic over buckets. A job that broke off repeats its batch; the
log of ``fan_out`` holds every change, should a table have to be built anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.cdc import latest_per_key
from strata.operators.dim import literal, quoted, table_columns

BUCKETS = 32
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def own_columns(columns: list[str]) -> tuple[str, str]:
    """Names of the change and bucket columns beside ``columns``."""
    taken, out = {c.lower() for c in columns}, []
    for name in ("change", "bucket"):
        while name in taken:
            name = "_" + name
        out.append(name)
    return out[0], out[1]


def configured(config: DataFrame) -> dict[str, tuple[str, list[str]]]:
    """Destination -> (key column, columns), from the live configuration (config-sized)."""
    out: dict[str, tuple[str, list[str]]] = {}
    keys = {r.sink_table: r.pk for r in config.select(
        "sink_table", F.coalesce("sink_pk", F.lit("id")).alias("pk")).collect()}
    for r in table_columns(config).orderBy("sink_table", "ordinal").collect():
        columns = out.setdefault(r.sink_table, (keys[r.sink_table], []))[1]
        if r.column_name and r.column_name not in columns:
            columns.append(r.column_name)
    return out


def create_tables(config: DataFrame, database: str, location: str) -> dict[str, tuple[str, list[str]]]:
    """Create the tables that the configuration names, and add the columns that a
    change of it brought; none is ever dropped. Returns what is configured."""
    spark = config.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)} LOCATION {literal(location)}")
    wanted = configured(config)
    for table, (_, columns) in sorted(wanted.items()):
        name = f"{quoted(database)}.{quoted(table)}"
        change, bucket = own_columns(columns)
        if not spark.catalog.tableExists(name):
            spec = ", ".join(f"{quoted(c)} STRING" for c in columns)
            spark.sql(f"CREATE TABLE {name} ({spec}, {quoted(change)} STRUCT<pk: STRING, ts: BIGINT, tie: BIGINT, "
                      f"gone: BOOLEAN>, {quoted(bucket)} INT) USING parquet PARTITIONED BY ({quoted(bucket)}) "
                      f"LOCATION {literal(f'{location}/{table}')}")
            continue
        stored = spark.table(name)
        if clash := {c.lower() for c in columns} & {c.lower() for c in _own(stored)}:
            raise ValueError(f"{name} keeps its own {sorted(clash)}; it cannot become a configured column")
        have = {c.lower() for c in stored.columns}
        if new := [c for c in columns if c.lower() not in have]:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'{quoted(c)} STRING' for c in new)})")
    return wanted


def _own(df: DataFrame) -> tuple[str, str]:
    """The change and bucket columns of a table: its one struct, and its last column."""
    struct = next(f.name for f in df.schema.fields if f.dataType.typeName() == "struct")
    return struct, df.columns[-1]


def upsert(routed: DataFrame, database: str, table: str, staging: str) -> None:
    """Bring one table up to its rows in ``routed`` (``pk_value, type, ts, data``). The new
    buckets are written to the folder ``staging`` first, as Spark replaces no table that
    the same query reads."""
    spark = routed.sparkSession
    name = f"{quoted(database)}.{quoted(table)}"
    stored = spark.table(name)
    change, bucket = _own(stored)
    columns = [c for c in stored.columns if c not in (change, bucket)]
    new = routed.select(
        *[F.element_at("data", F.lit(c)).alias(c) for c in columns],
        F.struct(F.col("pk_value").alias("pk"), F.col("ts").try_cast("bigint").alias("ts"),
                 F.xxhash64(F.to_json("data"), "type").alias("tie"),
                 F.coalesce(F.col("type") == "delete", F.lit(False)).alias("gone")).alias(change),
        F.pmod(F.xxhash64("pk_value"), F.lit(BUCKETS)).cast("int").alias(bucket)).persist()
    try:
        touched = [r[0] for r in new.select(bucket).distinct().collect()]  # at most BUCKETS
        if not touched:
            return
        both = stored.where(F.col(bucket).isin(touched)).unionByName(new).withColumns({
            "_pk": F.col(f"{change}.pk"), "_ts": F.col(f"{change}.ts"), "_tie": F.col(f"{change}.tie")})
        kept = latest_per_key(both, [bucket, "_pk"], ["_ts", "_tie"]).select(*stored.columns)
        kept.repartition(bucket).write.mode("overwrite").parquet(f"{staging}/{table}")
        staged = spark.read.schema(stored.schema).parquet(f"{staging}/{table}")
        # The setting alone reaches insertInto; a static overwrite would empty the other buckets.
        before = spark.conf.get(OVERWRITE, "static")
        spark.conf.set(OVERWRITE, "dynamic")
        try:
            staged.repartition(bucket).write.insertInto(name, overwrite=True)
        finally:
            spark.conf.set(OVERWRITE, before)
    finally:
        new.unpersist()


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    """The live rows of a dimension table, configured columns only."""
    rows = spark.table(f"{quoted(database)}.{quoted(table)}")
    change, bucket = _own(rows)
    return rows.where(~F.col(f"{change}.gone")).drop(change, bucket)
