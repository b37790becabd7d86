"""DIM layer: route dimension-table changes by a live config table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.text import split_list
from strata.operators.sizing import broadcast_if_small

# A config has one row per source table; beyond this the join shuffles.
MAX_CONFIG_ROWS = 100_000
# Fixed value: primary key used when the config names none.
DEFAULT_PK = "id"


def route(envelopes: DataFrame, config: DataFrame, max_config_rows: int = MAX_CONFIG_ROWS) -> DataFrame:
    """Keep changes of tables with a live config row and shape them for the sink.

    Matches on the table name only. The payload keeps just the keys listed in
    ``sink_columns`` (exact names, no trimming; absent keys stay absent) and
    the row gets ``sink_table``, its ``sink_pk`` and that key's value. ``type``
    stays metadata: the sink uses it to choose upsert or delete.
    """
    cfg = config.select(
        F.col("source_table").alias("_src"), "sink_table",
        split_list(F.col("sink_columns")).alias("_cols"),
        F.coalesce(F.col("sink_pk"), F.lit(DEFAULT_PK)).alias("sink_pk"))
    joined = envelopes.join(broadcast_if_small(cfg, max_config_rows),
                            F.col("table") == F.col("_src"), "inner")
    pruned = F.map_filter(F.col("data"), lambda k, v: F.array_contains(F.col("_cols"), k))
    return joined.select(
        "sink_table", "sink_pk", "type", "ts",
        F.element_at(F.col("data"), F.col("sink_pk")).alias("pk_value"),
        pruned.alias("data"))


def quoted(name: str) -> str:
    """A name as one SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A text as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_columns(config: DataFrame) -> DataFrame:
    """Dimension schema from config: one row per (sink_table, column) with its
    position and whether it is the primary key (``id`` when none is named).
    Every column is a string, as in the sink tables."""
    cols = config.select(
        "sink_table", F.coalesce(F.col("sink_pk"), F.lit(DEFAULT_PK)).alias("_pk"),
        F.coalesce(F.col("sink_extend"), F.lit("")).alias("sink_extend"),
        F.posexplode(split_list(F.col("sink_columns"))).alias("ordinal", "column_name"))
    return cols.select("sink_table", "ordinal", "column_name",
                       (F.col("column_name") == F.col("_pk")).alias("is_pk"), "sink_extend")


def create_table_ddl(config: DataFrame, namespace: str = "dim") -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS`` text per sink table (config-sized)."""
    cols = table_columns(config)
    def ident(c):
        return F.concat(F.lit("`"), F.replace(c, F.lit("`"), F.lit("``")), F.lit("`"))

    spec = F.concat(ident(F.col("column_name")), F.lit(" STRING"),
                    F.when(F.col("is_pk"), F.lit(" NOT NULL")).otherwise(F.lit("")))
    per_table = cols.groupBy("sink_table", "sink_extend").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", spec.alias("s")))),
                                 lambda x: x["s"]), ", ").alias("_spec"))
    return per_table.select("sink_table", F.concat(
        F.lit(f"CREATE TABLE IF NOT EXISTS {quoted(namespace)}."), ident(F.col("sink_table")),
        F.lit(" ("), F.col("_spec"), F.lit(") "), F.col("sink_extend")).alias("ddl"))


def sync_tables(config: DataFrame, database: str, location_root: str) -> list[str]:
    """Create the dimension tables the config names in the session catalog
    (all columns STRING, stored as parquet under ``location_root``), and add
    columns a config update introduced. Columns are never dropped or retyped.

    The config has one row per source table, so the loop runs over a
    config-sized list on the driver; no data row is involved. Returns the DDL
    statements executed.
    """
    spark = config.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)} LOCATION {literal(location_root)}")
    wanted: dict[str, list[str]] = {}
    for r in table_columns(config).orderBy("sink_table", "ordinal").collect():
        cols = wanted.setdefault(r.sink_table, [])
        if r.column_name and r.column_name not in cols:
            cols.append(r.column_name)
    done = []
    for table, cols in sorted(wanted.items()):
        name = f"{quoted(database)}.{quoted(table)}"
        if not spark.catalog.tableExists(name):
            spec = ", ".join(f"{quoted(c)} STRING" for c in cols)
            ddl = (f"CREATE TABLE IF NOT EXISTS {name} ({spec}) USING parquet "
                   f"LOCATION {literal(f'{location_root}/{table}')}")
        else:
            have = {f.name for f in spark.table(name).schema.fields}
            new = [c for c in cols if c not in have]
            if not new:
                continue
            ddl = f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'{quoted(c)} STRING' for c in new)})"
        spark.sql(ddl)
        done.append(ddl)
    return done
