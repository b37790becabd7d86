"""T4 config state, CDC apply, K5 schema, J2/P9-P11 routing."""

from pyspark.sql import functions as F

from strata import schemas
from strata.operators.cdc import apply_changes, config_state, latest_per_key
from strata.operators.dim import create_table_ddl, route, table_columns


def cfg(src, typ="dim", cols="id,name", pk=None, sink=None, ext=None):
    return (src, None, sink or f"dim_{src}", typ, cols, pk, ext)


def test_config_state_ops(spark):
    log = [
        ("r", None, cfg("a"), 1, 1),
        ("r", None, cfg("b"), 1, 2),
        ("c", None, cfg("c"), 2, 3),
        ("u", cfg("b"), cfg("b", typ="dwd"), 3, 4),          # moves dim -> dwd: removed
        ("u", cfg("c"), cfg("c2"), 4, 5),                    # renames: old key gone
        ("d", cfg("zzz"), None, 5, 6),                       # unknown key: no-op
        ("u", cfg("a"), cfg("a", cols="id"), 6, 7),          # same key update: put wins
        ("r", None, cfg("x", typ="dwd"), 7, 8),              # never a dimension
    ]
    state = config_state(spark.createDataFrame(log, schemas.CONFIG_CDC))
    got = {r.source_table: r.sink_columns for r in state.collect()}
    assert got == {"a": "id", "c2": "id,name"}


def test_config_delete(spark):
    log = [("r", None, cfg("a"), 1, 1), ("d", cfg("a"), None, 2, 2)]
    assert config_state(spark.createDataFrame(log, schemas.CONFIG_CDC)).count() == 0


def test_apply_changes_tie_broken_by_seq(spark):
    ch = spark.createDataFrame([(1, "5", 1, "x", False), (1, "5", 2, "y", False), (2, "5", 1, "z", False),
                                (2, "6", 2, "z", True)], "k int, ts string, seq int, v string, d boolean")
    got = {r.k: r.v for r in apply_changes(ch, ["k"], ["ts", "seq"], F.col("d")).collect()}
    assert got == {1: "y"}


def test_latest_per_key_with_map_payload(spark):
    df = spark.createDataFrame([(1, 1, {"a": "1"}), (1, 2, {"a": "2"})], "k int, o int, m map<string,string>")
    assert latest_per_key(df, ["k"], ["o"]).first().m == {"a": "2"}


def _env(spark, rows):
    return spark.createDataFrame(rows, schemas.ENVELOPE)


def test_route_prunes_and_tags(spark):
    config = spark.createDataFrame([
        ("base_trademark", None, "dim_base_trademark", "dim", "id,tm_name", None, None),
        ("spaced", None, "dim_spaced", "dim", "id, name", "id", None),
        ("trailing", None, "dim_trailing", "dim", "id,name,", "id", None),
    ], schemas.CONFIG_ROW)
    env = _env(spark, [
        ("shop", "base_trademark", "insert", "1", {"tm_name": "x", "logo_url": "/a.jpg", "id": "1"}, None),
        ("other_db", "spaced", "update", "2", {"id": "2", "name": "n"}, None),
        ("shop", "trailing", "insert", "3", {"id": "3", "name": "m", "z": "q"}, None),
        ("shop", "no_config", "insert", "4", {"id": "4"}, None),
    ])
    got = {r.sink_table: (r.pk_value, r.type, dict(r.data), r.sink_pk) for r in route(env, config).collect()}
    assert got == {
        "dim_base_trademark": ("1", "insert", {"tm_name": "x", "id": "1"}, "id"),
        "dim_spaced": ("2", "update", {"id": "2"}, "id"),          # " name" matches nothing
        "dim_trailing": ("3", "insert", {"id": "3", "name": "m"}, "id"),
    }


def test_dimension_schema_and_ddl(spark):
    config = spark.createDataFrame([
        ("t", None, "dim_t", "dim", "id,tm_name", None, None),
        ("u", None, "dim_u", "dim", "k,v", "k", "SALT_BUCKETS = 4"),
    ], schemas.CONFIG_ROW)
    cols = [(r.sink_table, r.ordinal, r.column_name, r.is_pk) for r in table_columns(config).collect()]
    assert sorted(cols) == [("dim_t", 0, "id", True), ("dim_t", 1, "tm_name", False),
                            ("dim_u", 0, "k", True), ("dim_u", 1, "v", False)]
    ddl = {r.sink_table: r.ddl for r in create_table_ddl(config).collect()}
    assert ddl["dim_t"] == "CREATE TABLE IF NOT EXISTS `dim`.`dim_t` (`id` STRING NOT NULL, `tm_name` STRING) "
    assert ddl["dim_u"].endswith(") SALT_BUCKETS = 4")


def test_sync_tables_creates_and_grows(spark, tmp_dir):
    from strata.operators.dim import sync_tables
    v1 = spark.createDataFrame([("t", None, "dim_sync_t", "dim", "id,tm_name", None, None)], schemas.CONFIG_ROW)
    assert len(sync_tables(v1, "strata_test_dim", tmp_dir)) == 1
    assert sync_tables(v1, "strata_test_dim", tmp_dir) == []          # idempotent
    v2 = spark.createDataFrame([("t", None, "dim_sync_t", "dim", "id,logo_url", None, None)], schemas.CONFIG_ROW)
    ddl = sync_tables(v2, "strata_test_dim", tmp_dir)
    assert ddl and ddl[0].startswith("ALTER TABLE")
    cols = [f.name for f in spark.table("strata_test_dim.dim_sync_t").schema.fields]
    assert cols == ["id", "tm_name", "logo_url"]                     # grown, nothing dropped


def test_route_null_payload(spark):
    config = spark.createDataFrame([("t", None, "dim_t", "dim", "id,name", None, None)], schemas.CONFIG_ROW)
    env = _env(spark, [("shop", "t", "insert", "1", None, None)])
    row = route(env, config).first()
    assert (row.sink_table, row.pk_value, row.data) == ("dim_t", None, None)   # the sink rejects it


def test_names_are_escaped(spark, tmp_dir):
    from strata.operators.dim import sync_tables
    odd = "o`d'd"
    config = spark.createDataFrame([("t", None, "dim_odd", "dim", f"id,{odd}", None, None)], schemas.CONFIG_ROW)
    assert "`o``d'd` STRING" in create_table_ddl(config).first().ddl
    sync_tables(config, "strata_odd", f"{tmp_dir}/it's")
    assert spark.table("strata_odd.dim_odd").columns == ["id", odd]


def _json(df):
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def _stream(spark, df, path):
    df.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_dimension_jobs_end_to_end(spark, tmp_dir):
    """Preload routes data sent before its config record; a column added mid-stream
    appears; numeric order of ts; deletes; rejects; restart from the checkpoints."""
    from strata.sinks.catalog_tables import read_table
    from strata.streaming import jobs
    from strata.streaming.replay import drain
    path = f"{tmp_dir}/dim"

    def change(op, row, seq):
        return spark.createDataFrame([(op, None, row, seq, seq)], schemas.CONFIG_CDC)

    jobs.preload_config(spark, path, change("r", ("t", None, "dim_t", "dim", "id,name", "id", None), 1))

    def run(data, config):
        if config is not None:
            drain(jobs.config_changes(_stream(spark, config, f"{tmp_dir}/cfg"), path, f"{tmp_dir}/c1", jobs.ONCE,
                                      database="strata_jobs_dim"))
        drain(jobs.dimension_routing(_stream(spark, data, f"{tmp_dir}/data"), path, f"{tmp_dir}/c2", jobs.ONCE,
                                     "strata_jobs_dim"))

    rows = [("shop", "t", "update", "9", {"id": "1", "name": "old"}, None),
            ("shop", "t", "update", "10", {"id": "1", "name": "new"}, None),
            ("shop", "t", "insert", "3", {"id": "2", "name": "gone"}, None),
            ("shop", "t", "insert", "3", {"name": "no key"}, None),
            ("shop", "u", "insert", "3", {"id": "9"}, None)]
    run(_json(_env(spark, rows)).unionByName(spark.createDataFrame([("{bad",)], "value string")), None)
    got = {r.pk_value: r.name for r in jobs.read_dimension(spark, path, "dim_t", "pk_value").collect()}
    assert got == {"1": "new", "2": "gone"}
    reasons = [r.reason for r in spark.read.parquet(f"{path}/rejects").collect()]
    assert sorted(reasons) == ["malformed", "no key"]
    # The configuration grows by a column and routes another table; older rows lack it.
    grown = _json(change("u", ("t", None, "dim_t", "dim", "id,name,color", "id", None), 5)).unionByName(
        _json(change("c", ("u", None, "dim_u", "dim", "id", None, None), 6)))
    more = [("shop", "t", "insert", "20", {"id": "3", "name": "c", "color": "red"}, None),
            ("shop", "t", "delete", "21", {"id": "2"}, None), ("shop", "t", "update", "2", {"id": "1", "name": "late"}, None),
            ("shop", "u", "insert", "30", {"id": "9"}, None)]
    run(_json(_env(spark, more)), grown)
    dim = jobs.read_dimension(spark, path, "dim_t", "pk_value")
    assert {r.pk_value: (r.name, r.color) for r in dim.collect()} == {"1": ("new", None), "3": ("c", "red")}
    assert dict(dim.dtypes)["color"] == "string"
    assert [r.pk_value for r in jobs.read_dimension(spark, path, "dim_u", "pk_value").collect()] == ["9"]
    table = read_table(spark, "strata_jobs_dim", "dim_t")
    assert table.columns == ["id", "name", "color"]
    assert sorted(map(tuple, table.collect())) == [("1", "new", None), ("3", "c", "red")]
    run(_json(_env(spark, [("shop", "u", "delete", "31", {"id": "9"}, None)])), None)
    assert jobs.read_dimension(spark, path, "dim_u").count() == 0
