"""K2/K3 message shapes (no broker needed): JSON records and upsert records
whose deletes are tombstones."""

import json

from pyspark.sql import functions as F

from strata.sinks.kafka import json_records, upsert_records


def test_json_records_with_key(spark):
    df = spark.createDataFrame([("1", "a", 5)], "id string, name string, n int")
    r = json_records(df, ["id"]).first()
    assert json.loads(r.key) == {"id": "1"}
    assert json.loads(r.value) == {"id": "1", "name": "a", "n": 5}


def test_upsert_records_tombstones(spark):
    df = spark.createDataFrame([("1", "insert"), ("2", "delete")], "id string, type string")
    rows = {json.loads(r.key)["id"]: r.value for r in
            upsert_records(df, ["id"], is_delete=F.col("type") == "delete").collect()}
    assert json.loads(rows["1"]) == {"id": "1", "type": "insert"}
    assert rows["2"] is None
