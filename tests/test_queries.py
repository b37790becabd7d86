"""Every registered batch query against its DuckDB oracle on the smallest
driver tables, plus the entry() smoke contract. (The streaming twins are
checked against the same oracles by tools/oracle_check.py; they take longer.)"""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from strata.plans.catalog import ORACLE, QUERIES

TABLES = "region nation customer supplier part orders lineitem events".split()
# The training-data queries have tests of their own in tests/llm.
BATCH = sorted(k for k in QUERIES if not k.startswith("stream_"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v.item() if hasattr(v, "item") else v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=str)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["stt", "edt", "vc", "ch", "ar", "is_new", "uv_ct", "sv_ct", "pv_ct", "dur_sum", "ts"]


def test_every_query_has_oracle_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", BATCH)
def test_batch_query_matches_oracle(spark, duck, name):
    got = _rows(entry.queries()[name](spark, SF_SMALL).toPandas())
    want = _rows(duck.execute(entry.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


STREAMS = sorted(k for k in QUERIES if k.startswith("stream_"))


@pytest.mark.parametrize("name", STREAMS)
def test_stream_twin_equals_batch_oracle(spark, duck, name):
    """Stream = batch: each twin, replayed over several micro-batches, ends with
    the batch query's SQL answer."""
    got = _rows(entry.queries()[name](spark, SF_SMALL).toPandas())
    want = _rows(duck.execute(entry.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert got[1] == want[1]
