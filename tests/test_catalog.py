"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from conftest import SMALL

import duckdb
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from compare import compare, connect

# Long-running ones are covered by their own operator tests.
SLOW = {"A38_segmentation_metrics", "A40_informative_patch_scores", "A52_density_and_bias_by_patch"}


@pytest.fixture(scope="module")
def other_engine():
    return connect(SMALL)


def test_twins_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())
    assert len(queries()) > 180


def test_entry(spark):
    assert entry(spark).count() == 12


@pytest.mark.parametrize("name", [n for n in queries() if n not in SLOW])
def test_query(spark, other_engine, name):
    status, _rows, _took, note = compare(spark, other_engine, SMALL, name, queries()[name], oracle_sql().get(name))
    assert status in ("ok", "rows"), note


def test_sizes_of_every_unit(spark, tmp_path):
    """Bytes to petabytes, at and beside the borders: X13 and its SQL follow one rule."""
    ids = sorted({0, 1, *[1024**p // 977 + i for p in range(1, 6) for i in (-1, 0, 1, 2)], *[(2 * 1024**p + 1024**p // 4) // 977 for p in range(1, 6)]})
    events = spark.createDataFrame([(i,) for i in ids], "event_id long").withColumn("ts", F.lit("2024-03-01 12:30:59").cast("timestamp"))
    events.write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    name = "X13_formatting"
    status, rows, _took, note = compare(spark, con, str(tmp_path), name, queries()[name], oracle_sql()[name])
    assert (status, rows) == ("ok", len(ids)), note
