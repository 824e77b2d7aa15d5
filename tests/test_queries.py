"""Every registered query against its SQL, and the shape of the plans."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows_of
from support import plan_of
from dayloom.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    got = rows_of([tuple(r) for r in df.collect()], df.columns, sorted(columns))
    assert got == rows_of(result.fetchall(), columns, sorted(columns))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["l_suppkey", "date", "y"] and df.count() > 0


BUILT_WITH_PYTHON = {
    "ridge_fit", "ridge_predict", "forecast_horizon", "backtest_join", "mape_metric", "ridge_full",
    "ridge_by_key", "guarded_train", "ridge_incremental", "json_array_scan", "daily_incremental",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - BUILT_WITH_PYTHON))
def test_plan_has_no_python_and_no_cartesian_product(spark, name):
    text = plan_of(QUERIES[name](spark, FOLDER))
    assert not re.search(r"Python|InPandas|ArrowEval", text)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)


KEYED = ["feature_matrix", "daily_as_of", "forward_fill_keyed", "latest_per_key", "dedup_keep_first",
         "dedup_keep_first_rejects", "dedup_reject_all", "dedup_reject_all_rejects", "lag_features"]


@pytest.mark.parametrize("name", KEYED)
def test_keyed_plans_gather_only_one_row_aggregates(spark, name):
    lines = plan_of(QUERIES[name](spark, FOLDER)).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate(keys=[]" in lines[i - 1]


def test_scans_read_only_what_is_needed(spark):
    text = plan_of(QUERIES["feature_matrix"](spark, FOLDER))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and all("l_partkey" not in s and "l_tax" not in s for s in schemas)
