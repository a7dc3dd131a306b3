"""A cross-section of the catalog against DuckDB on the smallest tables (compare.py runs all of it)."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_points
from acctiers.catalog import load
from compare import rows

FOLDER = "/root/testdata/sf0.001"
SAMPLE = [
    "A9_load_source",
    "D3_dim_customers",
    "E2_fct_customer_monthly",
    "E9_exact_quantiles",
    "F5_average_percent_rank",
    "F6_ordinal_rank",
    "I2_scd2_from_log",
    "K13_run_layer",
    "L4_volume_history",
    "L16_mart_data_health",
    "M16_build_features_multi",
    "O8_score_customers",
    "U3_stream_daily_counts",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, name):
    entry = load()[name]
    df = entry.run(spark, FOLDER)
    result = duck.execute(entry.sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(columns, result.fetchall())


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert entry_points.entry(spark).count() > 0


def test_scores_need_no_cross_join(spark):
    plan = load()["O8_score_customers"].run(spark, FOLDER)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("by", [[], ["l_returnflag"]])
def test_rank_windows_are_keyed_or_hold_one_row_per_partition(spark, by):
    """The only windows without a key of the data run over the partitions' sums."""
    from pyspark.sql import functions as F

    from acctiers.operators import rank as R

    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    order = [F.col("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")]
    for df in (R.average_rank(lines, "l_extendedprice", by), R.ordinal_rank(lines, order, by=by), R.exact_quantiles(lines, "l_extendedprice", [0.5], by)):
        plan = df._jdf.queryExecution().sparkPlan().toString().split("\n")
        for i, line in enumerate(plan):
            if re.search(r"[-+] Window \[", line) and "_part#" not in line:
                assert any("Aggregate(keys=[_part#" in x for x in plan[i + 1 : i + 4])
