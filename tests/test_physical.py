"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from tallymark.bindings import QUERIES
from tallymark.bindings.registry import Tables
from tallymark.operators import filters, windows
from tallymark.sources import readers

FOLDER = "/root/testdata/sf0.001"
# model training and streams run jobs of their own while they are built
LAZY = sorted(n for n in QUERIES if not n.startswith(("ml_", "st_")))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text


def test_filters_and_columns_reach_the_scan(spark):
    df = readers.table(spark, f"{FOLDER}/lineitem.parquet", ["l_orderkey", "l_quantity"], F.col("l_quantity") > 45)
    text = plan(df)
    assert "GreaterThan(l_quantity,45.0)" in text and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text
    text = plan(filters.key_lookup(spark.read.parquet(f"{FOLDER}/customer.parquet"), c_nationkey=7))
    assert "EqualTo(c_nationkey,7)" in text


def test_groups_are_limited_before_the_shuffle(spark):
    orders = Tables(spark, FOLDER)("orders")
    text = plan(windows.latest_wins(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"]))
    assert "Partial" in text.split("WindowGroupLimit")[-1].split("\n")[0]


def test_joins_count_nothing_by_default(spark):
    """No aggregate stands below a join unless hot keys are asked for; the counts of a group are used again."""
    assert "Aggregate" not in plan(QUERIES["jn_inner_key"](spark, FOLDER))
    assert "Aggregate" not in plan(QUERIES["jn_county_names"](spark, FOLDER))
    counted = QUERIES["win_schools_in_zip"](spark, FOLDER)
    counted.collect()
    assert "ReusedExchange" in plan(counted)


def test_state_statistics_shuffle_little(spark):
    """At most one exchange for the aggregate on top of those of the mart itself."""
    mart = plan(QUERIES["jn_left_upper_name"](spark, FOLDER)).count("Exchange hashpartitioning")
    stats = plan(QUERIES["agg_state_stats"](spark, FOLDER)).count("Exchange hashpartitioning")
    assert stats <= mart + 1
