"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import Window as W, functions as F

from conftest import SF
from millrace.operators.keys import dense_key
from millrace.operators.rows import dedupe
from millrace.plans import prices as P
from registry import QUERIES
from registry.lake import gold

c = F.col


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# A single partition is fine for one row per table, column or range partition.
SINGLE_OK = {
    "snk08_table_counts", "agg14_summary", "agg16_null_counts", "dq02_foreign_keys", "dq04_key_families",  # global counts
    "jn03_value_and_unit", "jn04_six_columns", "win01_dense_key", "win02_dense_key_columns", "dim04_value",
    "dim08_asset_value", "fct04_fact_value",  # one count per range partition
}


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("src", "snk", "str", "doc11", "vec06"))])
def test_no_row_python_no_cross_join_no_single_task(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for bad in ("BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
    if name not in SINGLE_OK:
        assert "SinglePartition" not in plan


def test_dense_key_equals_the_single_task_window(spark):
    df = spark.range(30000).select(F.md5(c("id").cast("string")).alias("h"), "id").repartition(5)
    keyed = dense_key(df, ["h"], "key", partitions=11)
    want = df.withColumn("want", F.row_number().over(W.orderBy("h")))
    assert keyed.join(want, "id").filter("key <> want").count() == 0
    assert keyed.agg(F.min("key"), F.max("key"), F.count_distinct("key")).first() == (1, 30000, 30000)
    # The only single-partition exchange is over the per-partition counts.
    plan = plan_of(keyed)
    assert plan.count("SinglePartition") == 1
    assert re.search(r"SinglePartition.*?\n.*HashAggregate\(keys=\[", plan)


def test_dense_key_empty(spark):
    assert dense_key(spark.range(0), ["id"], "key").count() == 0


def test_dedupe_reduces_hot_keys_before_the_shuffle(spark):
    df = spark.range(1000).select((c("id") % 3).alias("k"), "id")
    plan = plan_of(dedupe(df, ["k"]))
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_filters_reach_the_scans(spark, data):
    plan = P.asset_daily(gold(data), "LARGE", "1997-01-01", "1998-12-31")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert re.search(r"PartitionFilters: \[.*year#\d+ >= 1997.*year#\d+ <= 1998", plan)
    assert "EqualTo(asset_key,LARGE)" in plan and "EqualTo(symbol,LARGE)" in plan
    assert "GreaterThanOrEqual(date_parsed,1997-01-01)" in plan


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(QUERIES["jn02_star_chain"](spark, SF))
    assert "l_comment" not in plan and "l_shipdate" not in plan and "o_totalprice" not in plan


def test_search_does_not_read_text_without_text_filters(spark):
    plan = plan_of(QUERIES["vec01_top_k"](spark, SF))
    assert not re.search(r"FileScan parquet \[[^\]]*text", plan)


def test_quota_that_differs_per_key_is_limited_before_the_shuffle(spark):
    from millrace.operators.rows import top_per_key

    rows = spark.range(10_000).selectExpr("id % 3 as k", "id as v", "cast(id % 3 * 5 + 2 as int) as quota")
    got = top_per_key(rows, ["k"], [F.col("v")], "quota", most=12)
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()
    assert {(r.k, r["count"]) for r in got.groupBy("k").count().collect()} == {(0, 2), (1, 7), (2, 12)}
