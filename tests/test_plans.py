"""Plan properties the scale design relies on (checked on the smallest tables)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import lakeforge.operators as ops
from conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def final_plan(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", [
    "quake_silver", "health_treatments", "health_city_access", "retail_sales_by_store_holiday",
    "orders_upsert", "customer_scd1_merge", "country_transform", "events_cdc_scd1",
])
def test_no_python_udf_nodes(spark, name):
    plan = final_plan(spark, name)
    assert not any(n in plan for n in PYTHON_NODES)


def test_filters_reach_the_scan(spark):
    plan = final_plan(spark, "orders_lookup")
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_orderpriority), EqualTo(o_orderstatus,F)" in plan


def test_latest_per_key_is_partially_aggregated(spark):
    assert "partial_max(struct(" in final_plan(spark, "quake_latest_per_user")


def test_many_to_many_report_emits_no_pairs(spark):
    plan = final_plan(spark, "retail_sales_by_store_holiday")
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_city_access_has_no_expand(spark):
    assert "Expand" not in final_plan(spark, "health_city_access")


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


T0, T1 = (f"2024-01-0{d} 00:00:00" for d in (1, 2))


@pytest.mark.parametrize("operator", ["upsert", "upsert_more", "images", "both", "scd1", "cdc", "scd2", "feed"])
def test_change_operators_read_each_input_once_and_join_once(spark, tmp_dir, no_broadcast, operator):
    """Whole rows are read once and joined once. An upsert of equal columns reads its batch's keys
    besides; a feed reads the rows without a key apart, by a filter that reaches the scan."""
    rows = spark.range(50).selectExpr("id AS k", "id % 7 AS seq", "cast(id AS string) AS v")
    stamped = rows.selectExpr("*", *(f"timestamp_ntz'{T0}' AS {c}" for c in ("insert_dts", "update_dts")))
    first = {"scd1": stamped, "scd2": ops.scd2_open(None, rows, ["k"], ["v"], T0), "upsert_more": rows.drop("v")}.get(operator, rows)
    first.write.parquet(f"{tmp_dir}/target")
    rows.withColumn("v", F.concat("v", F.lit("!"))).write.parquet(f"{tmp_dir}/source")
    target, source = (spark.read.parquet(f"{tmp_dir}/{n}") for n in ("target", "source"))
    out = {
        "upsert": lambda: ops.upsert(target, source, ["k"]),
        "upsert_more": lambda: ops.upsert(target, source, ["k"]),
        "images": lambda: ops.upsert_images(target, source, ["k"]),
        "both": lambda: ops.upsert_with_images(target, source, ["k"]),
        "scd1": lambda: ops.scd1_merge(target, source, ["k"], T1),
        "cdc": lambda: ops.cdc_scd1(target, source, ["k"], "seq"),
        "scd2": lambda: ops.scd2_open(target, source, ["k"], ["v"], T1),
        "feed": lambda: ops.change_feed(target, source, ["k"]),
    }[operator]()
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    keys_only = [line for line in scans if "ReadSchema: struct<k:bigint>" in line]
    without_key = [line for line in scans if "PushedFilters: [IsNull(k)]" in line]
    assert len(scans) - len(keys_only) - len(without_key) == 2
    assert len(keys_only) == (operator == "upsert") and len(without_key) == 2 * (operator == "feed")
    assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") == 1
