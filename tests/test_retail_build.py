"""The steps of the retail model's build: rows are dealt once, and stored where they have met."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows

from lakeforge.operators import scd2_snapshot, upsert_with_images
from lakeforge.operators.changes import scd2_open
from lakeforge.plans import retail
from lakeforge.sources import HistoryTable


T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def bronze(spark, folder):
    lines = [(1, 1, 5.0, 10.0, "R", dt.datetime(2020, 1, 1)), (1, 1, 7.0, 20.0, "N", dt.datetime(2020, 1, 1, 5)),
             (1, 2, 9.0, 30.0, "N", dt.datetime(2020, 1, 1)), (10, 1, 9.0, 1.0, "N", dt.datetime(2020, 1, 1)),
             (None, 3, 1.0, 2.0, None, None), (1, 2, None, None, "N", None)]
    lineitem = spark.createDataFrame(lines, "l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz")
    supplier = spark.createDataFrame([(1, 4), (10, 5)], "s_suppkey long, s_nationkey int")
    tables = {"lineitem": lineitem, "supplier": supplier}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return retail.bronze_from_driver(*[spark.read.parquet(f"{folder}/{name}") for name in tables])


def combined(spark, folder, dated):
    b = bronze(spark, folder)
    facts = retail.stg_fact(b["fact"], "2024-03-01 00:00:00", dated)
    return retail.combined_fact(retail.stage_dept(b["department"], "2024-03-01 00:00:00", numbered=False), facts, retail.stage_store(b["stores"], "2024-03-01 00:00:00"))


def test_joined_fact_deals_line_items_once_per_roll_up(spark, tmp_dir):
    df = combined(spark, f"{tmp_dir}/1", dated=True)
    # dealt for the departments and for the facts: both roll-ups and their join follow there
    assert physical(df).count("Exchange hashpartitioning") == 2
    assert rows(df) == rows(combined(spark, f"{tmp_dir}/2", dated=False))
    assert ("2020-01-01", 30.0, 9.0) in rows(df.filter("store_id = 1 AND dept_id = 1").select("date_id", "store_weekly_sales", "temperature"))
    assert df.count() == 5


def test_checked_source_is_exchanged_once(spark, tmp_dir, no_broadcast):
    spark.createDataFrame([(1, "a", 1)], "k int, j string, v int").write.parquet(f"{tmp_dir}/s")
    source = spark.read.parquet(f"{tmp_dir}/s")
    scd2_open(None, source, ["k", "j"], ["v"], T1).write.parquet(f"{tmp_dir}/o")
    opened = spark.read.parquet(f"{tmp_dir}/o")
    for df in (scd2_open(opened, source, ["k", "j"], ["v"], T2), upsert_with_images(source, source, ["k", "j"])):
        assert physical(df).count("Exchange hashpartitioning") == 2


def test_ids_that_a_row_gives_do_not_travel_and_others_stay(spark, tmp_dir, no_broadcast):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    first = scd2_open(None, source, ["k"], ["v"], T1)
    own = F.when(F.col("k") == 1, "another id").when(F.col("k") == 2, F.lit(None)).otherwise(F.col("dbt_scd_id"))
    first.withColumn("dbt_scd_id", own).write.parquet(f"{tmp_dir}/o")
    opened = spark.read.parquet(f"{tmp_dir}/o")
    before = dict(opened.select("k", "dbt_scd_id").collect())
    assert before[1] == "another id" and before[2] is None and len(before[3]) == 32
    out = scd2_open(opened, source.withColumn("v", F.lit("new")), ["k"], ["v"], T2)
    assert dict(out.filter("dbt_valid_to IS NOT NULL").select("k", "dbt_scd_id").collect()) == before
    assert "_derived" in physical(out)


def test_joined_buckets_keep_the_history_of_plain_ones(spark, tmp_dir):
    loads = [[(i, f"d{i % 7}", 0) for i in range(200)], [(i, f"d{i % 7}", i % 3) for i in range(20, 240)] + [(None, "x", 1), (None, "x", 1)]]
    joined, ref = HistoryTable(spark, f"{tmp_dir}/joined", ["k", "d"], 8, joined=True), None
    for load, now in zip(loads, (T1, T2)):
        src = spark.createDataFrame(load, "k int, d string, v int")
        joined.snapshot(src, ["v"], now)
        ref = scd2_snapshot(ref, src, ["k", "d"], ["v"], now)
    cols = ["k", "d", "v", "dbt_valid_from", "dbt_valid_to", "dbt_scd_id"]
    assert rows(joined.read().select(*cols)) == rows(ref.select(*cols))
    # the join's partitions are the buckets: one file to a bucket of complete keys
    files = joined.open.read().filter("k IS NOT NULL").select(F.input_file_name().alias("f")).distinct().count()
    assert files == 8
