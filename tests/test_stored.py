"""Row numbers sized by measured rows, and facts stored in buckets."""

from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakeforge.operators import clean, global_row_number
from lakeforge.plans.catalog import REGISTRY
from lakeforge.sources import stored_buckets


def test_row_number_partitions_follow_the_rows(spark, monkeypatch):
    """A date of a third of all rows, in six partitions whatever the session says; none holds most of it."""
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).alias("d"), F.col("id").alias("u"))
    tables, write = {}, clean.materialize
    monkeypatch.setattr(clean, "materialize", lambda d, name: tables.setdefault(name, write(d, name)))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        got = global_row_number(df, ["d", "u"], rows_per_partition=1000)
        found = got.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    ref = df.withColumn("row_num", F.row_number().over(Window.orderBy("d", "u")))
    assert sorted((r["row_num"], r["d"], r["u"]) for r in found) == sorted(map(tuple, ref.select("row_num", "d", "u").collect()))
    sizes = Counter(r["_mid"] >> 33 for r in tables["row-number"].collect())
    assert len(sizes) == 6 and max(sizes.values()) < 2000
    monkeypatch.undo()
    assert global_row_number(df.limit(0), ["d", "u"]).count() == 0


def test_bucketed_facts_join_without_an_exchange(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for n in names:
        spark.conf.set(n, "-1")
    try:
        for query, most in (("health_treatments", 0), ("health_hospital_performance", 1), ("health_patient_value", 1)):
            df = REGISTRY[query](spark, SF_SMALL)
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            assert plan.count("Exchange hashpartitioning") <= most and "SortMergeJoin" in plan
    finally:
        for n in names:
            spark.conf.unset(n)


def test_stored_buckets_are_built_once_per_input(spark, tmp_dir):
    built = []

    def build():
        built.append(1)
        return spark.read.parquet(f"{tmp_dir}/in").withColumn("v", F.col("id") * 2)

    spark.range(50).write.parquet(f"{tmp_dir}/in")
    for _ in range(3):
        assert stored_buckets(spark, "t", [f"{tmp_dir}/in"], "id", 4, build).count() == 50
    assert len(built) == 1
    spark.range(50, 60).write.mode("append").parquet(f"{tmp_dir}/in")
    assert stored_buckets(spark, "t", [f"{tmp_dir}/in"], "id", 4, build).count() == 60 and len(built) == 2
