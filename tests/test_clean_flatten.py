import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from lakeforge.functions import na_to_zero, surrogate_key
from lakeforge.operators import (
    explode_variant,
    explode_variant_object,
    global_row_number,
    latest_per_key,
    vpath,
    vpath_int_rounded,
)


def test_latest_per_key_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [
            ("a", 1, 10, "x"),
            ("a", 3, 11, "y"),
            ("a", 3, 12, "z"),  # tie on order → tie-break column decides
            ("b", None, 5, "n"),  # NULL order loses against any value
            ("b", 2, 1, "m"),
            ("c", None, 7, "only"),
            (None, 1, 1, "nullkey"),
        ],
        "k string, o int, t int, v string",
    )
    got = rows(latest_per_key(df, ["k"], ["o"], ["t"]))
    assert got == sorted(
        [("a", 3, 12, "z"), ("b", 2, 1, "m"), ("c", None, 7, "only"), (None, 1, 1, "nullkey")], key=repr
    )
    # Same answer as the row_number window it replaces.
    w = Window.partitionBy("k").orderBy(F.col("o").desc(), F.col("t").desc())
    ref = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    assert rows(ref) == got


def test_latest_per_key_exact_duplicates_collapse(spark):
    df = spark.createDataFrame([("a", 1, "x")] * 5 + [("a", 0, "y")], "k string, o int, v string")
    assert rows(latest_per_key(df, ["k"], ["o"])) == [("a", 1, "x")]


def test_latest_per_key_hot_key_is_partially_aggregated(spark):
    hot = spark.range(0, 200_000).select(F.lit("hot").alias("k"), F.col("id").alias("o"))
    plan = latest_per_key(hot, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max(" in plan  # map-side combine before the shuffle
    assert rows(latest_per_key(hot, ["k"], ["o"])) == [("hot", 199_999)]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_global_row_number_matches_single_partition_window(spark, parts):
    df = spark.range(0, 5000).select(
        (F.col("id") % 97).alias("d"), (F.col("id") * 7919 % 5000).alias("u"), F.col("id").alias("payload")
    ).repartition(5)
    got = global_row_number(df, ["d", "u"], num_partitions=parts)
    ref = df.withColumn("row_num", F.row_number().over(Window.orderBy("d", "u")))
    assert rows(got.select("row_num", "d", "u", "payload")) == rows(ref.select("row_num", "d", "u", "payload"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


def test_global_row_number_skewed_leading_key(spark):
    # One date holds most rows; the tie-break columns still spread it.
    df = spark.range(0, 20000).select(
        F.when(F.col("id") < 15000, F.lit(1)).otherwise(F.col("id") % 10).alias("date"), F.col("id").alias("k")
    )
    got = global_row_number(df, ["date", "k"], num_partitions=8)
    assert sorted(r[0] for r in got.select("row_num").collect()) == list(range(1, 20001))


def test_na_to_zero(spark):
    df = spark.createDataFrame([("NA",), ("1.5",), (None,), ("x",)], "m string")
    assert [r[0] for r in df.select(na_to_zero("m", strict=False)).collect()] == [0.0, 1.5, None, None]
    with pytest.raises(Exception):
        df.select(na_to_zero("m", strict=True)).collect()


def test_surrogate_key_null_marker(spark):
    df = spark.createDataFrame([(1, None, "a")], "a int, b string, c string")
    got = df.select(surrogate_key(["a", "b", "c"]).alias("k")).first()[0]
    import hashlib

    assert got == hashlib.md5(b"1-_dbt_utils_surrogate_key_null_-a").hexdigest()


def test_variant_flatten_cross_product_and_outer(spark):
    docs = [
        '[{"n":"X","continents":["Africa","Asia"],"currencies":{"A":{"name":"a"},"B":{"name":"b"}},"area":12.5}]',
        '[{"n":"Y","continents":["Europe"],"currencies":{},"area":-2.5}]',
        '[{"n":"Z","currencies":{"C":{"name":"c"}},"area":0.4}]',
    ]
    raw = spark.createDataFrame([(d,) for d in docs], "data string").select(F.parse_json("data").alias("data"))
    flat = explode_variant(raw, "data", alias="sd")
    con = explode_variant(flat, "sd", alias="con", path="$.continents")
    both = explode_variant_object(con, "sd", path="$.currencies", key="k", value="v")
    got = rows(both.select(vpath("sd", "$.n"), vpath("con", "$"), "k", vpath("v", "$.name")))
    # X: 2 continents × 2 currencies; Y: no currency → gone; Z: no continents → gone
    assert len(got) == 4 and {r[0] for r in got} == {"X"}
    outer = explode_variant(flat, "sd", alias="con", path="$.continents", outer=True)
    assert outer.count() == 4
    areas = sorted(r[0] for r in flat.select(vpath_int_rounded("sd", "$.area")).collect())
    assert areas == [-3, 0, 13]  # half away from zero, not truncation


def test_epoch_ms_drops_milliseconds(spark):
    from lakeforge.functions import epoch_ms_exact, epoch_ms_to_ts

    df = spark.createDataFrame([(1700000000999,)], "ms bigint")
    r = df.select(epoch_ms_to_ts("ms"), epoch_ms_exact("ms")).first()
    assert r[0] == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert r[1] == dt.datetime(2023, 11, 14, 22, 13, 20, 999000)
