"""Skewed inputs: one key holds a third of the rows."""

from pyspark.sql import functions as F

from lakeforge.operators import sum_over_join, upsert
from lakeforge.operators.changes import SPREAD, _spread
from lakeforge.plans import health


def test_upsert_null_key_flood_is_spread(spark):
    n = 3000
    tgt = spark.createDataFrame([(None if i % 3 == 0 else i, "t") for i in range(n)], "k bigint, v string")
    src = spark.createDataFrame([(None if i % 3 == 0 else i, "s") for i in range(n - 600, n + 300)], "k bigint, v string")
    out = upsert(tgt, src, ["k"])
    got = out.groupBy("v", F.col("k").isNull().alias("null_key")).count().collect()
    counts = {(r[0], r[1]): r[2] for r in got}
    assert counts[("t", True)] == n // 3  # NULL-key target rows kept
    assert counts[("s", True)] == 300  # NULL-key source rows inserted
    assert counts[("s", False)] == 600  # 400 updated + 200 inserted
    assert counts[("t", False)] == 2 * n // 3 - 400
    # The join column that NULL keys get takes many values, so no partition gets them all.
    spread = _spread(tgt.withColumn("v", F.monotonically_increasing_id()), ["k"])
    assert spread.filter("k IS NULL").select(SPREAD).distinct().count() == n // 3
    assert [r[0] for r in spread.filter("k IS NOT NULL").select(SPREAD).distinct().collect()] == [0]


def test_sum_over_join_hot_date(spark):
    dim = spark.range(0, 3000).select(
        F.when(F.col("id") < 1000, F.lit(1)).otherwise(F.col("id") % 50).alias("d"),
        (F.col("id") % 2).alias("g"),
    )
    fact = spark.range(0, 3000).select(
        F.when(F.col("id") < 1000, F.lit(1)).otherwise(F.col("id") % 50).alias("d"),
        (F.col("id") % 7).alias("s"),
        F.lit(1).alias("m"),
    )
    got = sum_over_join(dim, fact, "d", "d", ["g"], ["s"], {"total": "m"})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    # Brute force from per-date counts (the pairwise join would hold 1M+ rows for d = 1).
    dims = {}
    for d, g in dim.collect():
        dims[(d, g)] = dims.get((d, g), 0) + 1
    facts = {}
    for d, s, m in fact.collect():
        facts[(d, s)] = facts.get((d, s), 0) + m
    expect = {}
    for (d, g), w in dims.items():
        for (d2, s), total in facts.items():
            if d == d2:
                expect[(g, s)] = expect.get((g, s), 0) + w * total
    assert {(r["g"], r["s"]): r["total"] for r in got.collect()} == expect


def test_city_access_hot_city(spark):
    pt = spark.range(0, 900).select(
        F.col("id").cast("string").alias("patient_id"),
        F.when(F.col("id") < 300, F.lit("Hot")).otherwise(F.concat(F.lit("C"), (F.col("id") % 10).cast("string"))).alias("patient_city"),
    )
    vt = spark.range(0, 5000).select(
        (F.col("id") % 800).cast("string").alias("patient_id"), (F.col("id") % 13).cast("string").alias("hospital_id")
    )
    got = {r[0]: (r[1], r[2]) for r in health.city_access(pt, vt).collect()}
    visits = {}
    for p, h in vt.collect():
        visits.setdefault(p, set()).add(h)
    expect = {}
    for p, c in pt.collect():
        pats, hosps = expect.setdefault(c, (set(), set()))
        pats.add(p)
        hosps.update(visits.get(p, set()))
    assert got == {c: (len(p), len(h)) for c, (p, h) in expect.items()}
