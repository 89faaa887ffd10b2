import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from lakeforge.operators import (
    cdc_scd1,
    change_feed,
    check_accepted,
    check_not_null,
    check_unique,
    duplicate_keys,
    scd1_merge,
    scd2_snapshot,
    sum_over_join,
    upsert,
)

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 1, 2)
T2 = dt.datetime(2024, 1, 3)
SCHEMA = "k int, a string, b int"


def test_upsert_updates_inserts_and_keeps(spark):
    tgt = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (None, "n", 0)], SCHEMA)
    src = spark.createDataFrame([(2, "Y", 20), (3, "z", 3), (None, "m", 9)], SCHEMA)
    got = rows(upsert(tgt, src, ["k"]))
    assert got == rows(spark.createDataFrame(
        [(1, "x", 1), (2, "Y", 20), (3, "z", 3), (None, "n", 0), (None, "m", 9)], SCHEMA))


def test_upsert_target_only_columns_keep_values(spark):
    tgt = spark.createDataFrame([(1, "x", 1, "keep")], "k int, a string, b int, extra string")
    src = spark.createDataFrame([(1, "X", 5), (2, "new", 6)], SCHEMA)
    got = rows(upsert(tgt, src, ["k"]))
    assert got == [(1, "X", 5, "keep"), (2, "new", 6, None)]


def test_upsert_duplicate_source_key_fails(spark):
    tgt = spark.createDataFrame([(1, "x", 1)], SCHEMA)
    src = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], SCHEMA)
    with pytest.raises(Exception, match="duplicate source key"):
        upsert(tgt, src, ["k"]).collect()


def test_scd1_merge_keeps_insert_time(spark):
    tgt = spark.createDataFrame([("a", "b", "old", T0, T0), ("c", "d", "same", T0, T0)],
                                "f string, l string, v string, insert_dts timestamp_ntz, update_dts timestamp_ntz")
    src = spark.createDataFrame([("a", "b", "new"), ("e", "f", "ins"), (None, "g", "nullkey")], "f string, l string, v string")
    got = rows(scd1_merge(tgt, src, ["f", "l"], T1))
    assert got == rows(spark.createDataFrame(
        [("a", "b", "new", T0, T1), ("c", "d", "same", T0, T0), ("e", "f", "ins", T1, T1), (None, "g", "nullkey", T1, T1)],
        tgt.schema))
    # A NULL key part never matches: merging the same batch again inserts it again.
    again = scd1_merge(scd1_merge(tgt, src, ["f", "l"], T1), src, ["f", "l"], T2)
    assert again.filter(F.col("f").isNull()).count() == 2


def test_cdc_scd1_late_rows_and_replay(spark):
    s1 = spark.createDataFrame([(1, 10, "a"), (1, 12, "b"), (2, 5, "c")], "k int, seq int, v string")
    t = cdc_scd1(None, s1, ["k"], "seq")
    late = spark.createDataFrame([(1, 11, "late"), (2, 6, "newer"), (3, 1, "new")], "k int, seq int, v string")
    t2 = cdc_scd1(t, late, ["k"], "seq")
    assert rows(t2) == [(1, 12, "b"), (2, 6, "newer"), (3, 1, "new")]
    assert rows(cdc_scd1(t2, late, ["k"], "seq")) == rows(t2)  # replay changes nothing


def _hist_rows(h):
    return rows(h.select("k", "a", "b", "dbt_valid_from", "dbt_valid_to"))


def test_scd2_snapshot_cases(spark):
    s1 = spark.createDataFrame([(1, "x", 1), (2, "y", None), (3, "z", 3), (4, "w", 4)], SCHEMA)
    h1 = scd2_snapshot(None, s1, ["k"], ["a", "b"], T0)
    # 1 changes, 2 NULL → value, 3 unchanged, 4 disappears, 5 is new
    s2 = spark.createDataFrame([(1, "X", 1), (2, "y", 2), (3, "z", 3), (5, "v", 5)], SCHEMA)
    h2 = scd2_snapshot(h1, s2, ["k"], ["a", "b"], T1)
    assert _hist_rows(h2) == sorted([
        (1, "x", 1, T0, T1), (1, "X", 1, T1, None),
        (2, "y", None, T0, T1), (2, "y", 2, T1, None),
        (3, "z", 3, T0, None), (4, "w", 4, T0, None), (5, "v", 5, T1, None),
    ], key=repr)
    # Same source again: nothing changes.
    assert _hist_rows(scd2_snapshot(h2, s2, ["k"], ["a", "b"], T2)) == _hist_rows(h2)
    # Back to an old value: a third version.
    s3 = spark.createDataFrame([(1, "x", 1)], SCHEMA)
    h3 = scd2_snapshot(h2, s3, ["k"], ["a", "b"], T2)
    assert h3.filter("k = 1").count() == 3


def test_scd2_case_insensitive(spark):
    s1 = spark.createDataFrame([(1, "abc", 1)], SCHEMA)
    h1 = scd2_snapshot(None, s1, ["k"], ["a"], T0)
    s2 = spark.createDataFrame([(1, "ABC", 1)], SCHEMA)
    assert scd2_snapshot(h1, s2, ["k"], ["a"], T1).count() == 2
    assert scd2_snapshot(h1, s2, ["k"], ["a"], T1, case_insensitive_cols=["a"]).count() == 1


def test_change_feed(spark):
    before = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (3, "z", 3)], SCHEMA)
    after = spark.createDataFrame([(1, "x", 1), (2, "Y", 2), (4, "n", 4)], SCHEMA)
    got = rows(change_feed(before, after, ["k"]))
    assert got == sorted([
        (2, "y", 2, "update_preimage"), (2, "Y", 2, "update_postimage"),
        (3, "z", 3, "delete"), (4, "n", 4, "insert"),
    ], key=repr)


def test_change_feed_compares_null_keys_as_a_multiset(spark):
    before = spark.createDataFrame([(None, "a", 1), (None, "a", 1), (None, "b", 2), (1, "x", 1)], SCHEMA)
    assert change_feed(before, before, ["k"]).count() == 0
    after = spark.createDataFrame([(None, "a", 1), (None, "b", 2), (None, "b", 2), (None, "c", 3), (1, "x", 1)], SCHEMA)
    assert rows(change_feed(before, after, ["k"])) == sorted(
        [(None, "a", 1, "delete"), (None, "b", 2, "insert"), (None, "c", 3, "insert")], key=repr)


def test_latest_needs_an_order(spark):
    tgt = spark.createDataFrame([(1, "x", 1)], SCHEMA)
    src = spark.createDataFrame([(1, "aaa", 10), (1, "zzz", 2)], SCHEMA)
    with pytest.raises(ValueError, match="order_by"):
        upsert(tgt, src, ["k"], on_duplicate="latest")
    assert rows(upsert(tgt, src, ["k"], on_duplicate="latest", order_by=["b"])) == [(1, "aaa", 10)]


def test_scd2_case_insensitive_keys(spark):
    schema = "k string, a string"
    h1 = scd2_snapshot(None, spark.createDataFrame([("P-a", "x"), ("q", "y")], schema), ["k"], ["a"], T0, case_insensitive_keys=["k"])
    h2 = scd2_snapshot(h1, spark.createDataFrame([("p-A", "z"), ("Q", "y")], schema), ["k"], ["a"], T1, case_insensitive_keys=["k"])
    got = rows(h2.select("k", "a", "dbt_valid_to"))
    assert got == sorted([("P-a", "x", T1), ("p-A", "z", None), ("q", "y", None)], key=repr)
    with pytest.raises(Exception, match="duplicate source key"):
        scd2_snapshot(h1, spark.createDataFrame([("r", "1"), ("R", "2")], schema), ["k"], ["a"], T1, case_insensitive_keys=["k"]).collect()


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "c"), (2, "zz")], "k int, v string")
    assert rows(check_unique(df, "k")) == [(1, 2)]  # NULLs ignored
    assert check_not_null(df, "k").count() == 2
    assert rows(check_accepted(df, "v", ["a", "b", "c"])) == [("zz", 1)]
    assert rows(duplicate_keys(df, ["k"])) == sorted([(1, 2), (None, 2)], key=repr)


# ------------------------------------------------------------------ properties
rows_strategy = st.lists(
    st.tuples(st.integers(0, 6), st.sampled_from(["p", "q", None]), st.integers(0, 3)), max_size=12
)
PROP = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _unique_by_key(rs):
    seen = {}
    for r in rs:
        seen[r[0]] = r
    return list(seen.values())


@PROP
@given(tgt=rows_strategy, src=rows_strategy)
def test_prop_upsert_idempotent(spark, tgt, src):
    t = spark.createDataFrame(_unique_by_key(tgt), SCHEMA)
    s = spark.createDataFrame(_unique_by_key(src), SCHEMA)
    once = upsert(t, s, ["k"])
    assert rows(upsert(once, s, ["k"])) == rows(once)
    # Brute force: source wins per key, target keeps the rest.
    expect = {r[0]: r for r in _unique_by_key(tgt)}
    expect.update({r[0]: r for r in _unique_by_key(src)})
    assert rows(once) == sorted(expect.values(), key=repr)


@PROP
@given(loads=st.lists(rows_strategy, min_size=1, max_size=4))
def test_prop_scd2_versions_well_formed(spark, loads):
    hist = None
    times = [dt.datetime(2024, 1, i + 1) for i in range(len(loads))]
    for load, now in zip(loads, times):
        s = spark.createDataFrame(_unique_by_key(load), SCHEMA)
        hist = scd2_snapshot(hist, s, ["k"], ["a", "b"], now)
    got = hist.select("k", "dbt_valid_from", "dbt_valid_to").collect()
    by_key = {}
    for k, vf, vt in got:
        by_key.setdefault(k, []).append((vf, vt))
    for k, spans in by_key.items():
        assert sum(1 for _, vt in spans if vt is None) <= 1  # one open version
        spans.sort()
        for (f1, t1), (f2, _) in zip(spans, spans[1:]):
            assert t1 is not None and t1 <= f2  # no overlap
    # Applying the last load again changes nothing.
    last = spark.createDataFrame(_unique_by_key(loads[-1]), SCHEMA)
    again = scd2_snapshot(hist, last, ["k"], ["a", "b"], dt.datetime(2025, 1, 1))
    assert _hist_rows(again) == _hist_rows(hist)


@PROP
@given(
    left=st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["h", "n"])), max_size=15),
    right=st.lists(st.tuples(st.integers(0, 5), st.integers(0, 2), st.integers(-50, 50)), max_size=15),
    how=st.sampled_from(["inner", "left"]),
)
def test_prop_sum_over_join_equals_pairwise(spark, left, right, how):
    l_df = spark.createDataFrame(left, "d int, g string")
    r_df = spark.createDataFrame(right, "d int, s int, m int")
    got = sum_over_join(l_df, r_df, "d", "d", ["g"], ["s"], {"total": "m"}, how=how)
    pairs = l_df.alias("l").join(r_df.alias("r"), F.col("l.d") == F.col("r.d"), how)
    ref = pairs.groupBy("l.g", "r.s").agg(F.sum("r.m").alias("total"))
    assert rows(got.select("g", "s", "total")) == rows(ref)


def test_scd1_merge_matches_brute_force(spark):
    tgt = spark.range(0, 300).selectExpr(
        "CAST(id % 30 AS STRING) AS f", "CAST(id AS STRING) AS l", "'old' AS v", "CAST(id AS INT) AS extra",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS insert_dts", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS update_dts",
    )
    src = spark.range(250, 320).selectExpr("CAST(id % 30 AS STRING) AS f", "CAST(id AS STRING) AS l", "'new' AS v")
    got = scd1_merge(tgt, src, ["f", "l"], T1)
    r = {(a, b): (v, e, i, u) for a, b, v, e, i, u in got.collect()}
    assert len(r) == 320
    assert r[("10", "10")] == ("old", 10, T0, T0)
    assert r[("10", "280")] == ("new", 280, T0, T1)
    assert r[("10", "310")] == ("new", None, T1, T1)


@PROP
@given(tgt=rows_strategy, src=rows_strategy)
def test_prop_scd1_merge_brute_force(spark, tgt, src):
    t_rows = [(k, a, b, T0, T0) for k, a, b in _unique_by_key(tgt)]
    t = spark.createDataFrame(t_rows, "k int, a string, b int, insert_dts timestamp_ntz, update_dts timestamp_ntz")
    s = spark.createDataFrame(_unique_by_key(src), SCHEMA)
    got = scd1_merge(t, s, ["k"], T1)
    expect = {r[0]: r for r in t_rows}
    for k, a, b in _unique_by_key(src):
        expect[k] = (k, a, b, expect[k][3] if k in expect else T1, T1)
    assert rows(got) == sorted(expect.values(), key=repr)


@PROP
@given(
    first=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 20), st.integers(0, 9)), max_size=12),
    second=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 20), st.integers(0, 9)), max_size=12),
)
def test_prop_cdc_scd1_newest_wins(spark, first, second):
    schema = "k int, seq int, v int"
    t = cdc_scd1(None, spark.createDataFrame(first, schema), ["k"], "seq", ["v"])
    got = cdc_scd1(t, spark.createDataFrame(second, schema), ["k"], "seq", ["v"])
    # Brute force: per key the greatest (seq, v) of each batch; the second
    # batch's pick wins unless it is older than the first's.
    def newest(rs):
        out = {}
        for k, q, v in rs:
            if k not in out or (q, v) > out[k][1:]:
                out[k] = (k, q, v)
        return out
    a, b = newest(first), newest(second)
    expect = dict(a)
    for k, r in b.items():
        if k not in a or r[1] >= a[k][1]:
            expect[k] = r
    assert rows(got) == sorted(expect.values(), key=repr)
