"""Commits of stored tables, change images, exact stream dedup, checks inside a load."""

import datetime as dt
import glob
import os
import shutil

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from lakeforge.operators import CheckFailed, change_feed, insert_absent, is_null, not_accepted, upsert, upsert_images, upsert_with_images
from lakeforge.sources import KeyedTable, VersionedTable, infer_json_schema, read_json_rescued, stored_model
from lakeforge.streaming import apply_batch, csv_stream, json_stream, run_dedup_stream, run_scd1_stream, table_stream

KV = "k int, v string"
MARK = "0a1b2c3d-0000-4000-8000-000000000000"


# -------------------------------------------------------------------- commits
def staged_upsert(spark, root, feed=False):
    """A table of 40 rows, and a complete pending commit that changes and adds some; the rows it leads to."""
    t = KeyedTable(spark, root, ["k"], buckets=4, feed=feed)
    t.upsert(spark.range(40).selectExpr("cast(id AS int) AS k", "'old' AS v"))
    batch = spark.range(35, 45).selectExpr("cast(id AS int) AS k", "'new' AS v")
    step = upsert_with_images if feed else upsert
    merged = step(t._touched(batch), batch, ["k"])
    kind = F.when(F.col("_change_type").isNull(), "rows").otherwise("changes") if feed else F.lit("rows")
    name = t._stage(merged, kind, (MARK, 7))
    return t, name, sorted([(k, "old") for k in range(35)] + [(k, "new") for k in range(35, 45)], key=repr)


@pytest.mark.parametrize("feed", [False, True])
@pytest.mark.parametrize("moved", [0, 1, 2, 4])
def test_stop_between_removal_and_arrival_loses_nothing(spark, tmp_dir, moved, feed):
    root = f"{tmp_dir}/t"
    t, name, want = staged_upsert(spark, root, feed)
    folders = sorted(glob.glob(f"{root}/_pending/{name}/_kind=rows/_b=*"))
    for f in folders[:moved]:  # these have arrived
        shutil.rmtree(f"{t.path}/{os.path.basename(f)}")
        shutil.move(f, t.path)
    if moved < len(folders):  # of this one, the old partition is gone and the new one not yet there
        shutil.rmtree(f"{t.path}/{os.path.basename(folders[moved])}")
    again = KeyedTable(spark, root, ["k"], buckets=4, feed=feed)
    assert rows(again.read()) == want
    assert again.applied(MARK) == 7 and not os.listdir(f"{root}/_pending")
    # the replayed batch is known
    batch = spark.createDataFrame([(1, "replayed")], KV)
    again.upsert(batch, mark=(MARK, 7))
    assert rows(again.read()) == want
    if feed:
        assert again.changes(after=1).count() == 5 * 2 + 5


def test_pending_commit_that_is_not_complete_is_dropped(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    t, name, want = staged_upsert(spark, root)
    os.remove(f"{root}/_pending/{name}/_SUCCESS")
    again = KeyedTable(spark, root, ["k"], buckets=4)
    assert {r["v"] for r in again.read().collect()} == {"old"} and again.applied(MARK) == -1
    batch = spark.range(35, 45).selectExpr("cast(id AS int) AS k", "'new' AS v")
    again.upsert(batch, mark=(MARK, 7))
    assert rows(again.read()) == want


def test_append_moves_files_in_and_survives_a_stop(spark, tmp_dir):
    t = KeyedTable(spark, f"{tmp_dir}/t", ["k"], buckets=4)
    first = spark.range(40).selectExpr("cast(id AS int) AS k", "'a' AS v")
    t.append(first, lambda cur, b: b)
    before = set(glob.glob(f"{t.path}/*/*.parquet"))
    batch = spark.range(30, 60).selectExpr("cast(id AS int) AS k", "'b' AS v")
    t._stage(insert_absent(t._touched(batch), batch, ["k"]), F.lit("more"), (MARK, 0))
    some = sorted(glob.glob(f"{tmp_dir}/t/_pending/*/_kind=more/_b=*/*.parquet"))[0]
    shutil.move(some, f"{t.path}/{some.split('/')[-2]}/")
    again = KeyedTable(spark, f"{tmp_dir}/t", ["k"], buckets=4)
    assert rows(again.read()) == sorted([(k, "a" if k < 40 else "b") for k in range(60)], key=repr)
    assert before < set(glob.glob(f"{t.path}/*/*.parquet"))
    again.compact()
    assert len(glob.glob(f"{t.path}/*/*.parquet")) == 4 and again.read().count() == 60


def test_marks_of_streams_outlive_old_commits(spark, tmp_dir):
    t = KeyedTable(spark, f"{tmp_dir}/t", ["k"], buckets=2)
    for n in range(4):
        t.upsert(spark.createDataFrame([(n, "x")], KV), mark=(MARK, n))
    t.upsert(spark.createDataFrame([(9, "x")], KV))
    t.upsert(spark.createDataFrame([(10, "x")], KV), mark=(MARK.replace("0a", "1a"), 0))
    assert t.applied(MARK) == 3 and t.last_commit() == 6
    assert len(os.listdir(f"{tmp_dir}/t/_commits")) <= 4


def test_scd1_stream_writes_what_its_batch_touches(spark, tmp_dir):
    """Bytes written follow the batch, not the table; an empty run writes nothing."""
    from pyspark.sql.types import StringType, StructField, StructType

    now = dt.datetime(2024, 1, 2)
    t = KeyedTable(spark, f"{tmp_dir}/t", ["k"], buckets=32)
    first = spark.range(3000).selectExpr("cast(id AS string) AS k", "repeat(sha2(cast(id AS string), 256), 4) AS v",
                                         "timestamp_ntz'2024-01-01' AS insert_dts", "timestamp_ntz'2024-01-01' AS update_dts")
    t.merge(first, lambda cur, b: b)
    size = lambda: {f: os.path.getsize(f) for f in glob.glob(f"{t.path}/*/*.parquet")}
    before = size()
    os.makedirs(f"{tmp_dir}/raw")
    with open(f"{tmp_dir}/raw/1.csv", "w") as f:
        f.write("k,v\n7,changed\n")
    schema = StructType([StructField("k", StringType()), StructField("v", StringType())])
    for _ in range(2):
        run_scd1_stream(csv_stream(spark, f"{tmp_dir}/raw", schema), t, f"{tmp_dir}/ck", ["k"], now=lambda: now).awaitTermination()
    after = size()
    new = {f: n for f, n in after.items() if f not in before}
    assert len(new) == 1 and sum(new.values()) < sum(before.values()) / 10
    assert t.read().filter("k = '7'").first()["v"] == "changed" and t.read().count() == 3000


# --------------------------------------------------------------- change images
def test_change_feed_of_maps_and_variants(spark):
    make = lambda m, j: f"map({m}) AS m, parse_json('{j}') AS j, array(named_struct('p', map('q', {len(j)}))) AS n"
    before = spark.sql(f"SELECT 1 AS k, {make('1, 2, 3, 4', '{}')} UNION ALL SELECT 2, {make('1, 2', '[1]')} UNION ALL SELECT NULL, {make('1, 2', '[2]')}")
    after = spark.sql(f"SELECT 1 AS k, {make('3, 4, 1, 2', '{}')} UNION ALL SELECT 2, {make('1, 3', '[1]')} UNION ALL SELECT 3, {make('1, 2', '[1]')}")
    got = change_feed(before, after, ["k"]).select("k", F.to_json("m").alias("m"), F.to_json("j").alias("j"), "_change_type")
    assert rows(got) == sorted([(2, '{"1":2}', "[1]", "update_preimage"), (2, '{"1":3}', "[1]", "update_postimage"),
                                (3, '{"1":2}', "[1]", "insert"), (None, '{"1":2}', "[2]", "delete")], key=repr)
    assert change_feed(before, before, ["k"]).count() == 0
    complete = before.filter("k IS NOT NULL")
    images = upsert_images(complete, after, ["k"]).select("k", "_change_type")
    assert rows(images) == [(2, "update_postimage"), (2, "update_preimage"), (3, "insert")]


def test_change_feed_of_many_equal_rows_without_key(spark):
    row = "CAST(NULL AS int) AS k, 'same' AS v"
    before, after = spark.range(1000).selectExpr(row.split(", ")[0], "'same' AS v"), spark.range(150_000).selectExpr(*row.split(", "))
    got = change_feed(before, after, ["k"])
    assert got.groupBy("k", "v", "_change_type").count().collect() == [(None, "same", "insert", 149_000)]
    plan = got._jdf.queryExecution().toString()
    assert "Window" not in plan


cells = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from(["a", "b", None])), max_size=12)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cells, cells)
def test_images_of_a_merge_are_those_of_its_versions(spark, target, source):
    one = lambda pairs: list({k: (k, v) for k, v in pairs if k is not None}.values()) + [p for p in pairs if p[0] is None]
    t, s = spark.createDataFrame(one(target), KV), spark.createDataFrame(one(source), KV)
    merged = upsert(t, s, ["k"])
    want = rows(change_feed(t, merged, ["k"]))
    assert rows(upsert_images(t, s, ["k"])) == want
    both = upsert_with_images(t, s, ["k"])
    assert rows(both.filter("_change_type IS NULL").drop("_change_type")) == rows(merged)
    assert rows(both.filter("_change_type IS NOT NULL")) == want


def test_images_of_a_column_that_the_target_lacks(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], KV)
    s = spark.createDataFrame([(1, "a", None), (2, "b", 5), (3, "c", 6)], KV + ", extra int")
    want = sorted([(2, "b", None, "update_preimage"), (2, "b", 5, "update_postimage"), (3, "c", 6, "insert")], key=repr)
    assert rows(upsert_images(t, s, ["k"])) == want


def test_feed_is_read_by_commit(spark, tmp_dir):
    t = KeyedTable(spark, f"{tmp_dir}/t", ["k"], buckets=4, feed=True)
    versions = [spark.createDataFrame([], KV)]
    loads = [[(1, "a"), (2, "b")], [(2, "B"), (3, "c")], [(3, "c")], [(1, "z")]]
    for n, load in enumerate(loads):
        batch = spark.createDataFrame(load, KV)
        t.upsert(batch, mark=(MARK, n))
        t.upsert(batch, mark=(MARK, n))  # replayed
        versions.append(upsert(versions[-1], batch, ["k"]))
    for a in range(4):
        for b in range(a + 1, 5):
            got = t.changes(after=a, upto=b)
            want = [(*r, n + 1) for n in range(a, b) for r in change_feed(versions[n], versions[n + 1], ["k"]).collect()]
            assert rows(got.select("k", "v", "_change_type", "_commit")) == sorted(want, key=repr)
    assert rows(t.read()) == rows(versions[-1])
    assert t.changes(after=4).columns == ["k", "v", "_change_type", "_commit"]


# ---------------------------------------------------------------- stream dedup
def test_stream_dedup_keeps_rows_however_late(spark, tmp_dir):
    """1 June, 2 June, then 1 January: five rows each, and later copies of some."""
    schema = "id long, ts timestamp_ntz, v string"
    day = lambda d, ids: [(i, d, f"v{i}") for i in ids]
    june, late = dt.datetime(2024, 6, 1), dt.datetime(2024, 1, 1)
    files = [day(june, range(5)), day(dt.datetime(2024, 6, 2), range(5, 10)), day(late, range(10, 15)),
             day(late, range(12, 15)) + day(june, range(3)) + day(june, [20, 20, 20]) + [(None, late, "n")] * 2, [(None, late, "n")]]
    t = KeyedTable(spark, f"{tmp_dir}/out", ["id"], buckets=4)
    for i, data in enumerate(files):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
        stream = table_stream(spark, f"{tmp_dir}/in", max_files_per_trigger=1)
        run_dedup_stream(stream, t, f"{tmp_dir}/ck").awaitTermination()
    want = {r for f in files for r in f}
    assert rows(t.read()) == sorted(want, key=repr)
    run_dedup_stream(table_stream(spark, f"{tmp_dir}/in"), t, f"{tmp_dir}/fresh").awaitTermination()  # all again
    assert rows(t.read()) == sorted(want, key=repr)
    assert not glob.glob(f"{tmp_dir}/ck/state/*")  # no state beside the table


# ---------------------------------------------------------------------- intake
def test_micro_batches_are_bounded_by_bytes_and_files_archived(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/raw")
    for i in range(12):  # a backlog of unlike files
        with open(f"{tmp_dir}/raw/{i:02}.json", "w") as f:
            f.writelines('{"k": %d, "v": "%s"}\n' % (i, "x" * 90) for _ in range(400 if i % 4 == 0 else 10))
        os.utime(f"{tmp_dir}/raw/{i:02}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    sizes, seen = [], []

    def handle(batch, _):
        counts = {r["k"]: r["count"] for r in batch.groupBy("k").count().collect()}
        sizes.append(sum(counts.values()))
        seen.extend(sorted(counts))

    stream = json_stream(spark, f"{tmp_dir}/raw", spark.createDataFrame([], KV).schema, multiline=False,
                         max_bytes_per_trigger=45_000, archive=f"{tmp_dir}/archive")
    stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start().awaitTermination()
    assert sum(sizes) == 3 * 400 + 9 * 10 and max(sizes) <= 430 and len(sizes) >= 3
    assert seen == list(range(12))  # oldest first
    with pytest.raises(ValueError, match="files or by bytes"):
        json_stream(spark, f"{tmp_dir}/raw", spark.createDataFrame([], KV).schema, max_files_per_trigger=1, max_bytes_per_trigger=1)


# ---------------------------------------------------------------------- checks
def test_failed_checks_block_the_version(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/t")
    checks = {"key": is_null("k"), "known": not_accepted("v", ["a", "b"])}
    t.publish(spark.createDataFrame([(1, "a"), (2, None)], KV), checks=checks)
    with pytest.raises(CheckFailed, match="key: 1 rows, known: 2 rows") as e:
        t.publish(spark.createDataFrame([(None, "a"), (2, "c"), (3, "d")], KV), checks=checks)
    assert e.value.counts == {"key": 1, "known": 2}
    assert t.versions() == [1] and rows(t.read()) == [(1, "a"), (2, None)]
    assert t.publish(spark.createDataFrame([(5, "b")], KV), checks=checks) == 2
    assert rows(t.read()) == [(5, "b")]
    assert t.publish(spark.createDataFrame([], KV), checks=checks) == 3 and t.read().count() == 0


# ------------------------------------------------------------- stored models, S1
def test_stored_model_is_built_once_per_input(spark, tmp_dir):
    built = []

    def build(folder):
        built.append(folder)
        spark.read.parquet(f"{tmp_dir}/in").groupBy().count().write.parquet(f"{folder}/n")

    spark.range(5).write.parquet(f"{tmp_dir}/in")
    roots = {stored_model(spark, "m", [f"{tmp_dir}/in"], build) for _ in range(3)}
    assert len(roots) == 1 and len(built) == 1
    spark.range(3).write.mode("append").parquet(f"{tmp_dir}/in")
    later = stored_model(spark, "m", [f"{tmp_dir}/in"], build)
    assert len(built) == 2 and spark.read.parquet(f"{later}/n").first()[0] == 8


def test_rescued_json_loses_nothing(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/raw")
    lines = ['{"a": 1, "b": "x", "t": "2024-01-01T00:00:00"}', '{"a": "one", "b": "y"}', '{"a": 2, "b": "z", "more": {"p": [1, 2]}, "a.b": 3}', "no json", "{}", '{"a": null, "b": 5}']
    with open(f"{tmp_dir}/raw/1.json", "w") as f:
        f.write("\n".join(lines))
    with open(f"{tmp_dir}/sample.json", "w") as f:
        f.write(lines[0])
    schema = infer_json_schema(spark, f"{tmp_dir}/sample.json", multiline=False)
    got = [(r["a"], r["b"], r["t"], r["_rescued"]) for r in read_json_rescued(spark, f"{tmp_dir}/raw", schema).collect()]
    assert got == [
        (1, "x", "2024-01-01T00:00:00", None),
        (None, "y", None, {"a": "one"}),
        (2, "z", None, {"more": '{"p":[1,2]}', "a.b": "3"}),
        (None, None, None, {"": "no json"}),
        (None, None, None, None),
        (None, "5", None, None),
    ]
