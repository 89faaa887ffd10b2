import csv
import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from conftest import rows
from lakeforge.sources import (
    CsvDialect,
    HistoryTable,
    KeyedTable,
    VersionedTable,
    list_files,
    load_csv,
    load_csv_with_lineage,
    table_inventory,
)
from lakeforge.operators import scd1_merge, scd2_snapshot, upsert
from lakeforge.streaming import (
    apply_batch,
    csv_stream,
    drain,
    json_stream,
    run_cdc_stream,
    run_scd1_stream,
    stream_dedup,
)

T1 = dt.datetime(2024, 1, 2)


def _write_csv(path, header, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(data)


def test_csv_dialect_null_tokens_and_missing_columns(spark, tmp_dir):
    _write_csv(f"{tmp_dir}/a.csv", ["id", "name", "note"],
               [["1", "NULL", "x"], ["2", "null", ""], ["3", "a,b", "NULL"]])
    schema = StructType([StructField(n, StringType()) for n in ("id", "name", "note")])
    df = load_csv(spark, f"{tmp_dir}/a.csv", schema,
                  [("id", "int"), ("name", "string"), ("note", "string"), ("extra", "string")],
                  CsvDialect.with_null_tokens("NULL", "null"))
    assert rows(df) == [(1, None, "x", None), (2, None, None, None), (3, "a,b", None, None)]


def test_lineage_row_numbers_match_brute_force(spark, tmp_dir):
    data = [[str(i), f"name {i}"] for i in range(3000)]
    _write_csv(f"{tmp_dir}/files/f1.csv", ["id", "name"], data[:1700])
    _write_csv(f"{tmp_dir}/files/f2.csv", ["id", "name"], data[1700:])
    schema = StructType([StructField("id", StringType()), StructField("name", StringType())])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # many blocks per file
    try:
        got = load_csv_with_lineage(spark, f"{tmp_dir}/files", schema, now=T1)
        got_rows = {(r["source_file_name"], r["id"]): r["source_file_row_number"] for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    expect = {}
    for path in glob.glob(f"{tmp_dir}/files/*.csv"):
        with open(path) as f:
            for n, rec in enumerate(list(csv.reader(f))[1:], start=1):
                expect[(os.path.basename(path), rec[0])] = n
    assert got_rows == expect


def test_list_files_and_inventory(spark, tmp_dir):
    spark.range(10).write.parquet(f"{tmp_dir}/t")
    files = list_files(spark, f"{tmp_dir}/t", "*.parquet")
    assert files.count() >= 1 and {"path", "size", "last_modified"} == set(files.columns)
    inv = table_inventory(spark, {"b": spark.range(3), "a": spark.range(5)})
    assert [tuple(r) for r in inv.collect()] == [("a", 5), ("b", 3)]


def test_versioned_table_publish_is_all_or_nothing(spark, tmp_dir):
    t = VersionedTable(spark, f"{tmp_dir}/tbl")
    assert t.publish(spark.range(3)) == 1
    bad = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception):
        t.publish(bad)
    assert t.versions() == [1] and t.read().count() == 3
    assert t.upsert(spark.range(2, 6), ["id"]) == 3  # the failed attempt's number is skipped
    assert sorted(r[0] for r in t.read().collect()) == [0, 1, 2, 3, 4, 5]
    feed = t.change_feed(["id"], 1)
    assert sorted(r[0] for r in feed.filter("_change_type = 'insert'").collect()) == [3, 4, 5]


JSON_SCHEMA = StructType([StructField("id", LongType()), StructField("v", StringType())])


def _land(path, name, recs):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        for r in recs:
            f.write('{"id": %d, "v": "%s"}\n' % r)


def test_file_stream_takes_each_file_once(spark, tmp_dir):
    raw, out, ck = f"{tmp_dir}/raw", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    _land(raw, "a.json", [(1, "a"), (2, "b")])
    drain(json_stream(spark, raw, JSON_SCHEMA, multiline=False), out, ck)
    _land(raw, "b.json", [(3, "c")])
    drain(json_stream(spark, raw, JSON_SCHEMA, multiline=False), out, ck)
    drain(json_stream(spark, raw, JSON_SCHEMA, multiline=False), out, ck)  # nothing new
    assert rows(spark.read.parquet(out)) == [(1, "a"), (2, "b"), (3, "c")]
    # A new checkpoint reprocesses every file (T-2).
    drain(json_stream(spark, raw, JSON_SCHEMA, multiline=False), f"{tmp_dir}/out2", f"{tmp_dir}/ck2")
    assert spark.read.parquet(f"{tmp_dir}/out2").count() == 3


def test_stream_dedup_with_and_without_watermark(spark, tmp_dir):
    schema = StructType([StructField("id", LongType()), StructField("ts", StringType())])
    raw = f"{tmp_dir}/raw"
    os.makedirs(raw)
    with open(f"{raw}/a.json", "w") as f:
        f.write('{"id": 1, "ts": "2024-01-01 00:00:00"}\n{"id": 1, "ts": "2024-01-01 00:00:00"}\n')
    s = spark.readStream.schema(schema).json(raw)
    drain(stream_dedup(s), f"{tmp_dir}/o1", f"{tmp_dir}/c1")
    assert spark.read.parquet(f"{tmp_dir}/o1").count() == 1
    s2 = s.withColumn("ts", F.col("ts").cast("timestamp"))
    drain(stream_dedup(s2, ["id"], watermark=("ts", "1 hour")), f"{tmp_dir}/o2", f"{tmp_dir}/c2")
    assert spark.read.parquet(f"{tmp_dir}/o2").count() == 1


def test_cdc_stream_late_rows_and_replay(spark, tmp_dir):
    raw, ck = f"{tmp_dir}/raw", f"{tmp_dir}/ck"
    schema = StructType([StructField("k", LongType()), StructField("seq", LongType()), StructField("v", StringType())])
    table = VersionedTable(spark, f"{tmp_dir}/tbl")
    os.makedirs(raw)
    with open(f"{raw}/1.json", "w") as f:
        f.write('{"k":1,"seq":5,"v":"a"}\n{"k":2,"seq":1,"v":"b"}\n')
    run_cdc_stream(spark.readStream.schema(schema).json(raw), table, ck, ["k"], "seq").awaitTermination()
    with open(f"{raw}/2.json", "w") as f:
        f.write('{"k":1,"seq":3,"v":"late"}\n{"k":2,"seq":2,"v":"newer"}\n')
    run_cdc_stream(spark.readStream.schema(schema).json(raw), table, ck, ["k"], "seq").awaitTermination()
    n_versions = len(table.versions())
    # Empty drain: no new version (run only when the stream holds data).
    run_cdc_stream(spark.readStream.schema(schema).json(raw), table, ck, ["k"], "seq").awaitTermination()
    assert len(table.versions()) == n_versions
    assert rows(table.read()) == [(1, 5, "a"), (2, 2, "newer")]


def test_scd1_stream_from_csv(spark, tmp_dir):
    landing, ck = f"{tmp_dir}/landing", f"{tmp_dir}/ck"
    schema = StructType([StructField(n, StringType()) for n in ("f", "l", "phone")])
    tgt = spark.createDataFrame([("a", "b", "1", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1))],
                                "f string, l string, phone string, insert_dts timestamp_ntz, update_dts timestamp_ntz")
    table = VersionedTable(spark, f"{tmp_dir}/customer")
    _write_csv(f"{landing}/d1.csv", ["f", "l", "phone"], [["a", "b", "2"], ["c", "d", '3,"x"']])
    run_scd1_stream(csv_stream(spark, landing, schema), table, ck, ["f", "l"], now=lambda: T1,
                    initial=tgt).awaitTermination()
    got = rows(table.read())
    assert got == [("a", "b", "2", dt.datetime(2024, 1, 1), T1), ("c", "d", '3,"x"', T1, T1)]


def test_infer_schema_from_sample_then_stream(spark, tmp_dir):
    from lakeforge.sources import infer_json_schema

    os.makedirs(f"{tmp_dir}/raw")
    with open(f"{tmp_dir}/raw/sample.json", "w") as f:
        f.write('{"type": "FeatureCollection",\n "features": [{"id": "a", "properties": {"mag": 1.5, "time": 1}}]}')
    schema = infer_json_schema(spark, f"{tmp_dir}/raw/sample.json")
    assert schema["features"].dataType.elementType["properties"].dataType["mag"].dataType.simpleString() == "double"
    drain(json_stream(spark, f"{tmp_dir}/raw", schema), f"{tmp_dir}/out", f"{tmp_dir}/ck")
    got = spark.read.parquet(f"{tmp_dir}/out").selectExpr("explode(features) f").select("f.id", "f.properties.mag")
    assert rows(got) == [("a", 1.5)]


def test_publish_kinds(spark, tmp_dir):
    from lakeforge.sources import publish

    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert publish(spark, df, "v_model", "view") == "v_model"
    assert spark.table("v_model").count() == 2
    assert publish(spark, df, "t", "table", root=f"{tmp_dir}/t") == 1
    assert publish(spark, df, "t", "table", root=f"{tmp_dir}/t") == 2  # replace = new version
    inc = f"{tmp_dir}/inc"
    publish(spark, df, "i", "incremental", root=inc, unique_key=["k"])
    publish(spark, spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string"), "i", "incremental",
            root=inc, unique_key=["k"])
    assert rows(VersionedTable(spark, inc).read()) == [(1, "a"), (2, "B"), (3, "c")]


def files_of(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_keyed_table_replaces_touched_partitions_only(spark, tmp_dir):
    t = KeyedTable(spark, f"{tmp_dir}/b", ["k"], buckets=64)
    t.upsert(spark.range(0, 400).selectExpr("id AS k", "'v0' AS v"))
    before = files_of(tmp_dir)
    assert len(before) <= 64  # one file per partition, whatever the number of tasks
    t.upsert(spark.createDataFrame([(3, "new", 1), (1000, "ins", 2)], "k bigint, v string, extra int"))
    after = files_of(tmp_dir)
    assert 1 <= len(set(after) - set(before)) <= 2 and len(set(before) - set(after)) <= 2
    got = {r["k"]: (r["v"], r["extra"]) for r in t.read().collect()}  # the column that came later is there
    assert len(got) == 401 and got[3] == ("new", 1) and got[1000] == ("ins", 2) and got[4] == ("v0", None)


def test_keyed_table_failed_merge_leaves_it_as_it_was(spark, tmp_dir):
    t = KeyedTable(spark, f"{tmp_dir}/b", ["k"], buckets=4)
    t.upsert(spark.range(0, 40).selectExpr("id AS k", "0 AS v"))
    bad = spark.range(0, 40).selectExpr("id AS k", "if(id = 39, raise_error('boom'), 1) AS v")
    with pytest.raises(Exception, match="boom"):
        t.upsert(bad)
    assert {r["v"] for r in t.read().collect()} == {0}


def test_keyed_table_bucket_count_is_part_of_the_layout(spark, tmp_dir):
    t = KeyedTable(spark, f"{tmp_dir}/b", ["k"], buckets=4)
    t.upsert(spark.range(0, 40).selectExpr("id AS k", "0 AS v"))
    with pytest.raises(ValueError, match="4 buckets"):
        KeyedTable(spark, f"{tmp_dir}/b", ["k"], buckets=8)
    more = t.rebucket(f"{tmp_dir}/c", 16)
    assert rows(more.read()) == rows(t.read())
    more.upsert(spark.createDataFrame([(3, 9)], "k bigint, v int"))
    assert {r["k"]: r["v"] for r in more.read().collect()}[3] == 9


def test_keyed_scd1_into_empty_partitions(spark, tmp_dir):
    t = KeyedTable(spark, f"{tmp_dir}/c", ["k"], buckets=64)
    first = spark.createDataFrame([(1, "a", T1, T1)], "k int, v string, insert_dts timestamp_ntz, update_dts timestamp_ntz")
    t.merge(first, lambda cur, b: b)
    later = dt.datetime(2024, 2, 1)
    batch = spark.createDataFrame([(k, "n") for k in range(2, 40)], "k int, v string")
    t.merge(batch, lambda cur, b: scd1_merge(cur, b, ["k"], later))
    got = {r[0]: (r[1], r[2]) for r in t.read().collect()}
    assert got[1] == ("a", T1) and got[39] == ("n", later) and len(got) == 39


def test_history_table_appends_closed_and_leaves_unchanged_open_versions(spark, tmp_dir):
    schema = "k string, a string"
    loads = [
        [("x1", "x"), ("y", "y"), *((f"z{i}", "z") for i in range(60))],
        [("X1", "X"), ("y", "y"), ("w", "w")],  # the key's case changes with its value
        [("x1", "x"), ("y", "Y"), ("w", "w")],
    ]
    times = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    t = HistoryTable(spark, f"{tmp_dir}/hist", ["k"], buckets=32, case_insensitive_keys=["k"])
    ref = None
    for load, now in zip(loads, times):
        src = spark.createDataFrame(load, schema)
        before = files_of(f"{tmp_dir}/hist")
        t.snapshot(src, ["a"], now)
        if ref is not None:
            after = files_of(f"{tmp_dir}/hist")
            closed = {f for f in before if "/closed/" in f}
            assert closed <= set(after) and all(after[f] == before[f] for f in closed)
            assert len({f for f in set(after) - set(before) if "/open/" in f}) <= 3  # touched partitions
            t.snapshot(src, ["a"], now)  # repeating a run changes nothing
        ref = scd2_snapshot(ref, src, ["k"], ["a"], now, case_insensitive_keys=["k"])
    cols = ["k", "a", "dbt_valid_from", "dbt_valid_to", "dbt_scd_id"]
    assert rows(t.read().select(*cols)) == rows(ref.select(*cols))
    assert t.open.read().count() == 63


BATCH = StructType([StructField("k", LongType()), StructField("seq", LongType()), StructField("v", StringType())])


def _land_batch(path, name, recs):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "w") as f:
        f.writelines('{"k":%d,"seq":%d,"v":"%s"}\n' % r for r in recs)


@pytest.mark.parametrize("kind", ["versioned", "keyed"])
def test_fresh_checkpoint_and_second_stream_lose_nothing(spark, tmp_dir, kind):
    table = VersionedTable(spark, f"{tmp_dir}/t") if kind == "versioned" else KeyedTable(spark, f"{tmp_dir}/t", ["k"], 4)
    run = lambda raw, ck: run_cdc_stream(spark.readStream.schema(BATCH).json(f"{tmp_dir}/{raw}"), table, f"{tmp_dir}/{ck}", ["k"], "seq").awaitTermination()
    _land_batch(f"{tmp_dir}/raw", "1", [(1, 1, "a"), (2, 1, "b")])
    run("raw", "ck1")
    _land_batch(f"{tmp_dir}/raw", "2", [(1, 2, "newer"), (3, 1, "c")])
    run("raw", "ck2")  # the checkpoint was reset: all files again, batch 0 again
    assert rows(table.read()) == [(1, 2, "newer"), (2, 1, "b"), (3, 1, "c")]
    _land_batch(f"{tmp_dir}/other", "1", [(4, 1, "d")])
    run("other", "ck3")  # another stream into the same table, with its own batch 0
    assert rows(table.read()) == [(1, 2, "newer"), (2, 1, "b"), (3, 1, "c"), (4, 1, "d")]


@pytest.mark.parametrize("kind", ["versioned", "keyed"])
def test_replayed_batch_changes_nothing(spark, tmp_dir, kind):
    """A failure between the table's commit and the checkpoint's: the same batch comes again."""
    table = VersionedTable(spark, f"{tmp_dir}/t") if kind == "versioned" else KeyedTable(spark, f"{tmp_dir}/t", ["k"], 4)
    step = lambda cur, b: b if cur is None else upsert(cur, b, ["k"])
    mark = ("0a1b2c3d-0000-4000-8000-000000000000", 0)
    batch = spark.createDataFrame([(1, "a"), (None, "no key")], "k int, v string")
    apply_batch(table, batch.filter("k IS NOT NULL") if kind == "keyed" else batch, step, mark)
    before = rows(table.read())
    apply_batch(table, batch.filter("k IS NOT NULL") if kind == "keyed" else batch, step, mark)
    assert rows(table.read()) == before
    apply_batch(table, spark.createDataFrame([(2, "b")], "k int, v string"), step, (mark[0], 1))
    assert table.read().count() == len(before) + 1
