"""What a feed costs as it grows: landed files are compressed, a backlog is few micro-batches."""

import glob

from pyspark.sql import functions as F

from conftest import rows
from lakeforge.plans import catalog
from lakeforge.sources import KeyedTable
from lakeforge.streaming import backlog, run_dedup_stream, table_stream


def test_landed_files_are_gzipped_and_bounded(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(catalog, "LANDED_ROWS", 10)
    df = spark.range(25).withColumn("t", F.lit("text"))
    catalog._land_json(df.coalesce(1), f"{tmp_dir}/raw")
    files = glob.glob(f"{tmp_dir}/raw/*.json*")
    assert len(files) == 3 and all(f.endswith(".gz") for f in files)
    assert rows(spark.read.schema(df.schema).json(f"{tmp_dir}/raw")) == rows(df)


def test_backlog_is_a_bounded_number_of_micro_batches(spark, tmp_dir):
    spark.range(4000).repartition(40).write.parquet(f"{tmp_dir}/in")
    table = KeyedTable(spark, f"{tmp_dir}/out", ["id"], 4, feed=True)  # keeps every commit
    intake = backlog(spark, f"{tmp_dir}/in", batches=4, least=1)
    run_dedup_stream(table_stream(spark, f"{tmp_dir}/in", **intake), table, f"{tmp_dir}/ck").awaitTermination()
    assert 4 <= table.last_commit() <= 5
    assert rows(table.read()) == rows(spark.range(4000))
    assert backlog(spark, f"{tmp_dir}/in") == {"max_bytes_per_trigger": 1 << 30}


def test_quake_streams_take_a_backlog_in_one_micro_batch(spark, monkeypatch):
    monkeypatch.setattr(catalog, "LANDED_ROWS", 100)  # many landed files
    taken = []
    real = catalog.run_cdc_stream
    monkeypatch.setattr(catalog, "run_cdc_stream", lambda s, table, *a, **k: taken.append(table) or real(s, table, *a, **k))
    assert catalog.REGISTRY["stream_quake_cdc_activity"](spark, "/root/testdata/sf0.001").count() > 0
    assert taken[0].last_commit() == 1
    root = taken[0].root.removesuffix("/silver")
    assert KeyedTable(spark, f"{root}/distinct", ["id", "updated"], buckets=16).last_commit() == 1
