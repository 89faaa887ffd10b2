"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.session import materialize as write_out
from lakeforge.session import read_table, scratch_path

__all__ = ["scratch_path"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back, which cuts its lineage.

    The shuffle files of the finished write are of no more use, but Spark
    deletes them only once the driver's JVM has collected what refers to
    them. A chain of such steps asks for that at each one, so that disks
    hold one step's shuffles and not all.
    """
    out = write_out(df, name)
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """``df`` as a table in the shared folder, bucketed by ``key``: joins on it, again and
    again, shuffle the other side only."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = f"{name}_{path[-12:]}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartition(parts, key)
    dealt.write.bucketBy(parts, key).sortBy(key).option("path", path).saveAsTable(table)
    spark.sparkContext._jvm.System.gc()
    return spark.table(table)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_key(df: DataFrame, id_col: str) -> tuple[DataFrame, str]:
    """``df`` and the name of a column that is present and unique in each row.

    This is ``id_col`` where its values are whole numbers, present and
    unique. Else (repeated rows, null ids) the rows are written once to the
    shared folder with a row number, so that every later read sees the same
    numbers.
    """
    if dict(df.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint"):
        repeated = df.groupBy(id_col).count().where((F.col("count") > 1) | F.col(id_col).isNull())
        if repeated.isEmpty():
            return df, id_col
    key = fresh_name(df, "row_number")
    return materialize(df.withColumn(key, F.monotonically_increasing_id()), "rows"), key


def keyed_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(rk, doc_id, text)``: a unique row key, the identifier, and the text (null: empty)."""
    rows, key = with_key(df, id_col)
    return rows.select(
        F.col(key).cast("long").alias("rk"),
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def text_slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds at most ``max_bytes`` of text (or one row)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        begin = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > max_bytes:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += n
        if begin < len(sizes):
            yield batch.slice(begin)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. All-ASCII values take the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def vocabulary(name: str) -> str:
    """A public vocabulary file's path, resolved where the task runs."""
    import public_tokenizers

    return public_tokenizers.path(name)
