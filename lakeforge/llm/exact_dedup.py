"""Exact dedup by a tree merge of sorted digest runs (DataFrame functions only).

Each input partition becomes one *run*: its rows reduced to one entry per
digest (best row, row count), sorted by digest. Runs are merged in binomial
rounds, ``2**rounds_per_merge`` at a time: every round groups by (run
number shifted right, digest), so a digest that a third of all rows share
is never one task's work but one entry per surviving run. At every level
an entry keeps the wanted identifier, and entries meet only if digest,
byte length and an independent 64-bit hash all agree. When one run is
left the answers are handed back down the same tree, again by (run,
digest), so that the way back is not skewed either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import ascii_lower, documents, materialize, with_key

KEY = ["digest", "n_bytes", "check"]


def digest_runs(df: DataFrame, id_col: str, text: Column) -> DataFrame:
    """``(doc_id, row, run, digest, n_bytes, check)`` per row, written to the shared folder."""
    rows = df.select(F.col(id_col).alias("doc_id"), text.alias("norm"))
    rows = rows.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().alias("run"),
        F.unhex(F.sha2("norm", 256)).alias("digest"),
        F.octet_length("norm").cast("long").alias("n_bytes"),
        F.xxhash64("norm").alias("check"),
    )
    return materialize(rows, "digests")


def exact_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    normalise=ascii_lower,
    rounds_per_merge: int = 3,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``keep`` is "min" or "max": which identifier of equal texts stays. Null
    text counts as empty. Rows that repeat the kept identifier are ties:
    exactly one of them (the first in input order) is kept. A null
    identifier is kept only if its group has no other. An empty table gives
    an empty result; other columns are ignored.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep must be 'min' or 'max'")
    docs = digest_runs(df, id_col, normalise(F.coalesce(F.col(text_col), F.lit(""))))
    # Present identifiers first, then the wanted extreme, then the first row.
    if keep == "max":
        best = F.max(F.struct(F.col("doc_id").isNotNull().alias("has"), F.col("doc_id").alias("id"), (-F.col("row")).alias("at")))
    else:
        best = F.min(F.struct(F.col("doc_id").isNull().alias("has"), F.col("doc_id").alias("id"), F.col("row").alias("at")))
    merge = F.max if keep == "max" else F.min

    level = docs.groupBy("run", *KEY).agg(best.alias("best"), F.count(F.lit(1)).alias("size"))
    levels = [materialize(level.sortWithinPartitions("run", "digest"), "run0")]
    runs = docs.agg(F.max("run")).first()[0] or 0
    while runs:
        runs >>= rounds_per_merge
        up = levels[-1].withColumn("run", F.shiftright("run", rounds_per_merge)).groupBy("run", *KEY)
        merged = up.agg(merge("best").alias("best"), F.sum("size").alias("size"))
        levels.append(materialize(merged.sortWithinPartitions("run", "digest"), f"run{len(levels)}"))

    answer = levels.pop()
    while levels:
        below = levels.pop().select("run", *KEY, F.shiftright("run", rounds_per_merge).alias("up"))
        above = answer.withColumnRenamed("run", "up")
        answer = below.join(above, ["up", *KEY]).drop("up")
    out = docs.join(answer, ["run", *KEY])
    kept = F.abs(F.col("best.at")) == F.col("row")
    return out.select(
        "doc_id",
        F.col("best.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        kept.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "row",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` drops; all columns stay."""
    rows, key = with_key(docs, id_col)
    # The wanted identifier first, ties by the row key.
    pair = F.struct(F.col(id_col).alias("id"), F.col(key).alias("key"))
    found = exact_dedup(rows.select(pair.alias("pair"), F.col(text_col).alias("text")), "pair", "text", keep)
    kept = found.where("kept").select(F.col("doc_id.key").alias(key))
    out = rows.join(kept, key, "left_semi")
    return out if key == id_col else out.drop(key)


ORACLE_SQL = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""


def query(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir), keep="max").drop("row")
