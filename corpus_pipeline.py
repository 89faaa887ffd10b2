"""The training-corpus pipeline: filter, two dedups, span removal, packing.

``STAGES`` lists the stages in order. Each function takes ``(spark, docs,
sf_dir)``; what it returns is written as Parquet and reread as the next
stage's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.llm.common import documents, materialize
from lakeforge.llm.exact_dedup import drop_copies
from lakeforge.llm.ngram_join import drop_near_copies
from lakeforge.llm.packing import pack_documents
from lakeforge.llm.substring_dedup import cut_repeats
from lakeforge.llm.toxicity import drop_toxic
from lakeforge.session import read_table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity reaches the bound go; fitted to the labelled ones among them."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the largest doc_id stays."""
    return drop_copies(docs, keep="max")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a shingle likeness of 0.75 or more, the smallest doc_id stays."""
    return drop_near_copies(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur more than once leave the texts, and ``n_chars`` follows."""
    out = cut_repeats(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every remaining document and their place in a sequence."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxic),
    ("exact_dedup", exact),
    ("ngram_join", near),
    ("suffix_array_dedup", repeats),
    ("best_fit_packing", pack),
]

#: Tokenizing, model scores and suffix arrays have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)
