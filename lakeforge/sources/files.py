"""Batch file sources.

Readers always take an explicit schema for production loads (inference
only for S1, once, from a sample). CSV binds columns by position, like a
``$1 … $n`` copy. Row lineage (S9) is computed with partition-local
positions, never by routing a file through one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeforge.session import ensure_checkpoint_dir, materialize


@dataclass(frozen=True)
class CsvDialect:
    """CSV file format: delimiter, optional quotes, header, NULL tokens.

    Spark's ``nullValue`` takes one token only, so further tokens are
    mapped to NULL after the read; empty fields read as NULL.
    """

    delimiter: str = ","
    quote: str = '"'
    header: bool = True
    null_tokens: tuple[str, ...] = ()
    empty_as_null: bool = True
    multiline: bool = False

    @classmethod
    def simple(cls) -> CsvDialect:
        """Optional quotes and one header line only."""
        return cls()

    @classmethod
    def with_null_tokens(cls, *tokens: str) -> CsvDialect:
        return cls(null_tokens=tuple(tokens) or ("NULL", "null"))

    def options(self) -> dict[str, str]:
        opts = {
            "sep": self.delimiter,
            "quote": self.quote,
            # A quote inside a quoted field is written doubled ("a""b").
            "escape": self.quote,
            "header": str(self.header).lower(),
            "enforceSchema": "true",
            "mode": "PERMISSIVE",
            "multiLine": str(self.multiline).lower(),
        }
        if self.null_tokens:
            opts["nullValue"] = self.null_tokens[0]
        if self.empty_as_null:
            opts["emptyValue"] = ""
        return opts

    def apply_null_tokens(self, df: DataFrame) -> DataFrame:
        extra = list(self.null_tokens[1:])
        cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
        if not (extra or self.empty_as_null) or not cols:
            return df
        tokens = extra + ([""] if self.empty_as_null else [])
        return df.withColumns({c: F.when(F.col(c).isin(tokens), F.lit(None)).otherwise(F.col(c)) for c in cols})


def infer_json_schema(spark: SparkSession, sample_path: str, multiline: bool = True) -> StructType:
    """Infer the schema once from a sample file; store it as a constant."""
    return spark.read.option("multiLine", str(multiline).lower()).json(sample_path).schema


def read_json(spark: SparkSession, path: str, schema: StructType, multiline: bool = True) -> DataFrame:
    """Batch JSON read with an explicit schema (one object per file by default)."""
    return spark.read.schema(schema).option("multiLine", str(multiline).lower()).json(path)


def read_json_rescued(spark: SparkSession, path: str, schema: StructType, rescued: str = "_rescued", whole_files: bool = False) -> DataFrame:
    """JSON read with a frozen schema that loses nothing when files change.

    ``rescued`` maps the name of each top-level field that the schema lacks,
    or whose value does not fit its type, to the value's JSON text; NULL
    where all fitted. A record that is no JSON object is rescued whole, under
    the empty name. One record to a line, or (``whole_files``) to a file.
    """
    lines = spark.read.option("wholetext", whole_files).text(path)
    raw = F.from_json("value", "map<string,string>")
    rows = lines.select("value", raw.alias("raw"), F.from_json("value", schema).alias("row"))
    fields = schema.fieldNames()
    # the names of the fields that came out empty, to look up what was there
    empty = F.filter(F.array(*[F.when(F.col(f"row.`{n}`").isNull(), F.lit(n)) for n in fields]), lambda n: n.isNotNull())
    lost = F.map_filter("raw", lambda k, v: v.isNotNull() & (~k.isin(fields) | F.array_contains(empty, k)))
    lost = F.when(F.col("raw").isNull() & F.col("value").isNotNull(), F.create_map(F.lit(""), F.col("value"))).when(F.size(lost) > 0, lost)
    return rows.select(*[F.col(f"row.`{n}`").alias(n) for n in fields], lost.alias(rescued))


def read_csv(spark: SparkSession, path: str, schema: StructType, dialect: CsvDialect = CsvDialect()) -> DataFrame:
    """Positional CSV read (S5/S11 batch form)."""
    df = spark.read.schema(schema).options(**dialect.options()).csv(path)
    return dialect.apply_null_tokens(df)


def load_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    target_cols: Sequence[tuple[str, str]] | None = None,
    dialect: CsvDialect = CsvDialect(),
) -> DataFrame:
    """Load a CSV into a column list; target columns absent from the
    file stay NULL. ``target_cols`` is ``[(name, type), …]`` in table order.
    """
    df = read_csv(spark, path, schema, dialect)
    if not target_cols:
        return df
    return df.select(
        *[F.col(n).cast(t).alias(n) if n in df.columns else F.lit(None).cast(t).alias(n) for n, t in target_cols]
    )


def read_variant_json(spark: SparkSession, path: str, column: str = "data") -> DataFrame:
    """JSON records into one VARIANT column (S4/S8 batch form)."""
    return spark.read.format("json").option("singleVariantColumn", column).load(path)


def load_csv_with_lineage(
    spark: SparkSession,
    path: str,
    schema: StructType,
    dialect: CsvDialect = CsvDialect(),
    now=None,
    folder: bool = False,
) -> DataFrame:
    """CSV rows plus load times, source file name and row number in file.

    A file may be cut into several splits (blocks) read by different
    tasks. Each row gets its position inside its task from
    ``monotonically_increasing_id``; rows of one (file, block) are read
    consecutively by one task, so ``position - min(position)`` is the row's
    index inside its block. Per-block row counts (one row per block) give
    each block's offset inside its file. The positioned rows are
    materialised so both passes see the same numbering. The first data
    row of a file is row 1 (a skipped header is not counted). With
    ``folder`` a file's name includes that of its folder, for files that are
    told apart by it.
    """
    ensure_checkpoint_dir(spark)
    df = read_csv(spark, path, schema, dialect)
    df = df.select(*schema.fieldNames())  # no columns from folder names
    positioned = (
        df.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_pos"),
        )
    )
    positioned = materialize(positioned, "csv-lineage")
    blocks = positioned.groupBy("_file", "_block").agg(
        F.min("_pos").alias("_base"), F.count(F.lit(1)).alias("_n")
    )
    blocks = blocks.withColumn(
        "_off",
        F.coalesce(
            F.sum("_n").over(Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    )
    out = positioned.join(blocks.select("_file", "_block", "_base", "_off"), ["_file", "_block"])
    ts = F.current_timestamp() if now is None else F.lit(now).cast("timestamp_ntz")
    return out.select(
        *df.columns,
        ts.alias("insert_dts"),
        ts.alias("update_dts"),
        F.substring_index("_file", "/", -2 if folder else -1).alias("source_file_name"),
        (F.col("_off") + F.col("_pos") - F.col("_base") + 1).cast("bigint").alias("source_file_row_number"),
    )


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """List the files of a folder (path, size, modification time).

    Only metadata columns are selected, so file contents are not read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        F.col("path"), F.col("length").alias("size"), F.col("modificationTime").alias("last_modified")
    )
