"""Row cleaning, deduplication and numbering.

Scale notes
- ``latest_per_key`` is an aggregate (the maximum of a struct that holds
  every column once), so Spark runs a partial aggregate before the shuffle:
  a key holding a third of all rows is reduced map-side to one row per task
  and never lands whole in one task. A ``row_number()`` window would sort
  that key in a single task.
- ``global_row_number`` never uses an un-partitioned window: rows are range
  partitioned on the full ordering, numbered inside each partition, and the
  per-partition counts (one row per partition) are turned into offsets.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.session import ensure_checkpoint_dir, materialize


def _cols(items) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


def dedup_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Exact duplicate removal (hash aggregate with map-side combine)."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tiebreak: Sequence[str] | None = None,
    newest: bool = True,
) -> DataFrame:
    """Keep one row per key: the greatest (or least) ``order_by`` value.

    Same result as ``row_number() over (partition by keys order by
    order_by desc, tiebreak desc) = 1`` with Spark's NULL placement (NULLs
    sort lowest, so a NULL ``order_by`` loses when ``newest``). ``tiebreak``
    defaults to every other column, which makes the choice deterministic
    (trap T3). Columns keep their order and types.
    """
    cols = df.columns
    if tiebreak is None:
        taken = set(keys) | set(order_by)
        tiebreak = [
            f.name
            for f in df.schema.fields
            if f.name not in taken and _orderable(f.dataType)
        ]
    ordered = [*order_by, *tiebreak]
    rest = [f for f in df.schema.fields if f.name not in {*keys, *ordered}]
    if all(_orderable(f.dataType) for f in rest):
        # Every column once: those that order, then the others.
        row = F.struct(*_cols([*ordered, *(f.name for f in rest)]))
        pick = F.max(row) if newest else F.min(row)
    else:
        row, ordering = F.struct(*_cols([c for c in cols if c not in keys])), F.struct(*_cols(ordered))
        pick = F.max_by(row, ordering) if newest else F.min_by(row, ordering)
    return df.groupBy(*keys).agg(pick.alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in cols]
    )


def _orderable(dtype) -> bool:
    from pyspark.sql.types import MapType, VariantType

    return not isinstance(dtype, (MapType, VariantType))


def global_row_number(
    df: DataFrame,
    order_by: Sequence,
    name: str = "row_num",
    num_partitions: int | None = None,
    rows_per_partition: int = 250_000,
) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order_by)`` without one-partition sort.

    1. materialise the rows, so that counting them, sampling them for range
       bounds and sorting them compute the input once;
    2. range-partition on the whole ordering, into as many partitions as the
       row count asks for (``rows_per_partition``, or ``num_partitions``; the
       session's setting has no part in it), and sort inside each. Bounds lie on the whole
       ordering, so a date that holds a third of all rows is cut by the
       columns after it like any other stretch of rows;
    3. give each row its in-partition position
       (``monotonically_increasing_id`` = partition << 33 | position) and
       materialise again, so both passes read the same numbered rows;
    4. count rows per partition (one row per partition), prefix-sum the
       counts into offsets and add them back with a broadcast join of as
       many rows as there are partitions.

    The ordering should be total (add tie-break columns); rows that tie on
    the whole ordering get consecutive numbers in an unspecified order, and
    stay in one partition.
    """
    ensure_checkpoint_dir(df.sparkSession)
    order_cols = _cols(order_by)
    rows = materialize(df, "to-number")
    parts = num_partitions or max(1, -(-rows.count() // rows_per_partition))
    ranged = rows.repartitionByRange(parts, *order_cols).sortWithinPartitions(*order_cols)
    ranged = materialize(ranged.withColumn("_mid", F.monotonically_increasing_id()), "row-number")
    ranged = ranged.withColumn("_pid", F.shiftright("_mid", 33))
    runs = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("_pid", (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    out = ranged.join(F.broadcast(runs), "_pid").withColumn(name, (F.col("_mid") + F.col("_shift")).cast("bigint"))
    return out.select(name, *df.columns)


def na_to_zero_cols(df: DataFrame, cols: Iterable[str], strict: bool = True) -> DataFrame:
    """F8: ``'NA'`` token → 0, everything else cast to double."""
    from lakeforge.functions import na_to_zero

    return df.withColumns({c: na_to_zero(c, strict) for c in cols})


def add_audit(df: DataFrame, **constants) -> DataFrame:
    """constant audit columns; times are passed in (repeatable runs)."""
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def lookup(df: DataFrame, **equals) -> DataFrame:
    """conjunction of equality filters (pushed into the scan)."""
    cond = F.lit(True)
    for k, v in equals.items():
        cond = cond & (F.col(k) == F.lit(v))
    return df.filter(cond)


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """DISTINCT values of some columns."""
    return df.select(*cols).distinct()


def current_rows(hist: DataFrame, valid_to: str = "dbt_valid_to") -> DataFrame:
    """Open versions only."""
    return hist.filter(F.col(valid_to).isNull())


def continent_mart(df: DataFrame, continent: str, col: str = "country_continent_name") -> DataFrame:
    """case-insensitive equality filter (``UPPER(x) = 'AFRICA'``)."""
    return df.filter(F.upper(F.col(col)) == F.lit(continent.upper()))
