"""Retail star schema.

Driver-table mapping (bronze):

| bronze      | driver                                                    |
| department  | lineitem rolled up per (l_suppkey, l_linenumber, ship day) |
| stores      | supplier: type and size from the nation key                |
| fact        | lineitem rolled up per (l_suppkey, ship day), but for every |
|             | tenth store: temperature, fuel price, markdowns (text, 'NA' |
|             | tokens), cpi, unemployment                                 |

Reports (R1, R2, R4, R6) join a date dimension holding one row per
department row to the fact on DATE_ID: many-to-many (trap T2). The SQL
result is kept, but it is computed with ``sum_over_join``: both sides are
aggregated per date first, so no row pairs are produced and the work stays
linear in the fact size however many rows share a date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.functions import iso_date_text, na_to_zero, surrogate_key
from lakeforge.operators import (
    current_rows,
    global_row_number,
    scd2_open,
    sum_over_join,
    upsert,
)

#: Line items that one task rolls up.
PART_ROWS = 250_000
MARKDOWNS = [f"markdown{i}" for i in range(1, 6)]
# The measures that a snapshot compares.
CHECK_COLS = ["store_weekly_sales", "fuel_price", "temperature", "cpi", "unemployment"]


def _txt(c) -> F.Column:
    return c.cast("string")


def stores_from_driver(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        F.col("s_suppkey").alias("store"),
        F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (F.col("s_nationkey") % 3 + 1).cast("int")).alias("type"),
        (F.lit(100000) + F.col("s_nationkey") * 1000).cast("int").alias("size"),
    )


def bronze_from_driver(lineitem: DataFrame, supplier: DataFrame) -> dict[str, DataFrame]:
    """Bronze tables from ``lineitem`` dealt by store and day.

    Both roll-ups come from an aggregation at the finer grain (supplier,
    line number, ship day): the store-day fact only needs min / max / count
    / sum, which roll up exactly from that grain. The rows go to the
    partition of their store and day first: there both roll-ups and their
    join on store and day follow without another exchange. A partial
    aggregate before it would hold nearly every row of a file split in one
    task's memory, as few rows share a key of the finer grain; partitions
    are as many as the row count (in the files' footers) asks for.
    """
    parts = max(16, -(-lineitem.count() // PART_ROWS))
    rows = lineitem.select(
        F.col("l_suppkey").alias("store"), F.col("l_linenumber").alias("dept"),
        F.col("l_shipdate").cast("date").alias("date"), "l_quantity", "l_extendedprice", "l_returnflag",
    ).repartition(parts, "store", "date")
    q = F.col("l_quantity")
    lines = rows.groupBy("store", "dept", "date").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("_sales"),
        F.max(F.col("l_returnflag") == "R").alias("_holiday"),
        F.min(q).alias("_min_q"),
        F.max(q).alias("_max_q"),
        F.count(F.lit(1)).alias("_n"),
    )
    department = lines.select(
        "store", "dept", "date",
        F.col("_sales").cast("double").alias("weekly_sales"),
        F.when(F.col("_holiday"), "TRUE").otherwise("FALSE").alias("isholiday"),
    )
    stores = stores_from_driver(supplier)
    ln, n = F.col("dept"), F.sum("_n")
    min_q, max_q = F.min("_min_q"), F.max("_max_q")
    fact = lines.filter(F.col("store") % 10 != 0).groupBy("store", "date").agg(
        max_q.alias("temperature"),
        F.min(ln).cast("double").alias("fuel_price"),
        F.when(F.min(ln) == 1, "NA").otherwise(_txt(min_q)).alias("markdown1"),
        F.when(F.max(ln) >= 6, "NA").otherwise(_txt(max_q)).alias("markdown2"),
        _txt(n).alias("markdown3"),
        F.when(n == 1, "NA").otherwise(_txt(F.sum(ln * F.col("_n")))).alias("markdown4"),
        _txt(F.max(ln)).alias("markdown5"),
        _txt(min_q + 100).alias("cpi"),
        F.when(max_q > 45, "NA").otherwise(_txt(max_q / 10)).alias("unemployment"),
        F.when(F.max("_holiday"), "TRUE").otherwise("FALSE").alias("isholiday"),
    )
    return {"department": department, "stores": stores, "fact": fact}


# ------------------------------------------------------------------ silver
def stage_dept(department: DataFrame, now, numbered: bool = True) -> DataFrame:
    """W2 + F3 + F11: global row number by date (tie-break store, dept).

    ``numbered=False`` leaves out ROW_NUM for consumers that never read it
    (the joined fact, the reports); the numbering costs a range shuffle
    and a checkpoint.
    """
    if numbered:
        department = global_row_number(department, ["date", "store", "dept"], name="row_num")
    return department.select(
        *(["row_num"] if numbered else []),
        iso_date_text("date").alias("date_id"),
        F.col("store").alias("store_id"),
        F.col("dept").alias("dept_id"),
        F.col("date").alias("store_date"),
        F.col("weekly_sales").alias("store_weekly_sales"),
        "isholiday",
        F.lit(now).cast("timestamp_ntz").alias("insert_date"),
    )


def stage_store(stores: DataFrame, now) -> DataFrame:
    return stores.select(
        F.col("store").alias("store_id"),
        F.col("type").alias("store_type"),
        F.col("size").alias("store_size"),
        F.lit(now).cast("timestamp_ntz").alias("insert_date"),
    )


def stg_fact(fact: DataFrame, now, dated: bool = False) -> DataFrame:
    """F8: 'NA' → 0 for the markdowns, CPI and unemployment; ``dated`` keeps the date itself, as STORE_DATE."""
    ts = F.lit(now).cast("timestamp_ntz")
    return fact.select(
        F.col("store").alias("store_id"),
        iso_date_text("date").alias("date_id"),
        "temperature",
        "fuel_price",
        *[na_to_zero(c).alias(c) for c in MARKDOWNS],
        na_to_zero("cpi").alias("cpi"),
        na_to_zero("unemployment").alias("unemployment"),
        "isholiday",
        ts.alias("insert_date"),
        ts.alias("vrsn_start_date"),
        ts.alias("vrsn_end_date"),
        *([F.col("date").alias("store_date")] if dated else []),
    )


# The columns of the joined fact.
COMBINED_COLS = [
    "store_id", "dept_id", "date_id", "store_weekly_sales",
    "temperature", "fuel_price", "cpi", "unemployment", *MARKDOWNS, "store_size",
]
STAGE_DEPT_COLS = ["date_id", "store_id", "dept_id", "store_date", "store_weekly_sales", "isholiday", "insert_date"]


def combined_fact(d: DataFrame, s: DataFrame, st: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Dept LEFT JOIN fact on (store, date_id) LEFT JOIN store.

    Both joined sides are unique on their join keys, so there is exactly
    one output row per department row; ``keep`` carries further department
    columns along (the staging row can then be read back from the result).
    DATE_ID is the text of STORE_DATE: facts that carry the date are joined
    on it, in the partitions that store and date have dealt them to.
    """
    s, day = s.drop("isholiday", "insert_date", "vrsn_start_date", "vrsn_end_date"), "date_id"
    if "store_date" in s.columns:
        s, day = s.drop("date_id"), "store_date"
    j = d.join(s, ["store_id", day], "left")
    j = j.join(st.select("store_id", "store_size"), "store_id", "left")
    return j.select(*COMBINED_COLS, *keep)


FACT_KEY = ["store_id", "dept_id", "date_id"]


def composite(prefix: str = "") -> F.Column:
    """The fact's surrogate key, from columns with a prefix."""
    return surrogate_key([F.col(f"{prefix}{c}") for c in FACT_KEY])


def fact_snapshot(open_versions: DataFrame | None, combined: DataFrame, now, **options) -> DataFrame:
    """M6: SCD2 on the fact's key over its open versions; five checked measures.

    Rows meet on the three natural columns; the composite surrogate key, an
    md5 of them, is computed on output and goes into the version id.
    """
    if open_versions is not None:
        open_versions = open_versions.drop("composite_key")
    rows = scd2_open(open_versions, combined, FACT_KEY, CHECK_COLS, now, id_key=composite, **options)
    return rows.withColumn("composite_key", composite())


def final_fact(history: DataFrame) -> DataFrame:
    """M8: open versions only."""
    return current_rows(history)


def planned_dates(stage: DataFrame) -> DataFrame:
    """Staged dates ten years on: a date dimension reaches past the facts."""
    later = F.add_months("store_date", 120)
    return stage.filter(F.col("dept_id") == 7).withColumns({"store_date": later, "date_id": iso_date_text(later)})


def dim_date(stage: DataFrame, now) -> DataFrame:
    key = ["row_num"] if "row_num" in stage.columns else []
    return stage.select(*key, "date_id", "store_date", "isholiday", F.lit(now).cast("timestamp_ntz").alias("update_date"))


def dim_store(stage: DataFrame, now) -> DataFrame:
    return stage.select("store_id", "store_type", "store_size", F.lit(now).cast("timestamp_ntz").alias("update_date"))


def incremental(existing: DataFrame | None, batch: DataFrame, unique_key: str) -> DataFrame:
    """M4: incremental model with a unique key (upsert)."""
    return batch if existing is None else upsert(existing, batch, [unique_key])


def dim_department(stage: DataFrame) -> DataFrame:
    return stage.select("dept_id")


# ------------------------------------------------------------------ reports
def _year(dd: DataFrame) -> DataFrame:
    return dd.withColumn("year", F.year("store_date"))


def sales_by_store_holiday(dd: DataFrame, ff: DataFrame) -> DataFrame:
    """dim_date LEFT JOIN fact on date_id, by (store, holiday flag)."""
    return sum_over_join(dd, ff, "date_id", "date_id", ["isholiday"], ["store_id"],
                         {"total_sales": "store_weekly_sales"}, how="left")


def sales_by_temperature_year(dd: DataFrame, ff: DataFrame) -> DataFrame:
    """R2: by (temperature, year)."""
    return sum_over_join(_year(dd), ff, "date_id", "date_id", ["year"], ["temperature"],
                         {"total_sales": "store_weekly_sales"})


def sales_by_store_size(ds: DataFrame, ff: DataFrame) -> DataFrame:
    """By store size."""
    return sum_over_join(ds, ff, "store_id", "store_id", ["store_size"], [], {"total_sales": "store_weekly_sales"})


def markdown_by_store_year(dd: DataFrame, ff: DataFrame) -> DataFrame:
    """Five markdown sums by (store, year)."""
    return sum_over_join(_year(dd), ff, "date_id", "date_id", ["year"], ["store_id"],
                         {f"sum_{m}": m for m in MARKDOWNS})


def sales_by_store_type(ds: DataFrame, ff: DataFrame) -> DataFrame:
    """By store type."""
    return sum_over_join(ds, ff, "store_id", "store_id", ["store_type"], [], {"total_sales": "store_weekly_sales"})


def fuel_by_store_year(dd: DataFrame, ds: DataFrame, ff: DataFrame) -> DataFrame:
    """Fact ⋈ date dim ⋈ store dim, fuel price by (store, year).

    The store join only repeats each fact row once per matching store-dim
    row: that count is applied as a weight.
    """
    store_w = ds.groupBy("store_id").agg(F.count(F.lit(1)).alias("_sw"))
    weighted = ff.join(store_w, "store_id").withColumn(
        "_fuel", F.col("fuel_price") * F.col("_sw")
    )
    return sum_over_join(_year(dd), weighted, "date_id", "date_id", ["year"], ["store_id"],
                         {"sum_fuel_price": "_fuel"})


def sales_by_cpi(ff: DataFrame) -> DataFrame:
    """By CPI (no join)."""
    return ff.groupBy("cpi").agg(F.sum("store_weekly_sales").alias("total_sales"))
