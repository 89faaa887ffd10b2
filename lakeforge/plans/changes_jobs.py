"""Change-application jobs on driver tables.

- Orders (M1, M12): day-one table = orders dated before 1999; the change
  batch = orders from 1998-07 on, some with a new status or price. The
  overlap half-year is the update set, later orders are inserts.
- Customers (M2, E5): contact first/last name are the composite key (40
  first names, each last name shared by 40 customers); the
  batch holds two market segments, one new to the target, one updated.
- Products (M5, M7, E6): the product dimension from ``part``; the second
  load changes some prices, upper-cases some names (a case-only change,
  not a change under the source's case-insensitive collation) and omits
  one brand (no hard delete).
- Events (M3): first batch = events before 2024-01-20, second batch =
  events from 2024-01-15, of every fourth user only those before
  2024-01-17 (older than what the first batch has), sequenced by ``ts``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.operators import add_audit
from lakeforge.sources.schemas import PRODUCT_FIELDS

ORDERS_SPLIT = "1999-01-01 00:00:00"
ORDERS_BATCH_FROM = "1998-07-01 00:00:00"
CUSTOMER_T0 = "2024-01-01 00:00:00"
CUSTOMER_T1 = "2024-01-02 00:00:00"
PRODUCT_T1 = "2024-05-01 00:00:00"
PRODUCT_T2 = "2024-05-02 00:00:00"
EVENTS_FIRST_BEFORE = "2024-01-20 00:00:00"
EVENTS_SECOND_FROM = "2024-01-15 00:00:00"
EVENTS_LATE_BEFORE = "2024-01-17 00:00:00"

PRODUCT_FIELD_NAMES = PRODUCT_FIELDS.fieldNames()
# All but the key are checked.
PRODUCT_CHECK_COLS = PRODUCT_FIELD_NAMES[1:]


def _ts(s: str) -> F.Column:
    return F.lit(s).cast("timestamp_ntz")


# ------------------------------------------------------------------- orders
def orders_day_one(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("o_orderdate") < _ts(ORDERS_SPLIT))


def orders_batch(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("o_orderdate") >= _ts(ORDERS_BATCH_FROM)).withColumns({
        "o_orderstatus": F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("F")).otherwise(F.col("o_orderstatus")),
        "o_totalprice": F.when(F.col("o_orderpriority") == "2-HIGH", F.col("o_totalprice") + 1.0).otherwise(F.col("o_totalprice")),
    })


# ---------------------------------------------------------------- customers
def customer_rows(customer: DataFrame) -> DataFrame:
    """Customer change rows (the 11 positional CSV fields)."""
    return customer.select(
        F.concat(F.lit("First"), (F.col("c_custkey") % 40).cast("string")).alias("contactfirstname"),
        F.concat(F.lit("Last"), F.floor(F.col("c_custkey") / 40).cast("string")).alias("contactlastname"),
        F.col("c_name").alias("customername"),
        F.concat(F.lit("+"), F.col("c_nationkey").cast("string"), F.lit("-"), F.col("c_custkey").cast("string")).alias("phone"),
        F.concat(F.col("c_custkey").cast("string"), F.lit(" Main St")).alias("addressline1"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit("Suite 1")).alias("addressline2"),
        F.concat(F.lit("City "), F.col("c_nationkey").cast("string")).alias("city"),
        F.lit(None).cast("string").alias("state"),
        F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("postalcode"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("country"),
        F.col("c_mktsegment").alias("territory"),
        F.col("c_acctbal"),
    )


def customer_target(customer: DataFrame) -> DataFrame:
    rows = customer_rows(customer).filter(F.col("territory") != "MACHINERY").drop("c_acctbal")
    return rows.withColumns({"insert_dts": _ts(CUSTOMER_T0), "update_dts": _ts(CUSTOMER_T0)})


def customer_batch(customer: DataFrame) -> DataFrame:
    rows = customer_rows(customer).filter(F.col("territory").isin("MACHINERY", "BUILDING"))
    rows = rows.withColumn(
        "phone",
        F.when((F.col("territory") == "BUILDING") & (F.col("c_acctbal") > 5000), F.concat(F.col("phone"), F.lit("-x"))).otherwise(F.col("phone")),
    )
    return rows.drop("c_acctbal")


# ----------------------------------------------------------------- products
def product_fields(part: DataFrame, run: int) -> DataFrame:
    """The ten product fields of load 1 or 2 (as in the landed CSV files)."""
    price = F.col("p_retailprice")
    name = F.col("p_name")
    src = part
    if run == 2:
        price = F.when(F.col("p_size") > 45, price + 10).otherwise(price)
        name = F.when(F.col("p_size").between(41, 45), F.upper(name)).otherwise(name)
        src = part.filter(F.col("p_brand") != "Brand#1")
    return src.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        name.alias("product_name"),
        F.col("p_type").alias("category"),
        price.cast("string").alias("selling_price"),
        F.col("p_brand").alias("model_number"),
        F.concat(F.lit("About "), F.col("p_name")).alias("about_product"),
        F.concat(F.lit("Size "), F.col("p_size").cast("string")).alias("product_specification"),
        F.when(F.col("p_size") > 45, F.lit(None).cast("string")).otherwise(F.concat(F.lit("Spec "), F.col("p_size").cast("string"))).alias("technical_details"),
        F.concat(F.col("p_size").cast("string"), F.lit(" kg")).alias("shipping_weight"),
        F.concat(F.col("p_size").cast("string"), F.lit("x"), F.col("p_size").cast("string")).alias("product_dimensions"),
    )


def product_transform(copied: DataFrame, run: int) -> DataFrame:
    """F10 + F11: the copy table's rows plus the transform's audit columns.

    ``copied`` holds the ten product fields, the load times and the file
    lineage columns (``source_file_name``, ``source_file_row_number``).
    """
    fields = [c for c in PRODUCT_FIELD_NAMES if c in copied.columns]
    # Fixed audit values of the product transform.
    audited = add_audit(copied, time_zone="EST", source_sys_name="PRODUCT", instnc_st_nm="STANDARD",
                        process_id=f"run-{run}", process_name="TRANSFORM_LOAD")
    return audited.select(
        *fields, "time_zone", "source_sys_name", "instnc_st_nm", "process_id", "process_name",
        "insert_dts", "update_dts", "source_file_name",
        F.col("source_file_row_number").cast("string").alias("source_file_row_number"),
    )


def product_load(part: DataFrame, run: int) -> DataFrame:
    """WORK_PRODUCT_TRANSFORM rows for load 1 or 2 straight from ``part``
    (file lineage stated as one file ordered by key)."""
    now = PRODUCT_T1 if run == 1 else PRODUCT_T2
    copied = product_fields(part, run).withColumns({
        "insert_dts": _ts(now),
        "update_dts": _ts(now),
        "source_file_name": F.lit("products.csv"),
        "source_file_row_number": (F.col("product_id").cast("bigint") + 1).cast("string"),
    })
    return product_transform(copied, run)


# The columns of the versioned product view.
PRODUCT_VIEW_KEEP = [
    *PRODUCT_FIELD_NAMES,
    "time_zone", "source_sys_name", "instnc_st_nm", "process_id", "process_name", "insert_dts", "update_dts",
]


# ------------------------------------------------------------------- events
def events_first(events: DataFrame) -> DataFrame:
    return events.filter(F.col("ts") < _ts(EVENTS_FIRST_BEFORE))


def events_second(events: DataFrame) -> DataFrame:
    late = (F.col("user_id") % 4 != 0) | (F.col("ts") < _ts(EVENTS_LATE_BEFORE))
    return events.filter((F.col("ts") >= _ts(EVENTS_SECOND_FROM)) & late)
