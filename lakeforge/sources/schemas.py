"""Declared table schemas of the source projects.

Fixed values: table and column names and types as the source projects
declare them (positional CSV files bind to these columns in this order).
Decimal columns declared without a scale keep scale 0 by default
(trap T7); ``retail_fact(scale=…)`` selects another scale.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    VariantType,
)


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


# Healthcare bronze: five all-string CSV tables.
HEALTH_BRONZE = {
    "doctors": _strings("doctor_id", "name", "gender", "specialization", "hospital_id", "city"),
    "hospitals": _strings("hospital_name", "hospital_id", "city"),
    "patients": _strings("patient_id", "name", "gender", "dob", "city"),
    "treatments": _strings("treatment_id", "visit_id", "treatment_type", "outcome", "cost"),
    "visits": _strings("visit_id", "patient_id", "hospital_id", "visit_date", "department", "doctor_id"),
}

# Customer change source (11 positional strings) and the SCD1 target.
CUSTOMER_SOURCE = _strings(
    "customername", "phone", "addressline1", "addressline2", "city", "state",
    "postalcode", "country", "territory", "contactfirstname", "contactlastname",
)
CUSTOMER_TARGET = StructType(
    [StructField(n, StringType()) for n in (
        "contactfirstname", "contactlastname", "customername", "phone", "addressline1", "addressline2",
        "city", "state", "postalcode", "country", "territory",
    )]
    + [StructField("insert_dts", TimestampNTZType()), StructField("update_dts", TimestampNTZType())]
)

# Product copy table: ten positional strings, load times and file lineage.
PRODUCT_FIELDS = _strings(
    "product_id", "product_name", "category", "selling_price", "model_number", "about_product",
    "product_specification", "technical_details", "shipping_weight", "product_dimensions",
)
PRODUCT_COPY = StructType(
    PRODUCT_FIELDS.fields
    + [
        StructField("insert_dts", TimestampNTZType()),
        StructField("update_dts", TimestampNTZType()),
        StructField("source_file_name", StringType()),
        StructField("source_file_row_number", StringType()),
    ]
)

# Retail raw tables.
RETAIL_DEPARTMENT = StructType([
    StructField("store", IntegerType()), StructField("dept", IntegerType()), StructField("date", DateType()),
    StructField("weekly_sales", DoubleType()),
    StructField("isholiday", StringType()),
])
RETAIL_STORES = StructType([
    StructField("store", IntegerType()), StructField("type", StringType()), StructField("size", IntegerType()),
])


def retail_fact(scale: int = 0) -> StructType:
    """Fact raw table; temperature and fuel price are DECIMAL (scale 0 as declared)."""
    dec = DecimalType(38, scale)
    return StructType(
        [StructField("store", IntegerType()), StructField("date", DateType()),
         StructField("temperature", dec), StructField("fuel_price", dec)]
        + [StructField(f"markdown{i}", StringType()) for i in range(1, 6)]
        + [StructField("cpi", StringType()), StructField("unemployment", StringType()),
           StructField("isholiday", StringType())]
    )


# One-column variant tables (landing, country copy) and the country raw model.
VARIANT_LANDING = StructType([StructField("data", VariantType())])
COUNTRY_RAW = StructType([StructField("source_data", VariantType()), StructField("insert_dts", TimestampNTZType())])

TABLES = {
    **{f"{k}_raw": v for k, v in HEALTH_BRONZE.items()},
    "customer_source": CUSTOMER_SOURCE,
    "customer": CUSTOMER_TARGET,
    "work_product_copy": PRODUCT_COPY,
    "department_raw": RETAIL_DEPARTMENT,
    "stores_raw": RETAIL_STORES,
    "fact_raw": retail_fact(),
    "realtime_landing": VARIANT_LANDING,
    "country_details_cp": VARIANT_LANDING,
    "country_details_raw": COUNTRY_RAW,
}


def table_schema(name: str) -> StructType:
    """Declared schema of a table by name."""
    return TABLES[name.lower()]


# Earthquake feed: the properties of a feature, then the GeoJSON feature collection.
QUAKE_PROPERTIES = (
    "alert string, cdi double, code string, detail string, dmin double, felt bigint, gap bigint, ids string, mag double, "
    "magType string, mmi double, net string, nst bigint, place string, rms double, sig bigint, sources string, status string, "
    "time bigint, title string, tsunami bigint, type string, types string, tz string, updated bigint, url string"
)
_PLAIN = {"string": StringType(), "double": DoubleType(), "bigint": LongType()}


def _typed(fields: str) -> StructType:
    """Plain fields from ``name type, name type, ...``."""
    return StructType([StructField(name, _PLAIN[kind]) for name, kind in map(str.split, fields.split(","))])


QUAKE_FEED = StructType([
    StructField("bbox", ArrayType(DoubleType())),
    StructField("features", ArrayType(StructType([
        StructField("geometry", StructType([StructField("coordinates", ArrayType(DoubleType())), *_typed("type string")])),
        *_typed("id string"),
        StructField("properties", _typed(QUAKE_PROPERTIES)),
        *_typed("type string"),
    ]))),
    StructField("metadata", _typed("api string, count bigint, generated bigint, status bigint, title string, url string")),
    *_typed("type string"),
])
