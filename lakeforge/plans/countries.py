"""Country details on semi-structured data.

Driver-table mapping: every customer (⋈ nation ⋈ region) becomes one country document, and every tenth occurs twice in its array;
every thirteenth has no common name. The continent list holds the region
name (the two Americas by nation, and Oceania for the Middle East), plus
'Antarctica' for customers with a negative balance; the
currency object holds the market segment's code, plus 'EUR' for every
fifth nation, and is empty for the HOUSEHOLD segment (such rows vanish in
the flatten, trap T12). Documents are written as JSON text and parsed into
a VARIANT column, as a JSON file copied into a variant table would be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.operators import (
    continent_mart,
    explode_variant,
    explode_variant_object,
    vpath,
    vpath_int_rounded,
)

# The seven continent marts of the source project.
CONTINENTS = ["Africa", "Antarctica", "Asia", "Europe", "North America", "Oceania", "South America"]


def documents_from_driver(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """One JSON array document (``data`` text) per customer."""
    geo = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    c = customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    seg = F.col("c_mktsegment")
    money = F.create_map(F.substring(seg, 1, 3), F.struct(F.lower(seg).alias("name"), F.lit("$").alias("symbol")))
    euro = F.create_map(F.lit("EUR"), F.struct(F.lit("Euro").alias("name"), F.lit("€").alias("symbol")))
    currencies = (
        F.when(seg == "HOUSEHOLD", F.map_filter(money, lambda k, v: F.lit(False)))
        .when(F.col("c_nationkey") % 5 == 0, F.map_concat(money, euro))
        .otherwise(money)
    )
    continent = (
        F.when(F.col("r_name") == "MIDDLE EAST", "Oceania")
        .when((F.col("r_name") == "AMERICA") & (F.col("n_nationkey") % 2 == 0), "North America")
        .when(F.col("r_name") == "AMERICA", "South America")
        .otherwise(F.col("r_name"))
    )
    doc = F.struct(
        F.struct(F.when(F.col("c_custkey") % 13 != 0, F.col("c_name")).alias("common"), F.concat(F.col("c_name"), F.lit(" Republic")).alias("official")).alias("name"),
        F.array(F.col("n_nationkey"), F.col("n_regionkey")).alias("latlng"),
        F.when(F.col("c_acctbal") < 0, F.array(continent, F.lit("Antarctica"))).otherwise(F.array(continent)).alias("continents"),
        F.col("n_name").alias("region"),
        F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("Sub "), F.col("n_name"))).alias("subregion"),
        F.array(F.concat(F.lit("Capital "), F.col("c_custkey").cast("string"))).alias("capital"),
        F.struct(F.array(F.col("c_nationkey"), F.lit(0)).alias("latlng")).alias("capitalInfo"),
        F.col("c_acctbal").alias("area"),
        (F.col("c_custkey") * 1000).alias("population"),
        currencies.alias("currencies"),
        F.struct(F.concat(F.lit("https://flags.example/"), F.col("c_custkey").cast("string"), F.lit(".png")).alias("png")).alias("flags"),
        F.struct(F.concat(F.lit("https://maps.example/"), F.col("c_custkey").cast("string")).alias("googleMaps")).alias("maps"),
        F.struct(F.concat(F.lit("Lang "), F.col("c_nationkey").cast("string")).alias("lng")).alias("languages"),
        F.when(F.col("c_nationkey") % 2 == 0, "monday").otherwise("sunday").alias("startOfWeek"),
        (F.col("c_acctbal") > 0).alias("unMember"),
        F.struct(F.when(F.col("c_nationkey") % 4 == 0, "left").otherwise("right").alias("side")).alias("car"),
    )
    docs = F.when(F.col("c_custkey") % 10 == 0, F.array(doc, doc)).otherwise(F.array(doc))
    return c.select(F.to_json(docs).alias("data"))


def country_raw(docs: DataFrame, now) -> DataFrame:
    """JSON array → one variant row per element, with the load time.

    ``docs.data`` is JSON text or an already loaded VARIANT column.
    """
    is_text = docs.schema["data"].dataType.simpleString() == "string"
    parsed = docs.select((F.parse_json("data") if is_text else F.col("data")).alias("data"))
    flat = explode_variant(parsed, "data", alias="source_data")
    return flat.select("source_data", F.lit(now).cast("timestamp_ntz").alias("insert_dts"))


def country_transform(raw: DataFrame, now) -> DataFrame:
    """G3 × G4 (lateral flattens) and 19 typed path reads."""
    con = explode_variant(raw, "source_data", alias="con", path="$.continents")
    both = explode_variant_object(con, "source_data", path="$.currencies", key="cur_key", value="cur_value")
    sd = "source_data"
    return both.select(
        vpath(sd, "$.name.official").alias("country_official_name"),
        vpath(sd, "$.name.common").alias("country_common_name"),
        vpath(sd, "$.latlng").alias("country_latlng"),
        vpath("con", "$").alias("country_continent_name"),
        vpath(sd, "$.region").alias("country_region_name"),
        vpath(sd, "$.subregion").alias("country_subregion_name"),
        vpath(sd, "$.capital").alias("country_capital_name"),
        vpath(sd, "$.capitalInfo.latlng").alias("country_capital_latlng"),
        vpath_int_rounded(sd, "$.area").alias("country_total_area"),
        vpath(sd, "$.population", "bigint").alias("country_population"),
        F.col("cur_key").alias("country_currency"),
        vpath("cur_value", "$.name").alias("country_currency_name"),
        vpath("cur_value", "$.symbol").alias("country_currency_symbol"),
        vpath(sd, "$.flags.png").alias("country_flag"),
        vpath(sd, "$.maps.googleMaps").alias("country_map"),
        vpath(sd, "$.languages").alias("country_language"),
        vpath(sd, "$.startOfWeek").alias("country_start_of_week"),
        vpath(sd, "$.unMember", "boolean").alias("country_un_member_status"),
        vpath(sd, "$.car.side").alias("country_driving_lane"),
        F.lit(now).cast("timestamp_ntz").alias("insert_dts"),
    )


def mart(transform: DataFrame, continent: str) -> DataFrame:
    """one continent mart."""
    return continent_mart(transform, continent)


def mart_key(df: DataFrame) -> F.Column:
    """The marts' tested key: common name || continent || currency name."""
    return F.concat(F.col("country_common_name"), F.col("country_continent_name"), F.col("country_currency_name"))
