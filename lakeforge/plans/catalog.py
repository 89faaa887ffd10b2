"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query runs a job of the library over whole driver tables (see the
mapping notes in each plan module). Measures that are floating-point sums
or averages are rounded in the last projection only, so the DuckDB oracle
(``oracle.py``) can be compared value by value.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge import functions as lf
from lakeforge.operators import (
    CheckFailed,
    cdc_scd1,
    change_feed,
    check_accepted,
    check_not_null,
    check_unique,
    dedup_rows,
    distinct_values,
    duplicate_keys,
    is_null,
    latest_per_key,
    lookup,
    not_accepted,
    scd1_merge,
    scd2_open,
    scd2_snapshot,
    upsert,
    upsert_images,
    versioned_view,
)
from lakeforge.plans import changes_jobs as cj
from lakeforge.plans import countries, health, quakes, retail
from lakeforge.session import ensure_checkpoint_dir, materialize, read_table, scratch_path, table_path
from lakeforge.sources import (
    CsvDialect,
    HistoryTable,
    KeyedTable,
    VersionedTable,
    infer_json_schema,
    list_files,
    load_csv,
    load_csv_with_lineage,
    parquet_tables,
    publish,
    read_csv,
    read_json,
    read_json_rescued,
    reload_variant,
    replace_table,
    schemas,
    stored_buckets,
    stored_model,
    table_inventory,
)
from lakeforge.streaming import (
    backlog,
    csv_stream,
    drain,
    json_stream,
    run_cdc_stream,
    run_dedup_stream,
    run_scd1_stream,
    table_stream,
    variant_stream,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def _prep(spark: SparkSession) -> None:
    quakes.use_utc(spark)
    ensure_checkpoint_dir(spark)


def register(name: str):
    """Register a query; every query runs with a UTC session clock and the
    shared checkpoint folder in place."""
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            _prep(spark)
            return fn(spark, sf_dir)

        run.__doc__, run.__name__ = fn.__doc__, fn.__name__
        REGISTRY[name] = run
        return fn

    return deco


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})


# ---------------------------------------------------------------- earthquakes
def _quake_silver(spark, sf_dir):
    _prep(spark)
    return quakes.silver(quakes.feed_from_events(read_table(spark, sf_dir, "events")))


@register("quake_flatten")
def quake_flatten(spark, sf_dir):
    """G1, F1, F2, F4, scalar casts: bronze feed → flat silver columns."""
    _prep(spark)
    bronze = quakes.feed_from_events(read_table(spark, sf_dir, "events"))
    return quakes.silver_transform(bronze).select(*quakes.SILVER_COLUMNS)


@register("quake_silver")
def quake_silver(spark, sf_dir):
    """D1, W1, hash id: deduplicated latest-per-id silver table."""
    return _quake_silver(spark, sf_dir)


@register("quake_seismic_activity")
def quake_seismic_activity(spark, sf_dir):
    """A2: hourly activity per network (the flagship query)."""
    return rounded(quakes.seismic_activity(_quake_silver(spark, sf_dir)), {"avg_mag": 6})


@register("quake_geo_hotspot")
def quake_geo_hotspot(spark, sf_dir):
    """A1: event density per 0.1° cell."""
    return rounded(quakes.geo_hotspot(_quake_silver(spark, sf_dir)), {"avg_mag": 6})


@register("quake_daily_events")
def quake_daily_events(spark, sf_dir):
    """Events per day."""
    return quakes.daily_events(_quake_silver(spark, sf_dir))


@register("quake_events_by_net")
def quake_events_by_net(spark, sf_dir):
    """Events per network."""
    return quakes.events_by_net(_quake_silver(spark, sf_dir))


@register("quake_point_map")
def quake_point_map(spark, sf_dir):
    """F16: point-map extract."""
    return quakes.point_map(_quake_silver(spark, sf_dir))


@register("quake_hotspot_map")
def quake_hotspot_map(spark, sf_dir):
    """F16: hotspot-map extract."""
    return rounded(quakes.hotspot_map(quakes.geo_hotspot(_quake_silver(spark, sf_dir))), {"avg_mag": 6})


@register("quake_latest_per_user")
def quake_latest_per_user(spark, sf_dir):
    """W1 on the raw events: latest event per user (tie-break event_id)."""
    ev = read_table(spark, sf_dir, "events")

    return latest_per_key(ev, ["user_id"], ["ts"], ["event_id"])


# ----------------------------------------------------------------- healthcare
HEALTH_TODAY = dt.date(2025, 6, 30)


def _health_bronze(spark, sf_dir):
    names = ("customer", "supplier", "nation", "orders", "lineitem")
    return health.bronze_from_driver({n: read_table(spark, sf_dir, n) for n in names})


@register("health_patients")
def health_patients(spark, sf_dir):
    """patients projection (name split, dob cast, age)."""
    return health.patients_transform(_health_bronze(spark, sf_dir)["patients"], HEALTH_TODAY)


def _health_visits(spark, sf_dir):
    b = _health_bronze(spark, sf_dir)
    return health.visits_transform(b["visits"], b["patients"], b["doctors"], b["hospitals"])


def _health_facts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Treatments, and visits with what their patient, doctor and hospital add, stored in buckets of the visit id."""
    names = ("customer", "supplier", "nation", "orders", "lineitem")
    inputs, buckets = [table_path(sf_dir, n) for n in names], 16
    b = _health_bronze(spark, sf_dir)
    treatments = stored_buckets(spark, "health_treatments", inputs, "visit_id", buckets, lambda: b["treatments"])
    star = [b[n] for n in ("visits", "patients", "doctors", "hospitals")]
    return treatments, stored_buckets(spark, "health_visits", inputs, "visit_id", buckets, lambda: health.visit_frame(*star))


@register("health_visits")
def health_visits(spark, sf_dir):
    """Visit ⋈ patient ⋈ doctor ⋈ hospital."""
    return _health_visits(spark, sf_dir)


@register("health_treatments")
def health_treatments(spark, sf_dir):
    """Treatment ⋈ visit ⋈ patient ⋈ doctor ⋈ hospital."""
    return health.framed_treatments(*_health_facts(spark, sf_dir))


@register("health_city_access")
def health_city_access(spark, sf_dir):
    """J3 + A3: LEFT JOIN, two distinct counts per city."""
    pt = health.patients_transform(_health_bronze(spark, sf_dir)["patients"], HEALTH_TODAY)
    return health.city_access(pt, _health_visits(spark, sf_dir))


@register("health_hospital_performance")
def health_hospital_performance(spark, sf_dir):
    """A4: hospital performance."""
    return health.framed_performance(*_health_facts(spark, sf_dir))


@register("health_visit_summary")
def health_visit_summary(spark, sf_dir):
    """A5: patient visit summary."""
    return health.visit_summary(_health_visits(spark, sf_dir))


@register("health_patient_value")
def health_patient_value(spark, sf_dir):
    """Patient value."""
    return health.framed_value(*_health_facts(spark, sf_dir))


# --------------------------------------------------------------------- retail
RETAIL_NOW1 = "2024-03-01 00:00:00"
RETAIL_NOW2 = "2024-03-02 00:00:00"
RETAIL_BUCKET_ROWS = 500_000


def _retail_silver(spark, sf_dir, dated: bool = False):
    """Bronze and silver models (lazy; nothing is materialised here)."""
    b = retail.bronze_from_driver(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "supplier"))
    return {
        "stage_dept_unnumbered": retail.stage_dept(b["department"], RETAIL_NOW1, numbered=False),
        "stage_store": retail.stage_store(b["stores"], RETAIL_NOW1),
        "stg_fact": retail.stg_fact(b["fact"], RETAIL_NOW1, dated),
    }


def _retail(spark, sf_dir, history: bool = True, folder: str | None = None):
    """Joined fact and the two-load fact history of the retail model.

    The joined fact (the intermediate model every later step reads: both
    snapshot loads, the current fact, the reports) is materialised as
    Parquet in the shared checkpoint folder, as the source project
    materialises its models as tables; the lineitem roll-ups behind it are
    then computed once. The first snapshot is a projection of it and is
    not written (measured: writing it costs more than re-deriving it).
    A ``folder`` keeps the joined fact, with the staging columns.
    """
    r = _retail_silver(spark, sf_dir, dated=True)
    # One row per department row: the staging columns ride along, so the
    # date dimension reads this table too and lineitem is rolled up once.
    joined = retail.combined_fact(r["stage_dept_unnumbered"], r["stg_fact"], r["stage_store"],
                                  keep=("store_date", "isholiday", "insert_date"))
    if folder:
        joined.write.parquet(folder)
        joined = spark.read.parquet(folder)
    else:
        joined = materialize(joined, "retail-combined")
    combined = joined.select(*retail.COMBINED_COLS)
    r["combined"] = combined
    r["stage_dept_unnumbered"] = joined.select(*retail.STAGE_DEPT_COLS)
    if history:
        # The second load has the first one's keys and is checked; once is enough.
        h1 = retail.fact_snapshot(None, combined, RETAIL_NOW1, on_duplicate="keep")
        r["history"] = retail.fact_snapshot(h1, _second_load(combined), RETAIL_NOW2)
    return r


def _second_load(combined: DataFrame) -> DataFrame:
    """Sales of department 1 move (new versions); markdown1 of department 2 moves too, not a checked column (trap T13)."""
    return combined.withColumns({
        "store_weekly_sales": F.when(F.col("dept_id") == 1, F.col("store_weekly_sales") + 100).otherwise(F.col("store_weekly_sales")),
        "markdown1": F.when(F.col("dept_id") == 2, F.col("markdown1") + 5).otherwise(F.col("markdown1")),
    })


def _retail_stage_dept(spark, sf_dir, numbered: bool = True):
    b = retail.bronze_from_driver(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "supplier"))
    return retail.stage_dept(b["department"], RETAIL_NOW1, numbered=numbered)


@register("retail_stage_dept")
def retail_stage_dept(spark, sf_dir):
    """Department staging with a distributed global row number."""
    return _retail_stage_dept(spark, sf_dir)


@register("retail_stg_fact")
def retail_stg_fact(spark, sf_dir):
    """F8: 'NA' tokens to 0, text measures to double."""
    return _retail_silver(spark, sf_dir)["stg_fact"]


@register("retail_combined_fact")
def retail_combined_fact(spark, sf_dir):
    """Two left joins onto the department rows."""
    return _retail(spark, sf_dir, history=False)["combined"]


@register("retail_fact_history")
def retail_fact_history(spark, sf_dir):
    """M6: SCD2 history after two loads (surrogate composite key)."""
    return _retail(spark, sf_dir)["history"]


@register("retail_final_fact")
def retail_final_fact(spark, sf_dir):
    """M8: current versions of the fact, as the history table keeps them apart."""
    return _retail_tables(spark, sf_dir)[1].open.read().withColumn("composite_key", retail.composite())


@register("retail_dim_date")
def retail_dim_date(spark, sf_dir):
    """M4: incremental date dimension keyed by row number, loaded twice."""
    d = _retail_stage_dept(spark, sf_dir)
    return retail.incremental(retail.dim_date(d, RETAIL_NOW1), retail.dim_date(d, RETAIL_NOW2), "row_num")


@register("retail_dim_store")
def retail_dim_store(spark, sf_dir):
    """M4: incremental store dimension (second load changes sizes)."""
    st = _retail_silver(spark, sf_dir)["stage_store"]
    first = retail.dim_store(st, RETAIL_NOW1).withColumn("store_size", F.col("store_size") - 1)
    return retail.incremental(first, retail.dim_store(st, RETAIL_NOW2), "store_id")


@register("retail_dim_department")
def retail_dim_department(spark, sf_dir):
    """Department dimension view (ids repeat, as in the source model)."""
    return retail.dim_department(_retail_stage_dept(spark, sf_dir, numbered=False))


def _retail_tables(spark, sf_dir) -> tuple[DataFrame, HistoryTable]:
    """The department staging rows and the fact's history table, both stored and built once for all
    queries that read them: open versions lie apart from closed ones. A bucket is what one task
    rewrites, so their number follows the rows (counted in the files' footers)."""
    buckets = max(16, -(-read_table(spark, sf_dir, "lineitem").count() // RETAIL_BUCKET_ROWS))

    def build(folder: str) -> None:
        r = _retail(spark, sf_dir, history=False, folder=f"{folder}/joined")
        table = HistoryTable(spark, f"{folder}/fact", retail.FACT_KEY, buckets, joined=True)
        table.snapshot(r["combined"], retail.CHECK_COLS, RETAIL_NOW1, id_key=retail.composite, on_duplicate="keep")
        table.snapshot(_second_load(r["combined"]), retail.CHECK_COLS, RETAIL_NOW2, id_key=retail.composite)

    inputs = [table_path(sf_dir, t) for t in ("lineitem", "supplier")]
    root = stored_model(spark, "retail", inputs, build)
    stage = spark.read.parquet(f"{root}/joined").select(*retail.STAGE_DEPT_COLS)
    return stage, HistoryTable(spark, f"{root}/fact", retail.FACT_KEY, buckets, joined=True)


@register("retail_fact_history_table")
def retail_fact_history_table(spark, sf_dir):
    """M6: the two loads as a stored history, closed versions appended to."""
    return _retail_tables(spark, sf_dir)[1].read().withColumn("composite_key", retail.composite())


def _reports(spark, sf_dir):
    stage, history = _retail_tables(spark, sf_dir)
    ff = history.open.read()
    # The reports read DATE_ID, STORE_DATE and ISHOLIDAY only: no ROW_NUM.
    dd = retail.dim_date(stage.unionByName(retail.planned_dates(stage)), RETAIL_NOW1)
    stores = retail.stores_from_driver(read_table(spark, sf_dir, "supplier"))
    return retail, dd, retail.dim_store(retail.stage_store(stores, RETAIL_NOW1), RETAIL_NOW1), ff


@register("retail_sales_by_store_holiday")
def retail_sales_by_store_holiday(spark, sf_dir):
    """R1 (J5): LEFT JOIN date dim → fact, many-to-many on date_id."""
    m, dd, ds, ff = _reports(spark, sf_dir)
    return rounded(m.sales_by_store_holiday(dd, ff), {"total_sales": 2})


@register("retail_sales_by_temperature_year")
def retail_sales_by_temperature_year(spark, sf_dir):
    """R2 (J6)."""
    m, dd, ds, ff = _reports(spark, sf_dir)
    return rounded(m.sales_by_temperature_year(dd, ff), {"total_sales": 2})


@register("retail_sales_by_store_size")
def retail_sales_by_store_size(spark, sf_dir):
    """R3 (J6)."""
    m, dd, ds, ff = _reports(spark, sf_dir)
    return rounded(m.sales_by_store_size(ds, ff), {"total_sales": 2})


@register("retail_markdown_by_store_year")
def retail_markdown_by_store_year(spark, sf_dir):
    """R4 (J6)."""
    m, dd, ds, ff = _reports(spark, sf_dir)
    return rounded(m.markdown_by_store_year(dd, ff), {f"sum_markdown{i}": 2 for i in range(1, 6)})


@register("retail_sales_by_store_type")
def retail_sales_by_store_type(spark, sf_dir):
    """R5 (J6)."""
    m, dd, ds, ff = _reports(spark, sf_dir)
    return rounded(m.sales_by_store_type(ds, ff), {"total_sales": 2})


@register("retail_fuel_by_store_year")
def retail_fuel_by_store_year(spark, sf_dir):
    """R6 (J7): two dimensions."""
    m, dd, ds, ff = _reports(spark, sf_dir)
    return rounded(m.fuel_by_store_year(dd, ds, ff), {"sum_fuel_price": 2})


@register("retail_sales_by_cpi")
def retail_sales_by_cpi(spark, sf_dir):
    """No join."""
    m, dd, ds, ff = _reports(spark, sf_dir)
    return rounded(m.sales_by_cpi(ff), {"total_sales": 2})


# ------------------------------------------------------------ change operators
@register("orders_upsert")
def orders_upsert(spark, sf_dir):
    """M1: keyed upsert (update all columns, insert new keys, never delete)."""
    o = read_table(spark, sf_dir, "orders")
    return upsert(cj.orders_day_one(o), cj.orders_batch(o), ["o_orderkey"])


@register("orders_change_feed")
def orders_change_feed(spark, sf_dir):
    """The row changes that a merge makes to orders, out of the merge's own join."""
    o = read_table(spark, sf_dir, "orders")
    return upsert_images(cj.orders_day_one(o), cj.orders_batch(o), ["o_orderkey"])


@register("orders_change_feed_versions")
def orders_change_feed_versions(spark, sf_dir):
    """The same changes by comparing two versions of orders."""
    o = read_table(spark, sf_dir, "orders")
    before = cj.orders_day_one(o)
    return change_feed(before, upsert(before, cj.orders_batch(o), ["o_orderkey"]), ["o_orderkey"])


@register("orders_change_feed_bucketed")
def orders_change_feed_bucketed(spark, sf_dir):
    """Two merges into a stored table that keeps its feed; the second one's images are read by commit."""
    o = read_table(spark, sf_dir, "orders")
    table = KeyedTable(spark, scratch_path(spark, "orders-feed"), ["o_orderkey"], buckets=16, feed=True)
    table.upsert(cj.orders_day_one(o))
    before = table.last_commit()
    table.upsert(cj.orders_batch(o))
    return table.changes(after=before).drop("_commit")


@register("customer_scd1_merge")
def customer_scd1_merge(spark, sf_dir):
    """M2: SCD1 MERGE on (first, last name); insert time kept on update."""
    c = read_table(spark, sf_dir, "customer")
    return scd1_merge(cj.customer_target(c), cj.customer_batch(c),
                      ["contactfirstname", "contactlastname"], cj.CUSTOMER_T1)


@register("events_cdc_scd1")
def events_cdc_scd1(spark, sf_dir):
    """M3: sequenced SCD1 by ts; late older rows lose."""
    ev = read_table(spark, sf_dir, "events")
    first = cdc_scd1(None, cj.events_first(ev), ["user_id"], "ts", ["event_id"])
    return cdc_scd1(first, cj.events_second(ev), ["user_id"], "ts", ["event_id"])


def _product_history(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    keys, cols = ["product_id"], cj.PRODUCT_CHECK_COLS
    h1 = scd2_snapshot(None, cj.product_load(part, 1), keys, cols, cj.PRODUCT_T1, case_insensitive_cols=cols)
    return scd2_snapshot(h1, cj.product_load(part, 2), keys, cols, cj.PRODUCT_T2, case_insensitive_cols=cols)


@register("product_scd2_history")
def product_scd2_history(spark, sf_dir):
    """M5: SCD2 snapshot (check strategy, 9 columns) after two loads."""
    return _product_history(spark, sf_dir)


@register("product_versions")
def product_versions(spark, sf_dir):
    """M7 + F9: versioned view, open end as the high date."""
    return versioned_view(_product_history(spark, sf_dir), cj.PRODUCT_VIEW_KEEP)


# --------------------------------------------------------------- data quality
@register("dq_unique_lineitem_key")
def dq_unique_lineitem_key(spark, sf_dir):
    """Q1: unique on an expression (concatenated key); failing values."""
    li = read_table(spark, sf_dir, "lineitem")
    key = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    return check_unique(li, key)


@register("dq_not_null_combined_temperature")
def dq_not_null_combined_temperature(spark, sf_dir):
    """Q2: not_null on the joined retail fact (rows without a store fact)."""
    return check_not_null(_retail(spark, sf_dir, history=False)["combined"], "temperature")


@register("dq_accepted_order_priority")
def dq_accepted_order_priority(spark, sf_dir):
    """Q3: accepted_values; values outside the list with their counts."""
    o = read_table(spark, sf_dir, "orders")
    return check_accepted(o, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"])


@register("dq_duplicate_lineitem_keys")
def dq_duplicate_lineitem_keys(spark, sf_dir):
    """Q4 + F13: duplicate-key profile (count > 1)."""
    return duplicate_keys(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("dq_unique_dim_date_id")
def dq_unique_dim_date_id(spark, sf_dir):
    """Q1 on DATE_ID of the date dimension: shows the repeated key."""
    return check_unique(retail.dim_date(_retail_stage_dept(spark, sf_dir, numbered=False), RETAIL_NOW1), "date_id")


# ------------------------------------------------------------------ countries
COUNTRY_NOW = "2024-04-01 00:00:00"


def _country_transform(spark, sf_dir):
    docs = countries.documents_from_driver(*(read_table(spark, sf_dir, t) for t in ("customer", "nation", "region")))
    return countries.country_transform(countries.country_raw(docs, COUNTRY_NOW), COUNTRY_NOW)


@register("country_transform")
def country_transform(spark, sf_dir):
    """G2, G3, G4, J8 + variant path reads with casts."""
    return _country_transform(spark, sf_dir)


def _mart_query(continent):
    def q(spark, sf_dir):
        return countries.mart(_country_transform(spark, sf_dir), continent)

    q.__doc__ = f"F6: continent mart for {continent}."
    return q


for _c in ("Africa", "Antarctica", "Asia", "Europe", "North America", "Oceania", "South America"):
    register("country_mart_" + _c.lower().replace(" ", "_"))(_mart_query(_c))


@register("dq_unique_country_raw")
def dq_unique_country_raw(spark, sf_dir):
    """Q1 on a variant column (grouped on its JSON text)."""
    docs = countries.documents_from_driver(*(read_table(spark, sf_dir, t) for t in ("customer", "nation", "region")))
    found = check_unique(countries.country_raw(docs, COUNTRY_NOW), "source_data")
    # The failing documents, shown by their common name.
    return found.withColumn("unique_field", F.get_json_object("unique_field", "$.name.common"))


@register("dq_unique_country_key")
def dq_unique_country_key(spark, sf_dir):
    """Q1 on the concatenated mart key of the transform."""
    t = _country_transform(spark, sf_dir)
    return check_unique(t, countries.mart_key(t))


@register("dq_not_null_country_key")
def dq_not_null_country_key(spark, sf_dir):
    """Q2 on the concatenated mart key."""
    t = _country_transform(spark, sf_dir)
    return check_not_null(t, countries.mart_key(t))


@register("dq_accepted_continent_asia")
def dq_accepted_continent_asia(spark, sf_dir):
    """Q3 on the Asia mart: the accepted value 'Asia' vs the data's 'ASIA'."""
    return check_accepted(countries.mart(_country_transform(spark, sf_dir), "Asia"), "country_continent_name", ["Asia"])


# ------------------------------------------------------------ scalar functions
FN_TODAY = "2025-06-30"


def _fn(name: str):
    def q(spark, sf_dir):
        _prep(spark)
        table, build = _fns()[name]
        return build(read_table(spark, sf_dir, table))

    q.__doc__ = f"Scalar function query {name} (SURVEY 2.6)."
    return q


def _fns():
    today = F.lit(FN_TODAY).cast("date")
    view_null = F.when(F.col("event_type") == "view", F.lit(None)).otherwise(F.col("event_type"))
    return {
        "fn_from_unixtime": ("events", lambda d: d.select(
            "event_id",
            lf.epoch_ms_to_ts(lf.ts_to_epoch_ms("ts")).alias("time_s"),
            lf.epoch_ms_exact(lf.ts_to_epoch_ms("ts")).alias("time_ms"))),
        "fn_date_trunc": ("events", lambda d: d.select(
            "event_id",
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_ts"),
            F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day_ts"))),
        "fn_sha2": ("events", lambda d: d.select("event_id", lf.hash_id("event_id", "event_type").alias("h"))),
        "fn_concat_ws": ("events", lambda d: d.select(
            "event_id", F.concat_ws("_", view_null, F.col("user_id").cast("string")).alias("joined"))),
        "fn_substr": ("events", lambda d: d.select("event_id", lf.hash_id("event_id", "event_type", length=15).alias("h15"))),
        "fn_round": ("events", lambda d: d.select(
            "event_id", F.round("value", 1).alias("r1"), F.round("value", 0).alias("r0"))),
        "fn_split_part": ("part", lambda d: d.select(
            "p_partkey", *[lf.name_part("p_name", k).alias(f"w{k}") for k in (1, 2, 3)])),
        "fn_datediff_year": ("orders", lambda d: d.select(
            "o_orderkey", lf.year_boundaries(F.col("o_orderdate").cast("date"), today).alias("years"))),
        "fn_datediff_day": ("orders", lambda d: d.select(
            "o_orderkey", lf.days_between(F.col("o_orderdate").cast("date"), today).alias("days"))),
        "fn_year": ("orders", lambda d: d.select("o_orderkey", F.year("o_orderdate").alias("yr"))),
        "fn_to_char": ("orders", lambda d: d.select("o_orderkey", lf.iso_date_text("o_orderdate").alias("date_id"))),
        "fn_upper": ("part", lambda d: d.select("p_partkey", F.upper("p_name").alias("name_uc"))),
        "fn_coalesce_nullif_case": ("orders", lambda d: d.select(
            "o_orderkey",
            F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("O")), F.lit("open")).alias("status"),
            F.when(F.col("o_totalprice") > 100000, "big").otherwise("small").alias("size"))),
        "fn_concat": ("customer", lambda d: d.select(
            "c_custkey",
            F.concat(F.col("c_name"), F.lit("-"), F.when(F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment"))).alias("joined"))),
        "fn_arithmetic": ("lineitem", lambda d: d.select(
            "l_orderkey", "l_linenumber",
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
            (F.col("l_quantity") / F.col("l_linenumber")).alias("per_line"),
            (F.col("l_linenumber") / 2).alias("half_line"))),
        "fn_variant_get": ("events", lambda d: d.select(
            "event_id", F.variant_get(F.parse_json("props"), "$.k", "int").alias("k"))),
        "fn_surrogate_key": ("lineitem", lambda d: d.select(
            "l_orderkey", "l_linenumber",
            lf.surrogate_key([F.col("l_orderkey"), F.col("l_linenumber"),
                              F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))]).alias("sk"))),
        "fn_cast_round_int": ("events", lambda d: d.select(
            "event_id", F.round("value", 0).cast("int").alias("v_int"), F.col("user_id").cast("double").alias("u_dbl"))),
        "fn_na_to_zero": ("lineitem", lambda d: d.select(
            "l_orderkey", "l_linenumber",
            lf.na_to_zero(F.when(F.col("l_returnflag") == "N", F.lit("NA")).otherwise(F.col("l_quantity").cast("string"))).alias("m"))),
    }


FN_NAMES = [
    "fn_from_unixtime", "fn_date_trunc", "fn_sha2", "fn_concat_ws", "fn_substr", "fn_round",
    "fn_split_part", "fn_datediff_year", "fn_datediff_day", "fn_year", "fn_to_char", "fn_upper",
    "fn_coalesce_nullif_case", "fn_concat", "fn_arithmetic", "fn_variant_get", "fn_surrogate_key",
    "fn_cast_round_int", "fn_na_to_zero",
]
for _name in FN_NAMES:
    register(_name)(_fn(_name))


# ------------------------------------------------- sources, sinks and streams
#: Rows of a landed file.
LANDED_ROWS = 50_000


def _land_json(df: DataFrame, path: str, mode: str = "error") -> None:
    """Write rows as JSON-lines files (the landed feed), times to the microsecond;
    ``append`` adds a later delivery as new files next to the earlier ones. Files are
    gzipped, which takes a tenth of the text, and as a gzipped file is read by one task
    they hold a bounded number of rows."""
    landed = df.write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", LANDED_ROWS)
    landed.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)


@register("stream_quake_bronze")
def stream_quake_bronze(spark, sf_dir):
    """S2/S3, S14, T-1…T-3, T-5: JSON file stream, flattened, drained."""
    _prep(spark)
    root = scratch_path(spark, "quake-bronze")
    _land_json(quakes.feed_from_events(read_table(spark, sf_dir, "events")), f"{root}/raw")
    stream = json_stream(spark, f"{root}/raw", schemas.QUAKE_FEED, multiline=False, max_bytes_per_trigger=64 << 20)
    drain(quakes.silver_transform(stream).select(*quakes.SILVER_COLUMNS), f"{root}/bronze", f"{root}/_ckpt/bronze")
    return spark.read.parquet(f"{root}/bronze")


@register("stream_quake_whole_files")
def stream_quake_whole_files(spark, sf_dir):
    """S2, S3 as the real feed comes: a file is one JSON object over many lines, with many features."""
    root = scratch_path(spark, "quake-files")
    files = quakes.feed_files(quakes.feed_from_events(read_table(spark, sf_dir, "events")))
    files.repartition("file").write.partitionBy("file").text(f"{root}/raw")  # one object to a file
    stream = json_stream(spark, f"{root}/raw", schemas.QUAKE_FEED, max_bytes_per_trigger=64 << 20)
    drain(quakes.silver_transform(stream).select(*quakes.SILVER_COLUMNS), f"{root}/bronze", f"{root}/_ckpt/bronze")
    return spark.read.parquet(f"{root}/bronze")


@register("stream_quake_cdc_activity")
def stream_quake_cdc_activity(spark, sf_dir):
    """File stream → flatten → table stream → stream dedup (D2) →
    sequenced CDC into a versioned table (M3, T-7) → hourly activity (A2).

    Ids are spread over all buckets, so each micro-batch of the dedup reads
    the stored keys and each of the CDC rewrites the table: a backlog comes
    in a bounded number of them, whatever its size.
    """
    _prep(spark)
    root = scratch_path(spark, "quake-cdc")
    _land_json(quakes.feed_from_events(read_table(spark, sf_dir, "events")), f"{root}/raw")
    bronze = quakes.silver_transform(json_stream(spark, f"{root}/raw", schemas.QUAKE_FEED, multiline=False, **backlog(spark, f"{root}/raw")))
    drain(bronze, f"{root}/bronze", f"{root}/_ckpt/bronze")
    flat = table_stream(spark, f"{root}/bronze", **backlog(spark, f"{root}/bronze")).select(*quakes.SILVER_COLUMNS)
    distinct = KeyedTable(spark, f"{root}/distinct", ["id", "updated"], buckets=16)
    run_dedup_stream(flat, distinct, f"{root}/_ckpt/distinct").awaitTermination()
    silver = table_stream(spark, distinct.path, flat.schema, **backlog(spark, distinct.path))
    silver = silver.withColumn("hash_id", lf.hash_id("id", "time"))
    table = KeyedTable(spark, f"{root}/silver", ["hash_id"], buckets=16)
    run_cdc_stream(silver, table, f"{root}/_ckpt/silver", ["hash_id"], "updated").awaitTermination()
    return rounded(quakes.seismic_activity(table.read()), {"avg_mag": 6})


@register("stream_variant_landing")
def stream_variant_landing(spark, sf_dir):
    """JSON records into one VARIANT column, continuously loaded."""
    root = scratch_path(spark, "landing")
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    _land_json(ev, f"{root}/raw")
    drain(variant_stream(spark, f"{root}/raw", **backlog(spark, f"{root}/raw")), f"{root}/landed", f"{root}/_ckpt")
    landed = spark.read.parquet(f"{root}/landed")
    return landed.select(
        F.variant_get("data", "$.event_id", "bigint").alias("event_id"),
        F.variant_get("data", "$.user_id", "bigint").alias("user_id"),
        F.variant_get("data", "$.event_type", "string").alias("event_type"),
        F.variant_get("data", "$.value", "double").alias("value"),
        F.variant_get("data", "$.props", "string").alias("props"),
    )


@register("stream_events_dedup")
def stream_events_dedup(spark, sf_dir):
    """D2/T-6: the same rows delivered twice, old ones last; one copy of each stays, however late it comes."""
    root = scratch_path(spark, "dedup")
    ev = read_table(spark, sf_dir, "events")
    old = F.col("ts") < F.lit(cj.EVENTS_SECOND_FROM).cast("timestamp_ntz")
    ev.filter(~old).write.parquet(f"{root}/in/delivery=1")
    ev.write.parquet(f"{root}/in/delivery=2")
    ev.filter(old).write.parquet(f"{root}/in/delivery=3")
    table = KeyedTable(spark, f"{root}/out", ["event_id"], buckets=16)
    run_dedup_stream(table_stream(spark, f"{root}/in", ev.schema, 4), table, f"{root}/_ckpt").awaitTermination()
    return table.read()


def _events_stream(spark, folder):
    return table_stream(spark, folder, max_files_per_trigger=4)


@register("stream_checkpoint_reset")
def stream_checkpoint_reset(spark, sf_dir):
    """T-2: a table stream drained, more files landed, and all drained again
    with a fresh checkpoint into the same table (M3): no row is lost, none twice."""
    root = scratch_path(spark, "reset")
    ev = read_table(spark, sf_dir, "events")
    table = VersionedTable(spark, f"{root}/latest")
    for i, part in enumerate((cj.events_first(ev), cj.events_second(ev))):
        part.write.mode("append").parquet(f"{root}/raw")
        run_cdc_stream(_events_stream(spark, f"{root}/raw"), table, f"{root}/_ckpt{i}", ["user_id"], "ts", ["event_id"]).awaitTermination()
    return table.read()


@register("stream_two_sources")
def stream_two_sources(spark, sf_dir):
    """M3, T-7: two streams with their own checkpoints into one keyed table, in turns."""
    root = scratch_path(spark, "two-streams")
    ev = read_table(spark, sf_dir, "events")
    table = KeyedTable(spark, f"{root}/latest", ["user_id"], buckets=16)
    clicks = F.col("event_type") == "click"
    for part in (cj.events_first(ev), cj.events_second(ev)):
        for name, rows in (("clicks", part.filter(clicks)), ("others", part.filter(~clicks))):
            rows.write.mode("append").parquet(f"{root}/{name}")
            run_cdc_stream(_events_stream(spark, f"{root}/{name}"), table, f"{root}/_ckpt/{name}", ["user_id"], "ts", ["event_id"]).awaitTermination()
    return table.read()


@register("stream_minute_trigger")
def stream_minute_trigger(spark, sf_dir):
    """T-4: a stream on a one-minute schedule, stopped once what is there is committed."""
    root = scratch_path(spark, "minute")
    read_table(spark, sf_dir, "events").write.parquet(f"{root}/raw")
    writer = table_stream(spark, f"{root}/raw").writeStream.format("parquet").option("checkpointLocation", f"{root}/_ckpt")
    stream = writer.trigger(processingTime="1 minute").start(f"{root}/out")
    try:
        while stream.isActive and stream.lastProgress is None:
            time.sleep(0.05)
    finally:
        stream.stop()
    return spark.read.parquet(f"{root}/out")


@register("stream_customer_scd1")
def stream_customer_scd1(spark, sf_dir):
    """E5: CSV change files (two deliveries, then an empty drain) → change
    stream (M9) → run only with data (M10) → SCD1 MERGE (M2) → committed
    by the partitions that a batch touches."""
    root = scratch_path(spark, "customer-scd1")
    c = read_table(spark, sf_dir, "customer")
    schema = schemas.CUSTOMER_SOURCE  # positional CSV columns, as declared
    batch = cj.customer_batch(c).select(*schema.fieldNames())
    dialect = CsvDialect.with_null_tokens("NULL", "null")
    keys = ["contactfirstname", "contactlastname"]
    table = KeyedTable(spark, f"{root}/customer", keys, buckets=16)  # a merge rewrites what its batch touches
    for i, seg in enumerate(["MACHINERY", "BUILDING", None], start=1):
        if seg is not None:
            (batch.filter(F.col("territory") == seg).write.option("header", "true")
             .option("nullValue", "NULL").csv(f"{root}/landing/delivery={i}"))
        stream = csv_stream(spark, f"{root}/landing", schema, dialect, max_files_per_trigger=4)
        run_scd1_stream(stream, table, f"{root}/_ckpt", keys,
                        now=lambda: cj.CUSTOMER_T1, initial=cj.customer_target(c)).awaitTermination()
    return table.read()


@register("csv_reload_visits")
def csv_reload_visits(spark, sf_dir):
    """Full reload of a bronze table from CSV (truncate + load)."""
    root = scratch_path(spark, "reload")
    visits = _health_bronze(spark, sf_dir)["visits"]
    visits.write.option("header", "true").option("quoteAll", "true").csv(f"{root}/files")
    schema = schemas.HEALTH_BRONZE["visits"]
    df = read_csv(spark, f"{root}/files", schema, CsvDialect.simple())
    replace_table(spark, df, f"{root}/visits_raw")   # first load
    replace_table(spark, df, f"{root}/visits_raw")   # forced reload: same rows again
    return VersionedTable(spark, f"{root}/visits_raw").read()


@register("csv_load_products")
def csv_load_products(spark, sf_dir):
    """CSV with 'NULL' tokens loaded into a wider column list."""
    root = scratch_path(spark, "products")
    schema = schemas.PRODUCT_FIELDS
    cj.product_fields(read_table(spark, sf_dir, "part"), 1).write.option("header", "true").option("nullValue", "NULL").csv(f"{root}/files")
    target = [(n, "string") for n in schema.fieldNames()] + [("source_file_name", "string")]
    return load_csv(spark, f"{root}/files", schema, target, CsvDialect.with_null_tokens("NULL", "null"))


@register("csv_lineage_products")
def csv_lineage_products(spark, sf_dir):
    """CSV rows with source file and row number in the file. Four files
    by key, each sorted and read in several splits; the folder's number stands
    for the file's name, which is random."""
    root = scratch_path(spark, "lineage")
    fields = cj.product_fields(read_table(spark, sf_dir, "part"), 1)
    number = F.col("product_id").cast("bigint")
    # one file to a folder, whatever the size: rows of a folder go to one task
    placed = fields.withColumns({"file": number % 4, "number": number}).repartition("file")
    placed = placed.sortWithinPartitions("file", "number").drop("number")
    placed.write.partitionBy("file").option("header", "true").csv(f"{root}/files")
    split = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(split)
    spark.conf.set(split, "8k")
    try:
        rows = load_csv_with_lineage(spark, f"{root}/files", schemas.PRODUCT_FIELDS, CsvDialect.simple(), now=cj.PRODUCT_T1, folder=True)
    finally:
        spark.conf.set(split, old)
    part = F.regexp_extract("source_file_name", r"file=(\d+)/", 1).cast("int")
    return rows.withColumn("source_file_part", part).drop("source_file_name")


@register("json_inferred_events")
def json_inferred_events(spark, sf_dir):
    """Schema inferred from one delivered day, then fixed for all files."""
    root = scratch_path(spark, "inferred")
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props", "ts")
    _land_json(ev.filter(F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz")), f"{root}/sample")
    _land_json(ev, f"{root}/raw")
    schema = infer_json_schema(spark, f"{root}/sample", multiline=False)
    return read_json(spark, f"{root}/raw", schema, multiline=False).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@register("json_rescued_events")
def json_rescued_events(spark, sf_dir):
    """The schema inferred from a first delivery stays frozen; a later one brings a new field and,
    in some rows, text where a number was. What does not fit is kept beside the columns."""
    root = scratch_path(spark, "rescued")
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    early = F.col("event_type") == "view"
    _land_json(ev.filter(early), f"{root}/raw")
    schema = infer_json_schema(spark, f"{root}/raw", multiline=False)
    text = F.when(F.col("user_id") % 5 == 0, F.lit("n/a")).otherwise(F.lit("?"))
    _land_json(ev.filter(~early & (F.col("event_type") != "click")).withColumn("channel", F.concat(F.lit("c"), F.col("user_id") % 3)), f"{root}/raw", "append")
    _land_json(ev.filter(F.col("event_type") == "click").withColumn("value", text), f"{root}/raw", "append")
    rows = read_json_rescued(spark, f"{root}/raw", schema)
    return rows.select("event_id", "user_id", "event_type", "value", F.col("_rescued")["channel"].alias("new_channel"), F.col("_rescued")["value"].alias("odd_value"))


@register("retail_checked_publish")
def retail_checked_publish(spark, sf_dir):
    """Q2, Q3 inside a load (E7): the joined fact is published under checks that the writing job counts.
    The second publish asks for a temperature, which rows without a store fact lack, and is stopped."""
    joined = _retail(spark, sf_dir, history=False)["combined"]
    table = VersionedTable(spark, f"{scratch_path(spark, 'checked')}/fact")
    first = {f"{c}_present": is_null(c) for c in retail.FACT_KEY} | {"dept_known": not_accepted("dept_id", range(1, 8))}
    second = first | {"temperature_present": is_null("temperature")}
    out = []
    for load, checks in enumerate((first, second), 1):
        counts: dict[str, int] = {}
        try:
            table.publish(joined, checks=checks)
        except CheckFailed as e:
            counts = e.counts
        out += [(load, n, counts.get(n, 0), not counts) for n in checks]
    found = spark.createDataFrame(out, "load int, check_name string, failing_rows long, published boolean")
    return found.withColumn("stored_rows", F.lit(table.read().count()).cast("bigint"))  # of the version that passed


@register("country_checked_publish")
def country_checked_publish(spark, sf_dir):
    """Q2, Q3 inside a load (E3): the transform published under its checks; a load that fails them leaves the table as it is."""
    table = VersionedTable(spark, f"{scratch_path(spark, 'checked')}/countries")
    rows = _country_transform(spark, sf_dir)
    names = [c.upper() for c in countries.CONTINENTS]
    checks = {"region_present": is_null("country_region_name"), "continent_known": not_accepted(F.upper("country_continent_name"), names)}
    table.publish(rows, checks=checks)
    try:
        table.publish(rows.withColumn("country_continent_name", F.lit("Atlantis")), checks=checks)
    except CheckFailed:
        return table.read()
    raise AssertionError("a load with unknown continents was published")


@register("publish_kinds_orders")
def publish_kinds_orders(spark, sf_dir):
    """One model published as table, view and incremental table (loaded twice)."""
    root = scratch_path(spark, "publish")
    o = read_table(spark, sf_dir, "orders")

    def model(orders):
        return orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))

    publish(spark, model(o), "orders_by_priority", "table", root=f"{root}/table")
    view = f"orders_by_priority_{root[-12:]}"
    publish(spark, model(o), view, "view")
    for orders in (cj.orders_day_one(o), o):
        publish(spark, model(orders), "orders_by_priority", "incremental", root=f"{root}/inc", unique_key=["o_orderpriority"])
    kinds = {"table": VersionedTable(spark, f"{root}/table").read(), "view": spark.table(view),
             "incremental": VersionedTable(spark, f"{root}/inc").read()}
    out = [df.select(F.lit(kind).alias("kind"), "o_orderpriority", "n") for kind, df in kinds.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@register("list_order_files")
def list_order_files(spark, sf_dir):
    """Files of a landing area that match a pattern, counted per folder."""
    root = scratch_path(spark, "listing")
    o = read_table(spark, sf_dir, "orders")
    o.repartition("o_orderstatus").write.partitionBy("o_orderstatus").option("header", "true").csv(f"{root}/orders")
    files = list_files(spark, f"{root}/orders", "part-*.csv")
    folder = F.element_at(F.split("path", "/"), -2)
    return files.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("n_files"))


@register("table_inventory_driver")
def table_inventory_driver(spark, sf_dir):
    """Tables of the driver folder with row counts, ordered by name."""
    return table_inventory(spark, parquet_tables(spark, sf_dir))


@register("quake_gold_merge")
def quake_gold_merge(spark, sf_dir):
    """E1 end to end: two feed deliveries that overlap for five days → bronze
    drain (S14) → silver of each delivery, merged on hash_id (S15, M1) →
    hourly activity merged into gold (A2, M1, T15)."""
    root = scratch_path(spark, "quake-e1")
    ev = read_table(spark, sf_dir, "events")
    silver_t = KeyedTable(spark, f"{root}/silver", ["hash_id"], buckets=16)
    gold_t = VersionedTable(spark, f"{root}/gold")
    day = lambda d: F.lit(f"2024-01-{d} 00:00:00").cast("timestamp_ntz")
    deliveries = [ev.filter(F.col("ts") < day(20)), ev.filter(F.col("ts") >= day(15))]
    for i, part in enumerate(deliveries):
        _land_json(quakes.feed_from_events(part), f"{root}/raw/{i}")
        stream = json_stream(spark, f"{root}/raw/{i}", schemas.QUAKE_FEED, multiline=False, **backlog(spark, f"{root}/raw/{i}"))
        drain(stream, f"{root}/bronze/{i}", f"{root}/_ckpt/{i}")
        silver_t.upsert(quakes.silver(spark.read.parquet(f"{root}/bronze/{i}")))
        gold_t.upsert(quakes.seismic_activity(silver_t.read()), ["hash_id"])
    return rounded(gold_t.read(), {"avg_mag": 6})


# ------------------------------------------------------- small batch operators
@register("lineitem_dedup_rows")
def lineitem_dedup_rows(spark, sf_dir):
    """Exact duplicate removal over all columns."""
    rows = read_table(spark, sf_dir, "lineitem")
    return dedup_rows(rows.unionByName(rows.filter(F.col("l_returnflag") == "R")))  # returns delivered twice


@register("orders_lookup")
def orders_lookup(spark, sf_dir):
    """conjunction of equality filters (pushed into the Parquet scan)."""
    return lookup(read_table(spark, sf_dir, "orders"), o_orderstatus="F", o_orderpriority="1-URGENT")


@register("orders_distinct_priority")
def orders_distinct_priority(spark, sf_dir):
    """DISTINCT values of a column."""
    return distinct_values(read_table(spark, sf_dir, "orders"), "o_orderpriority")


@register("country_from_landing")
def country_from_landing(spark, sf_dir):
    """E3 from files: JSON array files → delete-then-load into a VARIANT
    table (S8) → flatten (G2) → continents × currencies (G3, G4)."""
    root = scratch_path(spark, "countries")
    docs = countries.documents_from_driver(*(read_table(spark, sf_dir, t) for t in ("customer", "nation", "region")))
    docs.write.text(f"{root}/landing")
    reload_variant(spark, f"{root}/landing", f"{root}/country_details_cp")
    reload_variant(spark, f"{root}/landing", f"{root}/country_details_cp")  # re-run: replaced, not doubled
    copied = VersionedTable(spark, f"{root}/country_details_cp").read()
    return countries.country_transform(countries.country_raw(copied, COUNTRY_NOW), COUNTRY_NOW)


@register("health_e4_from_csv")
def health_e4_from_csv(spark, sf_dir):
    """E4 end to end: five CSV files reloaded into all-string bronze tables
    (S7 ×5), silver star joins (F17, J1) and the hospital gold (A4)."""
    root = scratch_path(spark, "healthcare")
    bronze = {}
    for name, df in _health_bronze(spark, sf_dir).items():
        schema = schemas.HEALTH_BRONZE[name]
        df.select(*schema.fieldNames()).write.option("header", "true").csv(f"{root}/landing/{name}")
        replace_table(spark, read_csv(spark, f"{root}/landing/{name}", schema, CsvDialect.simple()), f"{root}/bronze/{name}")
        bronze[name] = VersionedTable(spark, f"{root}/bronze/{name}").read()
    return health.hospital_performance(*(bronze[n] for n in ("treatments", "visits", "patients", "doctors", "hospitals")))


@register("product_e6_from_csv")
def product_e6_from_csv(spark, sf_dir):
    """E6 end to end: two product CSV loads with file name and row number
    (S9) → transform with audit columns (F10) → SCD2 snapshot per load into
    an append-only history table (M5) → versioned view (M7)."""
    root = scratch_path(spark, "products-e6")
    part = read_table(spark, sf_dir, "part")
    keys, cols = ["product_id"], cj.PRODUCT_CHECK_COLS
    history = HistoryTable(spark, f"{root}/product_snapshot", keys, buckets=8)  # closed versions are append-only
    for run, now in ((1, cj.PRODUCT_T1), (2, cj.PRODUCT_T2)):
        cj.product_fields(part, run).write.option("header", "true").option("nullValue", "NULL").csv(f"{root}/load{run}")
        copied = load_csv_with_lineage(spark, f"{root}/load{run}", schemas.PRODUCT_FIELDS,
                                       CsvDialect.with_null_tokens("NULL", "null"), now=now)
        history.snapshot(cj.product_transform(copied, run), cols, now, case_insensitive_cols=cols)
    return versioned_view(history.read(), cj.PRODUCT_VIEW_KEEP)


@register("retail_e7_from_csv")
def retail_e7_from_csv(spark, sf_dir):
    """E7 end to end: three CSV files into their declared tables (S6, S12),
    staging (F8), joined fact (J4), snapshot (M6), sales by temperature and
    year (R2). The files have fractions, which the declared decimals without
    a scale round away (trap T7)."""
    root = scratch_path(spark, "retail-e7")
    bronze = retail.bronze_from_driver(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "supplier"))
    bronze["fact"] = bronze["fact"].withColumns({"temperature": F.col("temperature") + 0.5, "fuel_price": F.col("fuel_price") + 0.25})
    tables = {"department": schemas.RETAIL_DEPARTMENT, "stores": schemas.RETAIL_STORES, "fact": schemas.retail_fact()}
    loaded = {}
    for name, schema in tables.items():
        bronze[name].select(*schema.fieldNames()).write.option("header", "true").csv(f"{root}/{name}")
        loaded[name] = load_csv(spark, f"{root}/{name}", schema, dialect=CsvDialect.simple())
    stage = retail.stage_dept(loaded["department"], RETAIL_NOW1, numbered=False)
    joined = retail.combined_fact(stage, retail.stg_fact(loaded["fact"], RETAIL_NOW1), retail.stage_store(loaded["stores"], RETAIL_NOW1))
    facts = retail.final_fact(retail.fact_snapshot(None, joined, RETAIL_NOW1))
    out = retail.sales_by_temperature_year(retail.dim_date(stage, RETAIL_NOW1), facts)
    return rounded(out.withColumn("temperature", F.col("temperature").cast("double")), {"total_sales": 2})
