"""Healthcare ELT.

Bronze tables are all strings, as loaded from CSV. Driver-table mapping:

| bronze      | driver   | notes                                                    |
| patients    | customer | name = c_name with '#' → ' ', dob derived from the key   |
| doctors     | supplier | specialization from the nation key                       |
| hospitals   | nation   |                                                          |
| visits      | orders   | hospital = o_custkey mod 25, doctor = o_orderkey mod 100 |
| treatments  | lineitem | outcome from l_returnflag, cost = price as text          |

Money is summed as a wide decimal and only totals are rounded: exact, so
they do not depend on how rows are partitioned, and no digit of a single
cost is lost.

Join plan (J1): visits ⋈ patients first, then doctors and hospitals; the
largest table (treatments) is shuffled once, on visit_id, or not at all where
both are stored in buckets of it (the ``framed_*`` functions). The gold tables
A4 and A6 sum up treatments per visit before that join, so it moves one row
per visit, and a distinct count of visits becomes a plain count.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.functions import name_part, ratio_or_null, year_boundaries

MONEY = "decimal(28,8)"


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def bronze_from_driver(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Map the driver tables onto the five all-string bronze tables."""
    c, s, n, o, li = (tables[k] for k in ("customer", "supplier", "nation", "orders", "lineitem"))
    patients = c.select(
        _s("c_custkey").alias("patient_id"),
        F.replace(F.col("c_name"), F.lit("#"), F.lit(" ")).alias("name"),
        F.when(F.col("c_custkey") % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.date_format(
            F.date_add(F.lit("1940-01-01").cast("date"), ((F.col("c_custkey") * 37) % 25000).cast("int")),
            "yyyy-MM-dd",
        ).alias("dob"),
        F.concat(F.lit("City "), _s("c_nationkey")).alias("city"),
    )
    doctors = s.select(
        _s("s_suppkey").alias("doctor_id"),
        F.replace(F.col("s_name"), F.lit("#"), F.lit(" ")).alias("name"),
        F.when(F.col("s_suppkey") % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.element_at(
            F.array(*[F.lit(x) for x in ("Cardiology", "Oncology", "Pediatrics", "Neurology")]),
            (F.col("s_nationkey") % 4 + 1).cast("int"),
        ).alias("specialization"),
        _s("s_nationkey").alias("hospital_id"),
        F.concat(F.lit("City "), _s("s_nationkey")).alias("city"),
    )
    hospitals = n.select(
        F.concat(F.lit("Hospital "), F.col("n_name")).alias("hospital_name"),
        _s("n_nationkey").alias("hospital_id"),
        F.concat(F.lit("City "), _s("n_nationkey")).alias("city"),
    )
    visits = o.select(
        _s("o_orderkey").alias("visit_id"),
        _s("o_custkey").alias("patient_id"),
        _s(F.col("o_custkey") % 25).alias("hospital_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("visit_date"),
        F.col("o_orderpriority").alias("department"),
        _s(F.col("o_orderkey") % 100).alias("doctor_id"),
    )
    treatments = li.select(
        F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("treatment_id"),
        _s("l_orderkey").alias("visit_id"),
        F.when(F.col("l_linestatus") == "O", "Therapy").otherwise("Surgery").alias("treatment_type"),
        F.when(F.col("l_returnflag") == "R", "Successful")
        .when(F.col("l_returnflag") == "A", "Failed")
        .otherwise("Ongoing")
        .alias("outcome"),
        _s("l_extendedprice").alias("cost"),
    )
    return {"patients": patients, "doctors": doctors, "hospitals": hospitals, "visits": visits, "treatments": treatments}


# ------------------------------------------------------------------- silver
def patients_transform(p: DataFrame, today: dt.date) -> DataFrame:
    """split name, typed birth date, age as year boundaries to ``today``."""
    dob = F.col("dob").cast("date")
    return p.select(
        F.col("patient_id"),
        name_part("name", 1).alias("patient_first_name"),
        name_part("name", 2).alias("patient_last_name"),
        F.col("gender").alias("patient_gender"),
        dob.alias("patient_dob"),
        year_boundaries(dob, F.lit(today)).alias("patient_age"),
        F.col("city").alias("patient_city"),
    )


def visit_frame(v: DataFrame, p: DataFrame, d: DataFrame, h: DataFrame) -> DataFrame:
    """visits ⋈ patients ⋈ doctors ⋈ hospitals (inner), visit-level columns.

    What every later step reads: stored in buckets of the visit id, beside
    treatments in the same buckets, no join or sum per visit moves a row.
    """
    vp = v.join(p.select("patient_id", F.col("name").alias("p_name")), "patient_id")
    d_ = d.select("doctor_id", F.col("name").alias("d_name"), "specialization")
    h_ = h.select("hospital_id", "hospital_name", F.col("city").alias("h_city"))
    return vp.join(d_, "doctor_id").join(h_, "hospital_id")


def visits_transform(v: DataFrame, p: DataFrame, d: DataFrame, h: DataFrame) -> DataFrame:
    """Four-table inner star join."""
    j = visit_frame(v, p, d, h)
    return j.select(
        F.col("visit_id").alias("patient_visit_id"),
        F.col("visit_date").cast("date").alias("patient_visit_date"),
        F.col("patient_id"),
        name_part("p_name", 1).alias("patient_first_name"),
        name_part("p_name", 2).alias("patient_last_name"),
        F.col("doctor_id"),
        name_part("d_name", 1).alias("doctor_first_name"),
        name_part("d_name", 2).alias("doctor_last_name"),
        F.col("specialization").alias("doctor_specialization"),
        F.col("hospital_id"),
        F.col("hospital_name"),
        F.col("department").alias("hospital_department"),
        F.col("h_city").alias("hospital_city"),
    )


def treatments_transform(t: DataFrame, v: DataFrame, p: DataFrame, d: DataFrame, h: DataFrame) -> DataFrame:
    """Five-table inner star join, one row per treatment."""
    return framed_treatments(t, visit_frame(v, p, d, h))


def framed_treatments(t: DataFrame, frame: DataFrame) -> DataFrame:
    """J1 over the visit frame."""
    j = t.join(frame, "visit_id")
    return j.select(
        F.col("treatment_id").alias("patient_treatment_id"),
        F.col("visit_id").alias("patient_visit_id"),
        F.col("visit_date").cast("date").alias("patient_visit_date"),
        F.col("treatment_type"),
        F.col("outcome").alias("treatment_outcome"),
        F.col("cost").alias("treatment_cost"),
        F.col("patient_id"),
        name_part("p_name", 1).alias("patient_first_name"),
        name_part("p_name", 2).alias("patient_last_name"),
        F.col("doctor_id"),
        name_part("d_name", 1).alias("doctor_first_name"),
        name_part("d_name", 2).alias("doctor_last_name"),
        F.col("specialization").alias("doctor_specialization"),
        F.col("hospital_id"),
        F.col("hospital_name"),
        F.col("h_city").alias("hospital_city"),
    )


# --------------------------------------------------------------------- gold
def city_access(pt: DataFrame, vt: DataFrame) -> DataFrame:
    """A3: distinct patients and hospitals per patient city (LEFT JOIN).

    Same result as ``COUNT(DISTINCT patient), COUNT(DISTINCT hospital)``
    over patients LEFT JOIN visits, planned without the ``Expand`` that
    two distinct aggregates need (it doubles every joined row):
    - patients per city need no join: the LEFT JOIN keeps every patient;
    - hospitals per city count distinct (city, hospital) pairs of the
      inner join with visits reduced to distinct (patient, hospital);
    - the two city-level results (one row per city) are joined null-safely
      on the city; a city without visits counts 0 hospitals.
    """
    people = pt.select("patient_id", "patient_city")
    patients = people.groupBy("patient_city").agg(F.count_distinct("patient_id").alias("total_patients"))
    pairs = vt.select("patient_id", "hospital_id").distinct()
    hospitals = (
        people.join(pairs, "patient_id")
        .select("patient_city", "hospital_id")
        .distinct()
        .groupBy("patient_city")
        .agg(F.count(F.lit(1)).alias("total_hospitals"))
        .withColumnRenamed("patient_city", "_city")
    )
    j = patients.join(hospitals, patients["patient_city"].eqNullSafe(hospitals["_city"]), "left")
    return j.select(
        "patient_city", "total_patients", F.coalesce(F.col("total_hospitals"), F.lit(0)).alias("total_hospitals")
    )


def _money(c: str) -> F.Column:
    return F.col(c).cast(MONEY)


def visit_costs(t: DataFrame) -> DataFrame:
    """Treatments summed up per visit: all that A4 and A6 need of them."""
    return t.groupBy("visit_id").agg(
        F.count(F.lit(1)).alias("treatments"),
        F.count("cost").alias("costs"),
        F.sum(_money("cost")).alias("cost"),
        F.sum(F.when(F.col("outcome") == "Successful", 1).otherwise(0)).alias("successes"),
    )


def hospital_performance(t: DataFrame, v: DataFrame, p: DataFrame, d: DataFrame, h: DataFrame) -> DataFrame:
    """A4: visits, treatments, average cost and success rate per hospital. A visit id occurs once in ``v``."""
    return framed_performance(t, visit_frame(v, p, d, h))


def framed_performance(t: DataFrame, frame: DataFrame) -> DataFrame:
    """A4 over the visit frame."""
    n = F.sum("treatments")
    seen = frame.join(visit_costs(t), "visit_id")
    return seen.groupBy("hospital_id", "hospital_name", F.col("h_city").alias("hospital_city")).agg(
        F.count(F.lit(1)).alias("total_visits"),
        n.alias("total_treatments"),
        F.round(F.sum("cost") / F.sum("costs"), 2).cast("double").alias("avg_treatment_cost"),
        F.round(F.lit(100.0) * F.sum("successes") / n, 2).alias("success_rate"),
    )


def visit_summary(vt: DataFrame) -> DataFrame:
    """A5: first / last visit, visits, average days between visits."""
    first, last = F.min("patient_visit_date"), F.max("patient_visit_date")
    visits = F.count_distinct("patient_visit_id")
    return vt.groupBy("patient_id", "patient_first_name", "patient_last_name").agg(
        first.alias("first_visit_date"),
        last.alias("last_visit_date"),
        visits.alias("total_visits"),
        F.round(ratio_or_null(F.datediff(last, first), visits - 1), 1).alias("avg_days_between_visits"),
    )


def patient_value(t: DataFrame, v: DataFrame, p: DataFrame, d: DataFrame, h: DataFrame) -> DataFrame:
    """Visits, treatments, total and average spend per patient. A visit id occurs once in ``v``."""
    return framed_value(t, visit_frame(v, p, d, h))


def framed_value(t: DataFrame, frame: DataFrame) -> DataFrame:
    """A6 over the visit frame."""
    total = F.sum("cost")
    seen = frame.join(visit_costs(t), "visit_id")
    names = [name_part("p_name", i).alias(f"patient_{n}_name") for i, n in ((1, "first"), (2, "last"))]
    return seen.groupBy("patient_id", *names).agg(
        F.count(F.lit(1)).alias("total_visits"),
        F.sum("treatments").alias("total_treatments"),
        F.round(total, 2).cast("double").alias("total_spent"),
        F.round(total / F.sum("costs"), 2).cast("double").alias("avg_cost_per_treatment"),
    )
