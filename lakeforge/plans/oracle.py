"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the reference's SQL semantics, not from the Spark code: each
statement re-derives the driver-table mapping in plain SQL and computes
the result the way the source system would (window row numbers, pairwise
joins, MERGE-like unions).
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# ---------------------------------------------------------------- earthquakes
# Flat silver rows of the earthquake mapping (time fields lose milliseconds).
QUAKE_FLAT = """
WITH reports AS (
  SELECT *, 0 AS later FROM events
  UNION ALL SELECT *, 1 FROM events WHERE user_id % 5 = 0
  UNION ALL SELECT *, 0 FROM events WHERE user_id % 7 = 0)
SELECT 'ev' || CAST(event_id AS VARCHAR) AS id,
       date_trunc('second', ts) AS time,
       CAST(user_id % 360 AS DOUBLE) - 180.0 AS longitude,
       CAST(floor(value) % 180 AS DOUBLE) - 90.0 AS latitude,
       value AS depth, value + later AS mag, 'ml' AS magType,
       'zone ' || CAST(user_id AS VARCHAR) AS place,
       user_id AS gap, value / 100 AS dmin, value / 1000 AS rms,
       event_type AS net, CAST(event_id AS VARCHAR) AS code,
       ',ev' || CAST(event_id AS VARCHAR) || ',' AS ids,
       ',lf,' AS sources, ',origin,' AS types,
       CAST(user_id AS DOUBLE) AS nst, 'event ' || CAST(event_id AS VARCHAR) AS title,
       'reviewed' AS status, CAST(0 AS DOUBLE) AS tsunami,
       CAST(user_id AS DOUBLE) AS sig, CAST(user_id AS DOUBLE) AS felt,
       date_trunc('second', ts) + INTERVAL 1 HOUR * later AS updated
FROM reports
"""

QUAKE_SILVER = f"""
SELECT *, sha256(id || '_' || strftime(time, '%Y-%m-%d %H:%M:%S')) AS hash_id
FROM (SELECT DISTINCT * FROM ({QUAKE_FLAT}))
QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated DESC) = 1
"""

QUAKE_HOTSPOT = f"""
SELECT round(latitude, 1) AS avg_latitude, round(longitude, 1) AS avg_longitude,
       count(*) AS event_density, round(avg(mag), 6) AS avg_mag, max(mag) AS max_mag,
       substr(sha256(CAST(round(latitude, 1) AS VARCHAR) || '_' || CAST(round(longitude, 1) AS VARCHAR)), 1, 15) AS hash_id
FROM ({QUAKE_SILVER})
GROUP BY 1, 2
"""

ORACLE["quake_flatten"] = QUAKE_FLAT
ORACLE["quake_silver"] = QUAKE_SILVER
ORACLE["quake_seismic_activity"] = f"""
SELECT date_trunc('hour', time) AS activity_hour, net,
       count(hash_id) AS total_event, round(avg(mag), 6) AS avg_mag, max(mag) AS max_mag,
       substr(sha256(strftime(date_trunc('hour', time), '%Y-%m-%d %H:%M:%S') || '_' || net), 1, 15) AS hash_id
FROM ({QUAKE_SILVER})
GROUP BY 1, 2
"""
ORACLE["quake_geo_hotspot"] = QUAKE_HOTSPOT
ORACLE["quake_daily_events"] = f"""
SELECT date_trunc('day', time) AS event_day, count(id) AS event_count
FROM ({QUAKE_SILVER}) GROUP BY 1
"""
ORACLE["quake_events_by_net"] = f"""
SELECT net, count(*) AS event_count FROM ({QUAKE_SILVER}) GROUP BY 1
"""
ORACLE["quake_point_map"] = f"""
SELECT mag, latitude, longitude, place, time FROM ({QUAKE_SILVER})
"""
ORACLE["quake_hotspot_map"] = f"""
SELECT event_density, avg_latitude, avg_longitude, avg_mag FROM ({QUAKE_HOTSPOT})
"""
ORACLE["quake_latest_per_user"] = """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""

# ----------------------------------------------------------------- healthcare
HEALTH_BRONZE = """
patients AS (
  SELECT CAST(c_custkey AS VARCHAR) AS patient_id, replace(c_name, '#', ' ') AS name,
         CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
         strftime(DATE '1940-01-01' + CAST((c_custkey * 37) % 25000 AS INTEGER), '%Y-%m-%d') AS dob,
         'City ' || CAST(c_nationkey AS VARCHAR) AS city
  FROM customer),
doctors AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS doctor_id, replace(s_name, '#', ' ') AS name,
         CASE WHEN s_suppkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
         CASE s_nationkey % 4 WHEN 0 THEN 'Cardiology' WHEN 1 THEN 'Oncology'
                              WHEN 2 THEN 'Pediatrics' ELSE 'Neurology' END AS specialization,
         CAST(s_nationkey AS VARCHAR) AS hospital_id,
         'City ' || CAST(s_nationkey AS VARCHAR) AS city
  FROM supplier),
hospitals AS (
  SELECT 'Hospital ' || n_name AS hospital_name, CAST(n_nationkey AS VARCHAR) AS hospital_id,
         'City ' || CAST(n_nationkey AS VARCHAR) AS city
  FROM nation),
visits AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS visit_id, CAST(o_custkey AS VARCHAR) AS patient_id,
         CAST(o_custkey % 25 AS VARCHAR) AS hospital_id, strftime(o_orderdate, '%Y-%m-%d') AS visit_date,
         o_orderpriority AS department, CAST(o_orderkey % 100 AS VARCHAR) AS doctor_id
  FROM orders),
treatments AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS treatment_id,
         CAST(l_orderkey AS VARCHAR) AS visit_id,
         CASE WHEN l_linestatus = 'O' THEN 'Therapy' ELSE 'Surgery' END AS treatment_type,
         CASE l_returnflag WHEN 'R' THEN 'Successful' WHEN 'A' THEN 'Failed' ELSE 'Ongoing' END AS outcome,
         CAST(l_extendedprice AS VARCHAR) AS cost
  FROM lineitem)"""

HEALTH_PT = """
SELECT patient_id, split_part(name, ' ', 1) AS patient_first_name, split_part(name, ' ', 2) AS patient_last_name,
       gender AS patient_gender, CAST(dob AS DATE) AS patient_dob,
       CAST(year(DATE '2025-06-30') - year(CAST(dob AS DATE)) AS INTEGER) AS patient_age, city AS patient_city
FROM patients"""

HEALTH_VT = """
SELECT V.visit_id AS patient_visit_id, CAST(V.visit_date AS DATE) AS patient_visit_date, V.patient_id,
       split_part(P.name, ' ', 1) AS patient_first_name, split_part(P.name, ' ', 2) AS patient_last_name,
       V.doctor_id, split_part(D.name, ' ', 1) AS doctor_first_name, split_part(D.name, ' ', 2) AS doctor_last_name,
       D.specialization AS doctor_specialization, V.hospital_id, H.hospital_name,
       V.department AS hospital_department, H.city AS hospital_city
FROM visits V
JOIN patients P ON V.patient_id = P.patient_id
JOIN doctors D ON V.doctor_id = D.doctor_id
JOIN hospitals H ON V.hospital_id = H.hospital_id"""

HEALTH_TT = """
SELECT T.treatment_id AS patient_treatment_id, T.visit_id AS patient_visit_id,
       CAST(V.visit_date AS DATE) AS patient_visit_date, T.treatment_type, T.outcome AS treatment_outcome,
       T.cost AS treatment_cost, V.patient_id,
       split_part(P.name, ' ', 1) AS patient_first_name, split_part(P.name, ' ', 2) AS patient_last_name,
       V.doctor_id, split_part(D.name, ' ', 1) AS doctor_first_name, split_part(D.name, ' ', 2) AS doctor_last_name,
       D.specialization AS doctor_specialization, V.hospital_id, H.hospital_name, H.city AS hospital_city
FROM treatments T
JOIN visits V ON T.visit_id = V.visit_id
JOIN patients P ON V.patient_id = P.patient_id
JOIN doctors D ON V.doctor_id = D.doctor_id
JOIN hospitals H ON V.hospital_id = H.hospital_id"""


def money_avg(col: str) -> str:
    """Exact half-up average to cents: integer arithmetic on summed cents."""
    cents = f"CAST(SUM(CAST({col} AS DECIMAL(18,2))) * 100 AS HUGEINT)"
    n = f"COUNT({col})"
    return f"CAST(({cents} * 2 + {n}) // (2 * {n}) AS DOUBLE) / 100.0"


def _health(body: str) -> str:
    return f"WITH {HEALTH_BRONZE},\npt AS ({HEALTH_PT}),\nvt AS ({HEALTH_VT}),\ntt AS ({HEALTH_TT})\n{body}"


ORACLE["health_patients"] = _health("SELECT * FROM pt")
ORACLE["health_visits"] = _health("SELECT * FROM vt")
ORACLE["health_treatments"] = _health("SELECT * FROM tt")
ORACLE["health_city_access"] = _health("""
SELECT TP.patient_city, COUNT(DISTINCT TP.patient_id) AS total_patients,
       COUNT(DISTINCT TV.hospital_id) AS total_hospitals
FROM pt TP LEFT JOIN vt TV ON TP.patient_id = TV.patient_id
GROUP BY TP.patient_city""")
ORACLE["health_hospital_performance"] = _health(f"""
SELECT hospital_id, hospital_name, hospital_city,
       COUNT(DISTINCT patient_visit_id) AS total_visits, COUNT(*) AS total_treatments,
       {money_avg("treatment_cost")} AS avg_treatment_cost,
       ROUND(100.0 * SUM(CASE WHEN treatment_outcome = 'Successful' THEN 1 ELSE 0 END) / COUNT(*), 2) AS success_rate
FROM tt GROUP BY hospital_id, hospital_name, hospital_city""")
ORACLE["health_visit_summary"] = _health("""
SELECT patient_id, patient_first_name, patient_last_name,
       MIN(patient_visit_date) AS first_visit_date, MAX(patient_visit_date) AS last_visit_date,
       COUNT(DISTINCT patient_visit_id) AS total_visits,
       ROUND(DATEDIFF('day', MIN(patient_visit_date), MAX(patient_visit_date))
             / NULLIF(COUNT(DISTINCT patient_visit_id) - 1, 0), 1) AS avg_days_between_visits
FROM vt GROUP BY patient_id, patient_first_name, patient_last_name""")
ORACLE["health_patient_value"] = _health(f"""
SELECT patient_id, patient_first_name, patient_last_name,
       COUNT(DISTINCT patient_visit_id) AS total_visits, COUNT(*) AS total_treatments,
       CAST(ROUND(SUM(CAST(treatment_cost AS DECIMAL(18,2))), 2) AS DOUBLE) AS total_spent,
       {money_avg("treatment_cost")} AS avg_cost_per_treatment
FROM tt GROUP BY patient_id, patient_first_name, patient_last_name""")

# --------------------------------------------------------------------- retail
RETAIL_BASE = """
dept AS (
  SELECT l_suppkey AS store, l_linenumber AS dept, CAST(l_shipdate AS DATE) AS date,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS weekly_sales,
         CASE WHEN bool_or(l_returnflag = 'R') THEN 'TRUE' ELSE 'FALSE' END AS isholiday
  FROM lineitem GROUP BY 1, 2, 3),
stores AS (
  SELECT s_suppkey AS store, CASE s_nationkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS type,
         CAST(100000 + s_nationkey * 1000 AS INTEGER) AS size
  FROM supplier),
fact AS (
  SELECT l_suppkey AS store, CAST(l_shipdate AS DATE) AS date,
         MAX(l_quantity) AS temperature, CAST(MIN(l_linenumber) AS DOUBLE) AS fuel_price,
         CASE WHEN MIN(l_linenumber) = 1 THEN 'NA' ELSE CAST(MIN(l_quantity) AS VARCHAR) END AS markdown1,
         CASE WHEN MAX(l_linenumber) >= 6 THEN 'NA' ELSE CAST(MAX(l_quantity) AS VARCHAR) END AS markdown2,
         CAST(COUNT(*) AS VARCHAR) AS markdown3,
         CASE WHEN COUNT(*) = 1 THEN 'NA' ELSE CAST(SUM(l_linenumber) AS VARCHAR) END AS markdown4,
         CAST(MAX(l_linenumber) AS VARCHAR) AS markdown5,
         CAST(MIN(l_quantity) + 100 AS VARCHAR) AS cpi,
         CASE WHEN MAX(l_quantity) > 45 THEN 'NA' ELSE CAST(MAX(l_quantity) / 10 AS VARCHAR) END AS unemployment,
         CASE WHEN bool_or(l_returnflag = 'R') THEN 'TRUE' ELSE 'FALSE' END AS isholiday
  FROM lineitem WHERE l_suppkey % 10 <> 0 GROUP BY 1, 2),
stage_dept AS (
  SELECT ROW_NUMBER() OVER (ORDER BY date, store, dept) AS row_num, strftime(date, '%Y-%m-%d') AS date_id,
         store AS store_id, dept AS dept_id, date AS store_date, weekly_sales AS store_weekly_sales,
         isholiday, TIMESTAMP '2024-03-01 00:00:00' AS insert_date
  FROM dept),
stage_store AS (
  SELECT store AS store_id, type AS store_type, size AS store_size, TIMESTAMP '2024-03-01 00:00:00' AS insert_date
  FROM stores),
stg_fact AS (
  SELECT store AS store_id, strftime(date, '%Y-%m-%d') AS date_id, temperature, fuel_price,
         CASE WHEN markdown1 = 'NA' THEN 0 ELSE CAST(markdown1 AS DOUBLE) END AS markdown1,
         CASE WHEN markdown2 = 'NA' THEN 0 ELSE CAST(markdown2 AS DOUBLE) END AS markdown2,
         CASE WHEN markdown3 = 'NA' THEN 0 ELSE CAST(markdown3 AS DOUBLE) END AS markdown3,
         CASE WHEN markdown4 = 'NA' THEN 0 ELSE CAST(markdown4 AS DOUBLE) END AS markdown4,
         CASE WHEN markdown5 = 'NA' THEN 0 ELSE CAST(markdown5 AS DOUBLE) END AS markdown5,
         CASE WHEN cpi = 'NA' THEN 0 ELSE CAST(cpi AS DOUBLE) END AS cpi,
         CASE WHEN unemployment = 'NA' THEN 0 ELSE CAST(unemployment AS DOUBLE) END AS unemployment,
         isholiday, TIMESTAMP '2024-03-01 00:00:00' AS insert_date,
         TIMESTAMP '2024-03-01 00:00:00' AS vrsn_start_date, TIMESTAMP '2024-03-01 00:00:00' AS vrsn_end_date
  FROM fact),
combined AS (
  SELECT d.store_id, d.dept_id, d.date_id, d.store_weekly_sales,
         s.temperature, s.fuel_price, s.cpi, s.unemployment,
         s.markdown1, s.markdown2, s.markdown3, s.markdown4, s.markdown5, st.store_size
  FROM stage_dept d
  LEFT JOIN stg_fact s ON d.store_id = s.store_id AND d.date_id = s.date_id
  LEFT JOIN stage_store st ON d.store_id = st.store_id),
keyed AS (
  SELECT *, md5(CAST(store_id AS VARCHAR) || '-' || CAST(dept_id AS VARCHAR) || '-' || date_id) AS composite_key
  FROM combined),
history AS (
  SELECT *, md5(composite_key || '|' || '2024-03-01 00:00:00') AS dbt_scd_id,
         TIMESTAMP '2024-03-01 00:00:00' AS dbt_updated_at, TIMESTAMP '2024-03-01 00:00:00' AS dbt_valid_from,
         CASE WHEN dept_id = 1 THEN TIMESTAMP '2024-03-02 00:00:00' END AS dbt_valid_to
  FROM keyed
  UNION ALL
  SELECT * REPLACE (store_weekly_sales + 100 AS store_weekly_sales),
         md5(composite_key || '|' || '2024-03-02 00:00:00') AS dbt_scd_id,
         TIMESTAMP '2024-03-02 00:00:00' AS dbt_updated_at, TIMESTAMP '2024-03-02 00:00:00' AS dbt_valid_from,
         CAST(NULL AS TIMESTAMP) AS dbt_valid_to
  FROM keyed WHERE dept_id = 1),
final_fact AS (SELECT * FROM history WHERE dbt_valid_to IS NULL),
dim_date AS (
  SELECT row_num, date_id, store_date, isholiday, TIMESTAMP '2024-03-01 00:00:00' AS update_date FROM stage_dept),
dim_store AS (
  SELECT store_id, store_type, store_size, TIMESTAMP '2024-03-01 00:00:00' AS update_date FROM stage_store)"""


def _retail(body: str) -> str:
    return f"WITH {RETAIL_BASE}\n{body}"


ORACLE["retail_stage_dept"] = _retail("SELECT * FROM stage_dept")
ORACLE["retail_stg_fact"] = _retail("SELECT * FROM stg_fact")
ORACLE["retail_combined_fact"] = _retail("SELECT * FROM combined")
ORACLE["retail_fact_history"] = _retail("SELECT * FROM history")
ORACLE["retail_final_fact"] = _retail("SELECT * FROM final_fact")
ORACLE["retail_dim_date"] = _retail("""
SELECT row_num, date_id, store_date, isholiday, TIMESTAMP '2024-03-02 00:00:00' AS update_date FROM stage_dept""")
ORACLE["retail_dim_store"] = _retail("""
SELECT store_id, store_type, store_size, TIMESTAMP '2024-03-02 00:00:00' AS update_date FROM stage_store""")
ORACLE["retail_dim_department"] = _retail("SELECT dept_id FROM stage_dept")
ORACLE["retail_sales_by_store_holiday"] = _retail("""
SELECT f.store_id, d.isholiday, ROUND(SUM(f.store_weekly_sales), 2) AS total_sales
FROM (SELECT date_id, isholiday FROM dim_date
      UNION ALL
      SELECT strftime(store_date + INTERVAL 120 MONTH, '%Y-%m-%d'), isholiday FROM stage_dept WHERE dept_id = 7) d
LEFT JOIN final_fact f ON f.date_id = d.date_id
GROUP BY 1, 2""")
ORACLE["retail_sales_by_temperature_year"] = _retail("""
SELECT f.temperature, CAST(YEAR(d.store_date) AS INTEGER) AS year, ROUND(SUM(f.store_weekly_sales), 2) AS total_sales
FROM final_fact f JOIN dim_date d ON d.date_id = f.date_id
GROUP BY 1, 2""")
ORACLE["retail_sales_by_store_size"] = _retail("""
SELECT s.store_size, ROUND(SUM(f.store_weekly_sales), 2) AS total_sales
FROM final_fact f JOIN dim_store s ON s.store_id = f.store_id
GROUP BY 1""")
ORACLE["retail_markdown_by_store_year"] = _retail("""
SELECT f.store_id, ROUND(SUM(f.markdown1), 2) AS sum_markdown1, ROUND(SUM(f.markdown2), 2) AS sum_markdown2,
       ROUND(SUM(f.markdown3), 2) AS sum_markdown3, ROUND(SUM(f.markdown4), 2) AS sum_markdown4,
       ROUND(SUM(f.markdown5), 2) AS sum_markdown5, CAST(YEAR(d.store_date) AS INTEGER) AS year
FROM dim_date d JOIN final_fact f ON d.date_id = f.date_id
GROUP BY 1, 7""")
ORACLE["retail_sales_by_store_type"] = _retail("""
SELECT s.store_type, ROUND(SUM(f.store_weekly_sales), 2) AS total_sales
FROM final_fact f JOIN dim_store s ON s.store_id = f.store_id
GROUP BY 1""")
ORACLE["retail_fuel_by_store_year"] = _retail("""
SELECT s.store_id, ROUND(SUM(f.fuel_price), 2) AS sum_fuel_price, CAST(YEAR(d.store_date) AS INTEGER) AS year
FROM final_fact f JOIN dim_date d ON d.date_id = f.date_id
JOIN dim_store s ON s.store_id = f.store_id
GROUP BY 1, 3""")
ORACLE["retail_sales_by_cpi"] = _retail("""
SELECT cpi, ROUND(SUM(store_weekly_sales), 2) AS total_sales FROM final_fact GROUP BY 1""")

# ------------------------------------------------------------ change operators
ORDERS_TS = """
t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00'),
s AS (SELECT o_orderkey, o_custkey,
             CASE WHEN o_orderpriority = '1-URGENT' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
             CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice + 1.0 ELSE o_totalprice END AS o_totalprice,
             o_orderdate, o_orderpriority
      FROM orders WHERE o_orderdate >= TIMESTAMP '1998-07-01 00:00:00'),
merged AS (
  SELECT COALESCE(s.o_orderkey, t.o_orderkey) AS o_orderkey,
         CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
         CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
         CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
         CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate,
         CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority
  FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey)"""
ORACLE["orders_upsert"] = f"WITH {ORDERS_TS}\nSELECT * FROM merged"
ORACLE["orders_change_feed"] = f"""WITH {ORDERS_TS},
diff AS (
  SELECT t.o_orderkey FROM t JOIN merged m ON t.o_orderkey = m.o_orderkey
  WHERE t.o_custkey IS DISTINCT FROM m.o_custkey OR t.o_orderstatus IS DISTINCT FROM m.o_orderstatus
     OR t.o_totalprice IS DISTINCT FROM m.o_totalprice OR t.o_orderdate IS DISTINCT FROM m.o_orderdate
     OR t.o_orderpriority IS DISTINCT FROM m.o_orderpriority)
SELECT m.*, 'insert' AS _change_type FROM merged m WHERE m.o_orderkey NOT IN (SELECT o_orderkey FROM t)
UNION ALL SELECT t.*, 'delete' FROM t WHERE t.o_orderkey NOT IN (SELECT o_orderkey FROM merged)
UNION ALL SELECT t.*, 'update_preimage' FROM t WHERE t.o_orderkey IN (SELECT o_orderkey FROM diff)
UNION ALL SELECT m.*, 'update_postimage' FROM merged m WHERE m.o_orderkey IN (SELECT o_orderkey FROM diff)"""

CUSTOMER_ROWS = """
SELECT 'First' || CAST(c_custkey % 40 AS VARCHAR) AS contactfirstname,
       'Last' || CAST(c_custkey // 40 AS VARCHAR) AS contactlastname,
       c_name AS customername, '+' || CAST(c_nationkey AS VARCHAR) || '-' || CAST(c_custkey AS VARCHAR) AS phone,
       CAST(c_custkey AS VARCHAR) || ' Main St' AS addressline1,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Suite 1' END AS addressline2,
       'City ' || CAST(c_nationkey AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state,
       lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS postalcode, 'NATION_' || CAST(c_nationkey AS VARCHAR) AS country,
       c_mktsegment AS territory, c_acctbal
FROM customer"""
ORACLE["customer_scd1_merge"] = f"""
WITH rows AS ({CUSTOMER_ROWS}),
tgt AS (SELECT * EXCLUDE (c_acctbal), TIMESTAMP '2024-01-01 00:00:00' AS insert_dts,
               TIMESTAMP '2024-01-01 00:00:00' AS update_dts
        FROM rows WHERE territory <> 'MACHINERY'),
tmp AS (SELECT * EXCLUDE (c_acctbal, phone),
               CASE WHEN territory = 'BUILDING' AND c_acctbal > 5000 THEN phone || '-x' ELSE phone END AS phone
        FROM rows WHERE territory IN ('MACHINERY', 'BUILDING'))
SELECT tgt.* REPLACE (
         tmp.customername AS customername, tmp.phone AS phone, tmp.addressline1 AS addressline1,
         tmp.addressline2 AS addressline2, tmp.city AS city, tmp.state AS state, tmp.postalcode AS postalcode,
         tmp.country AS country, tmp.territory AS territory, TIMESTAMP '2024-01-02 00:00:00' AS update_dts)
FROM tgt JOIN tmp ON tgt.contactfirstname = tmp.contactfirstname AND tgt.contactlastname = tmp.contactlastname
UNION ALL
SELECT tgt.* FROM tgt
WHERE NOT EXISTS (SELECT 1 FROM tmp WHERE tgt.contactfirstname = tmp.contactfirstname
                                      AND tgt.contactlastname = tmp.contactlastname)
UNION ALL
SELECT tmp.contactfirstname, tmp.contactlastname, tmp.customername, tmp.phone, tmp.addressline1, tmp.addressline2,
       tmp.city, tmp.state, tmp.postalcode, tmp.country, tmp.territory,
       TIMESTAMP '2024-01-02 00:00:00', TIMESTAMP '2024-01-02 00:00:00'
FROM tmp
WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.contactfirstname = tmp.contactfirstname
                                      AND tgt.contactlastname = tmp.contactlastname)"""

ORACLE["events_cdc_scd1"] = """
WITH t AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00'
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
s AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'
        AND (user_id % 4 <> 0 OR ts < TIMESTAMP '2024-01-17 00:00:00')
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT s.* FROM s LEFT JOIN t ON s.user_id = t.user_id WHERE t.user_id IS NULL OR s.ts >= t.ts
UNION ALL
SELECT t.* FROM t LEFT JOIN s ON s.user_id = t.user_id WHERE s.user_id IS NULL OR s.ts < t.ts"""


def _product_load(run: int) -> str:
    now = "2024-05-01 00:00:00" if run == 1 else "2024-05-02 00:00:00"
    price = "p_retailprice" if run == 1 else "CASE WHEN p_size > 45 THEN p_retailprice + 10 ELSE p_retailprice END"
    name = "p_name" if run == 1 else "CASE WHEN p_size BETWEEN 41 AND 45 THEN upper(p_name) ELSE p_name END"
    where = "" if run == 1 else "WHERE p_brand <> 'Brand#1'"
    return f"""
SELECT CAST(p_partkey AS VARCHAR) AS product_id, {name} AS product_name, p_type AS category,
       CAST({price} AS VARCHAR) AS selling_price, p_brand AS model_number, 'About ' || p_name AS about_product,
       'Size ' || CAST(p_size AS VARCHAR) AS product_specification,
       CASE WHEN p_size > 45 THEN NULL ELSE 'Spec ' || CAST(p_size AS VARCHAR) END AS technical_details,
       CAST(p_size AS VARCHAR) || ' kg' AS shipping_weight,
       CAST(p_size AS VARCHAR) || 'x' || CAST(p_size AS VARCHAR) AS product_dimensions,
       'EST' AS time_zone, 'PRODUCT' AS source_sys_name, 'STANDARD' AS instnc_st_nm,
       'run-{run}' AS process_id, 'TRANSFORM_LOAD' AS process_name,
       TIMESTAMP '{now}' AS insert_dts, TIMESTAMP '{now}' AS update_dts,
       'products.csv' AS source_file_name, CAST(p_partkey + 1 AS VARCHAR) AS source_file_row_number
FROM part {where}"""


_PCHK = ["product_name", "category", "selling_price", "model_number", "about_product",
         "product_specification", "technical_details", "shipping_weight", "product_dimensions"]
PRODUCT_HISTORY = f"""
WITH p1 AS ({_product_load(1)}), p2 AS ({_product_load(2)}),
changed AS (
  SELECT p1.product_id FROM p1 JOIN p2 ON p1.product_id = p2.product_id
  WHERE {' OR '.join(f'lower(p1.{c}) IS DISTINCT FROM lower(p2.{c})' for c in _PCHK)}),
history AS (
  SELECT p1.*, md5(product_id || '|' || '2024-05-01 00:00:00') AS dbt_scd_id,
         TIMESTAMP '2024-05-01 00:00:00' AS dbt_updated_at, TIMESTAMP '2024-05-01 00:00:00' AS dbt_valid_from,
         CASE WHEN product_id IN (SELECT product_id FROM changed) THEN TIMESTAMP '2024-05-02 00:00:00' END AS dbt_valid_to
  FROM p1
  UNION ALL
  SELECT p2.*, md5(product_id || '|' || '2024-05-02 00:00:00'),
         TIMESTAMP '2024-05-02 00:00:00', TIMESTAMP '2024-05-02 00:00:00', CAST(NULL AS TIMESTAMP)
  FROM p2 WHERE product_id IN (SELECT product_id FROM changed)
     OR product_id NOT IN (SELECT product_id FROM p1))"""
ORACLE["product_scd2_history"] = PRODUCT_HISTORY + "\nSELECT * FROM history"
ORACLE["product_versions"] = PRODUCT_HISTORY + """
SELECT product_id, dbt_valid_from AS vrsn_strt_dts,
       COALESCE(dbt_valid_to, TIMESTAMP '9999-12-31 00:00:00') AS vrsn_end_dts,
       product_name, category, selling_price, model_number, about_product, product_specification,
       technical_details, shipping_weight, product_dimensions, time_zone, source_sys_name, instnc_st_nm,
       process_id, process_name, insert_dts, update_dts
FROM history"""

# --------------------------------------------------------------- data quality
ORACLE["dq_unique_lineitem_key"] = """
SELECT unique_field, COUNT(*) AS n_records
FROM (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS unique_field FROM lineitem)
WHERE unique_field IS NOT NULL GROUP BY unique_field HAVING COUNT(*) > 1"""
ORACLE["dq_not_null_combined_temperature"] = _retail("SELECT * FROM combined WHERE temperature IS NULL")
ORACLE["dq_accepted_order_priority"] = """
SELECT o_orderpriority AS value_field, COUNT(*) AS n_records FROM orders GROUP BY 1
HAVING o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')"""
ORACLE["dq_duplicate_lineitem_keys"] = """
SELECT l_orderkey, l_linenumber, COUNT(*) AS count FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1"""
ORACLE["dq_unique_dim_date_id"] = _retail("""
SELECT date_id AS unique_field, COUNT(*) AS n_records FROM dim_date
WHERE date_id IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1""")

# ------------------------------------------------------------------ countries
COUNTRY_BASE = """
base AS (
  SELECT c.*, n.n_name, n.n_nationkey, n.n_regionkey,
         CASE WHEN r.r_name = 'MIDDLE EAST' THEN 'Oceania'
              WHEN r.r_name = 'AMERICA' AND n.n_nationkey % 2 = 0 THEN 'North America'
              WHEN r.r_name = 'AMERICA' THEN 'South America' ELSE r.r_name END AS r_name
  FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 10 = 0) c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
con AS (
  SELECT base.*, unnest(CASE WHEN c_acctbal < 0 THEN [r_name, 'Antarctica'] ELSE [r_name] END) AS continent FROM base),
cur AS (
  SELECT c_custkey, substr(c_mktsegment, 1, 3) AS code, lower(c_mktsegment) AS cname, '$' AS symbol
  FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
  UNION ALL
  SELECT c_custkey, 'EUR', 'Euro', '€' FROM customer WHERE c_mktsegment <> 'HOUSEHOLD' AND c_nationkey % 5 = 0),
transform AS (
  SELECT c_name || ' Republic' AS country_official_name, CASE WHEN con.c_custkey % 13 <> 0 THEN c_name END AS country_common_name,
         '[' || CAST(n_nationkey AS VARCHAR) || ',' || CAST(n_regionkey AS VARCHAR) || ']' AS country_latlng,
         continent AS country_continent_name, n_name AS country_region_name,
         CASE WHEN c_nationkey % 2 = 0 THEN 'Sub ' || n_name END AS country_subregion_name,
         '["Capital ' || CAST(con.c_custkey AS VARCHAR) || '"]' AS country_capital_name,
         '[' || CAST(c_nationkey AS VARCHAR) || ',0]' AS country_capital_latlng,
         CAST(round(c_acctbal) AS INTEGER) AS country_total_area,
         con.c_custkey * 1000 AS country_population,
         cur.code AS country_currency, cur.cname AS country_currency_name, cur.symbol AS country_currency_symbol,
         'https://flags.example/' || CAST(con.c_custkey AS VARCHAR) || '.png' AS country_flag,
         'https://maps.example/' || CAST(con.c_custkey AS VARCHAR) AS country_map,
         '{"lng":"Lang ' || CAST(c_nationkey AS VARCHAR) || '"}' AS country_language,
         CASE WHEN c_nationkey % 2 = 0 THEN 'monday' ELSE 'sunday' END AS country_start_of_week,
         c_acctbal > 0 AS country_un_member_status,
         CASE WHEN c_nationkey % 4 = 0 THEN 'left' ELSE 'right' END AS country_driving_lane,
         TIMESTAMP '2024-04-01 00:00:00' AS insert_dts
  FROM con JOIN cur ON con.c_custkey = cur.c_custkey)"""


def _country(body: str) -> str:
    return f"WITH {COUNTRY_BASE}\n{body}"


ORACLE["country_transform"] = _country("SELECT * FROM transform")
for _c in ("Africa", "Antarctica", "Asia", "Europe", "North America", "Oceania", "South America"):
    ORACLE["country_mart_" + _c.lower().replace(" ", "_")] = _country(
        f"SELECT * FROM transform WHERE upper(country_continent_name) = '{_c.upper()}'")
ORACLE["dq_unique_country_raw"] = """
SELECT CASE WHEN c_custkey % 13 <> 0 THEN c_name END AS unique_field, 2 :: BIGINT AS n_records
FROM customer WHERE c_custkey % 10 = 0"""
ORACLE["dq_unique_country_key"] = _country("""
SELECT k AS unique_field, COUNT(*) AS n_records
FROM (SELECT country_common_name || country_continent_name || country_currency_name AS k FROM transform)
WHERE k IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1""")
ORACLE["dq_not_null_country_key"] = _country("""
SELECT * FROM transform WHERE country_common_name || country_continent_name || country_currency_name IS NULL""")
ORACLE["dq_accepted_continent_asia"] = _country("""
SELECT country_continent_name AS value_field, COUNT(*) AS n_records
FROM transform WHERE upper(country_continent_name) = 'ASIA'
GROUP BY 1 HAVING country_continent_name NOT IN ('Asia')""")

# ------------------------------------------------------------ scalar functions
_VIEW_NULL = "CASE WHEN event_type = 'view' THEN NULL ELSE event_type END"
ORACLE.update({
    "fn_from_unixtime": "SELECT event_id, date_trunc('second', ts) AS time_s, date_trunc('millisecond', ts) AS time_ms FROM events",
    "fn_date_trunc": "SELECT event_id, date_trunc('hour', ts) AS hour_ts, date_trunc('day', ts) AS day_ts FROM events",
    "fn_sha2": "SELECT event_id, sha256(CAST(event_id AS VARCHAR) || '_' || event_type) AS h FROM events",
    "fn_concat_ws": f"SELECT event_id, concat_ws('_', {_VIEW_NULL}, CAST(user_id AS VARCHAR)) AS joined FROM events",
    "fn_substr": "SELECT event_id, substr(sha256(CAST(event_id AS VARCHAR) || '_' || event_type), 1, 15) AS h15 FROM events",
    "fn_round": "SELECT event_id, round(value, 1) AS r1, round(value, 0) AS r0 FROM events",
    "fn_split_part": "SELECT p_partkey, split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2, split_part(p_name, ' ', 3) AS w3 FROM part",
    "fn_datediff_year": "SELECT o_orderkey, CAST(year(DATE '2025-06-30') - year(o_orderdate) AS INTEGER) AS years FROM orders",
    "fn_datediff_day": "SELECT o_orderkey, CAST(datediff('day', CAST(o_orderdate AS DATE), DATE '2025-06-30') AS INTEGER) AS days FROM orders",
    "fn_year": "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders",
    "fn_to_char": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date_id FROM orders",
    "fn_upper": "SELECT p_partkey, upper(p_name) AS name_uc FROM part",
    "fn_coalesce_nullif_case": """SELECT o_orderkey, COALESCE(NULLIF(o_orderstatus, 'O'), 'open') AS status,
       CASE WHEN o_totalprice > 100000 THEN 'big' ELSE 'small' END AS size FROM orders""",
    "fn_concat": """SELECT c_custkey, c_name || '-' || CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment END AS joined
FROM customer""",
    "fn_arithmetic": """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net,
       l_quantity / l_linenumber AS per_line, l_linenumber / 2 AS half_line FROM lineitem""",
    "fn_variant_get": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "fn_surrogate_key": """SELECT l_orderkey, l_linenumber,
       md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' ||
           COALESCE(CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, '_dbt_utils_surrogate_key_null_')) AS sk
FROM lineitem""",
    "fn_cast_round_int": "SELECT event_id, CAST(round(value) AS INTEGER) AS v_int, CAST(user_id AS DOUBLE) AS u_dbl FROM events",
    "fn_na_to_zero": """SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'N' THEN 0.0 ELSE CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE) END AS m FROM lineitem""",
})

# ------------------------------------------------- sources, sinks and streams
ORACLE["stream_quake_bronze"] = QUAKE_FLAT
ORACLE["stream_quake_whole_files"] = QUAKE_FLAT
ORACLE["stream_quake_cdc_activity"] = ORACLE["quake_seismic_activity"]
ORACLE["stream_variant_landing"] = "SELECT event_id, user_id, event_type, value, props FROM events"
ORACLE["stream_events_dedup"] = "SELECT DISTINCT * FROM events"
ORACLE["stream_customer_scd1"] = ORACLE["customer_scd1_merge"]
ORACLE["csv_reload_visits"] = f"WITH {HEALTH_BRONZE}\nSELECT * FROM visits"
ORACLE["csv_load_products"] = f"""
SELECT product_id, product_name, category, selling_price, model_number, about_product, product_specification,
       technical_details, shipping_weight, product_dimensions, CAST(NULL AS VARCHAR) AS source_file_name
FROM ({_product_load(1)})"""
ORACLE["table_inventory_driver"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
    for t in sorted("region nation customer supplier part orders lineitem events documents "
                    "embeddings pages benchmark labels conversations".split()))
ORACLE["quake_gold_merge"] = ORACLE["quake_seismic_activity"]

# ------------------------------------------------------- small batch operators
ORACLE["lineitem_dedup_rows"] = "SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_returnflag = 'R')"
ORACLE["orders_lookup"] = "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"
ORACLE["orders_distinct_priority"] = "SELECT DISTINCT o_orderpriority FROM orders"
ORACLE["country_from_landing"] = ORACLE["country_transform"]
ORACLE["health_e4_from_csv"] = ORACLE["health_hospital_performance"]
ORACLE["product_e6_from_csv"] = ORACLE["product_versions"]
ORACLE["csv_lineage_products"] = f"""
SELECT product_id, product_name, category, selling_price, model_number, about_product, product_specification,
       technical_details, shipping_weight, product_dimensions,
       TIMESTAMP '2024-05-01 00:00:00' AS insert_dts, TIMESTAMP '2024-05-01 00:00:00' AS update_dts,
       CAST(CAST(product_id AS BIGINT) % 4 AS INTEGER) AS source_file_part,
       row_number() OVER (PARTITION BY CAST(product_id AS BIGINT) % 4 ORDER BY CAST(product_id AS BIGINT)) AS source_file_row_number
FROM ({_product_load(1)})"""
ORACLE["json_inferred_events"] = "SELECT event_id, user_id, event_type, value, props, ts FROM events"
ORACLE["json_rescued_events"] = """
SELECT event_id, user_id, event_type, CASE WHEN event_type <> 'click' THEN value END AS value,
       CASE WHEN event_type NOT IN ('view', 'click') THEN 'c' || CAST(user_id % 3 AS VARCHAR) END AS new_channel,
       CASE WHEN event_type = 'click' THEN CASE WHEN user_id % 5 = 0 THEN 'n/a' ELSE '?' END END AS odd_value
FROM events"""
ORACLE["orders_change_feed_versions"] = ORACLE["orders_change_feed_bucketed"] = ORACLE["orders_change_feed"]
ORACLE["retail_fact_history_table"] = ORACLE["retail_fact_history"]
ORACLE["country_checked_publish"] = ORACLE["country_transform"]
ORACLE["retail_checked_publish"] = _retail("""
SELECT load, check_name, failing_rows, load = 1 AS published, (SELECT count(*) FROM combined) AS stored_rows
FROM (SELECT CAST(unnest([1, 2]) AS INTEGER) AS load, count(*) FILTER (store_id IS NULL) AS store_id_present,
             count(*) FILTER (dept_id IS NULL) AS dept_id_present, count(*) FILTER (date_id IS NULL) AS date_id_present,
             count(*) FILTER (dept_id NOT BETWEEN 1 AND 7) AS dept_known FROM combined)
UNPIVOT (failing_rows FOR check_name IN (store_id_present, dept_id_present, date_id_present, dept_known))
UNION ALL
SELECT 2, 'temperature_present', count(*) FILTER (temperature IS NULL), FALSE, count(*) FROM combined""")
ORACLE["publish_kinds_orders"] = """
SELECT kind, o_orderpriority, count(*) AS n
FROM orders, (VALUES ('table'), ('view'), ('incremental')) k(kind) GROUP BY 1, 2"""
ORACLE["list_order_files"] = """
SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS folder, 1 :: BIGINT AS n_files FROM orders"""
ORACLE["stream_checkpoint_reset"] = ORACLE["events_cdc_scd1"]
ORACLE["stream_two_sources"] = ORACLE["events_cdc_scd1"]
ORACLE["stream_minute_trigger"] = "SELECT * FROM events"
ORACLE["retail_e7_from_csv"] = _retail("""
SELECT CAST(f.temperature + 1 AS DOUBLE) AS temperature, CAST(YEAR(d.store_date) AS INTEGER) AS year,
       ROUND(SUM(f.store_weekly_sales), 2) AS total_sales
FROM combined f JOIN dim_date d ON d.date_id = f.date_id
GROUP BY 1, 2""")
