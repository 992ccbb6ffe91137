"""Inputs of the registered queries, derived from whole test tables.

Each input is one SQL text in the common subset of Spark SQL and DuckDB, so both engines start from equal rows.
``{table}`` stands for a test table or another input. Faults (NULLs, bad text, bad dates) are put into rows by
expressions; no row of a table is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("customer", "orders", "lineitem", "events", "part")

INPUTS: dict[str, str] = {}

# A place per order, as delivered text. Orders of one customer are copies of one place with different names, so ids
# repeat about ten times.
INPUTS["places_text"] = """
SELECT CASE WHEN o_custkey % 53 <> 0 THEN ' c' || CAST(o_custkey AS STRING) || ' ' END AS place_id,
       CASE WHEN o_orderkey % 59 <> 0 THEN ' stop ' || o_orderpriority END AS place_name,
       o_orderstatus AS state,
       CASE WHEN o_custkey % 47 = 0 THEN 'not-a-number'
            ELSE '-' || CAST(8 + (o_custkey * 79) % 38 AS STRING) || '.' || CAST(1000 + (o_custkey * 7919) % 9000 AS STRING)
            END AS latitude,
       CAST(110 + (o_custkey * 131) % 46 AS STRING) || '.' || CAST(1000 + (o_custkey * 104729) % 9000 AS STRING) AS longitude
FROM {orders}
"""

# A point per order, already numeric.
INPUTS["points"] = """
SELECT o_orderkey AS point_id,
       CAST(-460000 + (o_orderkey * 7919) % 380000 AS DOUBLE) / 10000 AS latitude,
       CAST(1100000 + (o_orderkey * 104729) % 460000 AS DOUBLE) / 10000 AS longitude
FROM {orders}
"""

# A cell per customer, with start dates spread over 25 days.
INPUTS["cells"] = """
SELECT 'c' || CAST(c_custkey AS STRING) AS cell_key,
       CAST(-4400 + (c_custkey * 79) % 3400 AS DOUBLE) / 100 AS lat,
       CAST(11200 + (c_custkey * 131) % 4200 AS DOUBLE) / 100 AS lon,
       CASE WHEN c_nationkey < 5 THEN DATE '2023-12-05' WHEN c_nationkey < 15 THEN DATE '2024-01-01'
            ELSE DATE '2024-01-25' END AS backfill_from_date
FROM {customer}
"""

# Days stored for those cells: one row per event, so most (cell, day) pairs repeat.
INPUTS["stored_days"] = """
SELECT 'c' || CAST(user_id AS STRING) AS cell_key, CAST(ts AS DATE) AS date FROM {events}
"""

# Locations to be covered by observations: one per part, wanted from a date that depends on the part.
INPUTS["part_mapping"] = """
SELECT 'p' || CAST(p_partkey AS STRING) AS cell_key,
       CASE WHEN p_size < 10 THEN DATE '1995-01-01' WHEN p_size < 30 THEN DATE '1996-06-15'
            ELSE DATE '2001-10-01' END AS backfill_from_date
FROM {part}
"""

# Observations as text, one per line item, with every kind of fault the checks look for.
INPUTS["observations"] = """
SELECT 'p' || CAST(l_partkey AS STRING) AS cell_key,
       CASE WHEN d = 10 AND t = 8 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS date,
       CASE WHEN d = 9 AND t = 8 THEN NULL ELSE CAST(-1000 - l_partkey % 3400 AS DOUBLE) / 100 END AS lat,
       CASE WHEN d = 8 AND t = 8 THEN NULL ELSE CAST(11200 + l_partkey % 4200 AS DOUBLE) / 100 END AS lon,
       CASE WHEN d = 7 AND t = 8 THEN '' WHEN d = 6 AND t = 8 THEN NULL
            ELSE CAST(q * 30 AS STRING) END AS daily_rain,
       CASE WHEN d = 5 AND t = 8 THEN 'n/a' ELSE CAST(q + 8 AS STRING) || '.5' END AS max_temp,
       CASE WHEN d = 4 AND t = 8 THEN NULL ELSE CAST(d * 5 + t - 10 AS STRING) END AS min_temp,
       CAST(t * 5 AS STRING) AS evap_pan,
       CAST(l_linenumber * 6 AS STRING) AS radiation,
       CAST(CAST(FLOOR(l_extendedprice / 2000) AS INT) AS STRING) AS vp,
       CASE WHEN l_returnflag = 'R' AND t = 8 THEN NULL ELSE TIMESTAMP '2024-02-01 00:00:00' END AS created_at,
       CASE WHEN l_returnflag = 'A' AND t = 7 THEN TIMESTAMP '2024-01-01 00:00:00'
            WHEN l_returnflag = 'N' AND t = 7 THEN NULL ELSE TIMESTAMP '2024-03-01 00:00:00' END AS updated_at
FROM (SELECT *, CAST(ROUND(l_discount * 100) AS INT) AS d, CAST(ROUND(l_tax * 100) AS INT) AS t,
             CAST(l_quantity AS INT) AS q FROM {lineitem}) AS faulty
"""

# A stored table (everything shipped before 2000) and a delivery (everything from mid-1999 on): half a year of
# corrections overlaps, earlier rows stay, later rows are new. Together they hold every line item.
INPUTS["upsert_target"] = """
SELECT 's' || CAST(l_suppkey AS STRING) AS cell_key, CAST(l_shipdate AS DATE) AS date,
       MAX(l_quantity) AS quantity, MIN(l_returnflag) AS flag, MAX(l_linenumber) AS line_no,
       TIMESTAMP '2024-02-01 00:00:00' AS created_at, TIMESTAMP '2024-02-01 00:00:00' AS updated_at
FROM {lineitem} WHERE l_shipdate < TIMESTAMP '2000-01-01 00:00:00'
GROUP BY l_suppkey, CAST(l_shipdate AS DATE)
"""
INPUTS["upsert_source"] = """
SELECT 's' || CAST(l_suppkey AS STRING) AS cell_key, CAST(l_shipdate AS DATE) AS date,
       MAX(l_extendedprice) AS quantity, CASE WHEN MAX(l_linenumber) < 7 THEN MAX(l_linestatus) END AS flag
FROM {lineitem} WHERE l_shipdate >= TIMESTAMP '1999-07-01 00:00:00'
GROUP BY l_suppkey, CAST(l_shipdate AS DATE)
"""

# A log of fetch attempts: an order is a request, its line numbers are the attempts.
INPUTS["attempts"] = """
SELECT l_orderkey AS request, l_linenumber AS attempt,
       CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 503
            WHEN l_returnflag = 'A' THEN NULL
            WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 500
            WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 404
            ELSE 200 END AS status,
       CAST(ROUND(l_discount * 100) AS INT) < 9 AS body_ok
FROM {lineitem}
"""

# A run per day: each event is a location, tried in the order of its id.
INPUTS["run_log"] = """
SELECT CAST(ts AS DATE) AS run_day, event_id AS position, event_type <> 'error' AS succeeded FROM {events}
"""

# One CSV response per event. The event type decides its shape: comments first, columns in another order and one
# fewer, Windows line ends with quoted metadata, headers absent, or no CSV at all.
_ROW = """
       '-' || CAST(10 + user_id % 30 AS STRING) || '.2500' AS lat_text,
       '1' || CAST(20 + user_id % 30 AS STRING) || '.6000' AS lon_text,
       CAST(CAST(ts AS DATE) AS STRING) AS day_1,
       CAST(CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS DATE) AS STRING) AS day_2,
       CAST(CAST(FLOOR(value) AS INT) AS STRING) || '.0' AS rain,
       CAST(CAST(FLOOR(value) AS INT) % 50 AS STRING) || '.5' AS warm,
       CAST(CAST(FLOOR(value) AS INT) % 20 AS STRING) || '.0' AS cold,
       CAST(FLOOR(value) AS INT) % 97 = 0 AS spoilt
"""
INPUTS["response_parts"] = f"SELECT event_id, event_type, value, {_ROW} FROM {{events}}"
INPUTS["bodies"] = """
SELECT 'e' || CAST(event_id AS STRING) AS cell_key,
  CASE event_type
  WHEN 'view' THEN
    '# produced for tests' || chr(10) || chr(10) ||
    'latitude,longitude,YYYY-MM-DD,daily_rain,daily_rain_source,max_temp,min_temp,vp,radiation,metadata' || chr(10) ||
    ' ' || lat_text || ', ' || lon_text || ',' || day_1 || ',   ' || rain || ',25, ' || warm || ', ' || cold || ',9,8,' || chr(10) ||
    ' ' || lat_text || ', ' || lon_text || ',' || day_2 || ',,25, NA , ' || cold || ',9,8,x' || chr(10) ||
    ' ' || lat_text || ', ' || lon_text || ',,,,,,,,spill-over' || chr(10)
  WHEN 'click' THEN
    'YYYY-MM-DD,radiation,vp,min_temp,max_temp,daily_rain,longitude,latitude' || chr(10) ||
    day_1 || ',8,9,' || cold || ',' || warm || ',' || rain || ',' || lon_text || ',' || lat_text || chr(10) ||
    day_2 || ',8,9,' || cold || ',NA,,' || lon_text || ',' || lat_text || chr(10)
  WHEN 'purchase' THEN
    'latitude,longitude,YYYY-MM-DD,daily_rain,daily_rain_source,max_temp,min_temp,vp,radiation,metadata' || chr(13) || chr(10) ||
    lat_text || ',' || lon_text || ',' || day_1 || ',' || rain || ',25,' || warm || ',' || cold || ',9,8,"a, b"' || chr(13) || chr(10) ||
    lat_text || ',' || lon_text || ',' || CASE WHEN spoilt THEN 'someday' ELSE day_2 END || ',"",25,n/a,' || cold || ',9,8' || chr(13) || chr(10)
  WHEN 'signup' THEN
    'latitude,longitude,YYYY-MM-DD,daily_rain' || chr(10) || lat_text || ',' || lon_text || ',' || day_1 || ',' || rain || chr(10)
  ELSE CASE WHEN value < 10 THEN '' WHEN value < 20 THEN '# nothing here' || chr(10) || chr(10)
            WHEN value < 30 THEN 'YYYY-MM-DD,daily_rain,max_temp,min_temp,vp,radiation,latitude,longitude' || chr(10) || day_1 || ',1,2,3,4,5,6,7,8' || chr(10)
            WHEN value < 40 THEN 'YYYY-MM-DD,daily_rain,max_temp,min_temp,vp,radiation,latitude,longitude' || chr(10) || day_1 || ',1,2,3,4,"5,6,7' || chr(10)
            ELSE 'Sorry, your request failed.' END
  END AS body
FROM {response_parts}
"""

# Daily values per user for a load from start to end; days before the 21st come first, days from the 11th on later.
# ``fate`` is what happens when the user's location is fetched.
INPUTS["daily_values"] = """
SELECT user_id, CAST(ts AS DATE) AS day, MAX(CAST(FLOOR(value) AS INT)) AS peak, COUNT(*) AS events,
       CASE user_id % 10 WHEN 3 THEN 'silent' WHEN 4 THEN 'slow' WHEN 5 THEN 'refused' ELSE 'fine' END AS fate
FROM {events} GROUP BY user_id, CAST(ts AS DATE)
"""

# Daily totals per event type, for loads from landed files.
INPUTS["type_totals"] = """
SELECT event_type AS cell_key, CAST(ts AS DATE) AS day, MAX(CAST(FLOOR(value) AS INT)) AS peak, COUNT(*) AS events
FROM {events} GROUP BY event_type, CAST(ts AS DATE)
"""


def for_duckdb(name: str) -> str:
    """The input as a parenthesised subquery over DuckDB's registered views."""
    nested = {inner: for_duckdb(inner) for inner in INPUTS if "{" + inner + "}" in INPUTS[name]}
    return "(" + INPUTS[name].format(**{table: table for table in TABLES}, **nested) + ")"


def for_spark(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The input as a DataFrame over the parquet tables in ``folder``."""
    text = INPUTS[name]
    frames = {table: spark.read.parquet(f"{folder}/{table}.parquet") for table in TABLES if "{" + table + "}" in text}
    nested = {inner: for_spark(spark, folder, inner) for inner in INPUTS if "{" + inner + "}" in text}
    return spark.sql(text, **frames, **nested)
