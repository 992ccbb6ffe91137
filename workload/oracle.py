"""DuckDB SQL for the registered queries, written from the rules and not from the library's plans."""

from __future__ import annotations

from pyspark.sql.types import StructType

from daygrid.contracts import MAPPING_SCHEMA, OBSERVATION_SCHEMA
from workload.inputs import for_duckdb

places_text, points, cells, stored = (for_duckdb(n) for n in ("places_text", "points", "cells", "stored_days"))
parts, observations = for_duckdb("part_mapping"), for_duckdb("observations")
target, source = for_duckdb("upsert_target"), for_duckdb("upsert_source")
attempts, run_log, bodies = for_duckdb("attempts"), for_duckdb("run_log"), for_duckdb("bodies")
response_parts, daily = for_duckdb("response_parts"), for_duckdb("daily_values")
type_totals = for_duckdb("type_totals")

ORACLE: dict[str, str] = {}


def _snap(column: str, resolution: str = "0.05") -> str:
    res = f"CAST({resolution} AS DOUBLE)"
    return f"round(round({column} / {res}, 0) * {res}, 2)"


def _distance(lat: str, lon: str, cell_lat: str, cell_lon: str) -> str:
    return (
        f"round(CAST(6371.0088 AS DOUBLE) * 2 * asin(sqrt("
        f"pow(sin((radians({cell_lat}) - radians({lat})) / 2), 2) + cos(radians({lat})) * cos(radians({cell_lat}))"
        f" * pow(sin((radians({cell_lon}) - radians({lon})) / 2), 2))), 6)"
    )


INSIDE = "cell_lat BETWEEN -44 AND -10 AND cell_lon BETWEEN 112 AND 154"

places = f"""(SELECT trim(place_id) AS place_id, trim(place_name) AS place_name, trim(state) AS state,
    TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude FROM {places_text})"""

# One complete row per id, the smallest one.
candidates = f"""(SELECT place_id, place_name, state, latitude, longitude FROM (
    SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY place_name, state, latitude, longitude) AS n
    FROM {places} WHERE place_id IS NOT NULL AND place_name IS NOT NULL AND state IS NOT NULL
      AND latitude IS NOT NULL AND longitude IS NOT NULL) WHERE n = 1)"""


def _snapped(rows: str, resolution: str = "0.05") -> str:
    return f"""(SELECT *, CAST(cell_lat AS VARCHAR) || ',' || CAST(cell_lon AS VARCHAR) AS cell_key FROM (
        SELECT *, {_snap("latitude", resolution)} AS cell_lat, {_snap("longitude", resolution)} AS cell_lon
        FROM {rows}))"""


mapping = f"""(SELECT *, {_distance("latitude", "longitude", "cell_lat", "cell_lon")} AS distance,
    DATE '1990-01-01' AS backfill_from_date FROM {_snapped(candidates)} WHERE {INSIDE})"""

ORACLE["place_cell_mapping"] = f"""SELECT place_id, place_name, state, latitude AS place_lat, longitude AS place_lon,
    cell_lat, cell_lon, cell_key, distance, CAST(backfill_from_date AS VARCHAR) AS backfill_from_date FROM {mapping}"""
ORACLE["mapping_table"] = ORACLE["place_cell_mapping"]
ORACLE["places_typed"] = f"SELECT * FROM {places}"
ORACLE["places_csv"] = ORACLE["places_typed"]
ORACLE["place_candidates"] = f"SELECT * FROM {candidates}"
ORACLE["grid_snap"] = f"SELECT point_id, cell_lat, cell_lon, cell_key FROM {_snapped(points)} WHERE {INSIDE}"
ORACLE["haversine_distance"] = f"""SELECT point_id, {_distance("latitude", "longitude", "cell_lat", "cell_lon")}
    AS distance FROM {_snapped(points)}"""
ORACLE["grid_cells"] = f"""SELECT cell_key, cell_lat AS lat, cell_lon AS lon, '1990-01-01' AS backfill_from_date
    FROM {_snapped(candidates, "2.0")} WHERE {INSIDE} GROUP BY cell_key, cell_lat, cell_lon"""

ORACLE["dq_non_empty"] = f"""SELECT '1' AS check_no, CAST(CASE WHEN n = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations,
    CASE WHEN n = 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM (SELECT count(*) AS n FROM {mapping})"""
ORACLE["dq_rows_extra"] = f"""SELECT place_id FROM {mapping} m WHERE NOT EXISTS (SELECT 1 FROM customer
    WHERE c_acctbal > 0 AND 'c' || CAST(c_custkey AS VARCHAR) = m.place_id)"""
ORACLE["dq_rows_missing"] = f"""SELECT DISTINCT place_id FROM {places} p WHERE place_id IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM {mapping} m WHERE m.place_id = p.place_id)"""
ORACLE["dq_uniqueness"] = f"""SELECT place_id, count(*) AS duplicate_count FROM {places}
    GROUP BY place_id HAVING count(*) > 1"""
ORACLE["dq_distance_threshold"] = f"SELECT place_id, cell_key, distance FROM {mapping} WHERE distance > 3.0"
INVALID = "place_id IS NULL OR place_name IS NULL OR state IS NULL OR latitude IS NULL OR longitude IS NULL"
ORACLE["dq_source_validity"] = f"SELECT * FROM {places} WHERE {INVALID}"
ORACLE["dq_grid_bounds"] = f"""SELECT place_id, cell_lat, cell_lon, cell_key FROM {_snapped(candidates)}
    WHERE NOT ({INSIDE})"""
RAW_OUTSIDE = """latitude IS NOT NULL AND longitude IS NOT NULL
    AND (latitude < -44 OR latitude > -10 OR longitude < 112 OR longitude > 154)"""
ORACLE["dq_source_bounds"] = f"SELECT place_id, place_name, latitude, longitude FROM {places} WHERE {RAW_OUTSIDE}"
ORACLE["dq_backfill_date"] = f"""SELECT place_id, CASE WHEN distance < 0.3 THEN '1990-01-02' END AS backfill_from_date
    FROM {mapping} WHERE distance > 2.9 OR distance < 0.3"""

# --- responses ---------------------------------------------------------------------------------------------------
# The first content line, found by list functions on the text itself.
ORACLE["response_validation"] = f"""
WITH headed AS (SELECT cell_key, list_filter(string_split_regex(body, '\\r\\n|\\r|\\n'),
        lambda line: NOT regexp_matches(line, '^\\s*(#.*)?$'))[1] AS header FROM {bodies}),
named AS (SELECT *, list_transform(string_split(header, ','), lambda name: trim(name)) AS names FROM headed)
SELECT cell_key, CASE WHEN header IS NULL THEN 'no content'
    WHEN NOT list_has_all(names, ['YYYY-MM-DD', 'daily_rain', 'max_temp', 'min_temp', 'vp', 'radiation'])
    THEN 'required headers absent' ELSE 'ok' END AS verdict FROM named"""

# The rows each kind of response should give, straight from the events.
_KEY = "'e' || CAST(event_id AS VARCHAR) AS cell_key"
_PLACE = "CAST(lat_text AS DOUBLE) AS lat, CAST(lon_text AS DOUBLE) AS lon"
_SOURCE = "CASE WHEN event_type <> 'click' THEN '25' END AS daily_rain_source"
ORACLE["obs_normalised"] = f"""
SELECT {_KEY}, CAST(NULL AS VARCHAR) AS problem, {_PLACE}, day_1 AS date, rain AS daily_rain, {_SOURCE},
    warm AS max_temp, cold AS min_temp, '9' AS vp, '8' AS radiation
FROM {response_parts} WHERE event_type IN ('view', 'click', 'purchase')
UNION ALL
SELECT {_KEY}, CASE WHEN event_type = 'purchase' AND spoilt THEN 'unreadable date' END, {_PLACE},
    CASE WHEN NOT (event_type = 'purchase' AND spoilt) THEN day_2 END, NULL, {_SOURCE},
    CASE WHEN event_type = 'view' THEN 'NA ' END, cold, '9', '8'
FROM {response_parts} WHERE event_type IN ('view', 'click', 'purchase')
UNION ALL
SELECT {_KEY}, CASE WHEN event_type = 'signup' THEN 'required headers absent' WHEN value < 20 THEN 'no content'
        WHEN value < 30 THEN 'a line has more fields than the header' WHEN value < 40 THEN 'a line has an unpaired quote'
        ELSE 'required headers absent' END,
    NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM {response_parts} WHERE event_type IN ('signup', 'error')"""

ORACLE["landed_files"] = f"""SELECT event_type AS cell_key, CAST(NULL AS VARCHAR) AS problem, {_PLACE}, day_1 AS date,
    rain AS daily_rain, warm AS max_temp, CASE WHEN NOT spoilt THEN cold END AS min_temp,
    CAST(event_id AS VARCHAR) AS vp, '8' AS radiation FROM {response_parts}"""
ORACLE["landed_files_by_line"] = ORACLE["landed_files"]
ORACLE["landed_line_breaks"] = f"""SELECT event_type AS cell_key, CAST(NULL AS VARCHAR) AS problem, {_PLACE}, day_1 AS date,
    CASE WHEN event_id % 3 = 0 THEN 'so "noted",' || chr(10) || 'and # again ' || CAST(event_id AS VARCHAR) || chr(10) || chr(10) || 'end'
         ELSE rain END AS daily_rain,
    warm AS max_temp, cold AS min_temp, CAST(event_id AS VARCHAR) AS vp, '8' AS radiation FROM {response_parts}"""
ORACLE["landed_line_breaks_by_line"] = ORACLE["landed_line_breaks"]

# --- gaps: the plain definition, a row per key and day ---------------------------------------------------------------
missing = f"""(SELECT cell_key, date FROM (
    SELECT cell_key, CAST(unnest(generate_series(backfill_from_date, DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS date
    FROM {cells}) spine WHERE NOT EXISTS (SELECT 1 FROM {stored} s WHERE s.cell_key = spine.cell_key AND s.date = spine.date))"""
ORACLE["missing_days"] = f"SELECT cell_key, CAST(date AS VARCHAR) AS date FROM {missing}"
ORACLE["missing_days_spine"] = ORACLE["missing_days"]
ORACLE["first_missing_date"] = f"""SELECT cell_key, CAST(min(date) AS VARCHAR) AS first_missing_date
    FROM {missing} GROUP BY cell_key"""
ORACLE["first_missing_date_window"] = ORACLE["first_missing_date"]
ORACLE["first_missing_date_spine"] = ORACLE["first_missing_date"]


def _ranges(some_cells: str, capped: bool = False) -> str:
    start = "least(coalesce(first_missing, DATE '2024-01-20'), DATE '2024-01-20')"
    if capped:
        start = f"greatest({start}, DATE '2024-01-10')"
    return f"""(SELECT c.cell_key, lat, lon, backfill_from_date, {start} AS fetch_start,
        {start} < DATE '2024-01-20' AS needs_backfill FROM {some_cells} c
        LEFT JOIN (SELECT cell_key, min(date) AS first_missing FROM {missing} GROUP BY cell_key) m
        ON m.cell_key = c.cell_key)"""


_RANGE_COLUMNS = """cell_key, lat, lon, CAST(backfill_from_date AS VARCHAR) AS backfill_from_date,
    CAST(fetch_start AS VARCHAR) AS fetch_start, needs_backfill"""
ORACLE["fetch_ranges"] = f"SELECT {_RANGE_COLUMNS} FROM {_ranges(cells)}"
ORACLE["fetch_ranges_test_mode"] = f"""SELECT {_RANGE_COLUMNS}
    FROM {_ranges(f"(SELECT * FROM {cells} ORDER BY cell_key LIMIT 2)", capped=True)}"""
ORACLE["fetch_requests"] = f"""SELECT cell_key, printf('%.2f', lat) AS lat, printf('%.2f', lon) AS lon,
    strftime(fetch_start, '%Y%m%d') AS start, '20240130' AS finish, 'csv' AS format, 'RXNVDESCLJHGFTAPWM' AS comment
    FROM {_ranges(cells)}"""
ORACLE["backfill_summary"] = f"""SELECT count(*) AS locations,
    CAST(sum(CASE WHEN needs_backfill THEN 1 ELSE 0 END) AS BIGINT) AS need_backfill FROM {_ranges(cells)}"""

# --- upsert ------------------------------------------------------------------------------------------------------
ORACLE["obs_upsert"] = f"""
SELECT t.cell_key, CAST(t.date AS VARCHAR) AS date, CASE WHEN s.cell_key IS NULL THEN t.quantity ELSE s.quantity END
    AS quantity, CASE WHEN s.cell_key IS NULL THEN t.flag ELSE s.flag END AS flag, t.line_no,
    CAST(t.created_at AS VARCHAR) AS created_at,
    CASE WHEN s.cell_key IS NULL THEN CAST(t.updated_at AS VARCHAR) ELSE '2024-03-01 00:00:00' END AS updated_at
FROM {target} t LEFT JOIN {source} s ON s.cell_key = t.cell_key AND s.date = t.date
UNION ALL
SELECT s.cell_key, CAST(s.date AS VARCHAR), s.quantity, s.flag, NULL, '2024-03-01 00:00:00', '2024-03-01 00:00:00'
FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE s.cell_key = t.cell_key AND s.date = t.date)"""
ORACLE["obs_upsert_table"] = ORACLE["obs_upsert"]
ORACLE["backfill_by_bucket"] = ORACLE["obs_upsert"]
ORACLE["obs_upsert_rerun"] = f"""SELECT u.* REPLACE (CASE WHEN updated_at = '2024-03-01 00:00:00'
    THEN '2024-03-02 00:00:00' ELSE updated_at END AS updated_at) FROM ({ORACLE["obs_upsert"]}) u"""

_GATED = ("cell_key", "date", "lat", "lon", "created_at", "updated_at")
ORACLE["not_null_gate"] = " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, count(*) - count({name}) AS null_count FROM {observations}" for name in _GATED
)

# Locations that are never answered or refused load nothing; the rest load whatever the day delivers.
_loaded = "fate NOT IN ('silent', 'refused')"
_first, _second = "day < DATE '2024-01-21'", "day >= DATE '2024-01-11'"
_load_columns = """'u' || CAST(user_id AS VARCHAR) AS cell_key, CAST(day AS VARCHAR) AS date,
    CAST('-' || CAST(10 + user_id % 30 AS VARCHAR) || '.25' AS DOUBLE) AS lat,
    CAST(CAST(120 + user_id % 30 AS VARCHAR) || '.6' AS DOUBLE) AS lon"""
ORACLE["daily_load"] = f"""SELECT {_load_columns},
    CAST(CASE WHEN {_second} THEN events ELSE peak END AS VARCHAR) AS daily_rain,
    CAST(CASE WHEN {_second} THEN events ELSE peak END % 40 AS VARCHAR) || '.5' AS max_temp,
    CASE WHEN {_first} THEN '1010' END AS mslp,
    CASE WHEN {_first} THEN '2024-02-01 00:00:00' ELSE '2024-03-01 00:00:00' END AS created_at,
    CASE WHEN {_second} THEN '2024-03-01 00:00:00' ELSE '2024-02-01 00:00:00' END AS updated_at
FROM {daily} WHERE {_loaded}"""

ORACLE["streamed_attempts"] = f"""SELECT {_load_columns}, CAST(peak AS VARCHAR) AS daily_rain,
    CAST(peak % 40 AS VARCHAR) || '.5' AS max_temp, '1010' AS mslp FROM {daily} WHERE {_loaded}"""

ORACLE["load_summary"] = f"""
WITH users AS (SELECT user_id, bool_or({_loaded}) AS good, count(*) AS days FROM {daily} GROUP BY user_id)
SELECT n AS unanswered, n + (SELECT count(*) FROM users) AS locations,
    n + (SELECT count(*) FROM users WHERE NOT good) AS failed_locations,
    CAST((SELECT coalesce(sum(days), 0) FROM users WHERE good) AS BIGINT) AS rows_upserted
FROM (SELECT count(*) AS n FROM nation)"""

ORACLE["landed_load"] = f"""SELECT cell_key, CAST(day AS VARCHAR) AS date, -32.25::DOUBLE AS lat, 148.6::DOUBLE AS lon,
    CAST(CASE WHEN {_second} THEN events ELSE peak END AS VARCHAR) AS daily_rain,
    CAST(CASE WHEN {_second} THEN events ELSE peak END % 40 AS VARCHAR) || '.5' AS max_temp,
    CAST(NULL AS VARCHAR) AS mslp FROM {type_totals}"""
ORACLE["streamed_load"] = ORACLE["landed_load"]

# --- checks on observations ------------------------------------------------------------------------------------------
uncovered = "SELECT cell_key FROM {mapped} m WHERE NOT EXISTS (SELECT 1 FROM {rows} r WHERE r.cell_key = m.cell_key)"
ORACLE["dq_coverage"] = "SELECT DISTINCT cell_key FROM (" + uncovered.format(mapped=cells, rows=stored) + ")"
part_missing = f"""(SELECT cell_key, date FROM (
    SELECT cell_key, CAST(unnest(generate_series(backfill_from_date, DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS date
    FROM {parts}) spine
    WHERE NOT EXISTS (SELECT 1 FROM {observations} o WHERE o.cell_key = spine.cell_key AND o.date = spine.date))"""
part_gaps = f"""(SELECT cell_key, count(*) AS missing_date_count, CAST(min(date) AS VARCHAR) AS earliest_gap,
    CAST(max(date) AS VARCHAR) AS latest_gap FROM {part_missing} GROUP BY cell_key)"""
ORACLE["dq_date_completeness"] = f"SELECT * FROM {part_gaps}"

# Runs of consecutive missing days: a day less its rank is the same for all days of a run.
ORACLE["gap_intervals"] = f"""SELECT cell_key, CAST(min(date) AS VARCHAR) AS gap_start, CAST(max(date) AS VARCHAR) AS gap_end
    FROM (SELECT cell_key, date, date - CAST(row_number() OVER (PARTITION BY cell_key ORDER BY date) AS INTEGER) AS run
          FROM {part_missing}) GROUP BY cell_key, run"""

# --- the stored index of days ----------------------------------------------------------------------------------------
ORACLE["first_missing_date_indexed"] = ORACLE["first_missing_date"]
ORACLE["fetch_ranges_indexed"] = ORACLE["fetch_ranges"]
_left = f"""(SELECT cell_key, date FROM (SELECT cell_key, date FROM {target} UNION SELECT cell_key, date FROM {source})
    WHERE year(date) <> 1996 AND NOT (year(date) = 1998 AND (date - DATE '1998-01-01') % 7 = 3))"""
ORACLE["gap_report_indexed"] = f"""SELECT cell_key, count(*) AS missing_date_count, CAST(min(day) AS VARCHAR) AS earliest_gap,
        CAST(max(day) AS VARCHAR) AS latest_gap
    FROM (SELECT DISTINCT cell_key FROM {target}),
        (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS day)
    WHERE (cell_key, day) NOT IN (SELECT (cell_key, date) FROM {_left}) GROUP BY cell_key"""
ORACLE["index_differences"] = f"SELECT count(*) AS days, CAST(0 AS BIGINT) AS differ FROM {_left}"

_BOUNDS = {
    "daily_rain": (0, 1300),
    "max_temp": (-9, 54),
    "min_temp": (-20, 40),
    "evap_pan": (0, 35),
    "radiation": (0, 35),
    "vp": (0, 43.2),
}
_number = "TRY_CAST({} AS DOUBLE)".format
_RANGES = {f"{c}_out_of_range": f"{_number(c)} NOT BETWEEN {lo} AND {hi}" for c, (lo, hi) in _BOUNDS.items()}
_RANGES["max_temp_less_than_min_temp"] = f"{_number('max_temp')} < {_number('min_temp')}"
_UNREADABLE = {f"unparseable_{c}": f"{c} IS NOT NULL AND {_number(c)} IS NULL" for c in _BOUNDS}
_NULLS = {f"null_or_empty_{c}": f"{c} IS NULL OR {c} = ''" for c in ("cell_key", "daily_rain", "max_temp", "min_temp")}
_NULLS |= {f"null_{c}": f"{c} IS NULL" for c in ("date", "lat", "lon")}
_TIMES = {f"null_{c}": f"{c} IS NULL" for c in ("created_at", "updated_at")}
_TIMES["created_at_after_updated_at"] = "created_at > updated_at"


def _per_key(counts: dict[str, str]) -> str:
    sums = ", ".join(
        f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT) AS {name}" for name, condition in counts.items()
    )
    return f"""SELECT cell_key, {sums} FROM {observations} GROUP BY cell_key
        HAVING {" OR ".join(f"{name} > 0" for name in counts)}"""


ORACLE["dq_value_ranges"] = _per_key(_RANGES)
ORACLE["dq_unparseable_values"] = _per_key(_UNREADABLE)
ORACLE["dq_null_keys"] = _per_key(_NULLS)
ORACLE["dq_timestamps"] = _per_key(_TIMES)


ORACLE["dq_farthest_places"] = ORACLE["dq_distance_threshold"] + " ORDER BY distance DESC, place_id LIMIT 20"
ORACLE["dq_widest_gaps"] = ORACLE["dq_date_completeness"] + " ORDER BY missing_date_count DESC, cell_key LIMIT 20"

# Types as this engine names them.
_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "timestamp": "TIMESTAMP", "array<double>": "DOUBLE[]"}


def _misfits(rows: str, contract: StructType) -> str:
    """Positions where the engine's own description of ``rows`` and the contract differ in name or type."""
    wanted = ", ".join(
        f"({i}, '{field.name}', '{_TYPES[field.dataType.simpleString()]}')" for i, field in enumerate(contract.fields, 1)
    )
    return f"""SELECT 1 FROM (SELECT row_number() OVER () AS i, column_name, column_type
            FROM (DESCRIBE SELECT * FROM {rows})) found
        FULL JOIN (VALUES {wanted}) wanted(i, name, kind) ON wanted.i = found.i
        WHERE (column_name, column_type) IS DISTINCT FROM (name, kind)"""


def _report(counted: dict[str, str]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{number}' AS check_no, CAST(count(*) AS BIGINT) AS violations FROM ({violations})"
        for number, violations in counted.items()
    )
    return f"SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({rows})"


ORACLE["dq_report_mapping"] = _report(
    {
        "1": f"SELECT 1 FROM (SELECT count(*) AS n FROM {mapping}) WHERE n = 0",
        "1a": f"SELECT 1 FROM {mapping} m WHERE NOT EXISTS (SELECT 1 FROM {places} p WHERE p.place_id = m.place_id)",
        "1b": ORACLE["dq_rows_missing"],
        "2": _misfits(
            f"""(SELECT place_id, place_name, state, [latitude, longitude] AS place_latlon,
                [cell_lat, cell_lon] AS cell_latlon, cell_key, distance, backfill_from_date FROM {mapping})""",
            MAPPING_SCHEMA,
        ),
        "3": f"SELECT place_id FROM {mapping} GROUP BY place_id HAVING count(*) > 1",
        "4": ORACLE["dq_distance_threshold"],
        "5": ORACLE["dq_source_validity"],
        "6": f"SELECT 1 FROM {mapping} WHERE NOT ({INSIDE})",
        "7": ORACLE["dq_source_bounds"],
        "8": f"SELECT 1 FROM {mapping} WHERE backfill_from_date IS DISTINCT FROM DATE '1990-01-01'",
    }
)
ORACLE["dq_report_load"] = _report(
    {
        "1": uncovered.format(mapped=parts, rows=observations),
        "2": _misfits(observations, OBSERVATION_SCHEMA),
        "3": f"SELECT 1 FROM {part_gaps}",
        "4": ORACLE["dq_value_ranges"],
        "4a": ORACLE["dq_unparseable_values"],
        "5": ORACLE["dq_null_keys"],
        "6": ORACLE["dq_timestamps"],
    }
)

# --- outcomes ----------------------------------------------------------------------------------------------------
outcome = f"""(
WITH numbered AS (SELECT *, row_number() OVER (PARTITION BY request ORDER BY attempt, status, body_ok) AS n
    FROM {attempts} WHERE attempt <= 4 AND (status = 200 OR status BETWEEN 400 AND 499)),
deciding AS (SELECT * FROM numbered WHERE n = 1),
lasting AS (SELECT request, attempt, max(coalesce(status, 0)) AS status FROM {attempts} a WHERE attempt =
    (SELECT max(attempt) FROM {attempts} b WHERE b.request = a.request AND b.attempt <= 4) GROUP BY request, attempt),
asked AS (SELECT request, count(*) AS lines FROM {attempts} GROUP BY request)
SELECT asked.request, lines,
    CASE WHEN d.request IS NULL THEN CASE WHEN l.attempt = 4 THEN 'exhausted' ELSE 'pending' END
         WHEN d.status <> 200 THEN 'client_error' WHEN d.body_ok THEN 'accepted' ELSE 'invalid_body' END AS outcome,
    CAST(coalesce(d.attempt, l.attempt) AS BIGINT) AS attempts_used,
    CAST(CASE WHEN d.request IS NULL THEN nullif(l.status, 0) ELSE d.status END AS BIGINT) AS last_status
FROM asked LEFT JOIN deciding d ON d.request = asked.request LEFT JOIN lasting l ON l.request = asked.request)"""
ORACLE["fetch_outcomes"] = f"SELECT request, outcome, attempts_used, last_status FROM {outcome}"
ORACLE["run_summary"] = f"""SELECT count(*) AS locations,
    CAST(sum(CASE WHEN outcome <> 'accepted' THEN 1 ELSE 0 END) AS BIGINT) AS failed_locations,
    CAST(sum(CASE WHEN outcome = 'accepted' THEN lines ELSE 0 END) AS BIGINT) AS rows_upserted FROM {outcome}"""


def _cutoff(run: str, threshold: int) -> str:
    """Row by row: a run stops where it and the rows before it all failed."""
    over = f"({'PARTITION BY ' + run if run else ''} ORDER BY position"
    previous = " AND ".join(
        ["NOT succeeded"] + [f"NOT lag(succeeded, {n}, true) OVER {over})" for n in range(1, threshold)]
    )
    keys = f"CAST({run} AS VARCHAR) AS {run}, " if run else ""
    return f"""
WITH marked AS (SELECT *, row_number() OVER {over}) AS n, {previous} AS stops,
    sum(CASE WHEN succeeded THEN 0 ELSE 1 END) OVER {over} ROWS UNBOUNDED PRECEDING) AS fails FROM {run_log})
SELECT {keys}min(CASE WHEN stops THEN position END) AS stopped_at,
    CAST(coalesce(min(CASE WHEN stops THEN n END), count(*)) AS BIGINT) AS attempted,
    CAST(coalesce(min(CASE WHEN stops THEN fails END), max(fails)) AS BIGINT) AS failed,
    count(*) AS locations FROM marked {'GROUP BY ' + run if run else ''}"""


ORACLE["failure_cutoff"] = _cutoff("run_day", 3)
ORACLE["failure_cutoff_one_run"] = _cutoff("", 5)

ORACLE["failure_cutoff_sparse"] = ORACLE["failure_cutoff"]
