"""Fixed values.

Constants, column lists and bounds whose exact value decides whether results are right. Everything here is a
default: each operator takes the value as a parameter.
"""

from __future__ import annotations

from datetime import date

# --- grid ------------------------------------------------------------------------------------------------------
GRID_RESOLUTION_DEGREES = 0.05
GRID_DECIMALS = 2
EARTH_RADIUS_KM = 6371.0088
DISTANCE_DECIMALS = 6
MIN_LATITUDE, MAX_LATITUDE = -44.0, -10.0
MIN_LONGITUDE, MAX_LONGITUDE = 112.0, 154.0
MAX_DISTANCE_KM = 5.0

# --- dates -----------------------------------------------------------------------------------------------------
BACKFILL_START = date(1990, 1, 1)
ROLLING_REFRESH_DAYS = 30
TEST_MODE_DAYS = 30
TEST_MODE_LOCATIONS = 2

# --- requests and retries ----------------------------------------------------------------------------------------
MAX_ATTEMPTS = 4
MAX_CONSECUTIVE_FAILURES = 3
REQUEST_VARIABLE_CODES = "RXNVDESCLJHGFTAPWM"
REQUIRED_RESPONSE_HEADERS = ("YYYY-MM-DD", "daily_rain", "max_temp", "min_temp", "vp", "radiation")
RESPONSE_RENAMES = {"YYYY-MM-DD": "date", "latitude": "lat", "longitude": "lon"}

# --- places ------------------------------------------------------------------------------------------------------
PLACE_COLUMNS = ("place_id", "place_name", "state", "latitude", "longitude")

# --- daily variables, in stored order; each has a companion "<name>_source" column ---------------------------------
DAILY_VARIABLES = (
    "daily_rain",
    "max_temp",
    "min_temp",
    "vp",
    "vp_deficit",
    "evap_pan",
    "evap_syn",
    "evap_comb",
    "evap_morton_lake",
    "radiation",
    "rh_tmax",
    "rh_tmin",
    "et_short_crop",
    "et_tall_crop",
    "et_morton_actual",
    "et_morton_potential",
    "et_morton_wet",
    "mslp",
)

# --- what the daily variables mean, with their units ----------------------------------------------------------------
VARIABLE_MEANINGS = {
    "daily_rain": "Rainfall of the day, in mm.",
    "max_temp": "Highest temperature of the day, in degrees Celsius.",
    "min_temp": "Lowest temperature of the day, in degrees Celsius.",
    "vp": "Vapour pressure at 9 am, in hPa.",
    "vp_deficit": "Vapour pressure deficit, in hPa.",
    "evap_pan": "Evaporation from a class A pan, in mm; counted for the day before the reading.",
    "evap_syn": "Synthetic estimate of class A pan evaporation, in mm.",
    "evap_comb": "Evaporation, in mm: synthetic before 1970, from the pan since.",
    "evap_morton_lake": "Evaporation of a shallow lake after Morton, in mm.",
    "radiation": "Total incoming shortwave radiation on a level surface, in MJ per square metre.",
    "rh_tmax": "Relative humidity at the time of the highest temperature, in percent.",
    "rh_tmin": "Relative humidity at the time of the lowest temperature, in percent.",
    "et_short_crop": "Potential evapotranspiration of a short crop (FAO56 Penman-Monteith), in mm.",
    "et_tall_crop": "Potential evapotranspiration of a tall crop (ASCE Penman-Monteith), in mm.",
    "et_morton_actual": "Actual areal evapotranspiration after Morton, in mm.",
    "et_morton_potential": "Potential point evapotranspiration after Morton, in mm.",
    "et_morton_wet": "Potential areal evapotranspiration over wet land after Morton, in mm.",
    "mslp": "Pressure at mean sea level, in hPa.",
}

# --- codes in the "<name>_source" columns ----------------------------------------------------------------------------
SOURCE_CODES = {
    0: "observed",
    15: "rain observed over more than 24 hours and split by day",
    25: "interpolated from the day's observations",
    26: "synthetic class A pan evaporation from temperature, radiation and vapour pressure",
    35: "interpolated from the day's observations by anomalies",
    42: "radiation estimated from satellite data",
    75: "interpolated from long-term averages for the day of the year",
}

# --- accepted value ranges, inclusive at both ends -----------------------------------------------------------------
VALUE_RANGES = {
    "daily_rain": (0.0, 1300.0),
    "max_temp": (-9.0, 54.0),
    "min_temp": (-20.0, 40.0),
    "evap_pan": (0.0, 35.0),
    "radiation": (0.0, 35.0),
    "vp": (0.0, 43.2),
}

# --- text that stands for "missing" in a delivered CSV field (the default list of pandas.read_csv) ------------------
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# --- report texts ----------------------------------------------------------------------------------------------------
VIOLATIONS_TEXT = "{title} — {count} violation(s) found."
FAILED_TEXT = "QA FAILED — {count} check(s) did not pass:\n\t{messages}"
PASSED_TEXT = "QA PASSED — all checks completed successfully."
