"""The registered queries: name -> (spark, folder) -> DataFrame.

Dates and timestamps are given out as ISO text and arrays as their elements, so that any engine's result compares.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.contracts import create_table, null_counts
from daygrid.functions.geo import Grid, great_circle_km
from daygrid.operators import checks, gaps, mapping, outcomes
from daygrid.operators.day_index import DayIndex
from daygrid.operators.layout import PartitionBy
from daygrid.operators.upsert import KEYS, replace_partitions, upsert, upsert_table
from daygrid.plans import load_job, quality
from daygrid.plans.mapping_job import build_mapping_table
from daygrid.session import new_work_folder
from daygrid.sources import responses
from daygrid.sources.places import read_places, type_places
from daygrid.streaming.attempts import load_attempt_log
from daygrid.streaming.landing import load_landing_folder
from workload.inputs import for_spark

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_DATE = date(2024, 1, 30)
REFRESH_DAYS = 10
FIRST_DAY, LAST_DAY = date(1995, 1, 1), date(2001, 12, 31)
FIRST_RUN, SECOND_RUN, THIRD_RUN = "2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-03-02 00:00:00"
NEAR_KM = 3.0
COARSE = Grid(resolution=2.0)


def query(run: Query) -> Query:
    def portable(spark: SparkSession, folder: str) -> DataFrame:
        df = run(spark, folder)
        shown = []
        for field in df.schema.fields:
            column = F.col(field.name)
            shown.append(column.cast("string") if field.dataType.typeName() in ("date", "timestamp") else column)
        return df.select(*[column.alias(name) for column, name in zip(shown, df.columns, strict=True)])

    QUERIES[run.__name__] = portable
    return run


def _at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _by_year() -> dict[str, Column]:
    return {"year": F.date_format("date", "yyyy")}


def _places(spark: SparkSession, folder: str) -> DataFrame:
    return type_places(for_spark(spark, folder, "places_text"))


def _mapping(spark: SparkSession, folder: str, grid: Grid = Grid()) -> DataFrame:
    return mapping.place_cell_mapping(_places(spark, folder), grid)


def _flat(df: DataFrame) -> DataFrame:
    """Arrays of coordinates as two columns each."""
    for name, prefix in (("place_latlon", "place"), ("cell_latlon", "cell")):
        if name in df.columns:
            parts = {f"{prefix}_lat": F.get(name, F.lit(0)), f"{prefix}_lon": F.get(name, F.lit(1))}
            df = df.withColumns(parts).drop(name)
    return df


# --- places and grid ---------------------------------------------------------------------------------------------


@query
def place_cell_mapping(spark, folder):
    return _flat(_mapping(spark, folder))


@query
def places_typed(spark, folder):
    return _places(spark, folder)


def _places_as_csv(spark: SparkSession, folder: str) -> str:
    """The places as CSV files: other column order, one column too many, padded fields."""
    path = new_work_folder(spark, "places")
    text = for_spark(spark, folder, "places_text").withColumn("note", F.lit("a, b"))
    shuffled = text.select("longitude", "note", "state", "place_name", "latitude", "place_id")
    shuffled.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return path


@query
def places_csv(spark, folder):
    return read_places(spark, _places_as_csv(spark, folder))


@query
def place_candidates(spark, folder):
    return mapping.place_candidates(_places(spark, folder))


@query
def grid_snap(spark, folder):
    snapped = mapping.snap_to_cells(for_spark(spark, folder, "points"))
    return snapped.select("point_id", "cell_lat", "cell_lon", "cell_key")


@query
def haversine_distance(spark, folder):
    grid = Grid()
    lat, lon = F.col("latitude"), F.col("longitude")
    distance = great_circle_km(lat, lon, grid.snap(lat), grid.snap(lon))
    return for_spark(spark, folder, "points").select("point_id", distance.alias("distance"))


@query
def grid_cells(spark, folder):
    return mapping.grid_cells(_mapping(spark, folder, COARSE))


@query
def mapping_table(spark, folder):
    """The whole mapping job: places from CSV files to a stored table with comments."""
    table = f"mapping_{uuid.uuid4().hex}"
    build_mapping_table(spark, _places_as_csv(spark, folder), table, location=new_work_folder(spark, "table"))
    return _flat(spark.table(table))


# --- checks on places and mapping ----------------------------------------------------------------------------------


@query
def dq_non_empty(spark, folder):
    first = quality.mapping_suite(spark, _mapping(spark, folder), _places(spark, folder))[0]
    return quality.report([first]).select("check_no", "violations", "status")


@query
def dq_rows_extra(spark, folder):
    """Mapped places that a list of customers in credit does not have."""
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    in_credit = customers.where("c_acctbal > 0").select(F.concat(F.lit("c"), "c_custkey").alias("place_id"))
    return checks.extra_ids(_mapping(spark, folder), in_credit)


@query
def dq_rows_missing(spark, folder):
    return checks.missing_ids(_mapping(spark, folder), _places(spark, folder))


@query
def dq_uniqueness(spark, folder):
    return checks.duplicate_ids(_places(spark, folder))


@query
def dq_distance_threshold(spark, folder):
    return _flat(_mapping(spark, folder).where(checks.too_far(NEAR_KM))).select("place_id", "cell_key", "distance")


@query
def dq_source_validity(spark, folder):
    return _places(spark, folder).where(checks.incomplete())


@query
def dq_grid_bounds(spark, folder):
    candidates = mapping.place_candidates(_places(spark, folder))
    snapped = mapping.snap_to_cells(candidates, keep_outside=True)
    return snapped.where(checks.cell_outside()).select("place_id", "cell_lat", "cell_lon", "cell_key")


@query
def dq_source_bounds(spark, folder):
    outside = _places(spark, folder).where(checks.place_outside())
    return outside.select("place_id", "place_name", "latitude", "longitude")


@query
def dq_backfill_date(spark, folder):
    """A mapping whose start dates were altered for the nearest and the farthest places."""
    start = F.col("backfill_from_date")
    altered = F.when(F.col("distance") > 2.9, None).when(F.col("distance") < 0.3, F.date_add(start, 1)).otherwise(start)
    rows = _mapping(spark, folder).withColumn("backfill_from_date", altered)
    return rows.where(checks.wrong_date()).select("place_id", "backfill_from_date")


# --- responses ---------------------------------------------------------------------------------------------------

BODY_COLUMNS = (
    "latitude",
    "longitude",
    "YYYY-MM-DD",
    "daily_rain",
    "daily_rain_source",
    "max_temp",
    "min_temp",
    "vp",
    "radiation",
)


@query
def response_validation(spark, folder):
    judged = responses.judge_bodies(for_spark(spark, folder, "bodies"))
    return judged.select("cell_key", F.coalesce("problem", F.lit("ok")).alias("verdict"))


@query
def obs_normalised(spark, folder):
    records = responses.split_bodies(for_spark(spark, folder, "bodies"), BODY_COLUMNS)
    return responses.normalise(records, BODY_COLUMNS).drop("absent")


def _landed(spark: SparkSession, folder: str, whole_file_bytes: int) -> DataFrame:
    """Events landed as CSV files per type, written with two column orders, and read back."""
    path = new_work_folder(spark, "landed")
    parts = for_spark(spark, folder, "response_parts")
    rows = parts.select(
        F.col("event_type").alias("cell_key"),
        F.col("lat_text").alias("latitude"),
        F.col("lon_text").alias("longitude"),
        F.col("day_1").alias("YYYY-MM-DD"),
        F.col("rain").alias("daily_rain"),
        F.col("warm").alias("max_temp"),
        F.when(~F.col("spoilt"), F.col("cold")).alias("min_temp"),
        F.col("event_id").cast("string").alias("vp"),
        F.lit("8").alias("radiation"),
    )
    columns = rows.columns[1:]
    human = F.col("cell_key").isin("view", "click", "purchase")
    for these, order in ((rows.where(human), columns), (rows.where(~human), columns[::-1])):
        (
            these.select("cell_key", *order)
            .write.mode("append")
            .options(header=True, ignoreLeadingWhiteSpace=False)
            .partitionBy("cell_key")
            .csv(path)
        )
    wanted = [name for name in BODY_COLUMNS if name != "daily_rain_source"]
    records = responses.read_landed(spark, path, wanted, whole_file_bytes=whole_file_bytes)
    return responses.normalise(records, wanted).drop("absent", "landed")


@query
def landed_files(spark, folder):
    return _landed(spark, folder, responses.WHOLE_FILE_BYTES)


@query
def landed_files_by_line(spark, folder):
    """The reader for files too large to hold in one row, here used for all of them."""
    return _landed(spark, folder, 0)


def _landed_notes(spark: SparkSession, folder: str, whole_file_bytes: int) -> DataFrame:
    """Events landed as CSV files per type; every third has a field of two lines, with quotes and a comma in it."""
    path = new_work_folder(spark, "landed")
    parts = for_spark(spark, folder, "response_parts")
    note = F.concat(F.lit('so "noted",\nand # again '), F.col("event_id").cast("string"), F.lit("\n\nend"))
    rows = parts.select(
        F.col("event_type").alias("cell_key"),
        F.col("lat_text").alias("latitude"),
        F.col("lon_text").alias("longitude"),
        F.col("day_1").alias("YYYY-MM-DD"),
        F.when(F.col("event_id") % 3 == 0, note).otherwise(F.col("rain")).alias("daily_rain"),
        F.col("warm").alias("max_temp"),
        F.col("cold").alias("min_temp"),
        F.col("event_id").cast("string").alias("vp"),
        F.lit("8").alias("radiation"),
        F.when(F.col("event_id") % 5 == 0, F.lit('"\n')).alias("metadata"),
    )
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}
    rows.write.options(**options).partitionBy("cell_key").csv(path)
    wanted = [name for name in BODY_COLUMNS if name != "daily_rain_source"]
    records = responses.read_landed(spark, path, wanted, whole_file_bytes=whole_file_bytes)
    return responses.normalise(records, wanted).drop("absent", "landed")


@query
def landed_line_breaks(spark, folder):
    return _landed_notes(spark, folder, responses.WHOLE_FILE_BYTES)


@query
def landed_line_breaks_by_line(spark, folder):
    """The same for files too large for one row: records are put together across lines and blocks of a file."""
    return _landed_notes(spark, folder, 0)


# --- gaps and fetch planning -----------------------------------------------------------------------------------------


def _cells_and_stored(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return for_spark(spark, folder, "cells"), for_spark(spark, folder, "stored_days")


def _cell_ranges(cells: DataFrame) -> DataFrame:
    return gaps.key_ranges(cells, RUN_DATE)


@query
def missing_days(spark, folder):
    cells, stored = _cells_and_stored(spark, folder)
    return gaps.missing_days(_cell_ranges(cells), stored)


@query
def missing_days_spine(spark, folder):
    cells, stored = _cells_and_stored(spark, folder)
    return gaps.missing_days_by_spine(_cell_ranges(cells), stored)


@query
def first_missing_date(spark, folder):
    cells, stored = _cells_and_stored(spark, folder)
    return gaps.first_missing_date(_cell_ranges(cells), stored)


@query
def first_missing_date_window(spark, folder):
    cells, stored = _cells_and_stored(spark, folder)
    return gaps.first_missing_date_by_window(_cell_ranges(cells), stored)


@query
def first_missing_date_spine(spark, folder):
    cells, stored = _cells_and_stored(spark, folder)
    return gaps.first_missing_date_by_spine(_cell_ranges(cells), stored)


def _fetch_ranges(spark: SparkSession, folder: str) -> DataFrame:
    cells, stored = _cells_and_stored(spark, folder)
    return gaps.fetch_ranges(cells, stored, RUN_DATE, REFRESH_DAYS)


@query
def fetch_ranges(spark, folder):
    return _fetch_ranges(spark, folder)


@query
def fetch_ranges_test_mode(spark, folder):
    cells, stored = _cells_and_stored(spark, folder)
    return gaps.fetch_ranges(gaps.trial_slice(cells), stored, RUN_DATE, REFRESH_DAYS, cap_days=20)


@query
def fetch_requests(spark, folder):
    return gaps.fetch_requests(_fetch_ranges(spark, folder), RUN_DATE)


@query
def backfill_summary(spark, folder):
    return gaps.backfill_summary(_fetch_ranges(spark, folder))


@query
def gap_intervals(spark, folder):
    """Every run of missing days of the parts, from its first to its last day."""
    parts, rows = for_spark(spark, folder, "part_mapping"), for_spark(spark, folder, "observations")
    return gaps.gap_intervals(gaps.missing_blocks(gaps.key_ranges(parts, LAST_DAY), rows))


# --- gaps from the stored index of days --------------------------------------------------------------------------------


def _indexed_days(spark: SparkSession, folder: str) -> DayIndex:
    """The stored days loaded into a table in two overlapping deliveries; the index sees the deliveries alone."""
    days = for_spark(spark, folder, "stored_days").distinct()
    layout, name = PartitionBy.month(), uuid.uuid4().hex
    index = DayIndex(f"days_{name}", layout)
    create_table(spark, f"rows_{name}", days.schema, partition_by=layout.schema, location=new_work_folder(spark, "table"))
    index.create(spark, new_work_folder(spark, "table"))
    for part in (days.where(F.col("date") < date(2024, 1, 21)), days.where(F.col("date") >= date(2024, 1, 11))):
        upsert_table(spark, part, f"rows_{name}", partition_by=layout, index=index)
    return index


@query
def first_missing_date_indexed(spark, folder):
    cells = for_spark(spark, folder, "cells")
    return _indexed_days(spark, folder).first_missing_date(_cell_ranges(cells))


@query
def fetch_ranges_indexed(spark, folder):
    cells = for_spark(spark, folder, "cells")
    return _indexed_days(spark, folder).fetch_ranges(cells, RUN_DATE, REFRESH_DAYS)


def _rewritten(spark: SparkSession, folder: str) -> tuple[DayIndex, DataFrame]:
    """Two upserts, then a year rewritten without its every seventh day and one without any rows; the index and the table."""
    target, source = for_spark(spark, folder, "upsert_target"), for_spark(spark, folder, "upsert_source")
    layout, name = PartitionBy(_by_year()), uuid.uuid4().hex
    index, table = DayIndex(f"days_{name}", layout), f"rows_{name}"
    create_table(spark, table, target.schema, partition_by=layout.schema, location=new_work_folder(spark, "table"))
    index.create(spark, new_work_folder(spark, "table"))
    upsert_table(spark, target, table, run_ts=_at(FIRST_RUN), partition_by=layout, index=index)
    upsert_table(spark, source, table, run_ts=_at(SECOND_RUN), partition_by=layout, index=index)
    kept = F.pmod(F.datediff("date", F.lit(date(1998, 1, 1))), F.lit(7)) != 3
    left = spark.table(table).where(F.col("year") == "1998").where(kept).drop("year")
    replace_partitions(spark, left, table, also=[("1996",)], partition_by=layout, index=index)
    return index, spark.table(table)


@query
def gap_report_indexed(spark, folder):
    index, table = _rewritten(spark, folder)
    suppliers = for_spark(spark, folder, "upsert_target").select("cell_key").distinct()
    ranges = suppliers.select("cell_key", F.lit(FIRST_DAY).alias("start_date"), F.lit(LAST_DAY).alias("end_date"))
    return index.gap_report(ranges)


@query
def index_differences(spark, folder):
    """Days of the rewritten table in its index and in a scan: how many masks there are, and how many differ."""
    index, table = _rewritten(spark, folder)
    masks = index.masks(spark).groupBy("cell_key", "block").agg(F.expr("bit_or(present)").alias("present"))
    days = masks.agg(F.sum(F.expr("bit_count(present)")).alias("days"))
    return days.select("days", F.lit(index.differences(table).count()).cast("long").alias("differ"))


# --- upsert --------------------------------------------------------------------------------------------------------


@query
def obs_upsert(spark, folder):
    target, source = for_spark(spark, folder, "upsert_target"), for_spark(spark, folder, "upsert_source")
    return upsert(target, source, run_ts=_at(SECOND_RUN))


@query
def obs_upsert_rerun(spark, folder):
    """The same delivery loaded again a day later: only ``updated_at`` moves."""
    target, source = for_spark(spark, folder, "upsert_target"), for_spark(spark, folder, "upsert_source")
    return upsert(upsert(target, source, run_ts=_at(SECOND_RUN)), source, run_ts=_at(THIRD_RUN))


@query
def obs_upsert_table(spark, folder):
    """The same upsert through a stored table by year, clustered by the key: two loads, then the table."""
    target, source = for_spark(spark, folder, "upsert_target"), for_spark(spark, folder, "upsert_source")
    # What the table holds in the end at most; only the keys are read for it.
    rows = target.select(*KEYS).unionAll(source.select(*KEYS)).count()
    by_year = PartitionBy.clustered_for(rows, _by_year())
    table = f"upserted_{uuid.uuid4().hex}"
    location = new_work_folder(spark, "table")
    create_table(spark, table, target.schema, partition_by=by_year.schema, location=location, clustering=by_year.clustering)
    upsert_table(spark, target, table, run_ts=_at(FIRST_RUN), partition_by=by_year)
    upsert_table(spark, source, table, run_ts=_at(SECOND_RUN), partition_by=by_year)
    return spark.table(table).drop("year")


@query
def backfill_by_bucket(spark, folder):
    """The same upsert into months split by buckets of the key, the layout for cells that arrive with a long history."""
    target, source = for_spark(spark, folder, "upsert_target"), for_spark(spark, folder, "upsert_source")
    layout, table = PartitionBy.month_and_bucket(4), f"bucketed_{uuid.uuid4().hex}"
    create_table(spark, table, target.schema, partition_by=layout.schema, location=new_work_folder(spark, "table"))
    upsert_table(spark, target, table, run_ts=_at(FIRST_RUN), partition_by=layout)
    upsert_table(spark, source, table, run_ts=_at(SECOND_RUN), partition_by=layout)
    return spark.table(table).drop(*layout.columns)


@query
def not_null_gate(spark, folder):
    rows = for_spark(spark, folder, "observations")
    return null_counts(rows, ["cell_key", "date", "lat", "lon", "created_at", "updated_at"])


@query
def daily_load(spark, folder):
    """Two daily loads from logged fetch attempts into a table, the second correcting part of the first."""
    daily = for_spark(spark, folder, "daily_values")
    table = f"observations_{uuid.uuid4().hex}"
    load_job.create_observation_table(spark, table, location=new_work_folder(spark, "table"))
    early, late = F.col("day") < date(2024, 1, 21), F.col("day") >= date(2024, 1, 11)
    load_job.load_attempts(spark, _attempt_log(daily.where(early), "peak"), table, _at(FIRST_RUN))
    load_job.load_attempts(spark, _attempt_log(daily.where(late), "events"), table, _at(SECOND_RUN))
    return spark.table(table).select(
        "cell_key", "date", "lat", "lon", "daily_rain", "max_temp", "mslp", "created_at", "updated_at"
    )


@query
def load_summary(spark, folder):
    """What a load reports when some locations never answer, some are refused and a few were planned and not even tried."""
    daily = for_spark(spark, folder, "daily_values")
    table = f"observations_{uuid.uuid4().hex}"
    load_job.create_observation_table(spark, table, location=new_work_folder(spark, "table"))
    untried = spark.read.parquet(f"{folder}/nation.parquet").select(F.concat(F.lit("n"), "n_nationkey").alias("cell_key"))
    asked = daily.select(F.concat(F.lit("u"), "user_id").alias("cell_key")).distinct().unionByName(untried)
    result = load_job.load_attempts(spark, _attempt_log(daily, "peak"), table, _at(FIRST_RUN), requests=asked)
    untold = F.count_if(F.col("problem") == load_job.UNANSWERED).alias("unanswered")
    totals = (result.locations, result.failed_locations, result.rows_upserted)
    names = ("locations", "failed_locations", "rows_upserted")
    return result.failed.agg(untold, *[F.lit(n).cast("long").alias(name) for n, name in zip(totals, names)])


def _attempt_log(daily: DataFrame, value: str) -> DataFrame:
    """A response per user, first refused for some users and never answered for others.

    A user's lines are gathered into one text; a day comes once, so they are at most as many as there are days.
    The first load delivers ``mslp`` and the second does not.
    """
    has_mslp = value == "peak"
    header = "latitude,longitude,YYYY-MM-DD,daily_rain,max_temp,min_temp,vp,radiation" + (",mslp" if has_mslp else "")
    line = F.concat_ws(
        ",",
        F.concat(F.lit("-"), 10 + F.col("user_id") % 30, F.lit(".25")),
        F.concat(120 + F.col("user_id") % 30, F.lit(".6")),
        F.col("day").cast("string"),
        F.col(value).cast("string"),
        F.concat(F.col(value) % 40, F.lit(".5")),
        *[F.lit(text) for text in (("1", "2", "3", "1010") if has_mslp else ("1", "2", "3"))],
    )
    body = F.concat(F.lit(header + "\n"), F.array_join(F.sort_array(F.collect_list(line)), "\n"))
    bodies = daily.groupBy("user_id", "fate").agg(body.alias("body"))

    def attempt(number: int, status: int, has_body: bool):
        return F.struct(
            F.lit(number).alias("attempt"),
            F.lit(status).alias("status"),
            (F.col("body") if has_body else F.lit(None).cast("string")).alias("body"),
        )

    failing = F.array(*[attempt(n, 503, False) for n in range(1, 5)])
    tried = (
        F.when(F.col("fate") == "silent", failing)
        .when(F.col("fate") == "slow", F.array(attempt(1, 503, False), attempt(2, 200, True)))
        .when(F.col("fate") == "refused", F.array(attempt(1, 404, False), attempt(2, 200, True)))
        .otherwise(F.array(attempt(1, 200, True)))
    )
    cell = F.concat(F.lit("u"), "user_id").alias("cell_key")
    return bodies.select(cell, F.inline(tried))


def _land_daily(spark: SparkSession, folder: str, path: str, value: str, days) -> None:
    """Daily totals per event type as landed CSV files, a folder per type."""
    totals = for_spark(spark, folder, "type_totals").where(days)
    columns = {
        "latitude": F.lit("-32.25"),
        "longitude": F.lit("148.6"),
        "YYYY-MM-DD": F.col("day").cast("string"),
        "daily_rain": F.col(value).cast("string"),
        "max_temp": F.concat(F.col(value) % 40, F.lit(".5")),
        "min_temp": F.lit("1"),
        "vp": F.lit("2"),
        "radiation": F.lit("3"),
    }
    rows = totals.select("cell_key", *[column.alias(name) for name, column in columns.items()])
    rows.repartition("cell_key").write.mode("append").option("header", True).partitionBy("cell_key").csv(path)


_EARLY, _LATE = "day < DATE '2024-01-21'", "day >= DATE '2024-01-11'"
_LANDED_RESULT = ("cell_key", "date", "lat", "lon", "daily_rain", "max_temp", "mslp")


@query
def landed_load(spark, folder):
    """Landed files of two deliveries loaded in one go: the newer file of a day wins."""
    path, table = new_work_folder(spark, "landing"), f"observations_{uuid.uuid4().hex}"
    load_job.create_observation_table(spark, table, location=new_work_folder(spark, "table"))
    _land_daily(spark, folder, path, "peak", _EARLY)
    _land_daily(spark, folder, path, "events", _LATE)
    load_job.load_landed_files(spark, path, table, _at(SECOND_RUN))
    return spark.table(table).select(*_LANDED_RESULT)


@query
def streamed_load(spark, folder):
    """The same two deliveries picked up by the stream as they land, in two runs."""
    path, table = new_work_folder(spark, "landing"), f"observations_{uuid.uuid4().hex}"
    load_job.create_observation_table(spark, table, location=new_work_folder(spark, "table"))
    for value, days in (("peak", _EARLY), ("events", _LATE)):
        _land_daily(spark, folder, path, value, days)
        load_landing_folder(spark, path, table, table).awaitTermination()
    return spark.table(table).select(*_LANDED_RESULT)


@query
def streamed_attempts(spark, folder):
    """A log of attempts that arrives in two parts, the second and fourth attempts first: settled and loaded as they complete."""
    path, table = new_work_folder(spark, "attempts"), f"observations_{uuid.uuid4().hex}"
    load_job.create_observation_table(spark, table, location=new_work_folder(spark, "table"))
    log = _attempt_log(for_spark(spark, folder, "daily_values"), "peak")
    log = log.select(F.lit("r1").alias("run"), "cell_key", "attempt", "status", "body", _at(FIRST_RUN).alias("at"))
    for part in (log.where("attempt % 2 = 0"), log.where("attempt % 2 = 1")):
        part.write.mode("append").parquet(path)
        load_attempt_log(spark, path, table, table).awaitTermination()
    return spark.table(table).select(*_LANDED_RESULT)


# --- checks on observations ------------------------------------------------------------------------------------------


@query
def dq_coverage(spark, folder):
    cells, stored = _cells_and_stored(spark, folder)
    return checks.uncovered_keys(cells, stored)


@query
def dq_date_completeness(spark, folder):
    parts, rows = for_spark(spark, folder, "part_mapping"), for_spark(spark, folder, "observations")
    return gaps.gap_report(gaps.key_ranges(parts, LAST_DAY), rows)


@query
def dq_value_ranges(spark, folder):
    return checks.value_range_violations(for_spark(spark, folder, "observations"))


@query
def dq_unparseable_values(spark, folder):
    return checks.unparseable_values(for_spark(spark, folder, "observations"))


@query
def dq_null_keys(spark, folder):
    return checks.null_key_violations(for_spark(spark, folder, "observations"))


@query
def dq_timestamps(spark, folder):
    return checks.timestamp_violations(for_spark(spark, folder, "observations"))


@query
def dq_farthest_places(spark, folder):
    """The rows shown for the distance check: worst first."""
    suite = quality.mapping_suite(spark, _mapping(spark, folder), _places(spark, folder), max_distance_km=NEAR_KM)
    found = next(check for check in suite if check.number == "4").sample()
    return found.select("place_id", "cell_key", "distance")


@query
def dq_widest_gaps(spark, folder):
    """The rows shown for the date check: most missing days first."""
    rows, parts = for_spark(spark, folder, "observations"), for_spark(spark, folder, "part_mapping")
    suite = quality.load_suite(spark, parts, rows, LAST_DAY)
    return next(check for check in suite if check.number == "3").sample()


@query
def dq_report_mapping(spark, folder):
    suite = quality.mapping_suite(spark, _mapping(spark, folder), _places(spark, folder), max_distance_km=NEAR_KM)
    return quality.report(suite).select("check_no", "violations", "status")


@query
def dq_report_load(spark, folder):
    rows = for_spark(spark, folder, "observations")
    parts = for_spark(spark, folder, "part_mapping")
    suite = quality.load_suite(spark, parts, rows, LAST_DAY)
    return quality.report(suite).select("check_no", "violations", "status")


# --- outcomes ----------------------------------------------------------------------------------------------------


@query
def fetch_outcomes(spark, folder):
    return outcomes.fetch_outcomes(for_spark(spark, folder, "attempts"), ["request"])


@query
def failure_cutoff(spark, folder):
    """A run per day, cut into chunks of 64 positions so that streaks cross many seams."""
    log = for_spark(spark, folder, "run_log")
    return outcomes.failure_cutoff(log, ["run_day"], "position", "succeeded", chunk=F.floor(F.col("position") / 64))


@query
def failure_cutoff_one_run(spark, folder):
    """The whole log as one run that stops at five failures in a row."""
    log = for_spark(spark, folder, "run_log")
    return outcomes.failure_cutoff(log, [], "position", "succeeded", threshold=5)


@query
def failure_cutoff_sparse(spark, folder):
    """Runs whose positions lie far apart: chunks hold rows, so the gaps between positions do not matter."""
    log = for_spark(spark, folder, "run_log").withColumn("position", F.col("position") * 1_000_003)
    found = outcomes.failure_cutoff(log, ["run_day"], "position", "succeeded")
    return found.withColumn("stopped_at", F.expr("stopped_at div 1000003"))


@query
def run_summary(spark, folder):
    attempts = for_spark(spark, folder, "attempts")
    lines = attempts.groupBy("request").agg(F.count(F.lit(1)).alias("lines"))
    judged = outcomes.fetch_outcomes(attempts, ["request"]).join(lines, "request")
    done = F.col("outcome") == outcomes.ACCEPTED
    return outcomes.run_summary(judged, ~done, F.when(done, F.col("lines")))
