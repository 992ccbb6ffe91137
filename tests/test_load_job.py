"""The jobs end to end: mapping table, fetch plan, load, quality, rerun, stream."""

from __future__ import annotations

import os
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from daygrid.contracts import MAPPING_SCHEMA, OBSERVATION_SCHEMA
from daygrid.plans import load_job
from daygrid.plans.mapping_job import build_mapping_table
from daygrid.plans.quality import QualityGate, load_suite, mapping_suite
from daygrid.sources.places import read_places
from daygrid.streaming.landing import load_landing_folder

T1, T2 = datetime(2024, 2, 1), datetime(2024, 3, 1)
HEADER = "latitude,longitude,YYYY-MM-DD,daily_rain,daily_rain_source,max_temp,min_temp,vp,radiation"
PLACES = """place_id,place_name,state,latitude,longitude
p1,One,NSW,-32.2569,148.6011
p2,Two,NSW,-32.2431,148.5990
p3,Three,ACT,-35.2809,149.13
p4,Nowhere,NZ,-36.8,174.7
"""
DUBBO, CANBERRA = "-32.25,148.6", "-35.3,149.15"


def name():
    return f"t_{uuid.uuid4().hex}"


def response(days, rain="1", header=HEADER, tail=""):
    lines = [f"-32.2500, 148.6000,2024-01-{day:02d}, {rain},25,30,10,20,21{tail}" for day in days]
    return "\n".join([header, *lines]) + "\n"


def values(spark, table, *columns):
    return {tuple(r) for r in spark.table(table).select("cell_key", F.dayofmonth("date"), *columns).collect()}


@pytest.fixture
def table(spark):
    table = name()
    load_job.create_observation_table(spark, table)
    return table


def test_mapping_table(spark, tmp_path):
    path, mapping = tmp_path / "places.csv", name()
    path.write_text(PLACES)
    for _ in range(2):  # a rebuild replaces
        assert build_mapping_table(spark, str(path), mapping) == 3
    rows = spark.table(mapping)
    assert rows.columns == MAPPING_SCHEMA.names
    assert {r.place_id: r.cell_key for r in rows.collect()} == {"p1": DUBBO, "p2": DUBBO, "p3": CANBERRA}
    gate = QualityGate()
    gate.run(mapping_suite(spark, rows, read_places(spark, str(path))))
    assert [m.split(" - ")[0] for m in gate.messages] == ["Check 1b", "Check 7"]


def test_plan_load_and_check(spark, tmp_path, table):
    path, mapping = tmp_path / "places.csv", name()
    path.write_text(PLACES)
    build_mapping_table(spark, str(path), mapping, backfill_from=date(2024, 1, 1))
    run = date(2024, 1, 5)
    planned = {r.cell_key: (r.lat, r.start, r.finish) for r in load_job.plan_fetches(spark, mapping, table, run).collect()}
    assert planned == {
        DUBBO: ("-32.25", "20231206", "20240105"),
        CANBERRA: ("-35.30", "20231206", "20240105"),
    }
    assert load_job.plan_fetches(spark, mapping, table, run, trial=True).count() == 2

    bodies = [(DUBBO, 1, 200, response(range(1, 6))), (CANBERRA, 1, 200, response(range(1, 5)))]
    attempts = spark.createDataFrame(bodies, "cell_key string, attempt int, status int, body string")
    load_job.load_attempts(spark, attempts, table, T1).raise_if_failed()
    gate = QualityGate()
    observed = spark.table(table).drop("month", "bucket")
    results = gate.run(load_suite(spark, spark.table(mapping), observed, run))
    assert {number: count for number, _, count in results if count} == {"3": 1}
    assert observed.columns == OBSERVATION_SCHEMA.names


def test_one_bad_location_does_not_stop_the_others(spark, table):
    rows = [
        ("ok", 1, 503, None),
        ("ok", 2, 200, response([1, 2])),
        ("refused", 1, 404, None),
        ("refused", 2, 200, response([1])),
        ("error page", 1, 200, "Sorry"),
        ("silent", 1, None, None),
        ("unreadable", 1, 200, response([3]) + "-32, 148,2024-13-45,1,25,30,10,20,21\n"),
        ("header only", 1, 200, HEADER + "\n"),
    ]
    attempts = spark.createDataFrame(rows, "cell_key string, attempt int, status int, body string")
    result = load_job.load_attempts(spark, attempts, table, T1)
    assert result.rows_upserted == 3
    assert values(spark, table) == {("ok", 1), ("ok", 2), ("unreadable", 3)}
    assert {(r.cell_key, r.problem, r.rows) for r in result.failed.collect()} == {
        ("refused", "client_error, status 404", 1),
        ("error page", "invalid_body, status 200", 1),
        ("silent", "pending, status none", 1),
        ("unreadable", "unreadable date", 1),
    }
    assert result.failed_locations == 4
    with pytest.raises(RuntimeError, match=r"4 location\(s\) failed(.|\n)*key=refused: client_error"):
        result.raise_if_failed()


def test_reload_corrects_and_keeps_what_is_not_delivered(spark, table):
    columns = "cell_key string, attempt int, status int, body string"
    first = response([1, 2], header=HEADER + ",mslp", tail=",1010")
    load_job.load_attempts(spark, spark.createDataFrame([("k", 1, 200, first)], columns), table, T1)
    second = response([2, 3], rain="")
    load_job.load_attempts(spark, spark.createDataFrame([("k", 1, 200, second)], columns), table, T2)
    assert values(spark, table, "daily_rain", "mslp", "created_at", "updated_at") == {
        ("k", 1, "1", "1010", T1, T1),
        ("k", 2, None, "1010", T1, T2),
        ("k", 3, None, None, T2, T2),
    }


def land(folder, key, file, text, mtime):
    target = folder / f"cell_key={key}"
    target.mkdir(exist_ok=True, parents=True)
    (target / file).write_text(text)
    os.utime(target / file, (mtime, mtime))


@pytest.mark.parametrize("whole_file_bytes", [10**6, 0])
def test_landed_files_and_the_newest_copy_of_a_day(spark, tmp_path, table, whole_file_bytes):
    land(tmp_path, DUBBO, "old.csv", response([1, 2], rain="1"), 1_700_000_000)
    land(tmp_path, DUBBO, "new.csv", response([2, 3], rain="2"), 1_700_000_100)
    land(tmp_path, CANBERRA, "only.csv", "Sorry", 1_700_000_000)
    result = load_job.load_landed_files(spark, str(tmp_path), table, T1, whole_file_bytes=whole_file_bytes)
    assert values(spark, table, "daily_rain") == {(DUBBO, 1, "1"), (DUBBO, 2, "2"), (DUBBO, 3, "2")}
    assert (result.locations, result.failed_locations) == (2, 1)


def test_a_location_that_repeats_a_day_is_refused_and_a_repeated_attempt_is_one(spark, table):
    rows = [("twice", 1, 200, response([1, 1])), ("fine", 1, 200, response([1])), ("fine", 1, 200, response([1]))]
    attempts = spark.createDataFrame(rows, "cell_key string, attempt int, status int, body string")
    result = load_job.load_attempts(spark, attempts, table, T1)
    assert values(spark, table) == {("fine", 1)}
    assert (result.locations, result.failed_locations, result.rows_upserted) == (2, 1, 1)
    assert [r.problem for r in result.failed.collect()] == ["a day comes more than once: 2024-01-01"]
    result.close()


@pytest.mark.parametrize("together", [True, False])
def test_columns_of_an_older_file_survive_whatever_the_batches(spark, tmp_path, table, together):
    older = response([1], rain="1", header=HEADER + ",mslp", tail=",1010")
    for number, (text, mtime) in enumerate([(older, 1_700_000_000), (response([1], rain="2"), 1_700_000_100)]):
        folder = tmp_path if together else tmp_path / str(number)
        land(folder, DUBBO, f"{number}.csv", text, mtime)
        if not together:
            load_job.load_landed_files(spark, str(folder), table, T1).close()
    if together:
        load_job.load_landed_files(spark, str(tmp_path), table, T1).close()
    assert values(spark, table, "daily_rain", "mslp") == {(DUBBO, 1, "2", "1010")}


def test_files_without_content_are_refused_and_counted(spark, tmp_path, table):
    land(tmp_path, DUBBO, "good.csv", response([1]), 1_700_000_000)
    land(tmp_path, CANBERRA, "empty.csv", "", 1_700_000_000)
    land(tmp_path, "1.0,2.0", "header.csv", HEADER + "\n", 1_700_000_000)
    result = load_job.load_landed_files(spark, str(tmp_path), table, T1)
    assert (result.locations, result.failed_locations, result.rows_upserted) == (3, 1, 1)
    assert [(r.cell_key, r.problem) for r in result.failed.collect()] == [(CANBERRA, "no content")]


def test_no_work_folder_is_left_and_no_setting_changed(spark, table):
    shared = spark.conf.get("spark.checkpoint.dir")

    def folders():
        return {f for f in os.listdir(shared) if f.startswith(("parsed-", "refused-", "upsert-"))} if os.path.isdir(shared) else set()

    before, mode = folders(), spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    attempts = spark.createDataFrame([("k", 1, 200, response([1]))], "cell_key string, attempt int, status int, body string")
    load_job.load_attempts(spark, attempts, table, T1).close()
    with pytest.raises(Exception):
        load_job.load_attempts(spark, attempts, "no_such_table", T1)
    assert folders() == before and spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_stream_loads_each_file_once(spark, tmp_path, table):
    query, batches = name(), []

    def run():
        stream = load_landing_folder(
            spark, str(tmp_path), table, query, on_batch=lambda batch, result: batches.append(result.rows_upserted)
        )
        assert stream.awaitTermination(120)

    land(tmp_path, DUBBO, "a.csv", response([1, 2]), 1_700_000_000)
    run()
    assert values(spark, table, "daily_rain") == {(DUBBO, 1, "1"), (DUBBO, 2, "1")}
    run()
    land(tmp_path, DUBBO, "b.csv", response([2, 3], rain="9"), 1_700_000_100)
    run()
    assert values(spark, table, "daily_rain") == {(DUBBO, 1, "1"), (DUBBO, 2, "9"), (DUBBO, 3, "9")}
    assert batches == [2, 2]
