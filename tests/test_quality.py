"""Checks, suites, the report and the gate."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from daygrid.contracts import MAPPING_SCHEMA, PLACE_SCHEMA
from daygrid.operators import checks
from daygrid.operators.mapping import place_cell_mapping
from daygrid.plans import quality
from daygrid.plans.quality import Check, QualityGate, load_suite, mapping_suite, report

PLACES = [
    ("a", "A", "X", -32.25, 148.6),
    ("b", "B", "X", -32.26, 148.61),
    ("c", "C", None, -32.0, 148.0),
    ("d", "D", "X", -44.02, 148.0),  # outside, but snaps inside
    ("e", "E", "X", -50.0, 148.0),
    (None, "F", "X", -30.0, 148.0),
]


@pytest.fixture
def places(spark):
    return spark.createDataFrame(PLACES, PLACE_SCHEMA)


def counts(frame):
    return {r.check_no: r.violations for r in frame.collect()}


def test_mapping_suite(spark, places):
    suite = mapping_suite(spark, place_cell_mapping(places), places)
    found = counts(report(suite))
    assert found == {"1": 0, "1a": 0, "1b": 2, "2": 0, "3": 0, "4": 0, "5": 2, "6": 0, "7": 2, "8": 0}
    direct = {check.number: check.violations().count() for check in suite if check.measure is None}
    assert direct == {number: n for number, n in found.items() if number != "1"}


def test_mapping_suite_on_a_spoilt_mapping(spark, places):
    good = place_cell_mapping(places)
    bad = good.where("place_id = 'a'").withColumns(
        {
            "place_id": F.lit("z"),
            "distance": F.lit(5.1),
            "cell_latlon": F.array(F.lit(-44.05), F.lit(148.6)),
            "backfill_from_date": F.lit(date(1990, 1, 2)),
        }
    )
    found = counts(report(mapping_suite(spark, good.unionByName(bad).unionByName(bad), places)))
    assert found == {"1": 0, "1a": 2, "1b": 2, "2": 0, "3": 1, "4": 2, "5": 2, "6": 2, "7": 2, "8": 2}


def test_distance_at_the_limit_passes(spark):
    rows = spark.createDataFrame([(5.0,), (5.000001,)], "distance double")
    assert rows.where(checks.too_far()).count() == 1


def test_null_start_date_is_a_violation(spark):
    rows = spark.createDataFrame([(None,), (date(1990, 1, 1),)], "backfill_from_date date")
    assert rows.where(checks.wrong_date()).count() == 1


def test_empty_mapping_is_one_error(spark, places):
    gate = QualityGate()
    gate.run(mapping_suite(spark, spark.createDataFrame([], MAPPING_SCHEMA), places))
    assert [m for m in gate.messages if "Check 1" in m] == ["Check 1 - Row Count — output table is empty"]


OBSERVED = (
    "cell_key string, date date, lat double, lon double, daily_rain string, max_temp string, min_temp string, "
    "evap_pan string, radiation string, vp string, created_at timestamp, updated_at timestamp"
)
T0, T1 = datetime(2024, 1, 1), datetime(2024, 2, 1)


def observation(key="k", day=1, rain="0", warm="30", cold="10", pan="1", sun="1", vapour="1", created=T0, updated=T1, lat=1.0):
    return (key, date(2024, 1, day), lat, 2.0, rain, warm, cold, pan, sun, vapour, created, updated)


def violations(frame):
    return {r.cell_key: {n: v for n, v in r.asDict().items() if n != "cell_key" and v} for r in frame.collect()}


def test_value_ranges(spark):
    rows = [
        observation("edges", rain="1300", warm="54", cold="-20", pan="35.0", sun="0", vapour="43.2"),
        observation("high", rain="1300.1", warm="54.1", cold="40.1", pan="35.1", sun="35.1", vapour="43.3"),
        observation("low", rain="-0.1", warm="-9.1", cold="-20.1", pan="-1", sun="-1", vapour="-1"),
        observation("crossed", warm="9", cold="10"),
        observation("missing", rain=None, warm=None, cold=None),
        observation("unreadable", rain="", warm="n/a"),
        observation("nan", rain="NaN"),
        observation("nan", rain="2000", day=2),
    ]
    everything = {f"{n}_out_of_range": 1 for n in ("daily_rain", "max_temp", "min_temp", "evap_pan", "radiation", "vp")}
    frame = spark.createDataFrame(rows, OBSERVED)
    assert violations(checks.value_range_violations(frame)) == {
        "high": everything,
        "low": everything,
        "crossed": {"max_temp_less_than_min_temp": 1},
        "nan": {"daily_rain_out_of_range": 2},
    }
    assert violations(checks.unparseable_values(frame)) == {
        "unreadable": {"unparseable_daily_rain": 1, "unparseable_max_temp": 1}
    }
    assert violations(checks.null_key_violations(frame)) == {
        "missing": {f"null_or_empty_{n}": 1 for n in ("daily_rain", "max_temp", "min_temp")},
        "unreadable": {"null_or_empty_daily_rain": 1},
    }


def test_null_keys_form_their_own_group(spark):
    rows = [observation(None), observation(""), observation("x", lat=None)]
    assert violations(checks.null_key_violations(spark.createDataFrame(rows, OBSERVED))) == {
        None: {"null_or_empty_cell_key": 1},
        "": {"null_or_empty_cell_key": 1},
        "x": {"null_lat": 1},
    }


def test_timestamps(spark):
    rows = [
        observation("fine", created=T0, updated=T0),
        observation("late", created=T1, updated=T0),
        observation("none", created=None, updated=None),
    ]
    assert violations(checks.timestamp_violations(spark.createDataFrame(rows, OBSERVED))) == {
        "late": {"created_at_after_updated_at": 1},
        "none": {"null_created_at": 1, "null_updated_at": 1},
    }


def test_load_suite(spark):
    mapping = spark.createDataFrame(
        [("k", date(2024, 1, 1)), ("k", date(2024, 1, 2)), ("gone", date(2024, 1, 3))],
        "cell_key string, backfill_from_date date",
    )
    rows = [observation(day=1), observation(day=3, rain="-1"), observation("unmapped", created=None)]
    frame = spark.createDataFrame(rows, OBSERVED)
    suite = load_suite(spark, mapping, frame, date(2024, 1, 3), schema=frame.schema)
    assert counts(report(suite)) == {"1": 1, "2": 0, "3": 2, "4": 1, "4a": 0, "5": 0, "6": 1}
    assert {c.number: c.violations().count() for c in suite} == counts(report(suite))
    gaps = next(c for c in suite if c.number == "3").sample().collect()
    assert [tuple(r) for r in gaps] == [
        ("gone", 1, date(2024, 1, 3), date(2024, 1, 3)),
        ("k", 1, date(2024, 1, 2), date(2024, 1, 2)),
    ]


def test_checks_over_one_base_share_one_scan(spark, places):
    path_like = report([c for c in mapping_suite(spark, place_cell_mapping(places), places) if c.number in ("5", "7")])
    plan = path_like._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


# --- gate ----------------------------------------------------------------------------------------------------------


def test_gate_passes_on_nothing(spark, capsys):
    gate = QualityGate()
    assert gate.judge(spark.range(0), "Check 1 - Row Count") == 0
    gate.raise_if_failed()
    printed = capsys.readouterr().out
    assert "PASS: Check 1 - Row Count" in printed and "QA PASSED" in printed


def test_gate_reports_every_failure_and_shows_a_sample(spark):
    shown = []
    gate = QualityGate(show=lambda rows: shown.append(rows.count()))
    gate.add("Check 2 - Schema — column mismatch")
    assert gate.judge(spark.range(100), "Check 4 - Distance Threshold") == 100
    assert shown == [20]
    with pytest.raises(RuntimeError) as raised:
        gate.raise_if_failed()
    assert str(raised.value) == (
        "QA FAILED — 2 check(s) did not pass:\n"
        "\tCheck 2 - Schema — column mismatch\n"
        "\tCheck 4 - Distance Threshold — 100 violation(s) found."
    )


def test_a_check_that_cannot_run_does_not_hide_the_others(spark):
    broken = spark.range(3).select(F.raise_error(F.lit("boom")).cast("int").alias("x"))
    gate = QualityGate()
    results = gate.run(
        [
            Check("1", "Fine", spark.range(0)),
            Check("2", "Broken", broken, F.col("x") > 1),
            Check("3", "Failing", spark.range(2)),
        ]
    )
    assert [(number, count) for number, _, count in results] == [("1", 0), ("2", None), ("3", 2)]
    assert len(gate.messages) == 2 and "could not run" in gate.messages[0] and "2 violation(s)" in gate.messages[1]


def test_duplicate_ids_are_worst_first(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), ("b",), ("c",), (None,), (None,)], "place_id string")
    order = (F.col("duplicate_count").desc(), F.col("place_id"))
    sample = Check("3", "Duplicates", checks.duplicate_ids(rows), order_by=order).sample(2).collect()
    assert [tuple(r) for r in sample] == [("b", 3), (None, 2)]


def test_a_check_without_its_column_leaves_the_others_one_job(spark, monkeypatch):
    collected = []
    plain = quality.report

    def counting(checks):
        df = plain(checks)
        collected.append(len(checks))
        return df

    monkeypatch.setattr(quality, "report", counting)
    base = spark.range(5)
    checks = [Check("1", "Fine", base, F.col("id") < 0), Check("2", "Absent", base, F.col("no_such") > 1), Check("3", "Failing", base, F.col("id") > 2)]
    results = QualityGate().run(checks)
    assert [(number, count) for number, _, count in results] == [("1", 0), ("2", None), ("3", 2)]
    assert collected == [1, 1, 2]  # two looked at alone, by analysis, and then run together
    assert QualityGate().run([Check("2", "Absent", base, F.col("no_such") > 1)])[0][2] is None
