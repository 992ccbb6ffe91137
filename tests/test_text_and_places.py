"""Lenient parsing, CSV fields and the places reader."""

from __future__ import annotations

import csv

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daygrid.contracts import PLACE_SCHEMA, schema_mismatches
from daygrid.functions import text
from daygrid.functions.text import csv_fields, has_open_quote, lenient_double, missing_to_null
from daygrid.sources.places import read_places

NUMBERS = {
    "148.6": 148.6,
    " -32.25 ": -32.25,
    "+.5": 0.5,
    "7.": 7.0,
    "1e3": 1000.0,
    "inf": float("inf"),
    "-Infinity": float("-inf"),
    "1.5d": None,
    "2f": None,
    "0x1p3": None,
    "not-a-number": None,
    "NaN": None,
    "": None,
    "1 2": None,
    None: None,
}


def test_lenient_double(spark):
    rows = spark.createDataFrame([(text,) for text in NUMBERS], "t string").select("t", lenient_double(F.col("t")).alias("v"))
    assert {r.t: r.v for r in rows.collect()} == NUMBERS


def test_missing_words(spark):
    words = {"NA": None, "n/a": None, "": None, "null": None, "NA ": "NA ", "0": "0", "Na": "Na", None: None}
    rows = spark.createDataFrame([(w,) for w in words], "t string").selectExpr("t", f"{missing_to_null('t')} AS v")
    assert {r.t: r.v for r in rows.collect()} == words


def fields_of(spark, lines):
    rows = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, l string")
    return [r.f for r in rows.select("i", csv_fields(F.col("l")).alias("f")).orderBy("i").collect()]


def test_csv_fields(spark):
    assert fields_of(spark, ["a,b", ",a", "a,,b,", ' x , "1, 2" ,"say ""hi""",""', "", '"a"']) == [
        ["a", "b"],
        ["", "a"],
        ["a", "", "b", ""],
        ["x ", "1, 2", 'say "hi"', ""],
        [""],
        ["a"],
    ]


CELL = st.text(st.sampled_from('ab ,"'), max_size=6)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(CELL, min_size=1, max_size=4), min_size=30, max_size=60))
def test_csv_fields_agree_with_a_csv_reader(spark, rows):
    lines = []
    for row in rows:
        quoted = ['"' + cell.replace('"', '""') + '"' if set(cell) & set(' ,"') else cell for cell in row]
        lines.append(",".join(quoted))
    expected = [next(csv.reader([line], skipinitialspace=True)) or [""] for line in lines]
    assert fields_of(spark, lines) == expected


def test_open_quote(spark):
    lines = {'a,"b': True, 'a,"b"': False, "a": False, 'a,"b""': True}
    rows = spark.createDataFrame([(line,) for line in lines], "l string")
    assert {r.l: r.o for r in rows.select("l", has_open_quote(F.col("l")).alias("o")).collect()} == lines


def test_places_are_trimmed_and_parsed_leniently(spark, tmp_path):
    path = tmp_path / "places.csv"
    path.write_text(
        "note,place_id,place_name,state,latitude,longitude\n"
        'x, p1 , Place One ,NSW,not-a-number,148.6\n"a, b",p2,Two,,-30.5, 150\n'
    )
    found = read_places(spark, str(path))
    assert schema_mismatches(found.schema, PLACE_SCHEMA) == []
    assert [tuple(r) for r in found.orderBy("place_id").collect()] == [
        ("p1", "Place One", "NSW", None, 148.6),
        ("p2", "Two", None, -30.5, 150.0),
    ]


def test_places_without_a_required_column(spark, tmp_path):
    path = tmp_path / "places.csv"
    path.write_text("place_id,place_name,latitude\np1,Place One,-32.0\n")
    with pytest.raises(ValueError, match="state, longitude"):
        read_places(spark, str(path))


def test_files_with_different_headers_are_refused_rather_than_mixed(spark, tmp_path):
    (tmp_path / "a.csv").write_text("place_id,place_name,state,latitude,longitude\np1,One,NSW,-32.0,148.6\n")
    (tmp_path / "b.csv").write_text("place_id,place_name,state,longitude,latitude\np2,Two,NSW,148.6,-32.0\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_places(spark, str(tmp_path)).collect()


def test_the_short_way_to_a_number_reads_as_the_pattern_does(spark):
    texts = ["1", "-1.5", "+.5", "1e5", "1E-3", "1.", "5d", "5f", "0x1p3", "0X1P3", "1x5", "inf", "-Infinity", "nan", " nan ", "NaN"]
    texts += ["", None, " 1", "1 ", "\t1", "1e400", "-", "+", "1-1", "1e", "e5", "5d5", "١5", "1_0", "--1", "1.2.3", ".", "+.", "- 1"]
    texts += ["00012", "9" * 400, "\x015", "5\x00", "+nan", "1e+5", "1e++5", "e", "E.", "1.e5", "．5"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    nan = F.when(F.col("t").rlike(r"^\s*[+-]?(?i:nan)\s*$"), F.lit(float("nan")))
    found = rows.select("t", text.number_or_nan(F.col("t")).alias("a"), F.coalesce(text.lenient_double(F.col("t")), nan).alias("b")).collect()
    assert [r.t for r in found if repr(r.a) != repr(r.b)] == []
