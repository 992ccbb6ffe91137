"""Response bodies and landed files: verdicts, parsing, normalising."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from daygrid.sources import responses
from daygrid.sources.responses import LONG_LINE, NO_CONTENT, NO_HEADER, OPEN_QUOTE, UNKNOWN_COLUMN

HEADER = (
    "latitude,longitude,YYYY-MM-DD,daily_rain,daily_rain_source,max_temp,max_temp_source,"
    "min_temp,min_temp_source,vp,vp_source,radiation,radiation_source,metadata\n"
)
WANTED = HEADER.strip().split(",")[:-1]
GOOD = (
    HEADER
    + ' -32.2500, 148.6000,1990-01-01,    0.0,25, 33.5,25, 18.0,25, 19.0,25, 29.0,42,"height= 274.3 m"\n'
    + ' -32.2500, 148.6000,1990-01-02,    4.2,25, 30.1,25, 17.5,25, 20.1,25, 24.3,42,"kind, other"\n'
    + " -32.2500, 148.6000" + "," * 12 + '"made=20260927"\n'
)
ROW = "1,2,1990-01-01,0,25,1,25,2,25,3,25,4,25,\n"
BAD = {
    "Sorry, your request could not be processed.": NO_HEADER,
    "# comment only\n\n": NO_CONTENT,
    "": NO_CONTENT,
    None: NO_CONTENT,
    HEADER + ROW.strip() + ",15\n": LONG_LINE,
    HEADER + '1,2,1990-01-01,"0,25\n': OPEN_QUOTE,
    HEADER.replace("metadata", "humidity") + ROW: UNKNOWN_COLUMN + "humidity",
}


def bodies(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "cell_key int, body string").withColumn(
        "cell_key", F.concat(F.lit("k"), "cell_key")
    )


def parsed(spark, *texts, wanted=WANTED):
    return responses.normalise(responses.split_bodies(bodies(spark, texts), wanted), wanted)


def test_judging_looks_at_the_first_content_line(spark):
    texts = [GOOD, "# note\n\n" + GOOD, "Sorry, no", "# comment only\n\n", "", None, "x\n" + GOOD]
    judged = responses.judge_bodies(bodies(spark, texts)).orderBy("cell_key").collect()
    assert [r.problem for r in judged] == [None, None, NO_HEADER, NO_CONTENT, NO_CONTENT, NO_CONTENT, NO_HEADER]


def test_rows_are_renamed_typed_and_otherwise_kept_as_delivered(spark):
    rows = parsed(spark, GOOD).orderBy("date").collect()
    assert [r.date for r in rows] == [date(1990, 1, 1), date(1990, 1, 2)]  # the undated row is gone
    first = rows[0].asDict()
    assert (first["lat"], first["lon"], first["daily_rain"], first["daily_rain_source"]) == (-32.25, 148.6, "0.0", "25")
    assert {"latitude", "longitude", "YYYY-MM-DD", "metadata"}.isdisjoint(first)
    assert first["cell_key"] == "k0" and first["problem"] is None and first["absent"] == []


@pytest.mark.parametrize("text,problem", BAD.items())
def test_a_bad_response_gives_its_reason_and_no_values(spark, text, problem):
    rows = parsed(spark, text, GOOD).where("cell_key = 'k0'").collect()
    assert [(r.problem, r.date, r.daily_rain) for r in rows] == [(problem, None, None)]


def test_missing_words_become_null_and_trailing_spaces_stay(spark):
    text = HEADER + '1,2,1990-01-01,,NA, n/a ,x ,"",25,3,25,4,25\n'
    row = parsed(spark, text).first()
    assert (row.daily_rain, row.daily_rain_source, row.max_temp, row.max_temp_source, row.min_temp) == (
        None,
        None,
        "n/a ",
        "x ",
        None,
    )


def test_unreadable_date_or_position_keeps_the_row_with_a_reason(spark):
    text = HEADER + ROW + ROW.replace("1990-01-01", "someday") + ROW.replace("1,2,1990-01-01", "north,2,1990-01-02")
    observed = parsed(spark, text)
    assert responses.accepted(observed).count() == 1
    assert sorted(r.problem for r in responses.refused(observed).collect()) == ["unreadable date", "unreadable lat"]


def test_columns_are_found_by_name_in_each_response(spark):
    other = "radiation,vp,min_temp,max_temp,daily_rain,YYYY-MM-DD,longitude,latitude\n9,8,7,6,5,1990-01-01,148.6,-32.25\n"
    rows = {r.cell_key: r for r in parsed(spark, GOOD, other).where("date = '1990-01-01'").collect()}
    assert (rows["k1"].radiation, rows["k1"].daily_rain, rows["k1"].lat) == ("9", "5", -32.25)
    assert rows["k1"].daily_rain_source is None
    assert set(rows["k1"].absent) == {name for name in WANTED if name.endswith("_source")}


def test_windows_line_ends(spark):
    assert parsed(spark, GOOD.replace("\n", "\r\n")).count() == 2


def land(tmp_path, texts):
    for key, text in texts.items():
        folder = tmp_path / f"cell_key={key}"
        folder.mkdir()
        (folder / "response.csv").write_bytes((text or "").encode())


def test_both_file_readers_agree(spark, tmp_path):
    other = "# note\n\nYYYY-MM-DD,radiation,vp,min_temp,max_temp,daily_rain,longitude,latitude\n1990-01-01,1,2,3,4,5,6,7\n"
    texts = {"-1.0,2.0": GOOD, "-1.05,2.0": other, "007": GOOD.replace("\n", "\r\n")}
    texts |= {f"bad{i}": text for i, text in enumerate(BAD)}
    texts["repeated header"] = GOOD + GOOD  # the second header is a row, and a bad one
    land(tmp_path, texts)
    results = []
    for whole_file_bytes in (10**6, 0, 300):  # whole, by line, some of each
        records = responses.read_landed(spark, str(tmp_path), WANTED, whole_file_bytes=whole_file_bytes)
        observed = responses.normalise(records, WANTED).drop("landed")
        results.append(sorted(map(str, observed.collect())))
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == 2 + 1 + 2 + len(BAD) + 5
    keys = {r.cell_key for r in responses.read_landed(spark, str(tmp_path), WANTED).select("cell_key").collect()}
    assert keys == set(texts)  # keys stay text: no "7" for "007"


def test_a_file_over_many_splits_is_read_whole(spark, tmp_path):
    days = "".join(f"1,2,{date.fromordinal(726000 + i)},{i},25,1,25,2,25,3,25,4,25,\n" for i in range(3000))
    land(tmp_path, {"hot": "# note\n" + HEADER + days, "cold": GOOD})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        records = responses.read_landed(spark, str(tmp_path), WANTED, whole_file_bytes=0)
        rows = responses.normalise(records, WANTED).where("cell_key = 'hot'")
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 3
        assert rows.count() == 3000
        assert rows.agg(F.sum(F.col("daily_rain").cast("long"))).first()[0] == sum(range(3000))
        assert rows.where("problem IS NOT NULL").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
