"""DDL, comments, schema comparison and the NOT NULL gate."""

from __future__ import annotations

import uuid
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from daygrid import contracts
from daygrid import fixed_values as fixed
from daygrid.functions.text import sql_quoted
from daygrid.plans import load_job

SMALL = StructType([StructField("place_id", StringType(), False), StructField("distance", DoubleType(), True)])
COMMENTED = StructType(
    [
        StructField("cell_key", StringType(), False, {"comment": "Key in 'lat,lon' format."}),
        StructField("distance", DoubleType(), True),
    ]
)


def test_ddl():
    assert contracts.ddl_columns(SMALL) == "place_id STRING NOT NULL,\n    distance DOUBLE"


def test_text_survives_sql(spark):
    text = "Key in 'latitude,longitude' format (e.g. '-35.3,149.15'), a back\\slash\nand a second line."
    assert spark.sql(f"SELECT {sql_quoted(text)} AS t").first().t == text


def test_comments_skip_columns_without_one_and_mark_test_tables():
    table, column = contracts.comment_statements("t", COMMENTED, "Daily data.", stands_in_for="prd.t")
    assert table.startswith("COMMENT ON TABLE t IS '") and "prd.t" in table and table.endswith("\n\nDaily data.'")
    assert column == "ALTER TABLE t ALTER COLUMN cell_key COMMENT 'Key in \\'lat,lon\\' format.'"
    assert contracts.comment_statements("t", COMMENTED, "Daily data.")[0] == "COMMENT ON TABLE t IS 'Daily data.'"


def test_create_table_stores_comments_once(spark):
    table = f"commented_{uuid.uuid4().hex}"
    assert contracts.create_table(spark, table, COMMENTED, "First.")
    assert not contracts.create_table(spark, table, COMMENTED, "Second.")
    described = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE TABLE {table}").collect()}
    assert described["cell_key"] == "Key in 'lat,lon' format."
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    assert detail["Comment"] == "First."


def test_observation_contract_has_42_columns():
    names = contracts.OBSERVATION_SCHEMA.names
    assert len(names) == 42
    assert names[:6] == ["cell_key", "date", "lat", "lon", "daily_rain", "daily_rain_source"]
    assert contracts.required_columns(contracts.OBSERVATION_SCHEMA) == [
        "cell_key",
        "date",
        "lat",
        "lon",
        "created_at",
        "updated_at",
    ]


def test_every_mismatch_is_reported():
    actual = StructType([StructField("distance", DoubleType()), StructField("place_id", StringType())])
    assert contracts.schema_mismatches(SMALL, SMALL) == []
    assert contracts.schema_mismatches(actual, SMALL) == [
        (0, "place_id", "string", "distance", "double"),
        (1, "distance", "double", "place_id", "string"),
    ]
    assert contracts.schema_mismatches(StructType(SMALL.fields[:1]), SMALL) == [(1, "distance", "double", None, None)]


def test_nullability_counts_only_on_request():
    nullable = StructType([StructField(f.name, f.dataType, True) for f in SMALL.fields])
    assert contracts.schema_mismatches(nullable, SMALL) == []
    assert len(contracts.schema_mismatches(nullable, SMALL, check_nullable=True)) == 1


def test_mismatch_frame(spark):
    frame = contracts.schema_mismatch_frame(spark, StructType(SMALL.fields[:1]), SMALL)
    assert [tuple(r) for r in frame.collect()] == [(1, "distance", "double", None, None)]


def test_absent_columns_are_named(spark):
    with pytest.raises(ValueError, match="state, longitude"):
        contracts.require_columns(spark.range(1), ["id", "state", "longitude"], "places")


def test_gate_fails_the_job_on_null_and_passes_complete_rows(spark):
    rows = spark.createDataFrame([("a", date(2024, 1, 1)), ("b", None)], "k string, d date")
    gated = contracts.enforce_not_null(rows, ["k", "d"])
    assert gated.schema["d"].dataType == rows.schema["d"].dataType
    with pytest.raises(PySparkException, match="NULL in required column 'd'"):
        gated.collect()
    assert contracts.enforce_not_null(rows, ["k"]).count() == 2
    assert {tuple(r) for r in contracts.null_counts(rows, ["k", "d"]).collect()} == {("k", 0), ("d", 1)}


def test_observation_comments_give_meaning_unit_and_codes(spark):
    table = f"observed_{uuid.uuid4().hex}"
    assert load_job.create_observation_table(spark, table)
    described = {r.col_name: r for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    for variable in fixed.DAILY_VARIABLES:
        assert described[variable].comment == fixed.VARIABLE_MEANINGS[variable]
        assert "code" in described[f"{variable}_source"].comment
    legend = described["Comment"].data_type
    assert all(f"{code} {meaning}" in legend for code, meaning in fixed.SOURCE_CODES.items())
