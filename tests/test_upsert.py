"""Upsert: the pure function, the table writer, and what a rerun does."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType, TimestampType

from daygrid.contracts import create_table
from daygrid.operators import layout as layouts
from daygrid.operators.upsert import PartitionBy, replace_table, upsert, upsert_table
from workload.queries import QUERIES

T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)
TARGET = StructType(
    [
        StructField("cell_key", StringType(), False),
        StructField("date", DateType(), False),
        StructField("rain", StringType()),
        StructField("temp", DoubleType()),
        StructField("created_at", TimestampType()),
        StructField("updated_at", TimestampType()),
    ]
)
SOURCE = "cell_key string, date date, rain string"
D1, D2, D3, D4 = (date(2024, month, 1) for month in (1, 2, 3, 4))


def stored(spark):
    return spark.createDataFrame(
        [("a", D1, "1", 10.0, T0, T0), ("a", D2, "2", 20.0, T0, T0), ("b", D1, "3", 30.0, None, T0)], TARGET
    )


def delivered(spark):
    return spark.createDataFrame([("a", D2, "5"), ("b", D1, None), ("c", D3, "7")], SOURCE)


EXPECTED = {
    ("a", D1, "1", 10.0, T0, T0),  # no match: as it was
    ("a", D2, "5", 20.0, T0, T1),  # match: delivered column and updated_at change, temp and created_at stay
    ("b", D1, None, 30.0, None, T1),  # a delivered NULL overwrites
    ("c", D3, "7", None, T1, T1),  # new: both times are the run's
}


def test_upsert(spark):
    after = upsert(stored(spark), delivered(spark), run_ts=T1)
    assert after.columns == TARGET.names
    assert [f.dataType for f in after.schema] == [f.dataType for f in TARGET]
    assert {tuple(r) for r in after.collect()} == EXPECTED


def test_absent_columns_of_a_row_keep_their_values(spark):
    source = delivered(spark).withColumns(
        {"temp": F.lit(99.0), "absent": F.when(F.col("cell_key") == "a", F.array(F.lit("rain"))).otherwise(F.array())}
    )
    after = {tuple(r)[:4] for r in upsert(stored(spark), source, run_ts=T1, absent="absent").collect()}
    assert after == {("a", D1, "1", 10.0), ("a", D2, "2", 99.0), ("b", D1, None, 99.0), ("c", D3, "7", 99.0)}


def test_unknown_columns_are_named(spark):
    with pytest.raises(ValueError, match="snow"):
        upsert(stored(spark), delivered(spark).withColumn("snow", F.lit("1")))
    with pytest.raises(ValueError, match="date"):
        upsert(stored(spark), delivered(spark).drop("date"))


def test_a_key_that_comes_twice_fails(spark):
    twice = delivered(spark).union(delivered(spark).limit(1))
    with pytest.raises(PySparkException, match="more than once: a, 2024-02-01"):
        upsert(stored(spark), twice, run_ts=T1).collect()


ROWS = st.dictionaries(
    st.tuples(st.sampled_from("abc"), st.integers(1, 9).map(lambda m: date(2024, m, 1))),
    st.one_of(st.none(), st.sampled_from(["x", "y"])),
    min_size=1,
)


@settings(max_examples=5, deadline=None)
@given(ROWS, ROWS)
def test_laws(spark, old, new):
    target = spark.createDataFrame([(*key, value, None, T0, T0) for key, value in old.items()], TARGET)
    source = spark.createDataFrame([(*key, value) for key, value in new.items()], SOURCE)
    once = {tuple(r) for r in upsert(target, source, run_ts=T1).collect()}
    again = {tuple(r) for r in upsert(upsert(target, source, run_ts=T1), source, run_ts=T2).collect()}
    assert {row[:5] for row in again} == {row[:5] for row in once}  # a rerun moves updated_at only
    assert {row[:3] for row in once} == {(*key, value) for key, value in {**old, **new}.items()}
    assert len(once) == len(old) + len(set(new) - set(old))


def new_table(spark, schema=TARGET, partition_by=None):
    table = f"t_{uuid.uuid4().hex}"
    create_table(spark, table, schema, partition_by=(partition_by or PartitionBy()).schema)
    return table


def test_table_upsert(spark):
    layout = PartitionBy.month()
    table = new_table(spark, partition_by=layout)
    first = upsert_table(spark, stored(spark).drop("created_at", "updated_at"), table, run_ts=T0, partition_by=layout)
    assert (first.incoming_rows, first.partitions) == (3, 2)
    second = upsert_table(spark, delivered(spark), table, run_ts=T1, partition_by=layout)
    assert (second.incoming_rows, second.partitions) == (3, 3)
    after = {tuple(r) for r in spark.table(table).drop("month").collect()}
    assert after == {row if row[0] != "b" else (*row[:4], T0, T1) for row in EXPECTED}


def test_untouched_partitions_are_not_rewritten(spark):
    layout = PartitionBy.month()
    table = new_table(spark, partition_by=layout)
    upsert_table(spark, stored(spark).drop("created_at", "updated_at"), table, run_ts=T0, partition_by=layout)

    def files(month):
        rows = spark.table(table).where(F.col("month") == month).select("_metadata.file_path").distinct()
        return {r.file_path for r in rows.collect()}

    january, february = files("2024-01"), files("2024-02")
    upsert_table(spark, spark.createDataFrame([("a", D2, "9")], SOURCE), table, run_ts=T1, partition_by=layout)
    assert files("2024-01") == january
    assert files("2024-02") != february
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_nothing_to_load_writes_nothing(spark):
    table = new_table(spark)
    result = upsert_table(spark, delivered(spark).where("false"), table, run_ts=T0)
    assert (result.incoming_rows, result.partitions) == (0, 0)
    assert spark.table(table).isEmpty()


def test_a_failing_source_leaves_the_table_alone(spark):
    table = new_table(spark)
    upsert_table(spark, delivered(spark), table, run_ts=T0)
    before = spark.table(table).collect()
    with pytest.raises(PySparkException, match="NULL in required column 'cell_key'"):
        upsert_table(spark, delivered(spark).withColumn("cell_key", F.lit(None).cast("string")), table, run_ts=T1)
    with pytest.raises(ValueError, match="more than once"):
        upsert_table(spark, delivered(spark).union(delivered(spark)), table, run_ts=T1)
    assert spark.table(table).collect() == before


def test_partitions_by_several_columns(spark):
    layout = PartitionBy({"year": F.date_format("date", "yyyy"), "part": F.pmod(F.xxhash64("cell_key"), F.lit(2))})
    table = new_table(spark, partition_by=layout)
    for run_ts, rows in ((T0, stored(spark).drop("created_at", "updated_at")), (T1, delivered(spark))):
        upsert_table(spark, rows, table, run_ts=run_ts, partition_by=layout)
    after = {tuple(r) for r in spark.table(table).drop("year", "part").collect()}
    assert after == {row if row[0] != "b" else (*row[:4], T0, T1) for row in EXPECTED}


def test_replace_table_counts_and_gates(spark):
    table = f"t_{uuid.uuid4().hex}"
    create_table(spark, table, TARGET)
    assert replace_table(stored(spark).select(*TARGET.names[::-1]), table, ["cell_key", "date"]) == 3
    assert replace_table(stored(spark).limit(1), table, ["cell_key", "date"]) == 1
    assert spark.table(table).count() == 1
    with pytest.raises(PySparkException, match="created_at"):
        replace_table(stored(spark), table, ["created_at"])


def test_a_new_cell_rewrites_only_its_bucket(spark):
    layout, table = PartitionBy.month_and_bucket(4), f"bucketed_{uuid.uuid4().hex}"
    create_table(spark, table, TARGET, "Months split by buckets of the key", layout.schema)
    days = (D1, D2, D3)
    first = spark.createDataFrame([(f"c{i}", day, "1") for i in range(12) for day in days], SOURCE)
    upsert_table(spark, first, table, run_ts=T1, partition_by=layout)
    before = set(spark.table(table).inputFiles())
    new = spark.createDataFrame([("new", day, "2") for day in days], SOURCE)
    assert upsert_table(spark, new, table, run_ts=T2, partition_by=layout).partitions == 3
    after = set(spark.table(table).inputFiles())
    bucket = layout.add_to(new).first()["bucket"]
    assert all(f"bucket={bucket}" in file for file in before ^ after) and before & after
    assert spark.table(table).count() == 39


def test_the_default_layout_has_buckets(spark):
    table = new_table(spark)
    assert list(PartitionBy().columns) == ["month", "bucket"]
    upsert_table(spark, stored(spark).drop("created_at", "updated_at"), table, run_ts=T0)
    upsert_table(spark, delivered(spark), table, run_ts=T1)
    after = {tuple(r) for r in spark.table(table).drop("month", "bucket").collect()}
    assert after == {row if row[0] != "b" else (*row[:4], T0, T1) for row in EXPECTED}


@pytest.mark.parametrize("rows, clusters", [(0, 8), (8_000_000, 8), (8_000_001, 9), (192_000_000, 192)])
def test_clusters_follow_the_rows(rows, clusters):
    layout = PartitionBy.clustered_for(rows)
    assert layout.clustering == ("cell_key", clusters) and list(layout.columns) == ["month"]


def test_no_task_of_the_stored_upsert_grows_with_the_table(spark, tmp_path, monkeypatch):
    """Ten times the rows of eight full clusters: ten times as many clusters, each about as full."""
    monkeypatch.setattr(layouts, "CLUSTER_ROWS", 20)
    begin, days = datetime(1999, 5, 1), 4
    lines = [(k, k, d, 1.0 * d, 10.0 * d, "A", "F", begin + timedelta(days=40 * d)) for k in range(400) for d in range(days)]
    schema = "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    after = QUERIES["obs_upsert_table"](spark, str(tmp_path))
    assert after.count() == 400 * days
    bucket = F.regexp_extract(F.input_file_name(), r"_(\d{5})\.c", 1)
    held = [r["count"] for r in after.groupBy(bucket.alias("bucket")).count().collect()]
    assert len(held) > 8 and max(held) < 400 * days / 8 / 2
    columns = ["cell_key", "date", "quantity", "flag", "line_no", "created_at", "updated_at"]
    expected = QUERIES["obs_upsert"](spark, str(tmp_path))
    assert sorted(map(str, after.select(columns).collect())) == sorted(map(str, expected.select(columns).collect()))
