"""The stored index of days: the same gaps as a scan, after any loads and rewrites, without reading observations."""

from __future__ import annotations

import random
import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from daygrid.contracts import create_table
from daygrid.operators import gaps, upsert
from daygrid.operators.day_index import DayIndex
from daygrid.operators.layout import PartitionBy
from daygrid.operators.upsert import replace_partitions, upsert_table
from tests.test_upsert import SOURCE, TARGET

BEGIN = date(2023, 12, 1)
KEYS = [f"c{i}" for i in range(4)]
LAYOUTS = {
    "months": PartitionBy.month,
    "buckets": lambda: PartitionBy.month_and_bucket(2),
    "clusters": lambda: PartitionBy.clustered(3),
}


def new(spark, layout):
    name = uuid.uuid4().hex
    index = DayIndex(f"days_{name}", layout)
    create_table(spark, f"rows_{name}", TARGET, partition_by=layout.schema, clustering=layout.clustering)
    assert index.create(spark) and not index.create(spark)
    return f"rows_{name}", index


def delivery(spark, pairs):
    return spark.createDataFrame([(key, BEGIN + timedelta(days=day), str(day)) for key, day in sorted(pairs)], SOURCE)


def ranges(spark):
    rows = [(key, BEGIN - timedelta(days=3), BEGIN + timedelta(days=130)) for key in [*KEYS, "never"]]
    return spark.createDataFrame(rows, "cell_key string, start_date date, end_date date")


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def check(spark, table, index):
    wanted, stored = ranges(spark), spark.table(table)
    assert index.differences(stored).count() == 0
    assert rows_of(index.gap_report(wanted)) == rows_of(gaps.gap_report(wanted, stored))
    assert rows_of(index.first_missing_date(wanted)) == rows_of(gaps.first_missing_date_by_spine(wanted, stored))
    assert rows_of(index.missing_days(wanted)) == rows_of(gaps.missing_days_by_spine(wanted, stored))


@pytest.mark.parametrize("name", LAYOUTS)
def test_any_sequence_of_loads_and_rewrites(spark, name):
    layout, draw = LAYOUTS[name](), random.Random(name)
    table, index = new(spark, layout)
    have = set()
    for turn in range(5):
        kind = draw.choice(["load", "load", "rewrite"]) if turn else "load"
        if kind == "load":
            start, many = draw.randrange(100), draw.randrange(1, 40)
            pairs = {(key, day) for key in draw.sample(KEYS, 2) for day in range(start, start + many) if draw.random() < 0.8}
            upsert_table(spark, delivery(spark, pairs), table, run_ts=datetime(2024, 2, 1 + turn), partition_by=layout, index=index)
            have |= pairs
        else:
            months = sorted({r.month for r in spark.table(table).select("month").distinct().collect()})
            month, emptied = draw.choice(months), draw.choice(months)
            inside = F.col("month") == month
            kept = spark.table(table).where(inside).where(F.xxhash64("cell_key", "date", F.lit(turn)) % 3 != 0).drop(*layout.columns)
            parts = spark.table(table).where(F.col("month").isin(month, emptied)).select(*layout.columns).distinct().collect()
            if emptied != month:
                kept = kept.where("true")
            replace_partitions(spark, kept, table, also=[tuple(p) for p in parts], partition_by=layout, index=index)
            have = {(r.cell_key, (r.date - BEGIN).days) for r in spark.table(table).collect()}
        stored = {(r.cell_key, (r.date - BEGIN).days) for r in spark.table(table).collect()}
        assert stored == have
        check(spark, table, index)
    grown = index.compact(spark, many=1)
    assert index.compact(spark, many=1) <= grown
    check(spark, table, index)
    spark.sql(f"TRUNCATE TABLE {index.table}")
    index.rebuild(spark.table(table))
    check(spark, table, index)


def test_the_plan_reads_no_observations(spark):
    layout = PartitionBy.month()
    table, index = new(spark, layout)
    upsert_table(spark, delivery(spark, {("c1", 3), ("c2", 40)}), table, partition_by=layout, index=index)
    cells = spark.createDataFrame([("c1", BEGIN), ("c3", BEGIN)], "cell_key string, backfill_from_date date")
    for df in (index.gap_report(ranges(spark)), index.fetch_ranges(cells, BEGIN + timedelta(days=50))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert index.table in plan and table not in plan


def test_a_load_reads_and_rewrites_nothing_of_the_index(spark):
    layout = PartitionBy.month()
    table, index = new(spark, layout)
    upsert_table(spark, delivery(spark, {("c1", 3), ("c2", 40)}), table, partition_by=layout, index=index)
    before = set(spark.table(index.table).inputFiles())
    for _ in range(2):  # a rerun adds the same masks again and changes nothing
        upsert_table(spark, delivery(spark, {("c1", 4), ("c2", 41)}), table, partition_by=layout, index=index)
        assert before < set(spark.table(index.table).inputFiles())
        check(spark, table, index)


def test_a_run_that_dies_leaves_days_out_and_a_rerun_repairs(spark, monkeypatch):
    layout = PartitionBy.month()
    table, index = new(spark, layout)
    upsert_table(spark, delivery(spark, {("c1", 3)}), table, partition_by=layout, index=index)

    def dies(self, rows):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(DayIndex, "add", dies)
        with pytest.raises(RuntimeError, match="lost"):
            upsert_table(spark, delivery(spark, {("c1", 4)}), table, partition_by=layout, index=index)
    found = index.differences(spark.table(table)).collect()
    assert len(found) == 1 and found[0].indexed & ~found[0].stored == 0  # nothing claimed that is not there
    upsert_table(spark, delivery(spark, {("c1", 4)}), table, partition_by=layout, index=index)
    check(spark, table, index)
    with monkeypatch.context() as broken:
        broken.setattr(DayIndex, "add", dies)
        with pytest.raises(RuntimeError, match="lost"):
            replace_partitions(spark, delivery(spark, {("c1", 4)}).selectExpr("cell_key", "date", "rain", *_STAMPS), table, partition_by=layout, index=index)
    assert all(r.indexed & ~r.stored == 0 for r in index.differences(spark.table(table)).collect())


_STAMPS = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in TARGET.fields if f.name not in ("cell_key", "date", "rain")]


def test_a_clustered_merge_does_not_move_the_table(spark):
    layout = LAYOUTS["clusters"]()
    table, _ = new(spark, layout)
    upsert_table(spark, delivery(spark, {(k, d) for k in KEYS for d in range(40)}), table, partition_by=layout)
    more = layout.add_to(delivery(spark, {(k, d) for k in KEYS for d in range(20, 60)}))
    touched = upsert._touched_partitions(more, upsert.KEYS, ["month"])
    plan = upsert.merged_rows(spark, more, table, touched, partition_by=layout)._jdf.queryExecution().executedPlan().toString()
    join = plan.index("SortMergeJoin")
    left, right = plan[join:].split("\n      :- ")[1].split("\n      +- ")
    assert table in left and "Exchange" not in left and "Bucketed: true" in left
    assert right.count("Exchange hashpartitioning") == 1 and "Exchange" not in plan[:join]
    upsert_table(spark, delivery(spark, {(k, d) for k in KEYS for d in range(20, 60)}), table, partition_by=layout)
    assert spark.table(table).count() == 60 * len(KEYS)


def test_gap_intervals(spark):
    draw = random.Random(3)
    rows, wanted, expected = [], [], []
    for key, chance in (("dense", 0.98), ("half", 0.5), ("sparse", 0.02), ("none", 0.0), ("all", 1.0)):
        wanted.append((key, BEGIN, BEGIN + timedelta(days=400)))
        missing = []
        for n in range(401):
            if draw.random() < chance:
                rows.append((key, BEGIN + timedelta(days=n)))
            else:
                missing.append(BEGIN + timedelta(days=n))
        for day in missing:
            if expected and expected[-1][0] == key and expected[-1][2] == day - timedelta(days=1):
                expected[-1] = (key, expected[-1][1], day)
            else:
                expected.append((key, day, day))
    frame = spark.createDataFrame(wanted, "cell_key string, start_date date, end_date date")
    stored = spark.createDataFrame(rows, "cell_key string, date date")
    assert rows_of(gaps.gap_intervals(gaps.missing_blocks(frame, stored))) == sorted(expected)
