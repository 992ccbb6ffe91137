"""Keyed upsert with audit timestamps, as a pure DataFrame function and as a partition-wise table writer."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daygrid.contracts import enforce_not_null
from daygrid.functions.text import sql_quoted
from daygrid.operators.day_index import DayIndex
from daygrid.operators.layout import PartitionBy, overwriting
from daygrid.session import delete_work_folder, new_work_folder

KEYS = ("cell_key", "date")
REPEATED_KEY = "upsert source holds a key more than once"
# A table clustered by the cell alone may serve a join by cell and day.
_CLUSTER_SETTINGS = {
    "spark.sql.sources.bucketing.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def run_time(run_ts: datetime | Column | None) -> Column:
    """The run's timestamp: one value for the whole run, or the query's own start time."""
    if run_ts is None:
        return F.current_timestamp()
    return run_ts if isinstance(run_ts, Column) else F.lit(run_ts)


def repeated_keys(source: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys that come more than once. Reads key columns only and combines on the map side."""
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def _packed(source: DataFrame, keys: Sequence[str], data: Sequence[str], check_keys: bool) -> DataFrame:
    """The data columns as one struct per key, failing the job on a key that comes twice.

    The count combines on the map side, so even a key that comes a billion times reaches its reducer as a few rows.
    """
    row = F.struct(*data)
    if not check_keys:
        return source.select(*keys, row.alias("_incoming"))
    counted = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"), F.any_value(row).alias("_row"))
    shown = F.concat_ws(", ", *[F.coalesce(F.col(key).cast("string"), F.lit("NULL")) for key in keys])
    failure = F.raise_error(F.concat(F.lit(f"{REPEATED_KEY}: "), shown))
    return counted.select(*keys, F.when(F.col("_copies") == 1, F.col("_row")).otherwise(failure).alias("_incoming"))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = KEYS,
    run_ts: datetime | Column | None = None,
    created: str = "created_at",
    updated: str = "updated_at",
    absent: str | None = None,
    check_keys: bool = True,
) -> DataFrame:
    """The target after the upsert, with the target's columns.

    Matched rows take every incoming data column, NULLs included, and the run's time as ``updated``; ``created``
    stays. New rows get the run's time in both. Target columns the source lacks stay, or are NULL on new rows. Target
    rows without a match stay as they are. ``absent`` may name a source column that lists, row by row, data columns its
    delivery did not have; they count as columns the source lacks, for that row.

    A match is told by the packed row itself being there, not by any of its values, so an incoming NULL overwrites.
    A key that comes twice in the source fails the job; ``check_keys=False`` is for a source known to be unique, whose
    wide rows then go straight to the join. Otherwise the aggregate that checks shares its partitioning with the join.
    """
    data = [name for name in source.columns if name not in (*keys, created, updated, absent)]
    unknown = [name for name in (*keys, *data) if name not in target.columns]
    unkeyed = [name for name in keys if name not in source.columns]
    if unknown or unkeyed:
        raise ValueError(f"upsert columns unknown to the target: {unknown}; keys absent from the source: {unkeyed}")

    stored = target.select(*keys, F.struct(*[name for name in target.columns if name not in keys]).alias("_stored"))
    packed = _packed(source, keys, [*data, absent] if absent else data, check_keys)
    joined = stored.join(packed, list(keys), "full_outer").withColumn("_now", run_time(run_ts))

    def result(name: str) -> str:
        if name in keys:
            return f"`{name}`"
        if name == created:
            return f"CASE WHEN _stored IS NOT NULL THEN _stored.`{name}` ELSE _now END AS `{name}`"
        if name == updated:
            return f"CASE WHEN _incoming IS NOT NULL THEN _now ELSE _stored.`{name}` END AS `{name}`"
        if name not in data:
            return f"_stored.`{name}` AS `{name}`"
        taken = "_incoming IS NOT NULL"
        if absent:
            taken += f" AND NOT array_contains(_incoming.`{absent}`, {sql_quoted(name)})"
        new = f"CAST(_incoming.`{name}` AS {target.schema[name].dataType.simpleString()})"
        return f"CASE WHEN {taken} THEN {new} ELSE _stored.`{name}` END AS `{name}`"

    return joined.selectExpr(*[result(name) for name in target.columns])


@dataclass(frozen=True)
class UpsertResult:
    incoming_rows: int
    partitions: int


def upsert_table(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    keys: Sequence[str] = KEYS,
    run_ts: datetime | Column | None = None,
    required: Sequence[str] = KEYS,
    partition_by: PartitionBy | None = None,
    index: DayIndex | None = None,
) -> UpsertResult:
    """Upsert ``source`` into a partitioned table; returns the number of incoming rows. No rows, no write.

    1. The source is written once to the shared folder. That cuts its lineage (parsing is not repeated, and a lost
       executor re-reads files instead of recomputing), counts it on the way and fails on a NULL required column.
    2. The partitions it touches are listed. That list is as long as the table has partitions, not rows.
    3. Only those partitions are read, joined and overwritten. Each is rebalanced by size, so a partition that holds
       much of the data is written by several tasks and a small one does not leave many files.

    Use a table, never a bare path, as the target: Spark lets a table be read while its partitions are overwritten in
    dynamic mode, but deletes a path before reading it. The overwrite is atomic per partition at best, not across
    partitions; a rerun with the same source repairs a run that died while committing. ``index`` is told of the
    delivered days once they are stored.
    """
    partition_by = partition_by or PartitionBy()
    staged_at = new_work_folder(spark, "upsert")
    seen = Observation("incoming")
    staged = enforce_not_null(partition_by.add_to(source), [*required, *partition_by.columns])
    staged.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(staged_at)
    try:
        incoming = spark.read.schema(staged.schema).parquet(staged_at)
        touched = merge_staged(spark, incoming, table, keys, run_ts, partition_by, index=index)
        return UpsertResult(seen.get["rows"], touched)
    finally:
        delete_work_folder(spark, staged_at)


def merge_staged(
    spark: SparkSession,
    incoming: DataFrame,
    table: str,
    keys: Sequence[str] = KEYS,
    run_ts: datetime | Column | None = None,
    partition_by: PartitionBy | None = None,
    absent: str | None = None,
    index: DayIndex | None = None,
) -> int:
    """Steps 2 and 3 of ``upsert_table`` for rows that are stored already; returns the number of partitions touched.

    Stored rows are cheap to look at twice, so the keys are checked from their own columns before the wide rows move.
    """
    partition_by = partition_by or PartitionBy()
    names = list(partition_by.columns)
    incoming = partition_by.add_to(incoming)
    touched = _touched_partitions(incoming, keys, names)
    if not touched:
        return 0
    rows = merged_rows(spark, incoming, table, touched, keys, run_ts, partition_by, absent)
    rows.sortWithinPartitions(*names, *keys).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)
    if index:
        index.add(incoming)  # only now: the index never has a day that the table lacks
    return len(touched)


def merged_rows(
    spark: SparkSession,
    incoming: DataFrame,
    table: str,
    touched: list[tuple],
    keys: Sequence[str] = KEYS,
    run_ts: datetime | Column | None = None,
    partition_by: PartitionBy | None = None,
    absent: str | None = None,
) -> DataFrame:
    """What the ``touched`` partitions hold after the upsert, dealt out as it is to be written.

    In a clustered layout the table's own clusters deal out the join, so the stored rows are not moved. Otherwise both
    sides are shuffled, and the result is rebalanced by size.
    """
    partition_by = partition_by or PartitionBy()
    names = list(partition_by.columns)
    clustered = {**_CLUSTER_SETTINGS, "spark.sql.shuffle.partitions": str(partition_by.clusters)}
    own = overwriting(spark, clustered if partition_by.clusters else {})
    target = partition_by.only(own.table(table), touched)
    merged = upsert(target, incoming, [*keys, *names], run_ts, absent=absent, check_keys=False)
    return merged if partition_by.clusters else merged.hint("rebalance", *names)


def _touched_partitions(incoming: DataFrame, keys: Sequence[str], names: Sequence[str]) -> list[tuple]:
    """The partitions of the incoming rows; fails if a key comes twice. One pass over the key columns answers both."""
    copies = incoming.groupBy(*keys, *names).agg(F.count(F.lit(1)).alias("copies"))
    found = copies.agg(
        F.collect_set(F.struct(*names)).alias("touched"), F.max(F.struct("copies", *keys)).alias("most")
    ).first()
    if found["touched"] and found["most"]["copies"] > 1:
        raise ValueError(f"{REPEATED_KEY}: {', '.join(str(found['most'][key]) for key in keys)}")
    return [tuple(partition) for partition in found["touched"]]


def replace_partitions(
    spark: SparkSession,
    rows: DataFrame,
    table: str,
    also: Sequence[tuple] = (),
    required: Sequence[str] = KEYS,
    partition_by: PartitionBy | None = None,
    index: DayIndex | None = None,
) -> int:
    """Rewrite whole partitions: those of ``rows``, and the listed ones in ``also``; returns how many.

    ``rows`` is all that these partitions hold afterwards, so a listed partition without rows is emptied. The days of
    rewritten partitions leave the index first and come back from the rows written.
    """
    partition_by = partition_by or PartitionBy()
    names = list(partition_by.columns)
    staged_at = new_work_folder(spark, "rewrite")
    staged = enforce_not_null(partition_by.add_to(rows), [*required, *names])
    staged.write.parquet(staged_at)
    try:
        own = overwriting(spark)
        stored = own.read.schema(staged.schema).parquet(staged_at)
        written = {tuple(row) for row in stored.select(*names).distinct().collect()}  # as many as there are partitions
        touched = sorted(written | {tuple(partition) for partition in also})
        if not touched:
            return 0
        if index:
            index.clear(spark, touched)
        columns = own.table(table).columns
        stored.select(*columns).hint("rebalance", *names).write.insertInto(table, overwrite=True)
        data = ", ".join(f"`{name}`" for name in columns if name not in names)
        for partition in touched:
            if partition not in written:
                place = ", ".join(f"{name} = {sql_quoted(value)}" for name, value in zip(names, partition))
                own.sql(f"INSERT OVERWRITE {table} PARTITION ({place}) SELECT {data} FROM {{none}}", none=stored.limit(0))
        spark.catalog.refreshTable(table)
        if index:
            index.add(spark.read.schema(staged.schema).parquet(staged_at))
        return len(touched)
    finally:
        delete_work_folder(spark, staged_at)


def replace_table(df: DataFrame, table: str, required: Sequence[str]) -> int:
    """Rebuild a table from scratch, columns by position, and return its row count without a second scan."""
    spark = df.sparkSession
    written = Observation("written")
    ordered = df.select(*spark.table(table).columns)
    gated = enforce_not_null(ordered, required).observe(written, F.count(F.lit(1)).alias("rows"))
    gated.write.option("partitionOverwriteMode", "static").insertInto(table, overwrite=True)
    return written.get["rows"]
