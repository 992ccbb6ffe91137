"""Plan fetches and load landed responses for all locations at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid import fixed_values as fixed
from daygrid.contracts import OBSERVATION_SCHEMA, create_table
from daygrid.operators import gaps
from daygrid.operators.day_index import DayIndex
from daygrid.operators.layout import PartitionBy
from daygrid.operators.mapping import grid_cells
from daygrid.operators.outcomes import ACCEPTED, fetch_outcomes, run_summary
from daygrid.operators.upsert import KEYS, merge_staged, repeated_keys
from daygrid.session import delete_work_folder, new_work_folder
from daygrid.sources import responses

TABLE_COMMENT = (
    "Daily observations per grid cell, as delivered. The trailing window is loaded again on every run. Source codes: "
    + "; ".join(f"{code} {meaning}" for code, meaning in fixed.SOURCE_CODES.items())
    + "."
)

# Every column a response may deliver for the observation table, under the response's own names.
RESPONSE_COLUMNS = (
    "latitude",
    "longitude",
    "YYYY-MM-DD",
    *[name for variable in fixed.DAILY_VARIABLES for name in (variable, f"{variable}_source")],
)
_STAMPS = ("created_at", "updated_at")
UNANSWERED = "planned, but nothing came back"


def create_observation_table(
    spark: SparkSession,
    table: str,
    partition_by: PartitionBy | None = None,
    stands_in_for: str | None = None,
    location: str | None = None,
) -> bool:
    """A layout other than the default is chosen here once, and then passed to every load too."""
    partition_by = partition_by or PartitionBy()
    return create_table(
        spark, table, OBSERVATION_SCHEMA, TABLE_COMMENT, partition_by.schema, stands_in_for, location,
        clustering=partition_by.clustering,
    )


def plan_fetches(
    spark: SparkSession, mapping_table: str, table: str, run_date: date, trial: bool = False, index: DayIndex | None = None
) -> DataFrame:
    """The requests of a run, one per cell. A trial run takes the first few cells and a short period.

    With an ``index`` that the loads keep up to date, no observation is read.
    """
    cells = grid_cells(spark.table(mapping_table))
    if trial:
        cells = gaps.trial_slice(cells)
    cap = fixed.TEST_MODE_DAYS if trial else None
    if index:
        ranges = index.fetch_ranges(cells, run_date, cap_days=cap)
    else:
        ranges = gaps.fetch_ranges(cells, spark.table(table), run_date, cap_days=cap)
    return gaps.fetch_requests(ranges, run_date)


@dataclass(frozen=True)
class LoadResult:
    rows_upserted: int
    locations: int
    failed_locations: int
    failed: DataFrame
    """``cell_key, problem, rows`` of everything refused. It grows with the input and stays on the cluster until ``close``."""
    failed_at: str = ""

    def close(self) -> None:
        """Delete the stored ``failed`` rows; it cannot be read afterwards."""
        if self.failed_at:
            delete_work_folder(self.failed.sparkSession, self.failed_at)

    def raise_if_failed(self, shown: int = 20) -> None:
        """Report the refused locations of a finished load. The good ones are stored by then."""
        if not self.failed_locations:
            return
        sample = self.failed.orderBy("cell_key", "problem").limit(shown).collect()
        lines = "".join(f"\n  key={row['cell_key']}: {row['problem']}" for row in sample)
        problems = self.failed.count()
        if problems > len(sample):
            lines += f"\n  (the first {len(sample)} of {problems} problems; all of them are in `failed`)"
        raise RuntimeError(f"{self.failed_locations} location(s) failed; a rerun fetches what is missing.{lines}")


def load_records(
    spark: SparkSession,
    records: DataFrame,
    table: str,
    run_ts: datetime | Column | None = None,
    partition_by: PartitionBy | None = None,
    wanted: Sequence[str] = RESPONSE_COLUMNS,
    newest_by: str | None = None,
    failed_before: DataFrame | None = None,
    answered: DataFrame | None = None,
    index: DayIndex | None = None,
) -> LoadResult:
    """Normalise records, refuse the bad ones and upsert the rest.

    A bad location does not stop the others: its rows are refused with a reason and everything else is loaded. Parsing
    is the costly part and feeds the upsert and the report, so its result is written once to the shared folder, where
    a lost executor finds it again. A column that a response does not deliver keeps its stored values.

    ``newest_by`` names a record column that orders deliveries: when several hold the same day of a cell, each column
    is taken from the newest one that has it, as if they were loaded one by one. Without it the location is refused.
    ``failed_before`` (``cell_key, problem``) names locations that never got as far as a response to parse, and
    ``answered`` (``cell_key``) all that the summary is to count, with records or without. ``index`` is told of the days
    that were stored.
    """
    parsed_at, failed_at = new_work_folder(spark, "parsed"), new_work_folder(spark, "refused")
    placed = F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("cell_key").isNotNull()
    judged = responses.normalise(records, wanted).withColumn(
        "problem", F.coalesce("problem", F.when(~placed, "a row lacks its key or position"))
    )
    try:
        judged.write.parquet(parsed_at)
        parsed = spark.read.schema(judged.schema).parquet(parsed_at)
        doubled = repeated_keys(responses.accepted(parsed))
        any_doubled = doubled.first() is not None
        if any_doubled and not newest_by:
            parsed = _refuse_doubled(parsed, doubled)

        failed = responses.refused(parsed).select("cell_key", "problem")
        if failed_before is not None:
            failed = failed.unionByName(failed_before.select("cell_key", "problem"))
        failed = failed.groupBy("cell_key", "problem").agg(F.count(F.lit(1)).alias("rows"))
        failed.write.parquet(failed_at)
        failed = spark.read.schema(failed.schema).parquet(failed_at)

        incoming = responses.accepted(parsed)
        data = [name for name in OBSERVATION_SCHEMA.names if name not in (*KEYS, *_STAMPS)]
        if any_doubled and newest_by:
            incoming = _newest_delivery(incoming, doubled, newest_by, data)
        rows = incoming.select(*KEYS, *data, "absent")
        merge_staged(spark, rows, table, run_ts=run_ts, partition_by=partition_by, absent="absent", index=index)

        stored, refused = F.col("problem").isNull().cast("long").alias("stored"), F.lit(0).alias("refused")
        per_location = parsed.select("cell_key", stored, refused).unionByName(
            failed.select("cell_key", F.lit(0).cast("long").alias("stored"), F.lit(1).alias("refused"))
        )
        if answered is not None:
            per_location = per_location.unionByName(
                answered.select("cell_key", F.lit(0).cast("long").alias("stored"), refused)
            )
        per_location = per_location.groupBy("cell_key").agg(F.sum("stored").alias("stored"), F.max("refused").alias("refused"))
        totals = run_summary(per_location, F.col("refused") > 0, F.col("stored")).first()
    except BaseException:
        delete_work_folder(spark, failed_at)
        raise
    finally:
        delete_work_folder(spark, parsed_at)
    return LoadResult(totals["rows_upserted"], totals["locations"], totals["failed_locations"], failed, failed_at)


def _refuse_doubled(parsed: DataFrame, doubled: DataFrame) -> DataFrame:
    """All rows of a location that delivers a day twice get that as their problem."""
    reason = F.concat(F.lit("a day comes more than once: "), F.min("date").cast("string"))
    bad = doubled.groupBy("cell_key").agg(reason.alias("_doubled"))
    joined = parsed.join(bad, "cell_key", "left")
    return joined.withColumn("problem", F.coalesce("problem", "_doubled")).select(*parsed.columns)


def _newest_delivery(incoming: DataFrame, doubled: DataFrame, newest_by: str, data: Sequence[str]) -> DataFrame:
    """One row per key: each column from the newest delivery that has it. Keys that come once pass as they are."""
    incoming = incoming.select(*KEYS, *data, "absent", newest_by)
    once = incoming.join(doubled, list(KEYS), "left_anti").select(*KEYS, *data, "absent")
    # Within one delivery the largest row counts.
    rows = incoming.join(doubled.select(*KEYS), list(KEYS)).withColumn("_order", F.struct(newest_by, *data))
    has = {name: ~F.array_contains("absent", name) for name in data}
    picked = rows.groupBy(*KEYS).agg(
        *[F.max_by(name, F.when(has[name], F.col("_order"))).alias(name) for name in data],
        F.array_compact(F.array(*[F.when(~F.bool_or(has[name]), F.lit(name)) for name in data])).alias("absent"),
    )
    return once.unionByName(picked)


def load_landed_files(
    spark: SparkSession,
    path: str,
    table: str,
    run_ts: datetime | Column | None = None,
    partition_by: PartitionBy | None = None,
    whole_file_bytes: int = responses.WHOLE_FILE_BYTES,
    requests: DataFrame | None = None,
    index: DayIndex | None = None,
) -> LoadResult:
    """Load every response file under ``path/cell_key=<key>/``; ``requests`` are those planned, as in ``load_attempts``."""
    records = responses.read_landed(spark, path, RESPONSE_COLUMNS, whole_file_bytes=whole_file_bytes)
    answered = responses.landed_files(spark, path).select("cell_key").distinct()
    failed = _unanswered(requests, answered) if requests is not None else None
    return load_records(
        spark, records, table, run_ts, partition_by, newest_by="landed", failed_before=failed, answered=answered, index=index
    )


def _unanswered(requests: DataFrame, answered: DataFrame) -> DataFrame:
    """``cell_key, problem`` of every planned location that nothing came back for."""
    planned = requests.select("cell_key").distinct()
    return planned.join(answered, "cell_key", "left_anti").select("cell_key", F.lit(UNANSWERED).alias("problem"))


def load_attempts(
    spark: SparkSession,
    attempts: DataFrame,
    table: str,
    run_ts: datetime | Column | None = None,
    partition_by: PartitionBy | None = None,
    requests: DataFrame | None = None,
    index: DayIndex | None = None,
) -> LoadResult:
    """Load a log of fetch attempts: ``cell_key, attempt, status, body``.

    The deciding attempt of each location is found first; only bodies of accepted attempts are parsed. ``requests``
    (``cell_key``) are those planned: a location among them that the log does not have has failed.
    """
    judged = responses.judge_bodies(attempts)
    outcomes = fetch_outcomes(judged.withColumn("body_ok", F.col("problem").isNull()), ["cell_key"])
    is_accepted = F.col("outcome") == ACCEPTED
    chosen = outcomes.where(is_accepted).select("cell_key", F.col("attempts_used").alias("attempt"))
    # An attempt that was logged twice is one attempt; with two different bodies its location is refused below.
    bodies = attempts.where(F.col("status") == 200).join(chosen, ["cell_key", "attempt"])
    bodies = bodies.dropDuplicates(["cell_key", "attempt", "body"])
    status = F.coalesce(F.col("last_status").cast("string"), F.lit("none"))
    failed = outcomes.where(~is_accepted).select(
        "cell_key", F.concat("outcome", F.lit(", status "), status).alias("problem")
    )
    records = responses.split_bodies(bodies.select("cell_key", "body"), RESPONSE_COLUMNS)
    answered = attempts.select("cell_key").distinct()
    if requests is not None:
        failed = failed.unionByName(_unanswered(requests, answered))
    return load_records(spark, records, table, run_ts, partition_by, failed_before=failed, answered=answered, index=index)
