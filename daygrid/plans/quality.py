"""Quality suites: many checks, few scans, one report."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException, ArithmeticException, DateTimeException, NumberFormatException, SparkRuntimeException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daygrid import fixed_values as fixed
from daygrid.contracts import MAPPING_SCHEMA, OBSERVATION_SCHEMA, schema_mismatch_frame
from daygrid.functions.geo import Grid
from daygrid.operators import checks as rules_
from daygrid.operators.gaps import gap_report, key_ranges

SAMPLE_ROWS = 20
#: What a check's own plan or data can raise, as opposed to a lost cluster.
_OWN_FAULTS = (AnalysisException, ArithmeticException, DateTimeException, NumberFormatException, SparkRuntimeException)


@dataclass(frozen=True)
class Check:
    """Rows of ``base`` that meet ``failing`` are violations. Checks that hold the same ``base`` are counted together.

    ``measure`` replaces the count where a check judges the base as a whole; ``failure`` then says what is wrong. When
    this check fails, the checks numbered in ``skips`` would only repeat it and are left out.
    """

    number: str
    title: str
    base: DataFrame
    failing: Column | None = None
    columns: Sequence[str] = ()
    order_by: tuple[Column, ...] = ()
    measure: Column | None = None
    failure: str | None = None
    skips: tuple[str, ...] = ()

    def violations(self) -> DataFrame:
        rows = self.base if self.failing is None else self.base.where(self.failing)
        return rows.select(*self.columns) if self.columns else rows

    def sample(self, rows: int = SAMPLE_ROWS) -> DataFrame:
        """The rows a person looks at. Sorting stops at the limit, so the full set is neither sorted nor moved."""
        found = self.violations()
        return (found.orderBy(*self.order_by) if self.order_by else found).limit(rows)

    def _count(self) -> Column:
        if self.measure is not None:
            return self.measure
        return F.count(F.lit(1)) if self.failing is None else F.count_if(self.failing)


def report(checks: Sequence[Check]) -> DataFrame:
    """``check_no, title, violations, status``, one row per check, as one plan.

    Checks over one base share its scan and aggregate. Violating rows are counted where they are; none is collected.
    """
    groups: dict[int, list[Check]] = {}
    for check in checks:
        groups.setdefault(id(check.base), []).append(check)
    parts = []
    for group in groups.values():
        counted = group[0].base.agg(*[check._count().cast("long").alias(f"_{i}") for i, check in enumerate(group)])
        rows = [
            F.struct(
                F.lit(check.number).alias("check_no"),
                F.lit(check.title).alias("title"),
                F.col(f"_{i}").alias("violations"),
            )
            for i, check in enumerate(group)
        ]
        parts.append(counted.select(F.inline(F.array(*rows))))
    status = F.when(F.col("violations") == 0, "PASS").otherwise("FAIL")
    return reduce(DataFrame.unionByName, parts).withColumn("status", status)


class QualityGate:
    """Collects failures of all checks and raises once, at the end."""

    def __init__(self, show: Callable[[DataFrame], None] | None = None) -> None:
        self.messages: list[str] = []
        self._show = show

    def add(self, message: str) -> None:
        self.messages.append(message)

    def judge(self, violations: DataFrame, title: str, sample_rows: int = SAMPLE_ROWS) -> int:
        """Judge one set of violations. Rows are counted on the cluster; only a sample is shown."""
        count = violations.count()
        self._record(title, count, lambda: violations.limit(sample_rows))
        return count

    def run(self, checks: Sequence[Check]) -> list[tuple[str, str, int | None]]:
        """Run a suite in one job and record every failure in the suite's order.

        A check that cannot run at all (say, an absent column) must not hide the others. It is found by analysis alone,
        recorded as failed with ``None`` violations, and the others still share one job. Only if that job too fails by a fault of a
        check, which then lies in the data, does each check run alone. Any other failure, such as a lost cluster, is raised.
        """
        try:
            counted = {row["check_no"]: row["violations"] for row in report(checks).collect()}
            errors: dict[str, str] = {}
        except _OWN_FAULTS:
            counted, errors = self._run_apart(checks)
        skipped = {number for check in checks if counted.get(check.number) for number in check.skips}
        results = []
        for check in checks:
            if check.number in skipped:
                continue
            count = counted.get(check.number)
            label = f"Check {check.number} - {check.title}"
            if check.number in errors:
                self.add(f"{label} — could not run: {errors[check.number]}")
            elif count and check.failure:
                self.add(f"{label} — {check.failure}")
            else:
                self._record(label, count, check.sample)
            results.append((check.number, check.title, count))
        return results

    def _run_apart(self, checks: Sequence[Check]) -> tuple[dict[str, int], dict[str, str]]:
        counted, errors, sound = {}, {}, []
        for check in checks:
            try:
                report([check])
                sound.append(check)
            except AnalysisException as failure:
                errors[check.number] = str(failure).splitlines()[0]
        if errors:
            try:
                return {row["check_no"]: row["violations"] for row in report(sound).collect()} if sound else {}, errors
            except _OWN_FAULTS:
                pass
        for check in sound:
            try:
                counted[check.number] = report([check]).first()["violations"]
            except _OWN_FAULTS as failure:
                errors[check.number] = str(failure).splitlines()[0]
        return counted, errors

    def _record(self, title: str, count: int, sample: Callable[[], DataFrame]) -> None:
        if count == 0:
            print(f"PASS: {title}")
            return
        self.add(fixed.VIOLATIONS_TEXT.format(title=title, count=count))
        print(self.messages[-1])
        if self._show is not None:
            self._show(sample())

    def raise_if_failed(self) -> None:
        if self.messages:
            raise RuntimeError(
                fixed.FAILED_TEXT.format(count=len(self.messages), messages="\n\t".join(self.messages))
            )
        print(fixed.PASSED_TEXT)


def mapping_suite(
    spark: SparkSession,
    mapping: DataFrame,
    places: DataFrame,
    grid: Grid = Grid(),
    max_distance_km: float = fixed.MAX_DISTANCE_KM,
    backfill_from: date = fixed.BACKFILL_START,
    schema: StructType = MAPPING_SCHEMA,
) -> list[Check]:
    """The eight checks on a mapping table. Seven counts come from one scan each of the mapping and of the places."""
    by_id = (F.col("place_id"),)
    return [
        Check(
            "1",
            "Row Count",
            mapping,
            measure=F.when(F.count(F.lit(1)) == 0, 1).otherwise(0),
            failure="output table is empty",
            skips=("1a", "1b"),
        ),
        Check("1a", "Rows whose place is not in the places list", rules_.extra_ids(mapping, places), order_by=by_id),
        Check("1b", "Places without a mapping row", rules_.missing_ids(mapping, places), order_by=by_id),
        Check("2", "Schema", schema_mismatch_frame(spark, mapping.schema, schema), order_by=(F.col("position"),)),
        Check(
            "3",
            "Place Id Uniqueness",
            rules_.duplicate_ids(mapping),
            order_by=(F.col("duplicate_count").desc(), F.col("place_id")),
        ),
        Check(
            "4",
            f"Distance above {max_distance_km} km",
            mapping,
            rules_.too_far(max_distance_km),
            ("place_id", "place_latlon", "cell_latlon", "cell_key", "distance"),
            (F.col("distance").desc(), F.col("place_id")),
        ),
        Check("5", "Places List Validity", places, rules_.incomplete(), fixed.PLACE_COLUMNS, by_id),
        Check(
            "6",
            "Cells outside the grid",
            mapping,
            rules_.cell_outside(grid),
            ("place_id", "cell_latlon", "cell_key"),
            by_id,
        ),
        Check(
            "7",
            "Places outside the grid",
            places,
            rules_.place_outside(grid),
            ("place_id", "place_name", "latitude", "longitude"),
            by_id,
        ),
        Check(
            "8",
            f"Start date other than {backfill_from}",
            mapping,
            rules_.wrong_date(expected=backfill_from),
            ("place_id", "backfill_from_date"),
            by_id,
        ),
    ]


def load_suite(
    spark: SparkSession,
    mapping: DataFrame,
    observations: DataFrame,
    until: date,
    rules: rules_.ObservationRules | None = None,
    schema: StructType = OBSERVATION_SCHEMA,
    key: str = "cell_key",
) -> list[Check]:
    """The six checks on an observation table, ``until`` being the last day that must be there.

    Value ranges, unreadable values, empty values and timestamps are conditions over one aggregate: one scan, one
    shuffle of one row per key and task.
    """
    rules = rules or rules_.ObservationRules()
    in_range, readable, filled = rules.range_counts(), rules.unparseable_counts(), rules.null_counts()
    timed = rules.time_counts()
    per_key = rules_.count_per_key(observations, rules, {**in_range, **readable, **filled, **timed}, key)
    by_key = (F.col(key),)

    def counted(number: str, title: str, counts: dict[str, Column]) -> Check:
        return Check(number, title, per_key, rules_.breaking(counts), (key, *counts), by_key)

    gaps = gap_report(key_ranges(mapping, until, key), observations, key)
    return [
        Check("1", "Location Coverage", rules_.uncovered_keys(mapping, observations, key), order_by=by_key),
        Check(
            "2", "Schema", schema_mismatch_frame(spark, observations.schema, schema), order_by=(F.col("position"),)
        ),
        Check(
            "3", "Date Completeness", gaps, order_by=(F.col("missing_date_count").desc(), F.col(key))
        ),
        counted("4", "Value Ranges", in_range),
        counted("4a", "Unreadable Values", readable),
        counted("5", "Null Keys", filled),
        counted("6", "Timestamps", timed),
    ]
