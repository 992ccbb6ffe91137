"""What a log of fetch attempts means: outcome per request, early stop of a run, totals of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrid import fixed_values as fixed

ACCEPTED = "accepted"
INVALID_BODY = "invalid_body"
CLIENT_ERROR = "client_error"
EXHAUSTED = "exhausted"
PENDING = "pending"

# Positions of a run that are scanned by one task. Bounds the rows of a window partition.
CHUNK = 65_536


def fetch_outcomes(
    attempts: DataFrame,
    request: Sequence[str],
    attempt: str = "attempt",
    status: str = "status",
    body_ok: str = "body_ok",
    max_attempts: int = fixed.MAX_ATTEMPTS,
) -> DataFrame:
    """One row per request: ``outcome``, the deciding attempt number and its status.

    The first answer of 200 or 4xx decides, and later attempts do not count: 200 with a good body is accepted, with a
    bad one refused without retry, 4xx fails at once. Anything else, a NULL status (no connection) included, is
    retried; after ``max_attempts`` the last error stands, before that the request is pending.

    Attempt, status and verdict travel packed in one number (attempt, 4 digits of status, 1 digit of verdict), so the
    whole rule is a hash aggregate with map-side combining: no sort, no window.
    """
    in_budget = F.col(attempt) <= max_attempts
    code = F.coalesce(F.col(status), F.lit(0))
    decides = (code == 200) | code.between(400, 499)
    packed = F.col(attempt).cast("long") * 100_000 + code * 10 + F.when(F.col(body_ok), 1).otherwise(0)
    found = attempts.groupBy(*request).agg(
        F.min(F.when(in_budget & decides, packed)).alias("deciding"),
        F.max(F.when(in_budget, packed)).alias("last"),
    )
    shown = F.coalesce("deciding", "last")
    final_status = F.floor(F.pmod(shown, F.lit(100_000)) / 10)
    attempt_no = F.floor(shown / 100_000)
    outcome = (
        F.when(F.col("deciding").isNull(), F.when(attempt_no >= max_attempts, EXHAUSTED).otherwise(PENDING))
        .when(final_status != 200, CLIENT_ERROR)
        .when(F.pmod("deciding", F.lit(10)) == 1, ACCEPTED)
        .otherwise(INVALID_BODY)
    )
    return found.select(
        *request,
        outcome.alias("outcome"),
        attempt_no.alias("attempts_used"),
        F.nullif(final_status, F.lit(0)).alias("last_status"),
    )


def failure_cutoff(
    log: DataFrame,
    run: Sequence[str],
    order: str,
    succeeded: str,
    threshold: int = fixed.MAX_CONSECUTIVE_FAILURES,
    chunk: Column | None = None,
) -> DataFrame:
    """Where each run stops because ``threshold`` locations failed in a row.

    ``order`` must be unique within a run; rows are taken in its order and a success resets the count. Per run:
    ``stopped_at`` (order value of the failure that stops it, NULL if none), ``attempted`` and ``failed`` (rows up to
    and including it) and ``locations`` (all rows).

    A run may be the whole log, so no task scans one from end to end. Rows are cut into chunks that follow the order
    (``chunk``: any expression that never decreases with it; by default ranges of ``CHUNK`` rows). Windows run
    inside a chunk; each chunk is reduced to one row with its leading and trailing failures, and only these rows are
    scanned per run to carry a streak over the seams.
    """
    if chunk is None:
        # Ranges of (run, order) with about CHUNK rows each, however sparse the order's values are.
        ranges = -(-log.count() // CHUNK)
        log = log.repartitionByRange(max(ranges, 1), *run, order)
        chunk = F.spark_partition_id()
    log = log.select(*run, F.col(order).alias("_at"), F.col(succeeded).alias("_ok"), chunk.alias("_chunk"))

    inside = Window.partitionBy(*run, "_chunk").orderBy("_at")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = log.withColumns(
        {
            "_n": F.row_number().over(inside),
            "_fails": F.count_if(~F.col("_ok")).over(so_far),
        }
    )
    streaks = numbered.withColumn(
        "_streak", F.col("_n") - F.coalesce(F.max(F.when(F.col("_ok"), F.col("_n"))).over(so_far), F.lit(0))
    )
    leading = F.col("_streak") == F.col("_n")
    stops_here = F.col("_streak") >= threshold
    seams = [
        F.min(F.when(leading & (F.col("_n") == n), F.col("_at"))).alias(f"_head_{n}") for n in range(1, threshold)
    ]
    chunks = streaks.groupBy(*run, "_chunk").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.max("_fails").alias("_all_fails"),
        F.max_by("_streak", "_n").alias("_tail"),
        F.min(F.when(stops_here, F.col("_n"))).alias("_stop_n"),
        F.min(F.when(stops_here, F.col("_at"))).alias("_stop_at"),
        F.min(F.when(stops_here, F.col("_fails"))).alias("_stop_fails"),
        *seams,
    )

    by_chunk = Window.partitionBy(*run).orderBy("_chunk")
    up_to = by_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    # Rows before a streak that reaches the end of a chunk. A chunk of failures only does not move that point.
    carried = chunks.withColumn("_rows_to_here", F.sum("_rows").over(up_to)).withColumn(
        "_streak_from",
        F.when(F.col("_tail") < F.col("_rows"), F.col("_rows_to_here") - F.col("_tail")),
    )
    carried = carried.withColumns(
        {
            "_rows_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
            "_fails_before": F.coalesce(F.sum("_all_fails").over(earlier), F.lit(0)),
            "_from_before": F.coalesce(F.max("_streak_from").over(earlier), F.lit(0)),
        }
    ).withColumn("_carry", F.col("_rows_before") - F.col("_from_before"))

    # A streak carried over a seam stops the run at position threshold - carry, if the chunk starts with that many.
    seam_n, seam_at = F.lit(None).cast("long"), F.lit(None).cast(log.schema["_at"].dataType)
    for n in range(1, threshold):
        met = (F.col("_carry") == threshold - n) & F.col(f"_head_{n}").isNotNull()
        seam_n, seam_at = F.when(met, F.lit(n)).otherwise(seam_n), F.when(met, F.col(f"_head_{n}")).otherwise(seam_at)
    stops = carried.select(
        *run,
        "_rows",
        "_all_fails",
        F.coalesce(seam_at, F.col("_stop_at")).alias("_at"),
        (F.col("_rows_before") + F.coalesce(seam_n, F.col("_stop_n"))).alias("_attempted"),
        (F.col("_fails_before") + F.coalesce(seam_n, F.col("_stop_fails"))).alias("_failed"),
    )
    return stops.groupBy(*run).agg(
        F.min("_at").alias("stopped_at"),
        F.coalesce(F.min("_attempted"), F.sum("_rows")).alias("attempted"),
        F.coalesce(F.min("_failed"), F.sum("_all_fails")).alias("failed"),
        F.sum("_rows").alias("locations"),
    )


def run_summary(outcomes: DataFrame, failed: Column, rows: Column) -> DataFrame:
    """Totals of a run: locations, how many failed, rows upserted (NULL or 0 where a location stored none)."""
    return outcomes.agg(
        F.count(F.lit(1)).alias("locations"),
        F.count_if(failed).alias("failed_locations"),
        F.coalesce(F.sum(rows), F.lit(0)).alias("rows_upserted"),
    )
