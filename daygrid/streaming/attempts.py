"""Fetch attempts that arrive in micro-batches, settled by keyed state and loaded as one log would be."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from daygrid import fixed_values as fixed
from daygrid.operators.day_index import DayIndex
from daygrid.operators.layout import PartitionBy
from daygrid.operators.outcomes import ACCEPTED, CLIENT_ERROR, EXHAUSTED, INVALID_BODY, PENDING
from daygrid.plans.load_job import RESPONSE_COLUMNS, LoadResult, load_records
from daygrid.session import shared_folder
from daygrid.sources.responses import judge_bodies, split_bodies

ATTEMPTS = "run string, cell_key string, attempt int, status int, body string, at timestamp"
#: How long a request is kept after its newest attempt: until then, late attempts change what is not settled.
KEPT_FOR = "1 day"

_SETTLED = "run string, cell_key string, outcome string, attempts_used int, last_status int, bodies array<string>"
# What is known of a request: the attempts seen, the least that decides (with its bodies) and the last, both as in the batch rule:
# attempt, 4 digits of status, 1 digit of verdict.
_STATE = "seen long, deciding long, last long, bodies array<string>, settled boolean"


def _outcome(deciding: int, last: int, max_attempts: int) -> tuple[str, int, int | None]:
    shown = deciding or last
    attempt, status = shown // 100_000, shown % 100_000 // 10
    if not deciding:
        outcome = EXHAUSTED if attempt >= max_attempts else PENDING
    elif status != 200:
        outcome = CLIENT_ERROR
    else:
        outcome = ACCEPTED if deciding % 10 else INVALID_BODY
    return outcome, attempt, status or None


def settle(attempts: DataFrame, max_attempts: int = fixed.MAX_ATTEMPTS, kept_for: str = KEPT_FOR) -> DataFrame:
    """One row per request (run, cell_key) of a stream of attempts, once its outcome cannot change any more.

    The rule is that of ``outcomes.fetch_outcomes``. An attempt that decides does so only when every earlier one is known,
    as an earlier one may arrive later and decide instead. When ``kept_for`` has passed since the newest attempt, by the
    watermark, the request is given out as it stands, pending ones too. The state holds the bodies of at most one attempt.
    ``attempts`` is (run, cell_key, attempt, status, body, at, body_ok).
    """
    millis = int(pd.Timedelta(kept_for).total_seconds() * 1000)

    def row(key: tuple, deciding: int, last: int, bodies: list[str]) -> pd.DataFrame:
        outcome, attempt, status = _outcome(deciding, last, max_attempts)
        return pd.DataFrame(
            {
                "run": [key[0]],
                "cell_key": [key[1]],
                "outcome": [outcome],
                "attempts_used": [attempt],
                "last_status": pd.array([status], dtype="Int32"),
                "bodies": [bodies if outcome == ACCEPTED else []],
            }
        )

    def update(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, deciding, last, bodies, settled = state.get if state.exists else (0, 0, 0, [], False)
        if state.hasTimedOut:
            state.remove()
            if not settled and last:
                yield row(key, deciding, last, list(bodies))
            return
        bodies, newest = list(bodies), 0
        for batch in batches:
            newest = max(newest, int(batch["at"].max().timestamp() * 1000))
            for attempt, status, body, ok in zip(batch["attempt"], batch["status"], batch["body"], batch["body_ok"]):
                if settled or attempt > max_attempts:
                    continue
                code = 0 if pd.isna(status) else int(status)
                packed = int(attempt) * 100_000 + code * 10 + int(bool(ok))
                seen |= 1 << int(attempt)
                last = max(last, packed)
                if code == 200 or 400 <= code <= 499:
                    if not deciding or packed // 100_000 < deciding // 100_000:
                        deciding, bodies = packed, [body] if ok else []
                    elif packed // 100_000 == deciding // 100_000:
                        # One attempt logged twice: the least verdict stands, and different bodies are all kept.
                        deciding = min(deciding, packed)
                        if ok and body not in bodies:
                            bodies.append(body)
        known = 0
        while seen >> (known + 1) & 1:
            known += 1
        if not settled and (known >= deciding // 100_000 if deciding else known >= max_attempts):
            settled = True
            yield row(key, deciding, last, bodies)
            bodies = []
        state.update((seen, deciding, last, bodies, settled))
        state.setTimeoutTimestamp(max(newest, state.getCurrentWatermarkMs()) + millis)

    return (
        attempts.where("attempt IS NOT NULL")
        .withWatermark("at", kept_for)
        .groupBy("run", "cell_key")
        .applyInPandasWithState(update, _SETTLED, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )


def load_attempt_log(
    spark: SparkSession,
    path: str,
    table: str,
    query_name: str,
    partition_by: PartitionBy | None = None,
    on_batch: Callable[[int, DataFrame, LoadResult], None] | None = None,
    index: DayIndex | None = None,
    kept_for: str = KEPT_FOR,
    files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Load the attempts that were logged under ``path`` (Parquet, columns ``ATTEMPTS``) since the last call, then stop.

    Attempts of one request may be spread over any number of batches and calls, in any order: what is not settled waits in
    the stream's state, which outlives a restart. Every settled request is loaded or reported in the batch that settles
    it; ``on_batch`` gets the outcomes and the result. A batch that is repeated after a crash gives the same rows again.
    """
    logged = spark.readStream.schema(ATTEMPTS).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    judged = judge_bodies(logged).withColumn("body_ok", F.col("problem").isNull())
    settled = settle(judged.select("run", "cell_key", "attempt", "status", "body", "at", "body_ok"), kept_for=kept_for)

    def load(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            done = batch.where(F.col("outcome") == ACCEPTED).select("cell_key", F.explode("bodies").alias("body"))
            status = F.coalesce(F.col("last_status").cast("string"), F.lit("none"))
            failed = batch.where(F.col("outcome") != ACCEPTED)
            failed = failed.select("cell_key", F.concat("outcome", F.lit(", status "), status).alias("problem"))
            records = split_bodies(done, RESPONSE_COLUMNS)
            answered = batch.select("cell_key").distinct()
            result = load_records(spark, records, table, partition_by=partition_by, failed_before=failed, answered=answered, index=index)
            if on_batch is not None:
                on_batch(batch_id, batch, result)
            result.close()
        finally:
            batch.unpersist()

    return (
        settled.writeStream.foreachBatch(load)
        .outputMode("append")
        .option("checkpointLocation", f"{shared_folder(spark)}/attempts-{query_name}")
        .trigger(availableNow=True)
        .start()
    )
