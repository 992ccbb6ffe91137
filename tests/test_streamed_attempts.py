"""Attempts spread over micro-batches and restarts give what one log gives."""

from __future__ import annotations

import random
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from daygrid.operators.outcomes import fetch_outcomes
from daygrid.plans import load_job
from daygrid.sources.responses import judge_bodies
from daygrid.streaming.attempts import ATTEMPTS, load_attempt_log

HEADER = "latitude,longitude,YYYY-MM-DD,daily_rain,max_temp,min_temp,vp,radiation"
START = datetime(2024, 2, 1)


def log_of(seed, requests=25):
    draw, rows = random.Random(seed), []
    for k in range(requests):
        body = f"{HEADER}\n-30,140,2024-01-{1 + k % 28:02d},{k},2,3,4,5\n"
        for attempt in range(1, draw.randint(1, 5) + 1):
            status = draw.choice([503, 503, None, 500, 200, 200, 404])
            text = draw.choice([body, body, "Sorry, no"]) if status == 200 else None
            rows += [("r", f"c{k}", attempt, status, text, START)] * draw.choice([1, 1, 1, 2])
    return rows


def outcomes_of(spark, rows):
    judged = judge_bodies(spark.createDataFrame(rows, ATTEMPTS)).withColumn("body_ok", F.col("problem").isNull())
    return {(r.run, r.cell_key): tuple(r)[2:] for r in fetch_outcomes(judged, ["run", "cell_key"]).collect()}


def stream(spark, path, batches, **options):
    """Every batch is a file and a restart of its own; the outcomes that were given out."""
    table, told = f"observations_{uuid.uuid4().hex}", []
    load_job.create_observation_table(spark, table)

    def keep(batch_id, batch, result):
        told.extend(batch.collect())

    for rows in batches:
        spark.createDataFrame(rows, ATTEMPTS).coalesce(1).write.mode("append").parquet(path)
        load_attempt_log(spark, path, table, table, on_batch=keep, **options).awaitTermination()
    return table, told


@pytest.mark.parametrize("seed", range(2))
def test_any_order_over_any_batches(spark, tmp_path, seed):
    rows = log_of(seed)
    shuffled = random.Random(seed).sample(rows, len(rows))
    cuts = sorted(random.Random(seed).sample(range(1, len(rows)), 2))
    parts = [shuffled[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    # Much later attempts of another run move the watermark: what is still open is then given out as it stands.
    later = [[("z", "flush", 1, 404, None, START + timedelta(days=n))] for n in (5, 10)]
    table, told = stream(spark, str(tmp_path / "log"), [*parts, *later])
    found = {(r.run, r.cell_key): (r.outcome, r.attempts_used, r.last_status) for r in told if r.run == "r"}
    assert len([r for r in told if r.run == "r"]) == len(found)
    assert found == outcomes_of(spark, rows)
    once = f"observations_{uuid.uuid4().hex}"
    load_job.create_observation_table(spark, once)
    load_job.load_attempts(spark, spark.createDataFrame(rows, ATTEMPTS).select("cell_key", "attempt", "status", "body"), once)
    columns = ["cell_key", "date", "lat", "lon", "daily_rain", "max_temp", "vp"]
    assert sorted(map(tuple, spark.table(table).select(columns).collect())) == sorted(map(tuple, spark.table(once).select(columns).collect()))


def test_a_later_attempt_waits_for_the_earlier_ones(spark, tmp_path):
    body = f"{HEADER}\n-30,140,2024-01-01,1,2,3,4,5\n"
    second, first = [("r", "c", 2, 200, body, START)], [("r", "c", 1, 404, None, START)]
    table, told = stream(spark, str(tmp_path / "log"), [second, first])
    assert [(r.outcome, r.attempts_used, r.last_status, r.bodies) for r in told] == [("client_error", 1, 404, [])]
    assert spark.table(table).isEmpty()
