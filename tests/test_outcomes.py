"""Outcome per request, early stop of a run, totals."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daygrid.operators.outcomes import failure_cutoff, fetch_outcomes, run_summary

LOG = "request string, attempt int, status int, body_ok boolean"
CASES = {
    "first try": ([(200, True)], ("accepted", 1, 200)),
    "bad body is not retried": ([(200, False), (200, True)], ("invalid_body", 1, 200)),
    "retried": ([(503, False), (200, True)], ("accepted", 2, 200)),
    "refused at once": ([(403, False), (200, True)], ("client_error", 1, 403)),
    "refused later": ([(503, False), (404, False)], ("client_error", 2, 404)),
    "never reached": ([(None, False)] * 4, ("exhausted", 4, None)),
    "last error stands": ([(None, False)] * 3 + [(502, False)], ("exhausted", 4, 502)),
    "too late": ([(503, False)] * 4 + [(200, True)], ("exhausted", 4, 503)),
    "still trying": ([(503, False), (500, False)], ("pending", 2, 500)),
}


def test_outcomes(spark):
    rows = [(name, n, *answer) for name, (answers, _) in CASES.items() for n, answer in enumerate(answers, start=1)]
    found = fetch_outcomes(spark.createDataFrame(rows, LOG), ["request"]).collect()
    assert {r.request: tuple(r)[1:] for r in found} == {name: expected for name, (_, expected) in CASES.items()}


def stop_by_hand(results, threshold):
    """(stopped_at, attempted, failed, locations) by going through the run."""
    streak = failed = 0
    for position, succeeded in enumerate(results):
        streak = 0 if succeeded else streak + 1
        failed += not succeeded
        if streak >= threshold:
            return position, position + 1, failed, len(results)
    return None, len(results), failed, len(results)


RUN_LOG = "run string, position long, ok boolean"


def stops(spark, runs, threshold, chunk):
    rows = [(run, n, ok) for run, results in runs.items() for n, ok in enumerate(results)]
    log = spark.createDataFrame(rows, RUN_LOG).repartition(3)
    found = failure_cutoff(log, ["run"], "position", "ok", threshold, F.floor(F.col("position") / chunk))
    return {r.run: tuple(r)[1:] for r in found.collect()}


RESULTS = st.lists(st.sampled_from([True, False, False]), min_size=1, max_size=24)


@settings(max_examples=8, deadline=None)
@given(st.lists(RESULTS, min_size=20, max_size=40), st.integers(1, 6), st.integers(1, 7))
def test_chunks_carry_streaks_over_seams(spark, runs, threshold, chunk):
    runs = {f"r{n}": results for n, results in enumerate(runs)}
    assert stops(spark, runs, threshold, chunk) == {r: stop_by_hand(x, threshold) for r, x in runs.items()}


@pytest.mark.parametrize("chunk", [1, 2, 3, 50])
def test_long_streaks(spark, chunk):
    runs = {"all fail": [False] * 20, "late": [True] * 17 + [False] * 3, "never": [False, False, True] * 6}
    assert stops(spark, runs, 3, chunk) == {r: stop_by_hand(x, 3) for r, x in runs.items()}
    assert stops(spark, runs, 15, chunk) == {r: stop_by_hand(x, 15) for r, x in runs.items()}


def test_one_run_without_a_run_column(spark):
    rows = [(n, ok) for n, ok in enumerate([True, False, False, False, True])]
    found = failure_cutoff(spark.createDataFrame(rows, "position long, ok boolean"), [], "position", "ok")
    assert tuple(found.first()) == (3, 4, 3, 5)


def test_text_order_with_a_prefix_as_chunk(spark):
    """Any order works with a chunk that never decreases along it: here keys by their first letter."""
    keys = ["aa", "ab", "ba", "bb", "bc", "ca"]
    ok = [True, False, False, False, True, True]
    log = spark.createDataFrame(list(zip(keys, ok, strict=True)), "cell_key string, ok boolean")
    found = failure_cutoff(log, [], "cell_key", "ok", chunk=F.substring("cell_key", 1, 1))
    assert tuple(found.first()) == ("bb", 4, 3, 6)


def test_sparse_positions_share_chunks(spark, monkeypatch):
    """Chunks hold rows, not stretches of the order's values."""
    monkeypatch.setattr("daygrid.operators.outcomes.CHUNK", 50)
    results = [n % 9 != 0 and n % 7 != 0 for n in range(400)] + [False] * 5 + [True] * 40
    log = spark.createDataFrame([("r", n * 1_000_003, ok) for n, ok in enumerate(results)], RUN_LOG)
    found = failure_cutoff(log, ["run"], "position", "ok", 5).first()
    stopped, attempted, failed, locations = stop_by_hand(results, 5)
    assert tuple(found)[1:] == (stopped * 1_000_003, attempted, failed, locations)


def test_no_window_spans_a_run(spark):
    """Row-level windows stay inside a chunk; the only run-wide ones see a row per chunk."""
    log = spark.createDataFrame([("r", 1, True)], RUN_LOG)
    plan = failure_cutoff(log, ["run"], "position", "ok")._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    over_rows = [line for line in windows if "_at#" in line]
    assert over_rows and len(over_rows) < len(windows)
    for line in over_rows:
        partitioned_by = line.split("windowspecdefinition(")[1].split("_at#")[0]
        assert "_chunk#" in partitioned_by


def test_summary(spark):
    rows = spark.createDataFrame([("a", True, 5), ("b", False, None), ("c", True, 7)], "k string, ok boolean, n long")
    assert tuple(run_summary(rows, ~F.col("ok"), F.col("n")).first()) == (3, 1, 12)
    assert tuple(run_summary(rows.where("false"), ~F.col("ok"), F.col("n")).first()) == (0, 0, 0)
