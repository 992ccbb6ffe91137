"""Missing days in three forms, and the fetch plan made of them."""

from __future__ import annotations

from datetime import date, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st

from daygrid.operators import gaps

RANGES = "cell_key string, start_date date, end_date date"
STORED = "cell_key string, date date"


def brute_force(ranges, stored):
    """Sorted missing days per key, by walking the calendar."""
    have = set(stored)
    missing = {}
    for key, start, end in ranges:
        days = [start + timedelta(days=n) for n in range((end - start).days + 1)]
        gone = [day for day in days if (key, day) not in have]
        if gone:
            missing[key] = gone
    return missing


def check_all_forms(spark, ranges, stored):
    wanted, have = spark.createDataFrame(ranges, RANGES), spark.createDataFrame(stored, STORED)
    expected = brute_force(ranges, stored)
    report = {r.cell_key: tuple(r)[1:] for r in gaps.gap_report(wanted, have).collect()}
    assert report == {key: (len(days), days[0], days[-1]) for key, days in expected.items()}
    for form in (gaps.missing_days, gaps.missing_days_by_spine):
        listed = sorted((r.cell_key, r.date) for r in form(wanted, have).collect())
        assert listed == sorted((key, day) for key, days in expected.items() for day in days), form.__name__
    first = {key: days[0] for key, days in expected.items()}
    for form in (gaps.first_missing_date, gaps.first_missing_date_by_window, gaps.first_missing_date_by_spine):
        assert {r.cell_key: r.first_missing_date for r in form(wanted, have).collect()} == first, form.__name__


def test_edges(spark):
    d = date
    ranges = [
        ("none stored", d(2024, 1, 1), d(2024, 6, 30)),
        ("all stored", d(2024, 1, 1), d(2024, 1, 3)),
        ("one day", d(2024, 1, 1), d(2024, 1, 1)),
        ("hole", d(2023, 12, 30), d(2024, 1, 4)),
        ("only outside", d(2024, 1, 1), d(2024, 1, 2)),
        ("before 1970", d(1969, 11, 1), d(1970, 2, 1)),
        ("empty range", d(2024, 1, 2), d(2024, 1, 1)),
        ("a century", d(1900, 1, 1), d(1999, 12, 31)),
    ]
    stored = [("all stored", d(2024, 1, n)) for n in (1, 2, 3)]
    stored += [("hole", d(2023, 12, 30)), ("hole", d(2023, 12, 31)), ("hole", d(2024, 1, 4))]
    stored += [("only outside", d(2023, 12, 31)), ("only outside", d(2024, 1, 3))]
    stored += [("before 1970", d(1969, 12, 31)), ("before 1970", d(1970, 1, 1)), ("unknown key", d(2024, 1, 1))]
    stored += [("a century", d(1900, 1, 1))] * 3
    check_all_forms(spark, ranges, stored)


def test_masks_reach_every_bit(spark):
    """A missing day at each position of a block, alone and with its neighbours stored."""
    start = date(2020, 1, 1)
    ranges = [(f"k{n}", start, start + timedelta(days=2 * gaps.DAYS_PER_BLOCK)) for n in range(2 * gaps.DAYS_PER_BLOCK)]
    stored = [
        (key, first + timedelta(days=m)) for n, (key, first, _) in enumerate(ranges) for m in range(121) if m != n
    ]
    check_all_forms(spark, ranges, stored)


DAY = st.integers(0, 200).map(lambda n: date(2023, 11, 1) + timedelta(days=n))


@settings(max_examples=6, deadline=None)
@given(
    st.dictionaries(st.sampled_from("abcdef"), st.tuples(DAY, DAY), min_size=1),
    st.lists(st.tuples(st.sampled_from("abcdefg"), DAY), min_size=1, max_size=300),
)
def test_forms_agree_with_the_calendar(spark, ranges, stored):
    check_all_forms(spark, [(key, *days) for key, days in ranges.items()], stored)


def test_a_hot_key_is_spread_over_its_blocks(spark):
    """One key with most of the rows: the aggregate is keyed by (key, block) and combines before the shuffle."""
    start = date(2000, 1, 1)
    days = [("hot", start + timedelta(days=n % 5000)) for n in range(20000)] + [("cold", start)]
    wanted = spark.createDataFrame([("hot", start, start + timedelta(days=4999)), ("cold", start, start)], RANGES)
    blocks = gaps.missing_blocks(wanted, spark.createDataFrame(days, STORED))
    assert blocks.count() == 0
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(cell_key") == 1 and "block" in plan.split("Exchange")[1].splitlines()[0]
    assert "Join" not in plan and "Window" not in plan and "partial_bit_or" in plan


CELLS = "cell_key string, lat double, lon double, backfill_from_date date"
RUN = date(2024, 1, 30)


def plan_cells(spark):
    return spark.createDataFrame(
        [
            ("b", -32.255, 148.6, date(2023, 12, 1)),  # nothing stored: fetched from its start
            ("a", -30.0, 150.0, date(2024, 1, 1)),  # complete: only the rolling window
            ("c", -31.0, 151.0, date(2024, 1, 29)),  # starts inside the window: the window still goes back
        ],
        CELLS,
    )


def plan_stored(spark):
    return spark.createDataFrame([("a", date(2024, 1, n)) for n in range(1, 31)], STORED)


def test_fetch_ranges(spark):
    found = gaps.fetch_ranges(plan_cells(spark), plan_stored(spark), RUN, refresh_days=10)
    assert {r.cell_key: (r.fetch_start, r.needs_backfill) for r in found.collect()} == {
        "a": (date(2024, 1, 20), False),
        "b": (date(2023, 12, 1), True),
        "c": (date(2024, 1, 20), False),
    }
    assert tuple(gaps.backfill_summary(found).first()) == (3, 1)


def test_days_after_the_run_date_do_not_count_as_stored_before_it(spark):
    stored = spark.createDataFrame([("a", RUN + timedelta(days=1))], STORED)
    found = gaps.fetch_ranges(plan_cells(spark).where("cell_key = 'a'"), stored, RUN, refresh_days=10)
    assert found.first().fetch_start == date(2024, 1, 1)


def test_trial_runs_take_few_cells_and_a_short_period(spark):
    cells = gaps.trial_slice(plan_cells(spark))
    found = gaps.fetch_ranges(cells, plan_stored(spark), RUN, refresh_days=10, cap_days=30)
    assert {r.cell_key: r.fetch_start for r in found.collect()} == {"a": date(2024, 1, 20), "b": date(2023, 12, 31)}


def test_requests(spark):
    ranges = gaps.fetch_ranges(plan_cells(spark), plan_stored(spark), RUN, refresh_days=10)
    found = {r.cell_key: tuple(r)[1:] for r in gaps.fetch_requests(ranges, RUN).collect()}
    assert found["b"] == ("-32.26", "148.60", "20231201", "20240130", "csv", "RXNVDESCLJHGFTAPWM")
