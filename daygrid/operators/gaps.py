"""Which days are missing, and what to fetch because of it.

Three forms of one question. They give equal results; they differ in how many rows they move.

* *blocks* (default): days are packed 60 to a 64-bit mask per (key, block of days). Wanted days and stored days meet in
  one ``bit_or`` aggregate that combines on the map side, so stored duplicates and hot keys shrink before the shuffle
  and a key's work is spread over its blocks. Nothing is joined, windowed or broadcast.
* *window*: ``lead`` over the distinct stored days of a key. One row per stored day; a key's partition is bounded by the
  calendar, as duplicates are gone before the window.
* *spine*: one row per key and day, anti-joined to what is stored. The readable definition; it generates and shuffles
  keys x days rows.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrid import fixed_values as fixed

# Days per mask. Below 63 so that every mask is a positive long and ANSI arithmetic on it cannot overflow.
DAYS_PER_BLOCK = 60


def key_ranges(
    mapping: DataFrame, end: date | Column, key: str = "cell_key", start: str = "backfill_from_date"
) -> DataFrame:
    """One row per key: ``key, start_date`` (earliest) and ``end_date`` (the same for all)."""
    last = end if isinstance(end, Column) else F.lit(end)
    return mapping.groupBy(key).agg(F.min(start).alias("start_date")).withColumn("end_date", last)


# --- spine form --------------------------------------------------------------------------------------------------


def date_spine(ranges: DataFrame, key: str = "cell_key") -> DataFrame:
    """One row per key and day, both ends included. Ranges that end before they start give no rows."""
    valid = ranges.where(F.col("start_date") <= F.col("end_date"))
    days = F.sequence("start_date", "end_date", F.expr("INTERVAL 1 DAY"))
    return valid.select(key, F.explode(days).alias("date"))


def missing_days_by_spine(
    ranges: DataFrame, stored: DataFrame, key: str = "cell_key", day: str = "date"
) -> DataFrame:
    """Every (key, date) of the spine without a stored row.

    Stored days are made distinct first: many rows of one (key, date) would otherwise all travel to one task.
    """
    have = stored.select(F.col(key), F.col(day).alias("date")).distinct()
    return date_spine(ranges, key).join(have, [key, "date"], "left_anti")


def first_missing_date_by_spine(
    ranges: DataFrame, stored: DataFrame, key: str = "cell_key", day: str = "date"
) -> DataFrame:
    return missing_days_by_spine(ranges, stored, key, day).groupBy(key).agg(F.min("date").alias("first_missing_date"))


# --- window form -------------------------------------------------------------------------------------------------


def first_missing_date_by_window(
    ranges: DataFrame, stored: DataFrame, key: str = "cell_key", day: str = "date"
) -> DataFrame:
    """Same result from ``lead`` over stored days, fenced by the day before the range and the day after it."""
    valid = ranges.where(F.col("start_date") <= F.col("end_date"))
    have = stored.select(F.col(key), F.col(day).alias("date")).distinct()
    inside = have.join(valid, key).where(F.col("date").between(F.col("start_date"), F.col("end_date")))
    fences = valid.select(
        key, F.explode(F.array(F.date_sub("start_date", 1), F.date_add("end_date", 1))).alias("date")
    )
    following = F.lead("date").over(Window.partitionBy(key).orderBy("date"))
    steps = inside.select(key, "date").unionByName(fences).withColumn("following", following)
    return (
        steps.where(F.datediff("following", "date") > 1)
        .groupBy(key)
        .agg(F.min(F.date_add("date", 1)).alias("first_missing_date"))
    )


# --- block form --------------------------------------------------------------------------------------------------


def _block(day: str) -> str:
    return f"CAST(floor(unix_date({day}) / {DAYS_PER_BLOCK}) AS INT)"


def _bit(position: str) -> str:
    return f"shiftleft(1L, {position})"


def day_masks(stored: DataFrame, key: str = "cell_key", day: str = "date", *more: str) -> DataFrame:
    """``key, block, present`` and ``more``: a mask with one bit for every stored row. Rows without key or date have none."""
    return stored.where(f"`{key}` IS NOT NULL AND `{day}` IS NOT NULL").selectExpr(
        f"`{key}`",
        f"{_block(f'`{day}`')} AS block",
        f"{_bit(f'pmod(unix_date(`{day}`), {DAYS_PER_BLOCK})')} AS present",
        *more,
    )


def missing_blocks(ranges: DataFrame, stored: DataFrame, key: str = "cell_key", day: str = "date") -> DataFrame:
    """``key, block, missing``: a mask of the missing days of every block that has any."""
    return uncovered_blocks(ranges, day_masks(stored, key, day), key)


def uncovered_blocks(ranges: DataFrame, masks: DataFrame, key: str = "cell_key") -> DataFrame:
    """``missing_blocks`` from masks of stored days, in any number of rows for a key and block."""
    spine = ranges.where("start_date <= end_date").selectExpr(
        f"`{key}`",
        "unix_date(start_date) AS first",
        "unix_date(end_date) AS last",
        f"explode(sequence({_block('start_date')}, {_block('end_date')})) AS block",
    )
    low = f"greatest(first - block * {DAYS_PER_BLOCK}, 0)"
    high = f"least(last - block * {DAYS_PER_BLOCK}, {DAYS_PER_BLOCK - 1})"
    wanted = spine.selectExpr(f"`{key}`", "block", f"{_bit(f'{high} + 1')} - {_bit(low)} AS wanted", "0L AS present")
    have = masks.selectExpr(f"`{key}`", "block", "0L AS wanted", "present")
    merged = wanted.union(have).groupBy(key, "block").agg(F.expr("bit_or(wanted) & ~bit_or(present)").alias("missing"))
    return merged.where("missing <> 0")


def gap_report(ranges: DataFrame, stored: DataFrame, key: str = "cell_key", day: str = "date") -> DataFrame:
    """Keys with missing days: how many, the earliest and the latest. Keys without any do not appear."""
    return report_of(missing_blocks(ranges, stored, key, day), key)


def report_of(blocks: DataFrame, key: str = "cell_key") -> DataFrame:
    """``gap_report`` from the masks of missing days."""
    lowest_bit, highest_bit = "bit_count((missing & -missing) - 1)", "length(bin(missing)) - 1"
    return blocks.groupBy(key).agg(
        F.expr("sum(bit_count(missing))").alias("missing_date_count"),
        F.expr(f"date_from_unix_date(min(block * {DAYS_PER_BLOCK} + {lowest_bit}))").alias("earliest_gap"),
        F.expr(f"date_from_unix_date(max(block * {DAYS_PER_BLOCK} + {highest_bit}))").alias("latest_gap"),
    )


def days_of(blocks: DataFrame, key: str = "cell_key", mask: str = "missing") -> DataFrame:
    """One (key, date) for every bit of the masks."""
    bits = f"filter(sequence(0, {DAYS_PER_BLOCK - 1}), bit -> {mask} & {_bit('bit')} <> 0)"
    unpacked = blocks.selectExpr(f"`{key}`", "block", f"explode({bits}) AS bit")
    return unpacked.selectExpr(f"`{key}`", f"date_from_unix_date(block * {DAYS_PER_BLOCK} + bit) AS date")


def gap_intervals(blocks: DataFrame, key: str = "cell_key") -> DataFrame:
    """``key, gap_start, gap_end``: every run of missing days, however many blocks it spans.

    Runs end inside a block by its bits alone. Only the runs that touch a block's edge meet those of the next block, in a
    window over one row per block, and only first and last days are unpacked. A key's window is bounded by the calendar.
    """
    top = _bit(str(DAYS_PER_BLOCK - 1))
    by_block = Window.partitionBy(key).orderBy("block")
    seen = blocks.select(
        key,
        "block",
        "missing",
        (F.lag("block").over(by_block) == F.col("block") - 1).alias("follows"),
        F.lag("missing").over(by_block).alias("earlier"),
        (F.lead("block").over(by_block) == F.col("block") + 1).alias("goes_on"),
        F.lead("missing").over(by_block).alias("later"),
    )
    edges = seen.select(
        key,
        "block",
        # A run begins at a missing day whose day before is not missing, and ends where the day after is not.
        F.expr(f"missing & ~(shiftleft(missing & ~{top}, 1) | if(follows AND earlier & {top} <> 0, 1L, 0L))").alias("begins"),
        F.expr(f"missing & ~(shiftright(missing, 1) | if(goes_on AND later & 1 <> 0, {top}, 0L))").alias("ends"),
    )
    begins, ends = (days_of(edges.where(f"{side} <> 0"), key, side) for side in ("begins", "ends"))
    marks = begins.withColumn("side", F.lit(0)).unionAll(ends.withColumn("side", F.lit(1)))
    # Every beginning is followed by its own end, on the same day for a single missing one.
    following = F.lead("date").over(Window.partitionBy(key).orderBy("date", "side"))
    paired = marks.withColumn("gap_end", following).where("side = 0")
    return paired.select(key, F.col("date").alias("gap_start"), "gap_end")


def missing_days(ranges: DataFrame, stored: DataFrame, key: str = "cell_key", day: str = "date") -> DataFrame:
    """Every (key, date) without a stored row, unpacked from the masks: rows appear for missing days only."""
    return days_of(missing_blocks(ranges, stored, key, day), key)


def first_missing_date(ranges: DataFrame, stored: DataFrame, key: str = "cell_key", day: str = "date") -> DataFrame:
    """First day without a stored row, per key that has one."""
    return gap_report(ranges, stored, key, day).select(key, F.col("earliest_gap").alias("first_missing_date"))


# --- fetch planning ----------------------------------------------------------------------------------------------


def trial_slice(cells: DataFrame, locations: int = fixed.TEST_MODE_LOCATIONS, key: str = "cell_key") -> DataFrame:
    """The first few cells by key, for a trial run."""
    return cells.orderBy(key).limit(locations)


def fetch_ranges(
    cells: DataFrame,
    stored: DataFrame,
    run_date: date,
    refresh_days: int = fixed.ROLLING_REFRESH_DAYS,
    cap_days: int | None = None,
    key: str = "cell_key",
    day: str = "date",
) -> DataFrame:
    """Per cell: ``fetch_start`` and whether that reaches back before the rolling window (``needs_backfill``).

    The start is the first missing day or the start of the trailing window, whichever is earlier; stored days are
    looked at up to the run date. ``cap_days`` (trial runs) keeps the start within so many days of the run date.
    """
    known = stored.where(F.col(day) <= F.lit(run_date))
    first = first_missing_date(wanted_ranges(cells, run_date, key), known, key, day)
    return fetch_ranges_from(cells, first, run_date, refresh_days, cap_days, key)


def wanted_ranges(cells: DataFrame, run_date: date, key: str = "cell_key") -> DataFrame:
    """The days a run looks at, per cell: from its start to the run date."""
    return cells.select(key, F.col("backfill_from_date").alias("start_date"), F.lit(run_date).alias("end_date"))


def fetch_ranges_from(
    cells: DataFrame,
    first_missing: DataFrame,
    run_date: date,
    refresh_days: int = fixed.ROLLING_REFRESH_DAYS,
    cap_days: int | None = None,
    key: str = "cell_key",
) -> DataFrame:
    """``fetch_ranges`` where the first missing days (``key, first_missing_date``) are known already."""
    rolling = F.lit(run_date - timedelta(days=refresh_days))
    start = F.least(F.col("first_missing_date"), rolling)  # least skips NULL: nothing missing gives the window start
    if cap_days is not None:
        start = F.greatest(start, F.lit(run_date - timedelta(days=cap_days)))
    return (
        cells.join(first_missing, key, "left")
        .withColumn("fetch_start", start)
        .withColumn("needs_backfill", F.col("fetch_start") < rolling)
        .drop("first_missing_date")
    )


def fetch_requests(
    ranges: DataFrame, run_date: date, variables: str = fixed.REQUEST_VARIABLE_CODES, key: str = "cell_key"
) -> DataFrame:
    """One request per cell, as the text parameters a daily-data API expects."""
    return ranges.select(
        key,
        F.format_string("%.2f", "lat").alias("lat"),
        F.format_string("%.2f", "lon").alias("lon"),
        F.date_format("fetch_start", "yyyyMMdd").alias("start"),
        F.date_format(F.lit(run_date), "yyyyMMdd").alias("finish"),
        F.lit("csv").alias("format"),
        F.lit(variables).alias("comment"),
    )


def backfill_summary(ranges: DataFrame) -> DataFrame:
    """How many locations there are and how many of them reach back before the rolling window."""
    return ranges.agg(F.count(F.lit(1)).alias("locations"), F.count_if("needs_backfill").alias("need_backfill"))
