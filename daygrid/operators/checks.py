"""Data-quality rules. Each function returns the rows that break its rule; an empty frame is a pass.

Every rule that groups uses sums and counts only, so it combines on the map side and a key that holds much of a table
reaches its reducer as one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrid import fixed_values as fixed
from daygrid.functions.text import number_or_nan
from daygrid.functions.geo import Grid


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__or__, conditions)


# --- membership --------------------------------------------------------------------------------------------------


def extra_ids(output: DataFrame, source: DataFrame, id_column: str = "place_id") -> DataFrame:
    """Output rows whose id the source does not have."""
    known = source.select(id_column).where(F.col(id_column).isNotNull()).distinct()
    return output.select(id_column).join(known, id_column, "left_anti")


def missing_ids(output: DataFrame, source: DataFrame, id_column: str = "place_id") -> DataFrame:
    """Source ids that the output does not have. Both sides are made distinct before they are shuffled to the join."""
    wanted = source.select(id_column).where(F.col(id_column).isNotNull()).distinct()
    return wanted.join(output.select(id_column).distinct(), id_column, "left_anti")


def uncovered_keys(mapping: DataFrame, observations: DataFrame, key: str = "cell_key") -> DataFrame:
    """Mapped keys without a single observation. The other direction is not checked."""
    return mapping.select(key).distinct().join(observations.select(key).distinct(), key, "left_anti")


def duplicate_ids(output: DataFrame, id_column: str = "place_id") -> DataFrame:
    counted = output.groupBy(id_column).agg(F.count(F.lit(1)).alias("duplicate_count"))
    return counted.where(F.col("duplicate_count") > 1)


# --- row rules, as conditions so that several can share one scan ---------------------------------------------------


def too_far(limit_km: float = fixed.MAX_DISTANCE_KM) -> Column:
    return F.col("distance") > limit_km


def incomplete(columns: Sequence[str] = fixed.PLACE_COLUMNS) -> Column:
    return any_of([F.col(name).isNull() for name in columns])


def cell_outside(grid: Grid = Grid()) -> Column:
    return ~grid.covers(F.get("cell_latlon", F.lit(0)), F.get("cell_latlon", F.lit(1)))


def place_outside(grid: Grid = Grid()) -> Column:
    """The raw point is outside. A point just over the edge can still snap to a covered cell and be reported here."""
    both = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return both & ~grid.covers(F.col("latitude"), F.col("longitude"))


def wrong_date(column: str = "backfill_from_date", expected: date = fixed.BACKFILL_START) -> Column:
    return ~F.col(column).eqNullSafe(F.lit(expected))


# --- per-key rules over observations, all from one scan and one aggregate --------------------------------------------


@dataclass(frozen=True)
class ObservationRules:
    """What observations must satisfy. Values are text as delivered and are parsed here, never failing a run."""

    ranges: Mapping[str, tuple[float, float]] = None
    at_least: Sequence[tuple[str, str]] = (("max_temp", "min_temp"),)
    filled_text: Sequence[str] = ("cell_key", "daily_rain", "max_temp", "min_temp")
    filled: Sequence[str] = ("date", "lat", "lon")
    created: str = "created_at"
    updated: str = "updated_at"

    def __post_init__(self):
        if self.ranges is None:
            object.__setattr__(self, "ranges", fixed.VALUE_RANGES)

    @property
    def parsed(self) -> list[str]:
        return list(dict.fromkeys([*self.ranges, *(name for pair in self.at_least for name in pair)]))

    def _value(self, name: str) -> Column:
        return F.col(f"_{name}_value")

    def range_counts(self) -> dict[str, Column]:
        counts = {
            f"{name}_out_of_range": ~self._value(name).between(low, high) for name, (low, high) in self.ranges.items()
        }
        for upper, lower in self.at_least:
            counts[f"{upper}_less_than_{lower}"] = self._value(upper) < self._value(lower)
        return counts

    def unparseable_counts(self) -> dict[str, Column]:
        return {f"unparseable_{name}": F.col(name).isNotNull() & self._value(name).isNull() for name in self.parsed}

    def null_counts(self) -> dict[str, Column]:
        counts = {f"null_or_empty_{name}": F.col(name).isNull() | (F.col(name) == "") for name in self.filled_text}
        return counts | {f"null_{name}": F.col(name).isNull() for name in self.filled}

    def time_counts(self) -> dict[str, Column]:
        return {
            f"null_{self.created}": F.col(self.created).isNull(),
            f"null_{self.updated}": F.col(self.updated).isNull(),
            f"{self.created}_after_{self.updated}": F.col(self.created) > F.col(self.updated),
        }


def count_per_key(
    observations: DataFrame, rules: ObservationRules, counts: Mapping[str, Column], key: str = "cell_key"
) -> DataFrame:
    """One row per key with the number of rows that meet each condition. A NULL key is a group of its own.

    Values are parsed in a projection below the aggregate, once per row however many conditions use them.
    """
    parsed = observations.withColumns(
        {f"_{name}_value": number_or_nan(F.col(name)) for name in rules.parsed if name in observations.columns}
    )
    return parsed.groupBy(key).agg(*[F.count_if(condition).alias(name) for name, condition in counts.items()])


def breaking(counts: Mapping[str, Column]) -> Column:
    """True for a counted row with any violation."""
    return any_of([F.col(name) > 0 for name in counts])


def _violating_keys(
    observations: DataFrame, rules: ObservationRules, counts: Mapping[str, Column], key: str
) -> DataFrame:
    return count_per_key(observations, rules, counts, key).where(breaking(counts))


def value_range_violations(
    observations: DataFrame, rules: ObservationRules = ObservationRules(), key: str = "cell_key"
) -> DataFrame:
    """Keys with values out of range. NULL and unreadable values are not out of range; NaN is."""
    return _violating_keys(observations, rules, rules.range_counts(), key)


def unparseable_values(
    observations: DataFrame, rules: ObservationRules = ObservationRules(), key: str = "cell_key"
) -> DataFrame:
    """Keys with values that are not numbers; the empty text is one of them."""
    return _violating_keys(observations, rules, rules.unparseable_counts(), key)


def null_key_violations(
    observations: DataFrame, rules: ObservationRules = ObservationRules(), key: str = "cell_key"
) -> DataFrame:
    return _violating_keys(observations, rules, rules.null_counts(), key)


def timestamp_violations(
    observations: DataFrame, rules: ObservationRules = ObservationRules(), key: str = "cell_key"
) -> DataFrame:
    return _violating_keys(observations, rules, rules.time_counts(), key)
