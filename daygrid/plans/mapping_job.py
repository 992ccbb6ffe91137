"""Build the mapping table from a places list."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession

from daygrid import fixed_values as fixed
from daygrid.contracts import MAPPING_SCHEMA, create_table, required_columns
from daygrid.functions.geo import Grid
from daygrid.operators.mapping import place_cell_mapping
from daygrid.operators.upsert import replace_table
from daygrid.sources.places import read_places

TABLE_COMMENT = "Each listed place with its nearest grid cell, the distance to it and the first day to load."


def build_mapping_table(
    spark: SparkSession,
    places_path: str | Sequence[str],
    table: str,
    grid: Grid = Grid(),
    backfill_from: date = fixed.BACKFILL_START,
    stands_in_for: str | None = None,
    location: str | None = None,
) -> int:
    """Rebuild ``table`` from the places at ``places_path``; returns its row count.

    One job reads, maps and writes; the count comes with the write.
    """
    create_table(spark, table, MAPPING_SCHEMA, TABLE_COMMENT, stands_in_for=stands_in_for, location=location)
    mapping = place_cell_mapping(read_places(spark, places_path), grid, backfill_from)
    return replace_table(mapping, table, required_columns(MAPPING_SCHEMA))
