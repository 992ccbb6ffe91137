"""The places list: a CSV of text columns turned into typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid import fixed_values as fixed
from daygrid.contracts import PLACE_SCHEMA, conform, require_columns
from daygrid.functions.text import lenient_double, missing_to_null


def read_places(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Read places as typed rows. Extra columns are dropped and no row is.

    Columns are taken by header name. When ``path`` holds several files they must share one header:
    ``enforceSchema=False`` makes Spark compare each file's header and fail, where the default would fill columns by
    position and swap values silently.
    """
    paths = [path] if isinstance(path, str) else list(path)
    options = {"header": True, "ignoreLeadingWhiteSpace": True, "ignoreTrailingWhiteSpace": False, "escape": '"'}
    as_text = spark.read.options(**options).csv(paths).schema
    lines = spark.read.options(**options, enforceSchema=False).schema(as_text).csv(paths)
    return type_places(require_columns(lines, fixed.PLACE_COLUMNS, f"places list {path}"))


def type_places(lines: DataFrame) -> DataFrame:
    """Trim text, parse coordinates leniently: a coordinate that is not a number becomes NULL, the row stays."""
    require_columns(lines, fixed.PLACE_COLUMNS, "places")
    typed = {}
    for field in PLACE_SCHEMA.fields:
        if field.dataType.typeName() == "string":
            typed[field.name] = F.trim(F.expr(missing_to_null(field.name)))
        else:
            typed[field.name] = lenient_double(F.col(field.name))  # words for "missing" are not numbers either
    return conform(lines.withColumns(typed), PLACE_SCHEMA)
