"""Table contracts: schemas as code, the DDL and comments made from them, and schema comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from daygrid import fixed_values as fixed
from daygrid.functions.text import sql_quoted


def _field(name: str, data_type: DataType, comment: str, required: bool = False) -> StructField:
    return StructField(name, data_type, not required, {"comment": comment} if comment else None)


PLACE_SCHEMA = StructType(
    [
        _field("place_id", StringType(), ""),
        _field("place_name", StringType(), ""),
        _field("state", StringType(), ""),
        _field("latitude", DoubleType(), ""),
        _field("longitude", DoubleType(), ""),
    ]
)

MAPPING_SCHEMA = StructType(
    [
        _field("place_id", StringType(), "Place identifier from the source list.", True),
        _field("place_name", StringType(), "Name of the place.", True),
        _field("state", StringType(), "State or territory code.", True),
        _field("place_latlon", ArrayType(DoubleType()), "The place as [latitude, longitude] in degrees.", True),
        _field("cell_latlon", ArrayType(DoubleType()), "Nearest grid cell as [latitude, longitude].", True),
        _field("cell_key", StringType(), "Grid cell as 'latitude,longitude' text.", True),
        _field("distance", DoubleType(), "Great-circle distance from the place to its cell, in km.", True),
        _field("backfill_from_date", DateType(), "First day to load for the cell.", True),
    ]
)


def _observation_schema() -> StructType:
    fields = [
        _field("cell_key", StringType(), "Grid cell as 'latitude,longitude' text; joins to the mapping.", True),
        _field("date", DateType(), "Day of the observation.", True),
        _field("lat", DoubleType(), "Cell latitude in degrees.", True),
        _field("lon", DoubleType(), "Cell longitude in degrees.", True),
    ]
    for variable in fixed.DAILY_VARIABLES:
        fields.append(_field(variable, StringType(), fixed.VARIABLE_MEANINGS[variable]))
        code = f"Where {variable} comes from, as a code; the table's comment lists them."
        fields.append(_field(f"{variable}_source", StringType(), code))
    fields.append(_field("created_at", TimestampType(), "When the row was first loaded.", True))
    fields.append(_field("updated_at", TimestampType(), "When the row was last loaded.", True))
    return StructType(fields)


OBSERVATION_SCHEMA = _observation_schema()


def required_columns(schema: StructType) -> list[str]:
    return [field.name for field in schema.fields if not field.nullable]


def require_columns(df: DataFrame, columns: Sequence[str], what: str) -> DataFrame:
    """Fail early, naming every absent column. Looks at metadata only; no job runs."""
    absent = [name for name in columns if name not in df.columns]
    if absent:
        raise ValueError(f"{what} lacks the column(s) {', '.join(absent)}")
    return df


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast to the contract's columns, in its order."""
    return df.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in schema.fields])


def ddl_columns(schema: StructType) -> str:
    """The column list of a CREATE TABLE statement."""
    lines = []
    for field in schema.fields:
        line = f"{field.name} {field.dataType.simpleString().upper()}"
        lines.append(line if field.nullable else f"{line} NOT NULL")
    return ",\n    ".join(lines)


def comment_statements(
    table: str, schema: StructType, table_comment: str, stands_in_for: str | None = None
) -> list[str]:
    """SQL that stores the contract's comments on a table.

    ``stands_in_for`` names the production table when ``table`` is not it; the table comment then starts with a
    warning. Columns without a comment are left alone.
    """
    if stands_in_for:
        table_comment = f"Test copy, not kept up to date; use {stands_in_for} instead.\n\n{table_comment}"
    statements = [f"COMMENT ON TABLE {table} IS {sql_quoted(table_comment)}"]
    for field in schema.fields:
        comment = field.metadata.get("comment")
        if comment:
            statements.append(f"ALTER TABLE {table} ALTER COLUMN {field.name} COMMENT {sql_quoted(comment)}")
    return statements


def create_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    table_comment: str = "",
    partition_by: StructType | None = None,
    stands_in_for: str | None = None,
    location: str | None = None,
    table_format: str = "parquet",
    clustering: tuple[str, int] | None = None,
) -> bool:
    """Create the table (and its schema) if absent; comments are stored on first creation only.

    ``partition_by`` holds derived columns (see ``operators.upsert.PartitionBy``), stored after the contract's own.
    ``clustering`` (a column, and into how many files a partition is split by its hash) is part of the table's
    definition, so that joins know it. Returns True when the table was created now.
    """
    if "." in table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    existed = spark.catalog.tableExists(table)
    stored = StructType(schema.fields + (partition_by.fields if partition_by else []))
    partitioning = f" PARTITIONED BY ({', '.join(partition_by.names)})" if partition_by else ""
    if clustering:
        partitioning += f" CLUSTERED BY ({clustering[0]}) INTO {clustering[1]} BUCKETS"
    placed = f" LOCATION {sql_quoted(location)}" if location else ""
    columns = ddl_columns(stored)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (\n    {columns}\n) USING {table_format}{partitioning}{placed}")
    if not existed:
        for statement in comment_statements(table, schema, table_comment, stands_in_for):
            spark.sql(statement)
    return not existed


MISMATCH_SCHEMA = "position int, expected_column string, expected_type string, actual_column string, actual_type string"


def schema_mismatches(actual: StructType, expected: StructType, check_nullable: bool = False) -> list[tuple]:
    """Every position where name, type or order differ. Comments are ignored; nullability only on request."""

    def describe(schema: StructType, position: int) -> tuple[str | None, str | None]:
        if position >= len(schema.fields):
            return None, None
        field = schema.fields[position]
        optional = " not null" if check_nullable and not field.nullable else ""
        return field.name, field.dataType.simpleString() + optional

    return [
        (position, *describe(expected, position), *describe(actual, position))
        for position in range(max(len(actual.fields), len(expected.fields)))
        if describe(expected, position) != describe(actual, position)
    ]


def schema_mismatch_frame(
    spark: SparkSession, actual: StructType, expected: StructType, check_nullable: bool = False
) -> DataFrame:
    return spark.createDataFrame(schema_mismatches(actual, expected, check_nullable), MISMATCH_SCHEMA)


def enforce_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail the job on the first NULL in a required column.

    Parquet tables accept NULL in a NOT NULL column without a word, so the gate sits in the plan that writes: no
    second pass over the data and no action of its own.
    """

    def gated(name: str) -> Column:
        message = F.lit(f"NULL in required column '{name}'")
        return F.coalesce(F.col(name), F.raise_error(message).cast(df.schema[name].dataType)).alias(name)

    return df.select(*[gated(name) if name in columns else F.col(name) for name in df.columns])


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per required column with the number of NULLs in it, from one pass."""
    counted = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counted.unpivot([], list(columns), "column_name", "null_count")
