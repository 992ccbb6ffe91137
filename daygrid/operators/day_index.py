"""A stored index of which days each key has, so that gaps are found without reading observations.

The index is a table of day masks (key, block of 60 days, present) in the observations' own partitions. A load adds the
masks of its delivery, worked out from the delivery alone; nothing stored is read or moved. Masks of a key and block
may be in any number of rows and are joined by ``bit_or``, so adding the same delivery again changes nothing, and a rerun
repairs a run that died between the observations and the index. ``compact`` joins the rows of partitions that
have gathered many files.

An index never holds a day that the observations lack: an upsert writes observations first and masks after them, and
a rewrite of whole partitions clears their masks first. A run that dies in between leaves days out, and they are fetched again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from daygrid import fixed_values as fixed
from daygrid.contracts import create_table
from daygrid.operators import gaps
from daygrid.operators.layout import PartitionBy, overwriting

# Files of a partition beyond which it is compacted.
MANY_FILES = 16


@dataclass(frozen=True)
class DayIndex:
    """``table`` holds the masks; ``partition_by`` is the layout of the observations it follows."""

    table: str
    partition_by: PartitionBy = field(default_factory=PartitionBy)
    key: str = "cell_key"
    day: str = "date"

    @property
    def names(self) -> list[str]:
        return list(self.partition_by.columns)

    def create(self, spark: SparkSession, location: str | None = None) -> bool:
        schema = StructType(
            [
                StructField(self.key, StringType(), False),
                StructField("block", IntegerType(), False),
                StructField("present", LongType(), False),
            ]
        )
        comment = f"Days stored per {self.key}, {gaps.DAYS_PER_BLOCK} to a mask. Rows of a key and block are joined by bit_or."
        return create_table(spark, self.table, schema, comment, self.partition_by.schema, location=location)

    # --- keeping it up to date ---------------------------------------------------------------------------------------

    def _masks_of(self, rows: DataFrame) -> DataFrame:
        """The masks of ``rows``, in their partitions. Combined on the map side; a block may lie in two months' partitions."""
        placed = self.partition_by.add_to(rows.select(self.key, self.day))
        each = gaps.day_masks(placed, self.key, self.day, *self.names)
        return each.groupBy(*self.names, self.key, "block").agg(F.expr("bit_or(present)").alias("present")).select(*each.columns)

    def add(self, rows: DataFrame) -> None:
        """Add the days of ``rows`` (a delivery that is stored by now)."""
        self._masks_of(rows).hint("rebalance", *self.names).write.insertInto(self.table)
        rows.sparkSession.catalog.refreshTable(self.table)

    def clear(self, spark: SparkSession, touched: Sequence[tuple]) -> None:
        """Forget the days of whole partitions, in one job: each is overwritten with an empty mask."""
        own = overwriting(spark)
        partitions = own.createDataFrame([tuple(p) for p in touched], self.partition_by.schema)
        empty = partitions.select(F.lit("").alias(self.key), F.lit(0).alias("block"), F.lit(0).cast("long").alias("present"), *self.names)
        empty.coalesce(1).write.insertInto(self.table, overwrite=True)
        spark.catalog.refreshTable(self.table)

    def rebuild(self, observations: DataFrame) -> None:
        """The whole index from a scan, for a table that was loaded without one."""
        spark = observations.sparkSession
        self._masks_of(observations).hint("rebalance", *self.names).write.option("partitionOverwriteMode", "static").insertInto(
            self.table, overwrite=True
        )
        spark.catalog.refreshTable(self.table)

    def compact(self, spark: SparkSession, many: int = MANY_FILES) -> int:
        """Join the masks of partitions with more than ``many`` files; returns how many partitions that were."""
        files = spark.table(self.table).select(*self.names, F.col("_metadata.file_path").alias("file")).distinct()
        grown = files.groupBy(*self.names).count().where(F.col("count") > many).select(*self.names).collect()
        if not grown:
            return 0
        own = overwriting(spark)
        rows = self.partition_by.only(own.table(self.table), [tuple(p) for p in grown])
        joined = rows.groupBy(*self.names, self.key, "block").agg(F.expr("bit_or(present)").alias("present"))
        joined = joined.select(*rows.columns).hint("rebalance", *self.names)
        joined.write.insertInto(self.table, overwrite=True)
        spark.catalog.refreshTable(self.table)
        return len(grown)

    # --- asking it ---------------------------------------------------------------------------------------------------

    def masks(self, spark: SparkSession) -> DataFrame:
        """``key, block, present``, in any number of rows for a key and block."""
        return spark.table(self.table).select(self.key, "block", "present").where("present <> 0")

    def missing_blocks(self, ranges: DataFrame) -> DataFrame:
        return gaps.uncovered_blocks(ranges, self.masks(ranges.sparkSession), self.key)

    def gap_report(self, ranges: DataFrame) -> DataFrame:
        return gaps.report_of(self.missing_blocks(ranges), self.key)

    def gap_intervals(self, ranges: DataFrame) -> DataFrame:
        return gaps.gap_intervals(self.missing_blocks(ranges), self.key)

    def missing_days(self, ranges: DataFrame) -> DataFrame:
        return gaps.days_of(self.missing_blocks(ranges), self.key)

    def first_missing_date(self, ranges: DataFrame) -> DataFrame:
        return self.gap_report(ranges).select(self.key, F.col("earliest_gap").alias("first_missing_date"))

    def fetch_ranges(
        self, cells: DataFrame, run_date: date, refresh_days: int = fixed.ROLLING_REFRESH_DAYS, cap_days: int | None = None
    ) -> DataFrame:
        first = self.first_missing_date(gaps.wanted_ranges(cells, run_date, self.key))
        return gaps.fetch_ranges_from(cells, first, run_date, refresh_days, cap_days, self.key)

    def keys(self, spark: SparkSession) -> DataFrame:
        """Every key with a stored day."""
        return self.masks(spark).select(self.key).distinct()

    def differences(self, observations: DataFrame) -> DataFrame:
        """``key, block, stored, indexed``: where the index and a scan of the observations disagree. No rows: it is right."""
        spark = observations.sparkSession
        stored = gaps.day_masks(observations, self.key, self.day).selectExpr(f"`{self.key}`", "block", "present AS stored", "0L AS indexed")
        indexed = self.masks(spark).selectExpr(f"`{self.key}`", "block", "0L AS stored", "present AS indexed")
        both = stored.unionAll(indexed).groupBy(self.key, "block").agg(F.expr("bit_or(stored)").alias("stored"), F.expr("bit_or(indexed)").alias("indexed"))
        return both.where("stored <> indexed")
