"""How a keyed daily table is laid out: partitions derived from the key, and clusters of files inside them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Shares of a month in the default layout; a table keeps the number it was created with.
BUCKETS = 16

# Stored rows that one task of a clustered merge joins and sorts, some 220 bytes of memory each for narrow ones.
CLUSTER_ROWS, LEAST_CLUSTERS = 1_000_000, 8

# Inserting into a table takes the overwrite mode from the session, not from the writer. The second setting is the
# HotSpot limit above which a method is never compiled: a wide row's generated code passes it, and Spark then does
# better with several smaller methods.
_WRITE_SETTINGS = {
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}



def _by_month() -> dict[str, Column]:
    return {"month": F.date_format("date", "yyyy-MM")}


def _by_bucket(buckets: int = BUCKETS, key: str = "cell_key") -> dict[str, Column]:
    return {"bucket": F.lpad(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string"), 4, "0")}


@dataclass(frozen=True)
class PartitionBy:
    """Partition columns derived from the key, so that an upsert knows which partitions it touches.

    The default is the month of the date, split by a hash of the key. A daily run refreshes the last 30 days of *every*
    key: by month it rewrites two or three months, where directories per key would make it rewrite all of them. A new
    cell's whole history, or an old gap, rewrites one bucket of each month instead of the table.
    """

    columns: dict[str, Column] = field(default_factory=lambda: {**_by_month(), **_by_bucket()})
    clusters: int = 0
    cluster_key: str = "cell_key"

    @classmethod
    def month(cls) -> PartitionBy:
        """Months alone, for tables so small that buckets would only make small files."""
        return cls(_by_month())

    @classmethod
    def month_and_bucket(cls, buckets: int = BUCKETS, key: str = "cell_key") -> PartitionBy:
        """The default layout with another number of buckets; the daily refresh costs the same whatever it is."""
        return cls({**_by_month(), **_by_bucket(buckets, key)})

    @classmethod
    def clustered(cls, clusters: int, columns: dict[str, Column] | None = None, key: str = "cell_key") -> PartitionBy:
        """Partitions (months, if nothing else is given) whose files are clustered by the key, ``clusters`` files each.

        A merge then joins every cluster of the stored rows where it is: only the delivery is shuffled, and each task
        writes its own cluster. For deliveries that touch most keys of few partitions, as the daily refresh does; a few
        keys' long history still rewrites whole partitions. ``clusters`` is the number of tasks of a merge, so it
        follows the size of the touched partitions (``clustered_for``): some 128 MB a task.
        """
        return cls(columns or _by_month(), clusters, key)

    @classmethod
    def clustered_for(cls, rows: int, columns: dict[str, Column] | None = None, key: str = "cell_key") -> PartitionBy:
        """``clustered`` with as many clusters as a delivery asks for that touches ``rows`` stored rows.

        A task's memory then stays the same whatever the table's size. The number is fixed when the table is created, so
        ``rows`` is what its touched partitions are to hold, not what they hold on the first day.
        """
        return cls.clustered(max(LEAST_CLUSTERS, -(-rows // CLUSTER_ROWS)), columns, key)

    @property
    def clustering(self) -> tuple[str, int] | None:
        return (self.cluster_key, self.clusters) if self.clusters else None

    @property
    def schema(self) -> StructType:
        return StructType([StructField(name, StringType(), False) for name in self.columns])

    def only(self, rows: DataFrame, listed: Sequence[tuple]) -> DataFrame:
        """The rows of the listed partitions. Values per column prune the directories; combinations are then matched exactly."""
        names = list(self.columns)
        for name, values in zip(names, zip(*listed, strict=True), strict=True):
            rows = rows.where(F.col(name).isin(*set(values)))
        if len(names) == 1:
            return rows
        # Partition values are text without control characters, so the joined text tells combinations apart.
        return rows.where(F.concat_ws("\x01", *names).isin(*["\x01".join(partition) for partition in listed]))

    def add_to(self, df: DataFrame) -> DataFrame:
        return df.withColumns({name: value.cast("string") for name, value in self.columns.items()})


def overwriting(spark: SparkSession, more: Mapping[str, str] | None = None) -> SparkSession:
    """A session of its own that overwrites partitions; the mode of other writers in this one neither matters nor changes."""
    own = spark.newSession()
    for name, value in {**_inherited(spark), **_WRITE_SETTINGS, **(more or {})}.items():
        own.conf.set(name, value)
    return own


def _inherited(spark: SparkSession) -> dict[str, str]:
    """Settings of the caller's session that decide a write's meaning or size."""
    names = ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.ansi.enabled")
    return {name: spark.conf.get(name) for name in names}
