"""Incremental load of a landing folder with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from daygrid.operators.day_index import DayIndex
from daygrid.operators.layout import PartitionBy
from daygrid.plans.load_job import RESPONSE_COLUMNS, LoadResult, load_records
from daygrid.session import shared_folder
from daygrid.sources.responses import landed_order, split_bodies


def load_landing_folder(
    spark: SparkSession,
    path: str,
    table: str,
    query_name: str,
    files_per_batch: int = 10_000,
    partition_by: PartitionBy | None = None,
    on_batch: Callable[[int, LoadResult], None] | None = None,
    index: DayIndex | None = None,
) -> StreamingQuery:
    """Load the response files that are new since the last call, then stop.

    The stream's log remembers which files were read, so no landed file is parsed twice. A batch that is repeated after
    a crash is harmless: the upsert gives the same rows again. When files of one batch hold the same day of a location,
    each column comes from the newest file that has it.
    """
    schema = StructType([StructField("value", StringType()), StructField("cell_key", StringType())])
    landed = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .text(path, wholetext=True)
        .select("cell_key", landed_order(), F.col("value").alias("body"))
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        records = split_bodies(batch, RESPONSE_COLUMNS)
        result = load_records(spark, records, table, partition_by=partition_by, newest_by="landed", index=index)
        if on_batch is not None:
            on_batch(batch_id, result)
        result.close()

    return (
        landed.writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{shared_folder(spark)}/stream-{query_name}")
        .trigger(availableNow=True)
        .start()
    )
