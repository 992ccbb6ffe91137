"""What several operators share: reading tables, written intermediate tables, checked broadcasts, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from daygrid.session import new_work_folder

WHITE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A table of at most this many narrow rows (some 16 bytes each) may be broadcast.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared folder and read back: lineage ends here, and a lost executor loses nothing."""
    path = new_work_folder(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` dealt out by ``columns`` to as many tasks as the session shuffles to: few bytes may be much work."""
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, *columns)


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else as it is. ``df`` should be a written table."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def computed(df: DataFrame) -> DataFrame:
    """``df`` with its columns computed once, here.

    Spark moves a filter below the projections under it and repeats their expressions in the filter, nested ones many
    times over. It cannot move one below a generator, so later filters and joins use the values.
    """
    return df.select(F.inline_outer(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def beside(df: DataFrame, keep: tuple[str, ...], own: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """The columns ``keep`` of ``df`` as they are, and what ``own`` makes, row by row, of all its other columns.

    Kept columns never pass through pandas, where whole numbers beside a null would become fractions.
    """
    others = [c for c in df.columns if c not in keep]
    made = {f.name: to_arrow_type(f.dataType) for f in StructType.fromDDL(schema)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = own(batch.select(others).to_pandas())
            columns = [*(batch.column(c) for c in keep), *(pa.Array.from_pandas(out[c], type=t) for c, t in made.items())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *made])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*[f"`{c}`" for c in keep]).schema.fields]
    return df.select(*[f"`{c}`" for c in (*keep, *others)]).mapInArrow(run, ", ".join([*kept, schema]))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; ``lower`` would change other letters too, so it serves plain ASCII only."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))


def neighbours(left: str, right: str, distance: int, join: Callable[[Column, Column], Column]) -> Column:
    """``join(left[i], right[i + distance])`` for every i that has both; both are columns by name, equally long."""
    n = F.greatest(F.size(right) - distance, F.lit(0))
    ahead = F.slice(right, F.lit(distance + 1), n)
    return F.zip_with(F.slice(left, F.lit(1), n), ahead, join)


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; no words if it is null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def sha256_of(parts: Column) -> Column:
    """Lower-case hex digest of an array of strings, joined by commas."""
    return F.sha2(F.array_join(parts, ",").cast("binary"), 256)


def _fixed_point(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(u, root) for every node of the undirected ``edges`` (u, v): root is the smallest node that u reaches.

    Large-star and small-star steps in turn until nothing changes. Each step keeps at most one edge for each edge before
    it, hubs are aggregated before they are joined, and every round is a written table. Edges of a node with itself
    and repeated edges do no harm.
    """
    edges = staged(edges.where("u <> v").distinct(), "edges")
    before = _fixed_point(edges)
    for _ in range(rounds):
        around = _both_ways(edges)
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        below = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        least = below.groupBy("u").agg(F.min("v").alias("m"))
        small = below.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = staged(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _fixed_point(edges)
        if now == before:
            return edges.groupBy("u").agg(F.min("v").alias("root")).unionAll(
                edges.select(F.col("v").alias("u")).distinct().select("u", F.col("u").alias("root"))
            )
        before = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
