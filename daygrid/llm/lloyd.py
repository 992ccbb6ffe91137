"""Lloyd's clustering with the dimensions in shards: exact integer distances, block by block.

1. Vectors are packed into chunks of ``ROWS`` rows, and each chunk into blocks of ``width`` columns.
2. A task on a column block computes the partial squared distances of its chunk to its slice of the centroids. No task
   needs a whole centroid, so clusters x dimensions may outgrow a task's memory.
3. By chunk, the partial distances of all blocks are added and the nearest centroid is taken. The same task adds the
   chunk's vectors by cluster, once for each block, and these sums (never the vectors) go to the shards.
4. Each shard adds its sums in two steps and updates its own slice of the centroids. A round's slices are a written table.

Groups are chunks (``blocks`` rows of a known size) and shards (sums of tasks, split in ``SPLIT`` parts first), so no
cluster, however many vectors it holds, is ever one group. All arithmetic is on whole numbers: in float64 where every result
stays below 2**53, in int64 below 2**62, else with Python's own integers.

Nulls and edge cases: a vector that is null, of another length, or has a null or non-finite component is left out. A null
id counts as the empty string when the first centroids are chosen; equal hashes are ordered by their vectors. Repeated rows
are rows of their own; two equal first centroids leave the later one empty, and it stays as it is. Fewer vectors than
clusters: as many clusters as vectors. An empty table gives no rows. Distances and inertias beyond a long are 2**63 - 1. Other columns
are not looked at.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daygrid.llm.common import small_enough, staged, table

ROWS, WIDTH, SPLIT = 2048, 16, 32
#: Centroid slices of at most this many bytes together are broadcast.
BROADCAST_BYTES = 16 << 20
_LONG = 2**63 - 1


def _integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), exact for any finite x."""
    with np.errstate(over="ignore"):
        y = x * scale
    if (np.abs(y) < 2.0**62).all():
        return np.floor(y).astype(np.int64)
    return np.array([int(v) * scale if abs(v) >= 2.0**53 else math.floor(v * scale) for v in x.ravel().tolist()], dtype=object).reshape(x.shape)


def _bytes(a: np.ndarray) -> bytes:
    """``a`` in the narrowest type that holds it."""
    if a.dtype != object and a.size:
        low, high = int(a.min()), int(a.max())
        kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
        a = a.astype(kind)
    return pickle.dumps(a, protocol=5)


def _array(b: bytes) -> np.ndarray:
    a = pickle.loads(b)
    return a if a.dtype == object else a.astype(np.int64)


def _largest(a: np.ndarray) -> int:
    return max(abs(int(a.min())), abs(int(a.max()))) if a.size else 0


def _kind(bound: int) -> type:
    """The cheapest type in which numbers up to ``bound`` are exact."""
    return np.float64 if bound < 2**53 else np.int64 if bound < 2**62 else object


def partial_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances (row, centroid) over the columns of one block."""
    kind = _kind(4 * x.shape[1] * max(_largest(x), _largest(c)) ** 2)
    x, c = x.astype(kind), c.astype(kind)
    d = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]
    return d.astype(np.int64) if kind is np.float64 else d


def _added(total: np.ndarray | None, a: np.ndarray) -> np.ndarray:
    if total is None:
        return a
    if object not in (total.dtype, a.dtype) and _largest(total) + _largest(a) >= 2**62:
        total = total.astype(object)
    return total + a


def sums_by_cluster(x: np.ndarray, own: np.ndarray, clusters: int) -> np.ndarray:
    """(cluster, column) sums of the rows of ``x``; ``own`` are their clusters."""
    if x.dtype != object and _largest(x) * len(x) >= 2**62:
        x = x.astype(object)
    order = np.argsort(own, kind="stable")
    found, starts = np.unique(own[order], return_index=True)
    out = np.zeros((clusters, x.shape[1]), dtype=x.dtype)
    out[found] = np.add.reduceat(x[order], starts, axis=0)
    return out


def _packed(kept: DataFrame, dims: int, scale: int, width: int) -> DataFrame:
    """(chunk, block, body), and the ids of each chunk as its block -1. The ids never leave Arrow."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids, vectors = part.column(0), part.column(1)
                x = _integers(vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims), scale)
                bodies = [None, *[_bytes(x[:, i : i + width]) for i in range(0, dims, width)]]
                n = len(bodies)
                held = pa.ListArray.from_arrays(pa.array([0] + [len(ids)] * n, pa.int32()), ids)
                columns = [pa.array([chunk] * n, pa.int64()), pa.array(range(-1, n - 1), pa.int32()), pa.array(bodies, pa.binary()), held]
                yield pa.RecordBatch.from_arrays(columns, names=["chunk", "block", "body", "ids"])
                chunk += 1

    kind = kept.schema["id"].dataType.simpleString()
    return staged(kept.mapInArrow(pack, f"chunk long, block int, body binary, ids array<{kind}>"), "vectors")


def _first(kept: DataFrame, clusters: int, scale: int, width: int) -> DataFrame:
    """The slices (block, body) of the first centroids."""
    name = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    chosen = kept.select(name.alias("h"), "v").orderBy("h", "v").limit(clusters)
    numbered = chosen.withColumn("k", F.row_number().over(Window.orderBy("h", "v"))).select("k", F.posexplode("v").alias("i", "x"))
    numbered = numbered.withColumn("block", F.floor(F.col("i") / width).cast("int"))

    def slices(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["k", "i"])
        body = _integers(group["x"].to_numpy(np.float64).reshape(group["k"].nunique(), -1), scale)
        return pd.DataFrame({"block": [int(group["block"].iloc[0])], "body": [_bytes(body)]})

    return staged(numbered.groupBy("block").applyInPandas(slices, "block int, body binary"), "centroids")


def _beside(packed: DataFrame, slices: DataFrame) -> DataFrame:
    """Each block with its slice of the centroids: broadcast if all slices are small, else joined with split shards."""
    slices = slices.select("block", F.col("body").alias("slice"))
    size = slices.agg(F.coalesce(F.sum(F.length("slice")), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        return packed.join(F.broadcast(slices), "block")
    split = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = slices.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(split - 1))))
    return packed.withColumn("part", F.pmod(F.xxhash64("chunk"), F.lit(split)).cast("int")).join(many, ["block", "part"]).drop("part")


def _distances(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for chunk, block, body, part in zip(batch["chunk"], batch["block"], batch["body"], batch["slice"]):
            partial = _bytes(partial_distances(_array(body), _array(part)))
            yield pd.DataFrame({"chunk": [chunk], "block": [block], "body": [body], "partial": [partial]})


def _nearest(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    total = None
    for partial in group["partial"]:
        total = _added(total, _array(partial))
    own = np.argmin(total, axis=1)  # the first of equal ones
    return own, total[np.arange(len(own)), own], total.shape[1]


def _chunk_sums(group: pd.DataFrame) -> pd.DataFrame:
    own, _, clusters = _nearest(group)
    counts = np.bincount(own, minlength=clusters)[:, None]
    bodies = [_bytes(np.concatenate((sums_by_cluster(_array(b), own, clusters), counts), axis=1)) for b in group["body"]]
    return pd.DataFrame({"block": group["block"], "body": bodies})


def _chunk_clusters(group: pd.DataFrame) -> pd.DataFrame:
    own, distance, _ = _nearest(group)
    return pd.DataFrame({"chunk": [int(group["chunk"].iloc[0])], "cluster": [own.tolist()], "distance": [[min(int(d), _LONG) for d in distance]]})


def _task_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row of sums for each block and task."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, body in zip(batch["block"], batch["body"]):
            sums[block] = _added(sums.get(block), _array(body))
    part = TaskContext.get().partitionId() % SPLIT
    yield pd.DataFrame({"block": list(sums), "part": part, "body": [_bytes(s) for s in sums.values()]})


def _sum(group: pd.DataFrame) -> pd.DataFrame:
    total = None
    for body in group["body"]:
        total = _added(total, _array(body))
    return pd.DataFrame({"block": [int(group["block"].iloc[0])], "body": [_bytes(total)]})


def _updated(group: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
    """The shard's next slice; empty clusters keep theirs."""
    if not len(group):
        return old
    total, slice_ = _array(_sum(group)["body"].iloc[0]), _array(old["body"].iloc[0])
    sums, counts = total[:, :-1], total[:, -1:]
    new = np.where(counts > 0, sums // np.maximum(counts, 1), slice_)
    return pd.DataFrame({"block": old["block"], "body": [_bytes(new)]})


def _digests(slices: DataFrame) -> DataFrame:
    """(cluster, centroid_sha256)."""

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, body in zip(batch["block"], batch["body"]):
                rows = [",".join(map(str, row)) for row in _array(body).tolist()]
                yield pd.DataFrame({"cluster": range(len(rows)), "block": block, "text": rows})

    parts = slices.mapInPandas(texts, "cluster int, block int, text string").groupBy("cluster")
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "text"))), lambda s: s["text"]), ",")
    return parts.agg(F.sha2(whole.cast("binary"), 256).alias("centroid_sha256"))


def _as_long(total: Column) -> Column:
    return F.least(total, F.lit(_LONG).cast("decimal(38,0)")).cast("long")


def cluster(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", dims: int = 64, clusters: int = 16, rounds: int = 3, scale: int = 64, width: int = WIDTH
) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept row of ``vectors``."""
    v = F.col("v")
    kept = vectors.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    unfit = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = kept.where((F.size(v) == dims) & ~unfit)
    packed = _packed(kept, dims, scale, width)
    blocks = packed.where("block >= 0").select("chunk", "block", "body")
    slices = _first(kept, clusters, scale, width)

    def partials() -> DataFrame:
        return _beside(blocks, slices).mapInPandas(_distances, "chunk long, block int, body binary, partial binary").groupBy("chunk")

    for _ in range(rounds):
        by_task = partials().applyInPandas(_chunk_sums, "block int, body binary").mapInPandas(_task_sums, "block int, part int, body binary")
        by_part = by_task.groupBy("block", "part").applyInPandas(_sum, "block int, body binary")
        slices = staged(by_part.groupBy("block").cogroup(slices.groupBy("block")).applyInPandas(_updated, "block int, body binary"), "centroids")
    assigned = staged(partials().applyInPandas(_chunk_clusters, "chunk long, cluster array<int>, distance array<long>"), "clusters")

    each = assigned.select(F.inline(F.arrays_zip("cluster", "distance")))
    inertia = each.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))
    stats = staged(inertia.join(_digests(slices), "cluster"), "inertia")
    whole = stats.agg(_as_long(F.sum("own"))).first()[0]
    rows = packed.where("block = -1").select("chunk", "ids").join(assigned, "chunk")
    rows = rows.select(F.inline(F.arrays_zip("ids", "cluster", "distance"))).join(small_enough(stats), "cluster")
    return rows.select(
        F.col("ids").alias(id), "cluster", "distance", _as_long(F.col("own")).alias("cluster_inertia"),
        F.lit(whole).cast("long").alias("inertia"), "centroid_sha256",
    )


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))
