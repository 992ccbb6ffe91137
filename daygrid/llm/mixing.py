"""Mixing sources to target weights by entropy balancing.

Each source has a target number of words. Of all document rates r in [0, 2] that meet it, the one closest to 1 in
relative entropy (with a document's words as the constraint) is an exponential tilt, r = min(2, exp(lambda * size / mean
size)). The convex dual has one lambda per source. Newton steps, kept within a bracket, solve it for all sources at
once; each is one Spark aggregation over the counts of (source, size), which are gathered once. Sums are
decimals, so their order does not matter and reruns agree.

Rates become copies: the whole part is taken, and the fraction f by a hash of the row, u: rows are taken in the order of
u / f until the source's words are as close to the target as they can be. That order is cut by three rounds of histograms
with 1,024 bins for each source, not by sorting; a source may hold any share of the rows.

Targets: sources by code point, a null source last, weigh 5, 2, 1, 5, ... and share 150 % of all words; a target stops
at twice the source's words, and the excess goes to the others by weight until none is above. They are computed exactly.

Nulls and edge cases: a null or blank text has size 0 and is taken 0 words; a null source is a source; a source without
words has target 0. Rows equal in doc_id and text have the same hash and stand at one place of the order; where a cut falls on
such a place, as many of its rows are taken as bring the source nearest to its target. Other columns are not looked at; an empty table
gives an empty result. The pipeline's column ``copy`` takes another name where the documents have it, in any case.
"""

from __future__ import annotations

import itertools
import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daygrid.llm.common import computed, small_enough, staged, table, words_of

WEIGHTS = (5, 2, 1)
#: Share of all words to take, and the most copies of a document, both as they enter the targets.
SHARE = (3, 2)
MOST = 2
STEPS = 80
TOLERANCE = Decimal("1e-7")
_BITS, _ROUNDS = 10, 3
_DOMAIN = 1 << (_BITS * _ROUNDS)
_EXACT = "decimal(38,9)"
_LOG_MOST = math.log(MOST)


def sized(docs: DataFrame, keep: tuple[str, ...] = (), text: str = "text", source: str = "source", id: str = "doc_id") -> DataFrame:
    """The columns ``keep``, _s (the source; never null, and in order), _size (words) and _u (a hash of id and text)."""
    name = F.col(source).cast("string")
    key = F.when(name.isNull(), F.lit("n")).otherwise(F.concat(F.lit("k"), name))
    rows = docs.select(
        *[F.col(c) for c in keep],
        key.alias("_s"),
        F.size(words_of(F.col(text))).cast("long").alias("_size"),
        F.xxhash64(F.col(id), F.col(text)).alias("_u"),
    )
    return computed(rows)


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds rank, from 0, in the order of _s: ranges are dealt out and numbered in themselves, then offset."""
    spark = sources.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    parts = staged(sources.repartitionByRange(tasks, "_s").withColumn("_part", F.spark_partition_id()), "sources")
    offsets, total = [], 0
    for row in parts.groupBy("_part").count().orderBy("_part").collect():  # a row for each range
        offsets.append((row["_part"], total))
        total += row["count"]
    starts = spark.createDataFrame(offsets, "_part int, _start long")
    number = F.row_number().over(Window.partitionBy("_part").orderBy("_s")) - 1
    return parts.join(F.broadcast(starts), "_part").withColumn("rank", number + F.col("_start")).drop("_part", "_start")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds target (double) and full (it stops at MOST times the words) to (_s, source_size)."""
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod("rank", F.lit(len(weights))).cast("int"))
    known = staged(_ranked(sources).withColumn("weight", weight), "weights")
    share, out_of = SHARE
    size = F.col("source_size").cast("decimal(38,0)")
    total = known.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    left, over = Decimal(share * int(total)), None
    while True:
        # An open source gets weight * left / (out_of * over); it is full where that is above MOST * size.
        if over is None:
            full = F.lit(False)
        else:
            full = F.col("weight").cast("decimal(3,0)") * F.lit(left) > size * F.lit(Decimal(MOST * out_of) * over)
        taken, open_ = known.agg(
            F.coalesce(F.sum(F.when(full, size)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        now = Decimal(share * int(total) - MOST * out_of * int(taken)), Decimal(int(open_))
        if now == (left, over) or not open_:
            break
        left, over = now
    each = F.col("weight") * F.lit(float(left) / (out_of * float(over)) if over else 0.0)
    target = F.when(full, F.col("source_size").cast("double") * MOST).otherwise(each)
    return known.withColumn("target", target).withColumn("full", full)


def _rate(tilt: Column, size: Column, mean: Column) -> Column:
    """The document's rate; a full source (no tilt) takes MOST copies of everything."""
    return F.when(tilt.isNull(), F.lit(float(MOST))).otherwise(F.exp(F.least(tilt * size / mean, F.lit(_LOG_MOST))))


def tilts(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds tilt, the dual's solution, and mean (size) to ``sources``; ``sizes`` is (_s, _size, n). No tilt if it is full."""
    some = sizes.where("_size > 0").groupBy("_s").agg(
        F.min("_size").alias("least"), (F.sum(F.col("_size") * F.col("n")) / F.sum("n")).alias("mean")
    )
    start = sources.join(some, "_s", "left").withColumn("mean", F.coalesce("mean", F.lit(1.0)))
    size, target = F.col("source_size").cast("double"), F.col("target")
    solve = ~F.col("full") & (size > 0) & (target > 0)
    # Where every document had the smallest size, these tilts would be exact; else they are too far out.
    low = F.when(target < size, F.log(target / size) * F.col("mean") / F.col("least")).otherwise(0.0)
    high = F.when(target < size, 0.0).otherwise(F.lit(_LOG_MOST) * F.col("mean") / F.col("least"))
    state = start.withColumn("low", F.when(solve, low)).withColumn("high", F.when(solve, high))
    state = state.withColumn("tilt", F.when(solve, F.lit(0.0))).withColumn("off", F.when(solve, F.lit(1).cast(_EXACT)))
    state = staged(state, "tilts")
    for _ in range(STEPS):
        z = F.col("_size") / F.col("mean")
        words = F.col("_size") * F.col("n")
        rate = _rate(F.col("tilt"), F.col("_size"), F.col("mean"))
        slope = F.when(F.col("tilt") * z < F.lit(_LOG_MOST), words * z * rate).otherwise(0.0)
        met = (
            sizes.join(small_enough(state.where("tilt IS NOT NULL")), "_s")
            .groupBy("_s")
            .agg(F.sum((words * rate).cast("decimal(28,9)")).alias("got"), F.sum(slope.cast("decimal(28,9)")).alias("slope"))
        )
        joined = state.join(met, "_s", "left")
        miss = F.col("got").cast("double") - F.col("target")
        low = F.when(miss < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(miss < 0, F.col("high")).otherwise(F.col("tilt"))
        newton = F.col("tilt") - F.try_divide(miss, F.col("slope").cast("double"))
        inside = newton.isNotNull() & (newton > low) & (newton < high)
        step = F.when(inside, newton).otherwise((low + high) / 2)
        columns = [c for c in state.columns if c not in ("low", "high", "tilt", "off")]
        off = F.abs(miss) / F.col("target")
        now = F.when(off < float(TOLERANCE), F.col("tilt")).otherwise(step)
        state = staged(joined.select(*columns, low.alias("low"), high.alias("high"), now.alias("tilt"), off.cast(_EXACT).alias("off")), "tilts")
        worst = state.agg(F.max("off")).first()[0]
        if worst is None or worst < TOLERANCE:
            break
    return state.withColumn("tilt", F.when(F.col("full"), F.lit(None).cast("double")).otherwise(F.coalesce("tilt", F.lit(0.0)))).drop("low", "high", "off", "least")


def _parts() -> tuple[Column, Column]:
    """Whole copies, and the row's place in the order in which fractions are taken (null if there is no fraction)."""
    rate = _rate(F.col("tilt"), F.col("_size"), F.col("mean"))
    whole = F.floor(rate)
    fraction = rate - whole
    u = (F.pmod("_u", F.lit(1 << 52)) + 0.5) / float(1 << 52)
    place = F.floor(u / (u + fraction) * _DOMAIN).cast("long")
    return whole, F.when((fraction > 0) & (F.col("_size") > 0), place)


def cuts(rows: DataFrame, state: DataFrame) -> DataFrame:
    """Adds cut, some and rows to ``state``: fractions at places below cut are taken, and ``some`` of the ``rows`` at it."""
    whole, place = _parts()
    rated = rows.join(small_enough(state), "_s").select("_s", "_size", whole.alias("whole"), place.alias("place"))
    rated = staged(rated, "rated")
    base = rated.groupBy("_s").agg(F.sum(F.col("_size") * F.col("whole")).alias("base"))
    wanted = state.join(base, "_s").select("_s", (F.col("target") - F.col("base")).alias("wanted"))
    # below: the words at places before the bin; prefix: the bin.
    search = staged(wanted.withColumn("below", F.lit(0).cast("long")).withColumn("prefix", F.lit(0).cast("long")), "search")
    for turn in range(_ROUNDS):
        shift = _BITS * (_ROUNDS - 1 - turn)
        digit = F.shiftright("place", shift)
        here = rated.where("place IS NOT NULL").join(small_enough(search.drop("in_bin")), "_s")
        here = here.where(F.shiftright("place", shift + _BITS) == F.col("prefix"))
        bins = here.groupBy("_s", digit.alias("bin")).agg(F.sum("_size").alias("words"), F.max("wanted").alias("wanted"), F.max("below").alias("below"))
        upto = F.sum("words").over(Window.partitionBy("_s").orderBy("bin"))  # at most 1,024 bins for each source
        before = bins.withColumn("upto", upto + F.col("below"))
        # The bin in which the wanted number of words is passed; without one, everything is taken.
        passed = before.where(F.col("upto") > F.col("wanted")).groupBy("_s").agg(
            F.min(F.struct("bin", (F.col("upto") - F.col("words")).alias("below"), F.col("words").alias("in_bin"))).alias("first")
        )
        last = F.lit((1 << (_BITS * (turn + 1))) - 1)
        at = search.drop("in_bin").join(passed, "_s", "left")
        below = F.coalesce(F.col("first.below"), F.col("below"))
        found = at.select("_s", "wanted", below.alias("below"), F.coalesce("first.bin", last).alias("prefix"), "first.in_bin")
        search = staged(found, "search")
    # The bin itself is split by rows: as many as come closest. All rows of a repeated document are at one place.
    edge = rated.join(small_enough(search.select("_s", F.col("prefix").alias("place"))), ["_s", "place"])
    edge = edge.groupBy("_s").agg(F.count("*").alias("rows"))
    split = search.join(edge, "_s", "left").withColumn("each", F.col("in_bin") / F.col("rows"))
    some = F.round((F.col("wanted") - F.col("below")) / F.col("each"))
    some = F.greatest(F.least(some, F.col("rows")), F.lit(0)).cast("long")
    cut = F.when(F.col("in_bin").isNull(), F.col("prefix") + 1).otherwise(F.col("prefix"))
    return state.join(split.select("_s", cut.alias("cut"), F.coalesce(some, F.lit(0)).alias("some"), F.col("rows")), "_s", "left")


def copied(rows: DataFrame, state: DataFrame) -> DataFrame:
    """``rows`` with the columns of their source and _n, how often each is taken.

    Rows at their source's cut are numbered, in two steps: within the task that read them, and by task. So a document whose
    copies are a third of all rows is not one group.
    """
    whole, place = _parts()
    found = rows.join(small_enough(state), "_s").withColumn("_place", place)
    taken = whole + F.when(F.col("_place") < F.col("cut"), 1).otherwise(0)
    at_edge = F.coalesce((F.col("_size") > 0) & (F.col("_place") == F.col("cut")), F.lit(False))
    # All or nothing needs no numbers.
    numbered = at_edge & (F.col("some") > 0) & (F.col("some") < F.col("rows"))
    taken = taken + F.when(at_edge & (F.col("some") == F.col("rows")), 1).otherwise(0)
    plain = found.where(~numbered).withColumn("_n", F.when(F.col("_size") > 0, taken).otherwise(0).cast("int"))
    edge = staged(found.where(numbered).withColumn("_task", F.spark_partition_id()), "edge")
    before = Window.partitionBy("_s").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = edge.groupBy("_s", "_task").agg(F.count("*").alias("n"))
    tasks = tasks.select("_s", "_task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.row_number().over(Window.partitionBy("_s", "_task").orderBy("_size"))
    edge = edge.join(tasks, ["_s", "_task"]).withColumn("_number", number)
    edge = edge.withColumn("_n", (taken + F.when(F.col("_number") <= F.col("some"), 1).otherwise(0)).cast("int"))
    return plain.select(*plain.columns).unionByName(edge.select(*plain.columns))


def balance(rows: DataFrame) -> DataFrame:
    """The sources of ``rows`` (_s, _size, _u), with source_size, target and all that ``copied`` needs."""
    rows = staged(rows.select("_s", "_size", "_u"), "sized")
    sizes = staged(rows.groupBy("_s", "_size").agg(F.count("*").alias("n")), "sizes")
    sources = targets(sizes.groupBy("_s").agg(F.sum(F.col("_size") * F.col("n")).alias("source_size")))
    return staged(cuts(rows, staged(tilts(sizes, sources), "tilts")), "balance")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged(sized(table(spark, sf_dir, "documents"), ("doc_id",)), "sized")
    found = copied(rows, balance(rows))
    return found.select("doc_id", F.col("_size").alias("size"), "source_size", "target", (F.col("_n") * F.col("_size")).alias("taken"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as often as the mix takes it, numbered by ``copy`` from 0."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    inner = docs.select(row.alias("doc"), F.col("text").alias("_text"), F.col("source").alias("_source"), F.col("doc_id").alias("_id"))
    rows = sized(inner, ("doc",), "_text", "_source", "_id")
    found = copied(rows, balance(rows))
    numbers = F.when(F.col("_n") > 0, F.sequence(F.lit(0), F.col("_n") - 1)).otherwise(F.array().cast("array<int>"))
    each = found.select("doc", F.explode_outer(numbers).alias("_copy")).where("_copy IS NOT NULL")
    held = {c.lower() for c in docs.columns}
    names = itertools.chain(("copy", "mix_copy"), (f"mix_copy_{k}" for k in itertools.count(2)))
    return each.select("doc.*", F.col("_copy").alias(next(name for name in names if name not in held)))
