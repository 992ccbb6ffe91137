"""Benchmark decontamination by a prefix-filtered set join, with DataFrame functions alone.

An item's window (13 words, or the whole item if it is shorter) is a set of shingles with places; a document contains the
window if it holds all of them in a row. Shingles are ordered by rarity, that is by the number of distinct texts that hold them. As all of
them must be there, one, the rarest, is the necessary prefix: only its occurrences are candidates. Length
and position bounds drop those whose window would stick out of the document, and the rest are verified shingle by
shingle: neighbouring shingles overlap, so together they spell the window. Shingles are compared by hash so far; a last
comparison of the window's words, in the pass that counts the document's words, makes the result exact.

One pass over the documents finds the occurrences of benchmark shingles, a written table; rarity, candidates and
verification come from it. The benchmark's shingles are broadcast if there are at most ``BROADCAST_ROWS``, the places
found if there are at most ``BROADCAST_PLACES``; beyond that both sides of the join are shuffled. Texts are told apart by
their MD5, so copies of a text share one row of every table in between, whatever their number.

Nulls and edge cases: a null text has no words; a document without words is hit nowhere, an item without words occurs
nowhere. A null item_id takes part in hits but not in ``n_items``; items with the same id count once. Repeated rows and
repeated or null doc_ids are judged row by row. Other columns are not looked at. Without documents the result is empty,
without items nothing is hit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.llm.common import computed, lower_ascii, neighbours, sha256_of, small_enough, staged, table

WORDS = 13
SHINGLE = 5
#: Bytes of places, windows and item ids that may be broadcast.
BROADCAST_BYTES = 64 << 20
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NO_WORD_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _split(text: Column, pattern: str) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), pattern), "")


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def windows_of(items: DataFrame, words: int = WORDS) -> DataFrame:
    """(window, w, item_id): every window of every item as text, with its number of words."""
    split = computed(items.select("item_id", _split(lower_ascii(F.col("text")), _NO_WORD).alias("_words")))
    split = split.withColumn("_n", F.size("_words")).where("_n > 0")
    w = F.least(F.col("_n"), F.lit(words))
    starts = F.sequence(F.lit(1), F.col("_n") - w + 1)
    each = split.select("item_id", "_words", w.alias("w"), F.explode_outer(starts).alias("_at"))
    return each.select(F.array_join(F.slice("_words", F.col("_at"), F.col("w")), " ").alias("window"), "w", "item_id").distinct()


def shingles_of(windows: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(window, w, s, off, shingle): the shingles of every window; a window of fewer words is one shingle."""
    split = windows.select("window", "w").distinct().withColumn("_words", F.split("window", " "))
    split = split.withColumn("s", F.least("w", F.lit(size)))
    each = split.select("window", "w", "s", "_words", F.explode_outer(F.sequence(F.lit(0), F.col("w") - F.col("s"))).alias("off"))
    return each.select("window", "w", "s", "off", F.array_join(F.slice("_words", F.col("off") + 1, F.col("s")), " ").alias("shingle"))


def _hashes(frame: DataFrame, size: int) -> DataFrame:
    """(key, n, s, h): the hashes of all shingles of ``size`` words, made of the hashes of 1, 2, 4, ... words."""
    def pair(a: Column, b: Column) -> Column:
        return F.xxhash64(a, b)

    have, frame = 1, frame.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w))).withColumn("_1", F.col("_h"))
    while have * 2 <= size:
        frame, have = frame.withColumn("_h", neighbours("_h", "_h", have, pair)), have * 2
    for at in range(have, size):
        # The last windows of the shorter size have no further word and drop out.
        rest = F.slice("_1", F.lit(at + 1), F.greatest(F.size("_1") - at, F.lit(0)))
        frame = frame.withColumn("_h", F.zip_with(F.slice("_h", F.lit(1), F.size(rest)), rest, pair))
    return frame.select("key", "n", F.lit(size).alias("s"), F.col("_h").alias("h"))


def occurrences(docs: DataFrame, asked: DataFrame, sizes: list[int]) -> DataFrame:
    """(key, n, pos, shingle): where the texts of ``docs`` (text) hold the shingles ``asked`` (shingle, s), by hash.

    Each once, however many copies of a text there are.
    """
    words = docs.select(_text_key(F.col("text")).alias("key"), _split(lower_ascii(F.col("text")), _NO_WORD).alias("_words"))
    words = words.withColumn("n", F.size("_words"))
    named = asked.select(F.col("shingle").alias("key"), F.col("s").alias("n"), F.split("shingle", " ").alias("_words"))
    wanted = _union([_hashes(named.where(F.col("n") == size), size) for size in sizes])
    wanted = wanted.select(F.col("key").alias("shingle"), F.col("h")[0].alias("h"))
    wanted = small_enough(staged(wanted, "shingles"))
    each = [_hashes(words, size).select("key", "n", F.posexplode_outer("h").alias("pos", "h")) for size in sizes]
    return _union(each).join(wanted, "h").select("key", "n", "pos", "shingle").distinct()


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def contained(docs: DataFrame, windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(key, start, w, window): where a text of ``docs`` holds all shingles of one of ``windows``; key is the text's MD5."""
    parts = staged(shingles_of(windows, shingle), "window-shingles")
    sizes = sorted(r.s for r in parts.select("s").distinct().collect())  # at most `shingle` numbers
    if not sizes:
        return windows.select(F.lit(None).cast("binary").alias("key"), F.lit(0).alias("start"), "w", "window").where("false")
    held = staged(occurrences(docs, parts.select("shingle", "s").distinct(), sizes), "occurrences")
    rarity = held.groupBy("shingle").agg(F.count("*").alias("places"))
    ranked = parts.join(rarity, "shingle", "left").na.fill(0, ["places"])
    # A window with a shingle that occurs nowhere has that one as its prefix, and no candidates.
    prefix = ranked.groupBy("window", "w").agg(F.min(F.struct("places", "off", "shingle")).alias("rarest"))
    prefix = prefix.select("window", "w", F.col("rarest.off").alias("off"), F.col("rarest.shingle").alias("shingle"))
    candidates = (
        held.join(prefix, "shingle")
        .select("key", "n", (F.col("pos") - F.col("off")).alias("start"), "w", "window")
        .where((F.col("start") >= 0) & (F.col("start") + F.col("w") <= F.col("n")))
    )
    need = candidates.join(parts.select("window", "s", "off", "shingle"), "window")
    need = need.select("key", "start", "w", "window", "s", (F.col("start") + F.col("off")).alias("pos"), "shingle")
    met = need.join(held.select("key", "pos", "shingle"), ["key", "pos", "shingle"])
    counted = met.groupBy("key", "start", "w", "window", "s").count()
    return counted.where(F.col("count") == F.col("w") - F.col("s") + 1).select("key", "start", "w", "window")


def decontaminate(
    docs: DataFrame, items: DataFrame, text: str = "text", keep: tuple[str, ...] = (), words: int = WORDS, shingle: int = SHINGLE
) -> DataFrame:
    """The columns ``keep``, n_words, n_hit, n_items, item_ids (sorted strings) for every row of ``docs``."""
    rows = docs.select(*[F.col(c) for c in keep], F.col(text).alias("_text"))
    windows = staged(windows_of(items.select("item_id", "text"), words), "windows")
    places = staged(contained(rows.select(F.col("_text").alias("text")), windows, shingle), "places")
    ids = windows.groupBy("window").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    # The ids of a window come once for each text, however many places it has there and however many items share it.
    by_text = places.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "w", "window"))).alias("_places"))
    named = places.select("key", "window").distinct().join(ids, "window").groupBy("key").agg(F.collect_list(F.struct("window", "ids")).alias("_named"))
    by_text = staged(by_text.join(named, "key").withColumnRenamed("key", "_key"), "places-by-text")
    size = F.aggregate("_places", F.lit(64).cast("long"), lambda n, p: n + 24 + F.length(p["window"]))
    size = F.aggregate("_named", size, lambda n, x: n + 48 + F.length(x["window"]) + F.length(F.array_join(x["ids"], "")) + 24 * F.size(x["ids"]))
    few = by_text.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] <= BROADCAST_BYTES
    n_words = F.size(_split(F.col("_text"), _NO_WORD_ANY_CASE)).cast("long")
    found = rows.withColumn("_key", _text_key(F.col("_text"))).join(F.broadcast(by_text) if few else by_text, "_key", "left")
    lowered = F.when(F.col("_places").isNotNull(), _split(lower_ascii(F.col("_text")), _NO_WORD))
    found = found.select(*keep, n_words.alias("n_words"), "_places", "_named", lowered.alias("_words"))
    # Up to here shingles were compared by hash; now the words themselves are.
    spelled = F.filter("_places", lambda p: F.array_join(F.slice("_words", p["start"] + 1, p["w"]), " ") == p["window"])
    found = found.select(*keep, "n_words", spelled.alias("_places"), "_named")

    def step(state: Column, p: Column) -> Column:
        end = p["start"] + p["w"]
        new = F.greatest(end - F.greatest(p["start"], state["to"]), F.lit(0))
        return F.struct(F.greatest(state["to"], end).alias("to"), (state["hit"] + new).alias("hit"))

    none = F.struct(F.lit(0).alias("to"), F.lit(0).alias("hit"))
    n_hit = F.aggregate("_places", none, step, lambda state: state["hit"])
    # Only where words differed from what their hashes said are the windows looked up one by one.
    all_there = F.size(F.array_distinct(F.transform("_places", lambda p: p["window"]))) == F.size("_named")
    some = F.filter("_named", lambda x: F.exists("_places", lambda p: p["window"] == x["window"]))
    there = F.when(all_there, F.col("_named")).otherwise(some)
    item_ids = F.sort_array(F.array_distinct(F.flatten(F.transform(there, lambda x: x["ids"]))))
    found = found.select(
        *keep,
        "n_words",
        F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(item_ids, F.array().cast("array<string>")).alias("item_ids"),
    )
    return found.withColumn("n_items", F.size("item_ids").cast("long"))


def _contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=("doc_id",))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", sha256_of(F.col("item_ids")).alias("items_sha256"), _contaminated().alias("contaminated")
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that are not contaminated by ``benchmark``."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    found = computed(decontaminate(docs.select(row, F.col("text")), table(spark, sf_dir, "benchmark"), keep=("doc",)))
    return found.where(~_contaminated()).select("doc.*")
