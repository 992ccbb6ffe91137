"""SimHash near-duplicates by anchor-point covering.

Every distinct 64-bit fingerprint x has a home, its nearest anchor (a word of the covering code), at distance s(x). It is
listed at every anchor within s(x) + r, which is the covering radius at x plus the threshold r. Of two fingerprints within r bits let x be the
one with the smaller s: the other, y, is at most s(x) + r <= s(y) + r from the home of x, so it is listed there.
Comparing, at every anchor, those at home with all that are listed therefore finds every link, whatever the code; a code
that covers well only keeps the lists short.

The code is a product of extended BCH codes over blocks of the 64 bits. One block of 64 bits with 2^16 words serves up to
``ONE_BLOCK`` fingerprints; beyond, two blocks of 32 bits with 2^11 words each, so that fewer fingerprints share an anchor.
The links are the same with either.

Copies count once: only distinct fingerprints are listed and compared, so a group of equal texts is one row. The
comparison streams through the lists, keeps only those at home at one anchor in memory, and passes on a spanning
forest of the links it finds instead of all pairs. Anchors with more than ``LIST_ROWS`` rows are split: the list is dealt
out by fingerprint and the homes are copied to each share.

Nulls and edge cases: null, empty and blank texts have fingerprint zero and are linked to each other like any others. A
null doc_id never is a component's smallest id; a component of null ids alone has a null component_id. Repeated rows get
equal results. Other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.llm.common import components, small_enough, spread, staged, table

SHINGLE = 3
BITS = 3
SEED = 42
#: Message bits and generator polynomials (octal) of the BCH codes (63,16) and (31,11), by extended length.
GENERATORS = {64: (16, 0o6331141367235453), 32: (11, 0o5423325)}
ONE_BLOCK = 1 << 26
LIST_ROWS = 1 << 18
_CHUNK = 1 << 18


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned number: a bit is set if it is set in over half of the shingles' hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    joined, n = b" ".join(words), max(len(words) - shingle + 1, 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        some = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = (), shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint_of(t, shingle) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(found.view(np.int64))

    return docs.select(*keep, fingerprint(F.coalesce(F.col(text), F.lit(""))).alias("fp"))


def code_words(length: int) -> np.ndarray:
    """All words of the extended cyclic code, in the order of the message."""
    dimension, generator = GENERATORS[length]
    words = np.zeros(1 << dimension, dtype=np.uint64)
    for bit in range(dimension):
        row = generator << bit
        row |= (row.bit_count() & 1) << (length - 1)
        size = 1 << bit
        words[size : 2 * size] = words[:size] ^ np.uint64(row)
    return words


def _near(values: np.ndarray, words: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word, excess) of all words within s + reach of a value, s being its distance to the nearest one."""
    rows, found, excess = [], [], []
    step = max(1, _CHUNK // len(words))
    for at in range(0, len(values), step):
        far = np.bitwise_count(values[at : at + step, None] ^ words[None, :])
        s = far.min(axis=1)
        r, w = np.nonzero(far <= (s + reach)[:, None])
        rows.append(r + at)
        found.append(w)
        excess.append(far[r, w].astype(np.int16) - s[r])
    return np.concatenate(rows), np.concatenate(found), np.concatenate(excess)


def _listing(values: np.ndarray, codes: list[tuple[int, np.ndarray]], reach: int) -> tuple[np.ndarray, ...]:
    """(row, anchor, home) for every anchor of the product code within s + reach of a value."""
    rows, anchors = np.arange(len(values)), np.zeros(len(values), np.int64)
    excess, shift = np.zeros(len(values), np.int16), 0
    for length, code in codes:
        part = (values >> np.uint64(shift)) & np.uint64((1 << length) - 1)
        r, w, e = _near(part, code, reach)
        shift += length
        begin, end = np.searchsorted(r, rows, "left"), np.searchsorted(r, rows, "right")
        times = end - begin
        at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(begin, times)
        rows, anchors = np.repeat(rows, times), np.repeat(anchors, times) * len(code) + w[at]
        excess = np.repeat(excess, times) + e[at]
        good = excess <= reach
        rows, anchors, excess = rows[good], anchors[good], excess[good]
    nearest = np.flatnonzero(excess == 0)
    home = np.zeros(len(rows), dtype=bool)
    home[nearest[np.unique(rows[nearest], return_index=True)[1]]] = True  # of several nearest anchors the first
    return rows, anchors, home


def listed(distinct: DataFrame, blocks: tuple[int, ...], bits: int = BITS) -> DataFrame:
    """(anchor, fp, home): every fingerprint at each of its anchors."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = [(length, code_words(length)) for length in blocks]
        for batch in batches:
            for at in range(0, len(batch), 4096):
                fps = batch["fp"].to_numpy(np.int64)[at : at + 4096]
                row, anchor, home = _listing(fps.view(np.uint64), codes, bits)
                yield pd.DataFrame({"anchor": anchor, "fp": fps[row], "home": home})

    return distinct.select("fp").mapInPandas(assign, "anchor long, fp long, home boolean")


class _Forest:
    """The homes of one anchor, and which of them the links seen so far join."""

    def __init__(self, anchor: tuple[int, int]):
        self.anchor, self.homes = anchor, np.empty(0, dtype=np.uint64)
        self.parent: np.ndarray | None = None

    def add(self, homes: np.ndarray) -> None:
        self.homes = np.concatenate((self.homes, homes))

    def links(self, fps: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Edges that join the listed ``fps`` to the homes; homes that share a link are joined once."""
        out = []
        if self.parent is None:
            self.parent = np.arange(len(self.homes))
        step = max(1, _CHUNK // max(len(self.homes), 1))
        for at in range(0, len(fps), step):
            some = fps[at : at + step]
            near = np.bitwise_count(some[:, None] ^ self.homes[None, :]) <= bits
            rows = np.flatnonzero(near.any(axis=1))
            if not len(rows):
                continue
            out.append((some[rows], self.homes[near[rows].argmax(axis=1)]))
            for row in rows[near[rows].sum(axis=1) > 1]:
                met = np.flatnonzero(near[row])
                roots = np.unique(self.parent[met])
                if len(roots) > 1:
                    self.parent[np.isin(self.parent, roots)] = roots[0]
                    out.append((self.homes[roots[1:]], np.repeat(self.homes[roots[0]], len(roots) - 1)))
        return out


def links(lists: DataFrame, bits: int = BITS, rows: int = LIST_ROWS) -> DataFrame:
    """(u, v): edges between fingerprints within ``bits`` bits; joined, they connect all that are so linked."""
    hot = staged(lists.groupBy("anchor").count().where(F.col("count") > rows), "hot-anchors")
    shares = F.ceil(F.col("count") / F.lit(rows)).cast("int")
    dealt = lists.join(small_enough(hot.select("anchor", shares.alias("shares"))), "anchor", "left")
    n = F.coalesce("shares", F.lit(1))
    share = F.when(F.col("home"), F.sequence(F.lit(0), n - 1)).otherwise(F.array(F.pmod(F.xxhash64("fp"), n).cast("int")))
    # A home is copied to every share to be compared with, and is itself listed in one of them.
    own = dealt.where("home").withColumn("home", F.lit(False))
    own = own.select("anchor", F.pmod(F.xxhash64("fp"), n).cast("int").alias("share"), "fp", "home")
    dealt = dealt.select("anchor", F.explode_outer(share).alias("share"), "fp", "home").unionAll(own)
    sorted_ = spread(dealt, "anchor", "share").sortWithinPartitions("anchor", "share", F.desc("home"), "fp")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = None
        for batch in batches:
            anchor, share = batch["anchor"].to_numpy(), batch["share"].to_numpy()
            fps, home = batch["fp"].to_numpy(np.int64).view(np.uint64), batch["home"].to_numpy(bool)
            cuts = np.flatnonzero((anchor[1:] != anchor[:-1]) | (share[1:] != share[:-1])) + 1
            found = []
            for a, b in zip([0, *cuts], [*cuts, len(batch)]):
                if a == b:
                    continue
                if forest is None or forest.anchor != (anchor[a], share[a]):
                    forest = _Forest((anchor[a], share[a]))
                if home[a:b].any():
                    forest.add(fps[a:b][home[a:b]])
                if not home[a:b].all():
                    found += forest.links(fps[a:b][~home[a:b]], bits)
            if found:
                u, v = (np.concatenate(side).view(np.int64) for side in zip(*found))
                yield pd.DataFrame({"u": u, "v": v})[u != v]

    return sorted_.mapInPandas(compare, "u long, v long")


def near_duplicates(
    docs: DataFrame, text: str = "text", id: str = "doc_id", keep: tuple[str, ...] = (), shingle: int = SHINGLE, bits: int = BITS
) -> DataFrame:
    """The columns ``keep``, ``fp``, ``root`` (one number for each component) and ``component_id``.

    The latter is the smallest id that the row is linked to, itself included, over any number of links.
    """
    rows = docs.select(*[F.col(c) for c in keep], F.col(id).alias("_id"), F.col(text).alias("_text"))
    prints = staged(fingerprints(rows, "_text", (*keep, "_id"), shingle), "fingerprints")
    distinct = staged(prints.groupBy("fp").agg(F.min("_id").alias("least")), "distinct")
    blocks = (64,) if distinct.count() <= ONE_BLOCK else (32, 32)
    lists = staged(listed(spread(distinct, "fp"), blocks, bits), "lists")
    joined = components(links(lists, bits)).withColumnRenamed("u", "fp")
    rooted = distinct.join(joined, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = staged(rooted.select("fp", "root").join(least, "root"), "components")
    return prints.join(named, "fp").select(*keep, "fp", "root", "component_id")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), keep=("doc_id",))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of every component one row stays, that with the smallest doc_id (a null id comes last)."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    inner = docs.select(row.alias("doc"), F.col("doc_id").alias("_doc_id"), F.col("text").alias("_body"), F.xxhash64(row).alias("_row"))
    found = near_duplicates(inner, "_body", "_doc_id", ("_doc_id", "_row"))
    # Rows are told apart by id and content; only narrow columns are grouped, and the texts are joined once.
    first = found.groupBy("root").agg(F.min(F.struct(F.col("_doc_id").isNull().alias("last"), "_doc_id", "_row")).alias("one"))
    first = first.select(F.col("one._doc_id").alias("_one_id"), F.col("one._row").alias("_one_row"))
    same = F.col("_doc_id").eqNullSafe(F.col("_one_id")) & (F.col("_row") == F.col("_one_row"))
    # Rows that are equal in every column: one of them stays. They collapse in the task that reads them, before the texts are shuffled.
    once = inner.groupBy("_doc_id", "_row").agg(F.first("doc").alias("doc"))
    return once.join(first, same, "left_semi").select("doc.*")
