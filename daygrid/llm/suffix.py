"""Repeated passages by suffix arrays: per shard in numpy, merged across shards by binary search.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier, in a document with a smaller id or
before in the same one. Strings are judged on the input, and never cross documents.

1. Screen. The starts of a text are grouped by the smallest hash among the 24-byte grams of their 100-byte window
   (a minimizer): equal windows have equal minimizers, so only groups whose minimizer occurs twice or more in the corpus
   can hold repeats. This loses nothing and spares the suffix arrays the text that is unique, which is most of it.
2. Shards. Each task cuts the remaining regions of its documents into shards of ``SHARD`` bytes. Larsson-Sadakane
   refinement sorts a shard's suffixes to a depth of 100 bytes, resorting only groups that are not yet decided. Kasai's
   rule (the common prefix shrinks by at most one from a position to the next) gives common prefixes with the predecessor; 100 bytes or
   more mean a repeat inside the shard.
3. Merge. The other windows travel in groups as long as their minimizer, dealt out by it. Equal groups are settled at
   once; for the rest the shards' sorted windows are merged, finding each window of one in the other by binary search, and of equal
   windows the earlier stays. A minimizer with more than ``HOT`` occurrences has its windows sent one by one and dealt
   out by their own hash, so no minimizer and no passage, however frequent, ends up in one task: a shard sends a window
   at most once.

Nulls and edge cases: a null or empty text has 0 bytes and nothing to remove. A null doc_id comes after all others. Rows
equal in doc_id and text are one document; rows with the same doc_id and different texts are ordered by a hash of the text.
Other columns are not looked at; an empty table gives an empty result. Long texts are worked on in pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from daygrid.llm.common import beside, spread, staged, table

LENGTH = 100
GRAM = 24
SHARD = 1 << 18
BATCH = 8 << 20
PIECE = 1 << 19
HOT = 100_000
#: Starts of repeats that may be broadcast with their documents.
BROADCAST_VALUES = 4_000_000
_MIX = tuple(np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


def _words8(data: np.ndarray, order: str = "<") -> np.ndarray:
    """The eight bytes from each position on as a number; beyond the end there are zeros."""
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    return np.ndarray(len(data), dtype=f"{order}u8", buffer=padded, strides=(1,)).astype(np.uint64)


def _extreme(values: np.ndarray, width: int, better) -> np.ndarray:
    """``better`` (np.minimum or np.maximum) of every ``width`` neighbours."""
    have = 1
    while have * 2 <= width:
        values, have = better(values[:-have], values[have:]), have * 2
    rest = width - have
    return better(values[: len(values) - rest], values[rest:]) if rest else values


def _grams(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes (a multiple of 8) from each position on."""
    words = _words8(data)
    n = len(data) - gram + 1
    mixed = np.zeros(n, dtype=np.uint64)
    for at in range(0, gram, 8):
        mixed = (mixed ^ words[at : at + n]) * _MIX[at // 8 % 4]
        mixed ^= mixed >> np.uint64(31)
    mixed *= _MIX[3]
    return mixed ^ (mixed >> np.uint64(29))


def _pieces(texts: Iterable[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (text, offset, bytes), of some PIECE bytes each; pieces of a text overlap by a window less one byte."""
    some, size = [], 0
    for number, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 0), PIECE):
            some.append((number, at, text[at : at + PIECE + length - 1]))
            size += len(some[-1][2])
            if size >= PIECE:
                yield some
                some, size = [], 0
    if some:
        yield some


def _windows(texts: Iterable[bytes], length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For every list of pieces: their texts, offsets, begins and sizes, the hashes of grams, and the windows that count."""
    for some in _pieces(texts, length):
        data = np.frombuffer(b"".join(p[2] for p in some), dtype=np.uint8)
        sizes = np.array([len(p[2]) for p in some])
        begin = np.cumsum(sizes) - sizes
        piece = np.repeat(np.arange(len(some)), sizes)[: len(data) - length + 1]
        inside = np.arange(len(piece)) - begin[piece] <= sizes[piece] - length
        numbers, offsets = np.array([p[0] for p in some]), np.array([p[1] for p in some])
        yield numbers, offsets, begin, sizes, piece, inside, _grams(data, gram)


def _anchors(grams: np.ndarray, least: np.ndarray, inside: np.ndarray, width: int) -> np.ndarray:
    """The places whose gram is the least of some window that counts."""
    none = np.zeros(width - 1, dtype=np.uint64)
    most = _extreme(np.concatenate((none, np.where(inside, least, np.uint64(0)), none)), width, np.maximum)
    return np.flatnonzero((grams == most) & (most > 0))


def anchors(texts: Iterable[bytes], length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, minimizer) of every place whose gram is the least of some window."""
    width = length - gram + 1
    for numbers, _, begin, _, _, inside, grams in _windows(texts, length, gram):
        at = _anchors(grams, _extreme(grams, width, np.minimum), inside, width)
        yield numbers[np.searchsorted(begin, at, "right") - 1], grams[at]


def groups(texts: Iterable[bytes], length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, start, n, minimizer, again) of all groups of neighbouring window starts with the same minimizer.

    ``again``: the minimizer may be there twice, so that windows of the group can be equal.
    """
    width = length - gram + 1
    for numbers, offsets, begin, sizes, piece, inside, grams in _windows(texts, length, gram):
        least = _extreme(grams, width, np.minimum)
        head = np.flatnonzero(inside & np.concatenate(([True], (least[1:] != least[:-1]) | (piece[1:] != piece[:-1]))))
        # A group ends where the next begins, or with the last window of its piece.
        end = np.minimum(np.concatenate((head[1:], [len(least)])), begin[piece[head]] + sizes[piece[head]] - length + 1)
        at = _anchors(grams, least, inside, width)
        twice = np.cumsum(np.concatenate(([False], grams[at][1:] == grams[at][:-1])))
        first, last = np.searchsorted(at, head), np.searchsorted(at, end + width - 1) - 1
        again = twice[np.maximum(last, first)] > twice[first] if len(at) else np.zeros(len(head), dtype=bool)
        yield numbers[piece[head]], head - begin[piece[head]] + offsets[piece[head]], end - head, least[head], again


def suffix_array(data: np.ndarray, depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their next ``depth`` bytes, equal ones by position; and the rank of every position.

    Larsson-Sadakane: suffixes sorted by h bytes are sorted by up to 2h with the ranks h further on, and only in groups
    that still have several members. Beyond the end of ``data`` there are zeros.
    """
    words = _words8(data, ">")
    n, h = len(data), 8
    order = np.argsort(words)
    sorted_ = words[order]
    head = np.concatenate(([True], sorted_[1:] != sorted_[:-1])) if n else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.zeros(n + depth, dtype=np.int64)
    rank[order] = first + 1
    while h < depth:
        step = min(h, depth - h)
        # Slots of groups with several members: their head is followed by a slot that is no head, or they are none.
        open_ = np.flatnonzero(~head | ~np.concatenate((head[1:], [True])))
        if not len(open_):
            break
        members = order[open_]
        key = (rank[members] << 32) | rank[members + step]
        by = np.argsort(key)
        order[open_], key = members[by], key[by]
        head[open_] = np.concatenate(([True], key[1:] != key[:-1]))
        slot = np.maximum.accumulate(np.where(head[open_], open_, 0))
        rank[order[open_]] = slot + 1
        h += step
    open_ = np.flatnonzero(~head | ~np.concatenate((head[1:], [True])))
    members = order[open_]
    order[open_] = members[np.argsort(rank[members] << 32 | members)]
    return order, rank[:n]


def common_prefixes(data: np.ndarray, order: np.ndarray, rank: np.ndarray, depth: int = LENGTH, stride: int = 32) -> np.ndarray:
    """For each position the bytes, up to ``depth``, that it shares with its predecessor in ``order``.

    Only positions whose rank is their predecessor's are looked at; the others share fewer bytes and get 0. Kasai: the
    value is at most one less than at the position before. Every ``stride``-th position is compared from its beginning;
    the others go on from the bound that it gives, which mostly is enough.
    """
    n, reach = len(data), depth + stride
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    tied = np.zeros(n, dtype=bool)
    tied[order[1:]] = rank[order[1:]] == rank[order[:-1]]
    words = _words8(np.concatenate((data, np.zeros(reach + 8, dtype=np.uint8))))

    def extend(at: np.ndarray, known: np.ndarray, most: int) -> np.ndarray:
        """Common bytes of ``at`` and its predecessor, ``known`` of which are."""
        result = known.copy()
        todo = np.flatnonzero(known < most)
        while len(todo):
            here, there = at[todo] + result[todo], before[at[todo]] + result[todo]
            # Neither may run beyond the data, where the zeros would agree.
            room = n - np.maximum(here, there)
            good = room > 0
            todo, here, there, room = todo[good], here[good], there[good], room[good]
            differ = words[here] ^ words[there]
            low = differ & (~differ + np.uint64(1))
            same = np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8).astype(np.int64)
            result[todo] += np.minimum(same, room)
            todo = todo[(same == 8) & (room > 8) & (result[todo] < most)]
        return np.minimum(result, most)

    known = np.zeros(n, dtype=np.int64)
    steps = np.flatnonzero(tied[::stride]) * stride
    known[steps] = extend(steps, known[steps], reach)
    places = np.flatnonzero(tied)
    bound = np.maximum(known[places // stride * stride] - places % stride, 0)
    known[steps] = 0
    known[places] = extend(places, np.minimum(bound, depth), depth)
    return known


class _Shard:
    """Regions of some documents, in their order: where they come from and their bytes."""

    def __init__(self) -> None:
        self.parts: list[tuple[int, int, bytes]] = []
        self.size = 0

    def repeats(self, length: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """(text, offset, flags) for each region: which of its window starts repeat an earlier one of the shard."""
        # No UTF-8 text has the byte between the regions, so a window across it equals none inside a region.
        data = np.frombuffer(b"\xff".join(p[2] for p in self.parts), dtype=np.uint8)
        order, rank = suffix_array(data, length)
        repeated = common_prefixes(data, order, rank, length) >= length
        at = 0
        for number, offset, piece in self.parts:
            yield number, offset, repeated[at : at + len(piece) - length + 1]
            at += len(piece) + 1


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of every run of true."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edge[::2], edge[1::2] - 1


def _regions(number: np.ndarray, start: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(text, first, last) window start of groups that follow each other, at most SHARD starts long."""
    if not len(number):
        return
    first = np.concatenate(([True], (start[1:] != start[:-1] + n[:-1]) | (number[1:] != number[:-1])))
    last = np.concatenate((first[1:], [True]))
    for d, a, b in zip(number[first].tolist(), start[first].tolist(), (start + n)[last].tolist()):
        for at in range(a, b, SHARD):
            yield d, at, min(at + SHARD, b) - 1


def _member(number: np.ndarray, least: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """Whether each minimizer is among those of its text; texts follow each other."""
    found = np.zeros(len(number), dtype=bool)
    cuts = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1], [True]))) if len(number) else []
    for a, b in zip(cuts[:-1], cuts[1:]):
        found[a:b] = np.isin(least[a:b], sets[number[a]])
    return found


_SENT = "last boolean, id {id}, key long, start int, n int, route long, bytes binary"


def _sift(length: int, gram: int, names: list[str]):
    """Step 2: for the documents of a task, window groups to be merged, and (without bytes) repeats found already."""

    def shards(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        rows = batch.drop_duplicates("key").sort_values(["last", "id", "key"], kind="stable").reset_index(drop=True)
        texts = [t.encode("utf-8", "surrogatepass") for t in rows["text"]]
        wanted = [np.asarray(w, dtype=np.int64).view(np.uint64) for w in rows["wanted"]]
        hot = [np.asarray(w, dtype=np.int64).view(np.uint64) for w in rows["hot"]]
        some = [[], [], [], [], []]
        for each in groups(texts, length, gram):
            good = _member(each[0], each[3], wanted)
            for column, values in zip(some, each):
                column.append(values[good])
        number, start, n, least, again = (np.concatenate(c) for c in some) if some[0] else [np.zeros(0, dtype=np.int64)] * 5
        # Equal groups: all but the first repeat it, start by start.
        first: dict[tuple[int, bytes], int] = {}
        flags = [np.zeros(max(len(t) - length + 1, 0), dtype=bool) for t in texts]
        owner = np.zeros(len(number), dtype=bool)
        for i, (d, s, c, m) in enumerate(zip(number.tolist(), start.tolist(), n.tolist(), least.tolist())):
            owner[i] = first.setdefault((m, texts[d][s : s + c + length - 1]), i) == i
            if not owner[i]:
                flags[d][s : s + c] = True
        first.clear()
        # Only groups that share their minimizer with another one, or hold it twice, can have repeats within the task.
        _, inverse, count = np.unique(least[owner], return_inverse=True, return_counts=True)
        open_ = np.flatnonzero(owner)[(count[inverse] > 1) | again[owner].astype(bool)]
        shard = _Shard()

        def settle() -> None:
            for d, at, repeated in shard.repeats(length) if shard.parts else ():
                flags[d][at : at + len(repeated)] |= repeated

        for d, a, b in _regions(number[open_], start[open_], n[open_]):
            shard.parts.append((d, a, texts[d][a : b + length]))
            shard.size += b - a + length
            if shard.size >= SHARD:
                settle()
                shard = _Shard()
        settle()
        out: list[tuple] = []
        for d, repeated in enumerate(flags):
            out += [(d, a, b - a + 1, a, None) for a, b in zip(*_runs(repeated))]
        seldom = ~_member(number, least, hot)
        for i in np.flatnonzero(owner):
            d, s, c = int(number[i]), int(start[i]), int(n[i])
            fresh = ~flags[d][s : s + c]
            if not fresh.any():
                continue
            if seldom[i]:
                out.append((d, s, c, int(least[i].view(np.int64)), texts[d][s : s + c + length - 1]))
                continue
            for at in s + np.flatnonzero(fresh):
                window = texts[d][at : at + length]
                route = int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "little", signed=True)
                out.append((d, int(at), 1, route, window))
        if out:
            d, start, n, route, piece = zip(*out)
            sent = rows.loc[list(d), ["last", "id", "key"]].reset_index(drop=True)
            sent["start"], sent["n"], sent["route"], sent["bytes"] = start, n, route, piece
            yield sent[names]

    def sift(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        some, size = [], 0
        for batch in batches:
            some.append(batch)
            size += batch["text"].str.len().sum()
            if size >= BATCH:
                yield from shards(pd.concat(some))
                some, size = [], 0
        if some:
            yield from shards(pd.concat(some))

    return sift


def _merged(runs: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
    """The places (in order of their documents) of all windows that an earlier place has too.

    ``runs`` holds each shard's sorted, distinct windows and their places. Two at a time become one, until one is left.
    """
    while len(runs) > 1:
        left = []
        for (a, at), (b, bt) in zip(runs[::2], runs[1::2]):
            place = np.searchsorted(a, b)
            inside = np.minimum(place, len(a) - 1)
            met = a[inside] == b
            yield np.maximum(at[inside[met]], bt[met])
            at = at.copy()
            at[inside[met]] = np.minimum(at[inside[met]], bt[met])
            left.append((np.insert(a, place[~met], b[~met]), np.insert(at, place[~met], bt[~met])))
        runs = left + runs[len(left) * 2 :]


def _settle(length: int):
    """Step 3, over rows sorted by route and document: the windows that occur earlier in another shard."""

    def decide(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        known = rows["bytes"].isna()
        yield rows.loc[known, ["key", "start", "n"]]
        rows = rows[~known]
        owner: dict[tuple[int, bytes], int] = {}
        route, piece, key = rows["route"].to_numpy(), rows["bytes"].to_list(), rows["key"].to_numpy()
        start, n, shard = rows["start"].to_numpy(), rows["n"].to_numpy(), rows["shard"].to_numpy()
        gone, firsts = [], []
        for i in range(len(rows)):
            first = owner.setdefault((route[i], piece[i]), i)
            if first == i:
                firsts.append(i)
            elif key[first] != key[i] or start[first] != start[i]:
                gone.append((i, 0, n[i]))
        firsts = np.array(firsts, dtype=np.int64)
        same, several = route[firsts][1:] == route[firsts][:-1], np.zeros(len(firsts), dtype=bool)
        several[1:] = same
        several[:-1] |= same
        rest = firsts[several]
        cuts = np.flatnonzero(np.concatenate(([True], route[rest][1:] != route[rest][:-1], [True]))) if len(rest) else []
        # Whole routes, some BATCH bytes of windows at a time.
        a = 0
        while a + 1 < len(cuts):
            b, size = a + 1, 0
            while b < len(cuts) and (size := size + int(n[rest[cuts[b - 1] : cuts[b]]].sum()) * length) < BATCH:
                b += 1
            b = min(b, len(cuts) - 1)
            some = rest[cuts[a] : cuts[b]]
            a = b
            row = np.repeat(some, n[some])
            off = np.arange(len(row)) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
            place = np.arange(len(row))
            runs = []
            for s in np.unique(shard[some]):
                own = some[shard[some] == s]
                data = np.frombuffer(b"\xff".join([*(piece[i] for i in own), bytes(length)]), dtype=np.uint8)
                begin = np.cumsum(n[own] + length) - (n[own] + length)
                at = np.repeat(begin, n[own]) + np.arange(n[own].sum()) - np.repeat(np.cumsum(n[own]) - n[own], n[own])
                order, rank = suffix_array(data, length)
                name = np.full(len(data), -1, dtype=np.int64)
                name[at] = place[shard[row] == s]
                order = order[name[order] >= 0]
                new = np.concatenate(([True], rank[order][1:] != rank[order][:-1]))
                gone += [(row[i], off[i], 1) for i in name[order[~new]]]
                windows = np.lib.stride_tricks.sliding_window_view(data, length)[order[new]]
                runs.append((np.ascontiguousarray(windows).view(f"S{length}").ravel(), name[order[new]]))
            for late in _merged(runs):
                gone += [(row[i], off[i], 1) for i in late]
        if not gone:
            return
        i, off, count = (np.array(x, dtype=np.int64) for x in zip(*gone))
        # Neighbouring starts become one row again.
        by = np.lexsort((off, i))
        i, off, count = i[by], off[by], count[by]
        head = np.concatenate(([True], (i[1:] != i[:-1]) | (off[1:] != off[:-1] + count[:-1])))
        total = np.add.reduceat(count, np.flatnonzero(head))
        yield pd.DataFrame({"key": key[i[head]], "start": start[i[head]] + off[head], "n": total})

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat((held, batch), ignore_index=True)
            if held["n"].sum() + length * len(held) < BATCH:
                continue
            # The last route may go on in the next batch.
            open_ = held["route"] == held["route"].iloc[-1]
            if not open_.all():
                yield from decide(held[~open_].reset_index(drop=True))
                held = held[open_].reset_index(drop=True)
        if held is not None and len(held):
            yield from decide(held)

    return settle


def _small(df: DataFrame, values: str) -> DataFrame:
    """``df`` marked for broadcast if its arrays ``values`` hold few enough numbers in all."""
    total = df.agg(F.sum(F.size(values))).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_VALUES else df


def repeated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(key, spans): the window starts, as (start, n), that repeat an earlier window. ``docs`` is (id, key, text)."""

    def screen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names = batch["doc"].to_numpy()
            texts = (t.encode("utf-8", "surrogatepass") for t in batch["text"])
            for number, least in anchors(texts, length, gram):
                yield pd.DataFrame({"least": least.view(np.int64), "doc": names[number]})

    kind = docs.schema["id"].dataType.simpleString()
    # Ids pack better than hashes. Rows that share one are given each other's minimizers too, which does no harm.
    named = docs.withColumn("doc", F.coalesce("id", "key") if kind in ("bigint", "int") else F.col("key"))
    seen = named.select("doc", "text").mapInPandas(screen, "least long, doc long")
    # Written, so that the join below shuffles both sides anew and can split a minimizer that is everywhere.
    often = staged(seen.groupBy("least").count().where("count > 1"), "frequent")
    flagged = seen.join(often, "least").groupBy("doc").agg(
        F.collect_set("least").alias("wanted"),
        F.collect_set(F.when(F.col("count") > hot, F.col("least"))).alias("hot"),
    )
    # Null ids would make fractions of whole numbers in pandas; they are told apart by ``last``.
    whole = F.coalesce("id", F.lit(0).cast(kind)) if isinstance(docs.schema["id"].dataType, NumericType) else F.col("id")
    parts = named.join(flagged, "doc").select(F.col("id").isNull().alias("last"), whole.alias("id"), "key", "text", "wanted", "hot")
    names = ["last", "id", "key", "start", "n", "route", "bytes"]
    sent = parts.mapInPandas(_sift(length, gram, names), _SENT.format(id=kind)).withColumn("shard", F.spark_partition_id())
    merge = spread(sent, "route").sortWithinPartitions("route", "last", "id", "key", "start")
    found = merge.select("key", "start", "n", "route", "bytes", "shard").mapInPandas(_settle(length), "key long, start long, n long")
    return staged(found.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("start", "n"))).alias("spans")), "repeats")


def remove_repeats(
    docs: DataFrame, text: str = "text", id: str = "doc_id", keep: tuple[str, ...] = (), length: int = LENGTH, gram: int = GRAM, hot: int = HOT
) -> DataFrame:
    """The columns ``keep``, n_bytes, n_removed, n_spans (runs removed), removed (their begins and ends) and kept (bytes)."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*[F.col(c) for c in keep], F.col(id).alias("_id"), F.xxhash64(F.col(id), body).alias("_key"), body.alias("_text"))
    found = repeated(rows.select(F.col("_id").alias("id"), F.col("_key").alias("key"), F.col("_text").alias("text")), length, gram, hot)
    found = found.select(F.col("key").alias("_key"), F.col("spans.start").alias("_start"), F.col("spans.n").alias("_n"))
    joined = rows.join(_small(found, "_start"), "_key", "left").select(*keep, "_text", "_start", "_n")

    def cut(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for text, start, n in zip(batch["_text"], batch["_start"], batch["_n"]):
            data, spans = text.encode("utf-8", "surrogatepass"), []
            for a, b in zip(start, np.asarray(start) + np.asarray(n) + length - 1) if start is not None else ():
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], int(b))
                else:
                    spans.append([int(a), int(b)])
            places = [0, *(x for span in spans for x in span), len(data)]
            left = b"".join(data[a:b] for a, b in zip(places[::2], places[1::2]))
            out.append((len(data), len(data) - len(left), len(spans), places[1:-1], left))
        return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "removed", "kept"])

    return beside(joined, keep, cut, "n_bytes long, n_removed long, n_spans long, removed array<long>, kept binary")


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"), keep=("doc_id",))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
