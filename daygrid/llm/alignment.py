"""Two tokenizers aligned over a corpus: common boundaries, overlapping tokens, and how often each pair of ids overlaps.

1. Runs. Each task encodes its texts with both tokenizers. A run is up to ``RUN`` bytes of distinct texts (equal ones are encoded once and
   weighed). Where tokens of both end, a group ends; every stretch between two token ends is one link. The
   pair-document records of the links are sorted by B id, then A id, then text, cut by the radix of the B id into ``CELLS`` cells, and
   written as zstd frames: the head holds each pair once with its links in the run, the body holds the texts of each pair.
2. Counting. Heads are merged cell by cell, ``FAN`` runs at a time, level by level, by a heap of the runs' open frames. Hot
   pairs are one record of a head, however many texts hold them. The last merge knows every count; as pairs come in
   the order of B ids, each B id's maximum is known when its stretch ends.
3. Contributions. Each cell's counts meet the bodies of ``FAN`` runs at a time and stream back one sum for each text of a run.

A group in memory is at most ``FAN`` heads or bodies beside the pairs of one cell, which the vocabularies bound. Memory for one text is in
proportion to its length, as tokenizers need it whole.

Nulls and edge cases: a null or empty text, and one whose joined tokens differ from a space and the text (a tokenizer that rewrites
characters), has no tokens: all numbers 0, digest ''. Such rows and rows with equal texts, null or repeated ids are rows of their
own; every copy counts. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import pickle
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.llm.common import staged, table

FIRST, SECOND = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
RUN, TEXTS, ROWS = 4 << 20, 1 << 14, 1 << 16
CELLS, FAN, FRAME = 64, 32, 1 << 14

# The pattern by which byte-level tokenizers cut a text before their merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Beyond this much white space in a row the pattern's look-ahead runs out of stack; such texts go another way.
_LONG_BLANK = re.compile(r"\s{2000}")


def _byte_of() -> dict[str, int]:
    """Which byte a character of a byte-level vocabulary stands for: printable ones for themselves, the others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE vocabulary file (JSON). Merges whose ranks follow the ids are done by the faster of two equal encoders."""

    def __init__(self, blob: bytes):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_str(blob.decode())
        self.slow.encode_special_tokens = True
        spec, byte_of = json.loads(blob), _byte_of()
        model = spec["model"]
        added = {token["id"]: token["content"].encode() for token in spec["added_tokens"]}
        entries = {i: bytes(map(byte_of.__getitem__, token)) for token, i in model["vocab"].items() if i not in added}
        known = entries | added
        self.bytes = [known.get(i, b"") for i in range(max(known) + 1)]
        pairs = [merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"]]
        made = [model["vocab"].get("".join(pair)) for pair in pairs]
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        cut = spec["pre_tokenizer"] or {}
        plain &= cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True) and not spec["normalizer"]
        self.fast = None
        if plain and made == list(range(256, 256 + len(made))) and len(entries) == 256 + len(made):
            import tiktoken

            ranks = {token: i for i, token in entries.items()}
            self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast is None or _LONG_BLANK.search(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class Pieces:
    """A sentencepiece model; it puts a space before the text by itself."""

    def __init__(self, blob: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=blob)
        self.bytes = []
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text)


class Aligner:
    """Both vocabularies, as the tasks use them."""

    def __init__(self, first: bytes, second: bytes):
        self.a, self.b = ByteLevel(first), Pieces(second)
        self.a_size, self.b_size = (np.array(list(map(len, x.bytes)), dtype=np.int64) for x in (self.a, self.b))
        self.names = [b"%d%c" % (i, end) for i in range(len(self.a.bytes)) for end in b",|"]
        self.names += [b"%d%c" % (i, end) for i in range(len(self.b.bytes)) for end in b",;"]

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        if not text:
            return None
        spaced = " " + text
        a, b, whole = self.a.encode(spaced), self.b.encode(text), spaced.encode()
        if any(b"".join(map(x.bytes.__getitem__, ids)) != whole for x, ids in ((self.a, a), (self.b, b))):
            return None
        return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


class Links:
    """The links of encoded texts, one after another in one stream of bytes."""

    def __init__(self, aligner: Aligner, texts: list[tuple[np.ndarray, np.ndarray]]):
        n = len(texts)
        none = np.zeros(0, dtype=np.int64)
        a, b = (np.concatenate([none, *[t[side] for t in texts]]) for side in (0, 1))
        self.n_a, self.n_b = (np.array([len(t[side]) for t in texts], dtype=np.int64) for side in (0, 1))
        a_ends, b_ends = np.cumsum(aligner.a_size[a]), np.cumsum(aligner.b_size[b])
        marks = np.zeros(int(a_ends[-1]) + 1 if len(a) else 1, dtype=np.uint8)
        marks[a_ends] = 1
        marks[b_ends] |= 2
        ends = np.flatnonzero(marks)
        marks = marks[ends]
        in_a, in_b, both = marks & 1 > 0, marks > 1, marks == 3
        self.text = np.searchsorted(a_ends[np.cumsum(self.n_a) - 1] if n else none, ends)
        self.a = a[np.cumsum(in_a) - in_a]
        self.b = b[np.cumsum(in_b) - in_b]
        self.n_links, self.n_groups = np.bincount(self.text, minlength=n), np.bincount(self.text[both], minlength=n)
        self.digests = self._digests(aligner, a, b, in_a, in_b, both)

    def _digests(self, aligner: Aligner, a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, both: np.ndarray) -> list[str]:
        """Of ``a1,a2|b1;a3|b2,b3``: each group's A tokens are written before its B tokens."""
        group = np.cumsum(both) - both
        a_last, b_last = both[in_a], both[in_b]
        a_until, b_until = np.flatnonzero(a_last) + 1, np.concatenate(([0], np.flatnonzero(b_last) + 1))
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[np.arange(len(a)) + b_until[group[in_a]]] = 2 * a + a_last
        order[np.arange(len(b)) + a_until[group[in_b]]] = 2 * (len(aligner.a.bytes) + b) + b_last
        out, at = [], 0
        for n in (self.n_a + self.n_b).tolist():
            named = b"".join(map(aligner.names.__getitem__, order[at : at + n].tolist()))
            out.append(hashlib.sha256(named[:-1]).hexdigest())
            at += n
        return out


def _narrow(a: np.ndarray) -> np.ndarray:
    return a.astype(np.min_scalar_type(int(a.max()))) if a.size else a.astype(np.uint8)


def _frame(*columns: np.ndarray) -> bytes:
    return zstandard.compress(pickle.dumps([_narrow(c) for c in columns], protocol=5), 3)


def _columns(frame: bytes) -> list[np.ndarray]:
    return [c.astype(np.int64) for c in pickle.loads(zstandard.decompress(frame))]


def _head(keys: np.ndarray, *columns: np.ndarray) -> list[bytes]:
    """Frames of ascending keys, as differences, with their columns."""
    out = []
    for at in range(0, len(keys), FRAME):
        cut = slice(at, at + FRAME)
        out.append(_frame(np.diff(keys[cut], prepend=0), *[c[cut] for c in columns]))
    return out


def _open(frame: bytes) -> list[np.ndarray]:
    steps, *columns = _columns(frame)
    return [np.cumsum(steps), *columns]


def _whole(frames: Iterable[bytes]) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*map(_open, frames))]


class Radix:
    """Keys of id pairs, ordered by the cell of the B id, then the B id, then the A id."""

    def __init__(self, a: int, b: int, cells: int):
        self.a, self.cells, self.rows = a, cells, -(-b // cells)

    def keys(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (b % self.cells * self.rows + b // self.cells) * self.a + a

    def ids(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = keys // self.a
        return keys % self.a, row % self.rows * self.cells + row // self.rows

    def cuts(self, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(keys, np.arange(self.cells + 1) * self.rows * self.a)


def records(radix: Radix, links: Links, weights: np.ndarray) -> Iterator[tuple[int, list[bytes], bytes]]:
    """(cell, head, body) of the run, for cells that have any."""
    bits = max(len(weights) - 1, 1).bit_length()
    if (radix.cells * radix.rows * radix.a << bits) >= 2**63:
        raise ValueError("the vocabularies are too large for keys of 63 bits")
    each = radix.keys(links.a, links.b)
    each <<= bits
    each |= links.text
    each.sort()
    first = np.flatnonzero(np.diff(each, prepend=-1))
    times = np.diff(first, append=len(each))
    each = each[first]
    texts, pairs = each & ((1 << bits) - 1), each >> bits
    first = np.flatnonzero(np.diff(pairs, prepend=-1))
    keys, holders = pairs[first], np.diff(first, append=len(pairs))
    counts = np.add.reduceat(times * weights[texts], first) if len(first) else first
    cuts = radix.cuts(keys)
    inner = np.append(first, len(pairs))[cuts]
    for cell in np.flatnonzero(np.diff(cuts)).tolist():
        own, held = slice(cuts[cell], cuts[cell + 1]), slice(inner[cell], inner[cell + 1])
        yield cell, _head(keys[own], counts[own]), _frame(holders[own], texts[held], times[held])


def merged(runs: list[Iterator[list[np.ndarray]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and summed counts of ascending runs, by a heap of the last keys of their open frames."""
    held: dict[int, list[np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def advance(run: int) -> None:
        frame = next(runs[run], None)
        if frame is not None:
            held[run] = frame
            heapq.heappush(heap, (int(frame[0][-1]), run))

    for run in range(len(runs)):
        advance(run)
    while heap:
        # Up to the least last key every run's keys are at hand.
        last, _ = heap[0]
        keys, counts = [], []
        for run, frame in held.items():
            if frame[0][0] <= last:
                n = int(np.searchsorted(frame[0], last, "right"))
                keys.append(frame[0][:n])
                counts.append(frame[1][:n])
                held[run] = [c[n:] for c in frame]
        while heap and heap[0][0] == last:
            run = heapq.heappop(heap)[1]
            del held[run]
            advance(run)
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        yield keys[first], np.add.reduceat(counts[order], first)


def _opened(heads: pd.Series) -> list[Iterator[list[np.ndarray]]]:
    return [map(_open, frames) for frames in heads]


def _merge_runs(group: pd.DataFrame) -> pd.DataFrame:
    frames = [f for keys, counts in merged(_opened(group["head"])) for f in _head(keys, counts)]
    return pd.DataFrame({"cell": [int(group["cell"].iloc[0])], "run": [int(group["part"].iloc[0])], "head": [frames]})


def _maxima(b: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """1 where the count is the highest of its B id; equal B ids are neighbours."""
    first = np.flatnonzero(np.diff(b, prepend=-1))
    return (counts == np.repeat(np.maximum.reduceat(counts, first), np.diff(first, append=len(b)))).astype(np.int64)


def _counter(radix: Radix):
    def count(group: pd.DataFrame) -> pd.DataFrame:
        """The cell's pairs with their counts, marked where they are their B id's maximum."""
        frames: list[bytes] = []
        held = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

        def write(keys: np.ndarray, counts: np.ndarray) -> None:
            if len(keys):
                frames.extend(_head(keys, counts, _maxima(keys // radix.a, counts)))

        for part in merged(_opened(group["head"])):
            keys, counts = (np.concatenate(both) for both in zip(held, part))
            # The last B id may go on in the next part.
            n = int(np.searchsorted(keys // radix.a, keys[-1] // radix.a))
            write(keys[:n], counts[:n])
            held = keys[n:], counts[n:]
        write(*held)
        return pd.DataFrame({"cell": [int(group["cell"].iloc[0])], "head": [frames]})

    return count


def _contribute(group: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
    """For each run, the texts' links that are maxima, and their sums of counts, over the pairs of one cell."""
    keys, counts, best = _whole(counted["head"].iloc[0])
    out = []
    for run, head, body in zip(group["run"], group["head"], group["body"]):
        own = np.searchsorted(keys, np.concatenate([_open(f)[0] for f in head]))
        holders, texts, times = _columns(body)
        bests, sums = (np.zeros(int(texts.max()) + 1, dtype=np.int64) for _ in range(2))
        np.add.at(bests, texts, times * np.repeat(best[own], holders))
        np.add.at(sums, texts, times * np.repeat(counts[own], holders))
        out.append({"run": run, "bests": _frame(bests), "sums": _frame(sums)})
    return pd.DataFrame(out, columns=["run", "bests", "sums"])


def _total(group: pd.DataFrame) -> pd.DataFrame:
    out = {"run": [int(group["run"].iloc[0])]}
    for name in ("bests", "sums"):
        total = np.zeros(TEXTS, dtype=np.int64)
        for frame in group[name]:
            (part,) = _columns(frame)
            total[: len(part)] += part
        out[name] = [np.trim_zeros(total, "b")]
    return pd.DataFrame(out)


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


class Alignment:
    """The corpus's counted pairs and its rows; see ``align``."""

    def __init__(self, docs: DataFrame, text: str = "text", id: str = "doc_id", first: str = FIRST, second: str = SECOND, cells: int = CELLS):
        self.id, blobs = id, []
        for path in (first, second):
            with open(path, "rb") as file:
                blobs.append(file.read())
        aligner = Aligner(*blobs)
        self.radix = Radix(len(aligner.a.bytes), len(aligner.b.bytes), cells)
        self.runs = self._runs(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), blobs)
        self._heads = self.runs.where("cell >= 0")
        self._counts: DataFrame | None = None

    def _runs(self, docs: DataFrame, blobs: list[bytes]) -> DataFrame:
        """(run, cell, head, body), and as cell -1 the run's rows; ids stay in Arrow."""
        radix, vocabularies = self.radix, docs.sparkSession.sparkContext.broadcast(blobs)

        def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            aligner = Aligner(*vocabularies.value)
            run = TaskContext.get().partitionId() << 32
            ids: list[pa.Array] = []
            places: list[int] = []
            known: dict[str, int] = {}
            encoded: list[tuple[np.ndarray, np.ndarray]] = []
            weights: list[int] = []
            size = 0

            def close() -> pa.RecordBatch:
                links = Links(aligner, encoded)
                at = np.array(places, dtype=np.int64)
                numbers = [np.append(getattr(links, name), 0)[at] for name in _NUMBERS]
                digests = [*links.digests, ""]
                fields = [pa.concat_arrays(ids), pa.array(at, pa.int32()), *[pa.array(x, pa.int64()) for x in numbers], pa.array([digests[p] for p in places])]
                rows = pa.StructArray.from_arrays(fields, names=["id", "at", *_NUMBERS, "groups_sha256"])
                found = list(records(radix, links, np.array(weights, dtype=np.int64)))
                n = 1 + len(found)
                columns = [
                    pa.array([run] * n, pa.int64()),
                    pa.array([-1, *[cell for cell, _, _ in found]], pa.int32()),
                    pa.array([None, *[head for _, head, _ in found]], pa.list_(pa.binary())),
                    pa.array([None, *[body for _, _, body in found]], pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, *[len(rows)] * n], pa.int32()), rows),
                ]
                return pa.RecordBatch.from_arrays(columns, names=["run", "cell", "head", "body", "rows"])

            for batch in batches:
                begin = 0
                for end, text in enumerate(batch.column(1).to_pylist(), 1):
                    place = known.get(text or "")
                    if place is None:
                        tokens = aligner.encode(text)
                        size += len(text or "")
                        place = -1 if tokens is None else len(encoded)
                        known[text or ""] = place
                        if tokens is not None:
                            encoded.append(tokens)
                            weights.append(0)
                    if place >= 0:
                        weights[place] += 1
                    places.append(place)
                    if size >= RUN or len(known) >= TEXTS or len(places) >= ROWS:
                        ids.append(batch.column(0).slice(begin, end - begin))
                        begin = end
                        yield close()
                        run, ids, places, known, encoded, weights, size = run + 1, [], [], {}, [], [], 0
                if begin < batch.num_rows:
                    ids.append(batch.column(0).slice(begin))
            if places:
                yield close()

        kind = docs.schema["id"].dataType.simpleString()
        numbers = ", ".join(f"{name}: long" for name in _NUMBERS)
        row = f"struct<id: {kind}, at: int, {numbers}, groups_sha256: string>"
        return staged(docs.mapInArrow(write, f"run long, cell int, head array<binary>, body binary, rows array<{row}>"), "runs")

    def counts(self) -> DataFrame:
        """(cell, head): the pairs of each cell with counts and marks, in frames."""
        if self._counts is None:
            heads, n = self._heads.select("cell", "run", "head"), self.runs.where("cell = -1").count()
            while n > FAN:
                n = -(-n // FAN)
                parts = heads.withColumn("part", F.pmod(F.xxhash64("run"), F.lit(n))).groupBy("cell", "part")
                heads = staged(parts.applyInPandas(_merge_runs, "cell int, run long, head array<binary>"), "merged")
            self._counts = staged(heads.groupBy("cell").applyInPandas(_counter(self.radix), "cell int, head array<binary>"), "counts")
        return self._counts

    def pairs(self) -> DataFrame:
        """(a, b, links, best): every linked pair of ids, its links in the corpus, and whether no other A id has more with this B id."""
        radix = self.radix

        def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for frames in batch["head"]:
                    for keys, counts, best in map(_open, frames):
                        a, b = radix.ids(keys)
                        yield pd.DataFrame({"a": a, "b": b, "links": counts, "best": best > 0})

        return self.counts().mapInPandas(listed, "a int, b int, links long, best boolean")

    def documents(self) -> DataFrame:
        """The id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
        split = -(-self.runs.where("cell = -1").count() // FAN)
        bodies = self._heads.select("run", "cell", "head", "body").withColumn("part", F.pmod(F.xxhash64("run"), F.lit(max(split, 1))).cast("int"))
        counts = self.counts().withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(max(split, 1) - 1))))
        met = bodies.groupBy("cell", "part").cogroup(counts.groupBy("cell", "part"))
        parts = met.applyInPandas(_contribute_if_any, "run long, bests binary, sums binary")
        totals = parts.groupBy("run").applyInPandas(_total, "run long, bests array<long>, sums array<long>")
        rows = self.runs.where("cell = -1").select("run", "rows").join(totals, "run", "left")
        rows = rows.select(F.explode("rows").alias("r"), "bests", "sums")

        def of_text(column: str):
            return F.coalesce(F.get(column, F.col("r.at")), F.lit(0).cast("long"))

        return rows.select(
            F.col("r.id").alias(self.id), *[f"r.{name}" for name in _NUMBERS], of_text("bests").alias("n_best"), of_text("sums").alias("count_sum"), "r.groups_sha256"
        )


def _contribute_if_any(group: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
    """A part of the runs may have nothing in a cell."""
    return _contribute(group, counted) if len(group) else pd.DataFrame({"run": [], "bests": [], "sums": []})


def align(docs: DataFrame, text: str = "text", id: str = "doc_id", first: str = FIRST, second: str = SECOND) -> DataFrame:
    """Every row's tokens, groups and links, the links that are their B id's most frequent, and the sum of the links' counts."""
    return Alignment(docs, text, id, first, second).documents()


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"))
