"""Language-model scores of whole documents, by a gated recurrent network that is trained on the corpus.

1. Counting. Each task cuts its documents into blocks and passes on every block's distinct words with their
   training counts; added up, they are the vocabulary table, which grows with the corpus and never leaves Spark.
2. Training. Counts of all training tokens set the model's classes and biases. Gated weights are trained on every word of
   every training text, in segments of 64 words, by truncated backpropagation in numpy. A trainer is a task over its
   share of the documents where they are read, so no text moves; trainers work apart, their weights are averaged in a tree, and
   each of ``ROUNDS`` rounds takes its part of the segments (by hash of text and place) and starts from the last average.
3. Scoring. The words of a block are joined with the vocabulary and meet the block's documents, sorted so that words come
   first. Documents are read to their end, with the state carried across windows. Repeated rows are dealt out over the blocks that hold them.

The ``FREQUENT`` most frequent words are in classes of 64 with a softmax of their own; every other word is in a class by its ending, and
its share of that class follows from the counts, smoothed as in the base score: unknown words count half a word.

Nulls and edge cases: a null or empty text is its end token. A null doc_id counts as the empty text, so its document trains. Rows equal in doc_id and text count as often as they occur. Other
columns are not looked at. Without training documents every text has base score 0 and a score of the untrained model.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.llm import gru
from daygrid.llm.common import small_enough, spread, staged, table

FREQUENT, CLASS, ENDINGS, STATE = 2048, 64, 96, 24
BLOCK = 12 << 20
SEGMENT, WINDOW, ROWS = 64, 32, 256
LEAST_STEPS, ROUNDS, FAN = 150, 2, 16
#: Segments that a trainer holds at a time, and the parts over which the copies of one row are dealt.
HELD, DEALT = 1 << 14, 64
#: The end token; no word holds white space.
END = b"\n"


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


class _Numbers(dict):
    """Numbers of the frequent words; any other word has its ending's, and endings are few enough to be kept."""

    def __init__(self, words: list[bytes], model: gru.Model):
        super().__init__(zip(words, range(len(words))))
        self.first, self.kinds = model.frequent, model.endings
        self.endings: dict[bytes, int] = {}

    def __missing__(self, word: bytes) -> int:
        end = word[-2:]
        if (number := self.endings.get(end)) is None:
            number = self.endings[end] = self.first + zlib.crc32(end) % self.kinds
        return number


def _gather(docs: DataFrame) -> DataFrame:
    """kind 0: (block, word, training count); kind 1: (block, key)."""

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[bytes] = Counter()
        others: set[bytes] = set()
        keys: list[int] = []
        size = 0

        def block() -> pd.DataFrame:
            for word in others:
                counts.setdefault(word, 0)
            n, name = len(counts), keys[0]
            parts = [
                pd.DataFrame({"kind": 0, "block": name, "key": 0, "word": list(counts), "n": np.fromiter(counts.values(), np.int64, n)}),
                pd.DataFrame({"kind": 1, "block": name, "key": keys, "word": None, "n": 0}),
            ]
            return pd.concat(parts)

        for batch in batches:
            for key, held_out, text in zip(batch["key"], batch["held_out"], batch["text"]):
                words = tokens(text)
                keys.append(key)
                size += len(text or "") + 1
                if held_out:
                    others.update(words)
                else:
                    counts.update(words)
                if size >= BLOCK:
                    yield block()
                    counts, others, keys, size = Counter(), set(), [], 0
        if keys:
            yield block()

    return staged(docs.select("key", "held_out", "text").mapInPandas(gather, "kind int, block long, key long, word binary, n long"), "words")


class Counts:
    """What the vocabulary says: totals, the frequent words, and the endings of the others."""

    def __init__(self, vocabulary: DataFrame):
        spark = vocabulary.sparkSession
        row = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
        self.total, self.distinct = int(row[0]), int(row[1])
        top = vocabulary.orderBy(F.desc("c"), "word").limit(FREQUENT).collect()  # FREQUENT rows
        self.words = [bytes(r["word"]) for r in top] or [END]
        self.counts = np.array([r["c"] for r in top] or [0], dtype=np.float64)
        self.top = F.broadcast(spark.createDataFrame([(bytearray(w),) for w in self.words], "word binary"))
        ending = F.pmod(F.crc32(F.substring("word", -2, 2)), F.lit(ENDINGS)).cast("int")
        rest = vocabulary.join(self.top, "word", "left_anti").groupBy(ending.alias("e"))
        rows = rest.agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()
        self.mass, self.kinds = np.zeros(ENDINGS), np.zeros(ENDINGS)
        for r in rows:  # ENDINGS rows
            self.mass[r["e"]], self.kinds[r["e"]] = r["c"], r["v"]

    def model(self) -> tuple[gru.Model, gru.Parameters]:
        model = gru.Model(len(self.words), CLASS, ENDINGS, STATE)
        words = np.full(model.heads * CLASS, 1e-6)
        words[: len(self.words)] = self.counts + 0.5
        words = words.reshape(model.heads, CLASS)
        classes = np.concatenate((words.sum(axis=1), self.mass + 0.5))
        return model, model.fresh(np.log(classes / classes.sum()), np.log(words / words.sum(axis=1, keepdims=True)))

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.total + 0.5 * (self.distinct + 1)))

    def share(self, ending: np.ndarray, c: np.ndarray) -> np.ndarray:
        """log10 of a rare word's share of its ending's class; all unknown ones together count half a word, as in ``base``."""
        whole = self.mass + 0.5 * (self.kinds + 1)
        return np.log10((c + 0.5) / whole[ending])


def fit(docs: DataFrame, counts: Counts) -> tuple[gru.Model, gru.Parameters]:
    """The model, trained on all texts of ``docs`` (key, held_out, text) that are not held out."""
    model, parameters = counts.model()
    frequent = counts.words

    def learner(flat: np.ndarray, turn: int):
        def segments(batches: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
            number = _Numbers(frequent, model).__getitem__
            for batch in batches:
                for key, held_out, text in zip(batch["key"], batch["held_out"], batch["text"]):
                    if held_out:
                        continue
                    words = tokens(text)
                    for at in range(0, len(words), SEGMENT):
                        if zlib.crc32(b"%d:%d" % (key, at)) % ROUNDS == turn:
                            # The input before a text's first word is a token of its own.
                            before = [number(words[at - 1])] if at else [model.start]
                            yield np.array([*before, *map(number, words[at : at + SEGMENT])])

        def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            p, adam, held, words, more = model.unpack(flat), gru.Adam(), [], 0, segments(batches)
            while some := list(itertools.islice(more, HELD)):
                held = some
                words += sum(map(len, held))
                gru.train(model, p, held, WINDOW, ROWS, adam)
            if held:
                while adam.turn < LEAST_STEPS:
                    gru.train(model, p, held, WINDOW, ROWS, adam)
                yield pd.DataFrame({"trainer": [TaskContext.get().partitionId()], "n": [float(words)], "weights": [model.pack(p).tobytes()]})

        return learn

    def mean(group: pd.DataFrame) -> pd.DataFrame:
        n = group["n"].to_numpy()
        total = sum(np.frombuffer(w, np.float32) * np.float32(k / n.sum()) for w, k in zip(group["weights"], n))
        return pd.DataFrame({"trainer": [int(group["part"].iloc[0])], "n": [n.sum()], "weights": [total.astype(np.float32).tobytes()]})

    schema = "trainer long, n double, weights binary"
    for turn in range(ROUNDS):
        weights = staged(docs.mapInPandas(learner(model.pack(parameters), turn), schema), "weights")
        left = weights.agg(F.coalesce(F.max("trainer"), F.lit(0))).first()[0] + 1
        while left > FAN:
            weights = staged(weights.withColumn("part", F.floor(F.col("trainer") / FAN)).groupBy("part").applyInPandas(mean, schema), "weights")
            left = -(-left // FAN)
        rows = weights.orderBy("trainer").collect()  # at most FAN rows
        if rows:
            total = sum(r["n"] for r in rows)
            parameters = model.unpack(sum(np.frombuffer(r["weights"], np.float32).astype(np.float64) * (r["n"] / total) for r in rows))
    return model, parameters


def score(docs: DataFrame, text: str = "text", id: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep``, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``."""
    held_out = F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")) % 5 == 1
    body = F.coalesce(F.col(text), F.lit(""))
    kept = F.struct(*[F.col(c) for c in keep]) if keep else F.struct(F.lit(None).cast("int").alias("none"))
    rows = docs.select(kept.alias("_kept"), F.xxhash64(F.col(id), body).alias("_key"), held_out.alias("_held_out"), body.alias("_text"))
    read = rows.select(F.col("_key").alias("key"), F.col("_held_out").alias("held_out"), F.col("_text").alias("text"))
    gathered = _gather(read)
    words = gathered.where("kind = 0").select("block", "word", "n")
    vocabulary = staged(words.groupBy("word").agg(F.sum("n").alias("c")).where("c > 0"), "vocabulary")
    counts = Counts(vocabulary)
    model, parameters = fit(read, counts)
    flat = model.pack(parameters)

    known = words.join(counts.top, "word", "left_anti").join(vocabulary, "word", "left")
    # Any block that holds a row has its words. A row with many copies keeps up to DEALT of its blocks, and they are dealt out.
    dealt = F.pmod(F.xxhash64("block"), F.lit(DEALT))
    blocks = gathered.where("kind = 1").groupBy("key", dealt.alias("part")).agg(F.min("block").alias("block"))
    blocks = blocks.groupBy(F.col("key").alias("_key")).agg(F.sort_array(F.collect_list("block")).alias("_blocks"))
    placed = rows.withColumn("_at", F.monotonically_increasing_id()).join(small_enough(staged(blocks, "blocks")), "_key")
    chosen = F.element_at("_blocks", (F.pmod(F.xxhash64("_at"), F.size("_blocks")) + 1).cast("int"))
    placed = placed.withColumn("_block", chosen)
    vocabulary_rows = known.select(
        F.col("block").alias("_block"), F.lit(0).alias("_kind"), F.col("word").alias("_word"), F.coalesce("c", F.lit(0)).alias("_c"),
        F.pmod(F.crc32(F.substring("word", -2, 2)), F.lit(ENDINGS)).cast("int").alias("_ending"),
        F.lit(None).cast("boolean").alias("_held_out"), F.lit(None).cast("string").alias("_text"), F.lit(None).cast(rows.schema["_kept"].dataType).alias("_kept"),
    )
    text_rows = placed.select(
        "_block", F.lit(1).alias("_kind"), F.lit(None).cast("binary").alias("_word"), F.lit(0).cast("long").alias("_c"),
        F.lit(0).alias("_ending"), "_held_out", "_text", "_kept",
    )
    sorted_ = spread(vocabulary_rows.unionAll(text_rows), "_block").sortWithinPartitions("_block", "_kind")
    top = {word: i for i, word in enumerate(counts.words)}
    top_counts = counts.counts
    total = counts.total
    # Only arrays travel to the tasks, not the frames that Counts holds.
    base, share = _Plain(counts).base, _Plain(counts).share

    def judge_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.unpack(flat)
        block, index, seen, endings = None, {}, [], []
        held: list[pd.DataFrame] = []
        carried: list[pa.Array] = []
        size = 0

        def judge() -> pa.RecordBatch:
            c = np.concatenate((top_counts, *seen))
            ending = np.concatenate((np.zeros(0, dtype=np.int64), *endings))
            ids = np.concatenate((np.arange(len(top_counts)), model.frequent + ending))
            within = np.concatenate((np.zeros(len(top_counts)), share(ending, c[len(top_counts) :])))
            plain = base(c)
            batch = pd.concat(held)
            texts = [np.array(list(map(index.__getitem__, tokens(t))), dtype=np.int64) for t in batch["_text"]]
            likely = gru.score(model, weights, [ids[t] for t in texts], WINDOW)
            columns = [
                pa.concat_arrays(carried),
                pa.array(batch["_held_out"].astype(bool)),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([int((c[t] > 0).sum()) for t in texts], pa.int64()),
                pa.array([total] * len(texts), pa.int64()),
                pa.array([float(plain[t].sum()) for t in texts], pa.float64()),
                pa.array([float(s / np.log(10) + within[t].sum()) for s, t in zip(likely, texts)], pa.float64()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["_kept", *_SCORES])

        for arrow in batches:
            # What is kept stays in Arrow: whole numbers beside nulls would become fractions in pandas.
            own = arrow.column("_kept")
            batch = arrow.drop_columns(["_kept"]).to_pandas()
            cuts = np.flatnonzero(np.diff(batch["_block"].to_numpy())) + 1
            for a, b in zip([0, *cuts], [*cuts, len(batch)]):
                part = batch.iloc[a:b]
                if not len(part):
                    continue
                if block != part["_block"].iloc[0]:
                    if held:
                        yield judge()
                    block, index, seen, endings, held, carried, size = part["_block"].iloc[0], dict(top), [], [], [], [], 0
                fresh = part[part["_kind"] == 0]  # words come before texts
                index.update(zip(fresh["_word"], range(len(index), len(index) + len(fresh))))
                seen.append(fresh["_c"].to_numpy(np.float64))
                endings.append(fresh["_ending"].to_numpy(np.int64))
                texts = part.iloc[len(fresh) :]
                if len(texts):
                    held.append(texts)
                    carried.append(own.slice(a + len(fresh), len(texts)))
                    size += texts["_text"].str.len().sum()
                    if size > BLOCK:
                        yield judge()
                        held, carried, size = [], [], 0
        if held:
            yield judge()

    schema = ", ".join(f"{name} {kind}" for name, kind in _SCORES.items())
    scored = sorted_.mapInArrow(judge_all, f"_kept {rows.schema['_kept'].dataType.simpleString()}, {schema}")
    return scored.select(*[F.col(f"_kept.`{c}`").alias(c) for c in keep], *_SCORES)


_SCORES = {"held_out": "boolean", "n_tokens": "long", "n_known": "long", "train_tokens": "long", "base_score": "double", "score": "double"}


class _Plain(Counts):
    """The numbers of ``Counts`` alone."""

    def __init__(self, counts: Counts):
        for name in ("total", "distinct", "mass", "kinds"):
            setattr(self, name, getattr(counts, name))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), keep=("doc_id",))
