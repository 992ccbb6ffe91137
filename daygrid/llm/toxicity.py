"""Toxicity of whole texts by a bidirectional gated recurrent network over overlapping windows.

1. The network learns from at most ``SAMPLE`` labelled rows of each label, those with the smallest hash of their id; each label's rows
   weigh as many as it has. A label speaks of a whole text, so training is by windows: a text is shown by its most suspect window,
   first by its words' log-odds, then by the network's own logits, and a clean one by another window besides.
2. Scoring. Each task reads its texts to the end, ``STEP`` words at a time, in windows of ``WINDOW`` words. A text's score is the
   highest of its windows.

Only the text is an input. Labels are read for rows whose crc32(id as text) mod 5 is not 0; a null id counts as the empty text.

Nulls and edge cases: a null or blank text is one window with one empty word. Labels other than 0 and 1 and those without an id
are not used; of several labels of an id the highest counts. Repeated rows are rows of their own, and all of an
id's texts are shown with its label. Without labelled rows every score comes from the untrained network, below 0.5 for the empty text. An empty table
gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import functools
import pickle
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.llm.bigru import Network, Parameters, windows_of
from daygrid.llm.common import staged, table
from daygrid.llm.gru import Adam

#: The bound on the labelled rows, for each label.
SAMPLE = 2048
WINDOW, STEP, VOCABULARY, EPOCHS, LEAST_STEPS, BATCH = 32, 16, 4096, 6, 120, 256
#: Words whose gate values a task holds at once, windows scored at once, and characters cut into words at once.
HELD, AT_ONCE, SLICE = 1 << 17, 4096, 1 << 20
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def held_out(id: Column) -> Column:
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def words_of(text: str | None) -> Iterator[list[str]]:
    """The words of the lower-cased text, in slices that end between words."""
    text, at = text or "", 0
    while at < len(text):
        end = at + SLICE
        while end < len(text) and not text[end].isspace():
            end += 1
        found = _WORD.findall(text[at:end].lower())
        if found:
            yield found
        at = end


class Numbered:
    """Numbers for words, in order of appearance; 0 is the empty word."""

    def __init__(self):
        self.number: dict[str, int] = {"": 0}

    def __call__(self, text: str | None) -> np.ndarray:
        number, out = self.number, []
        for words in words_of(text):
            for word in words:
                if word not in number:
                    number[word] = len(number)
            out.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
        return np.concatenate(out) if out else np.zeros(1, dtype=np.int32)


def window_rows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids and presence (time, window) of all windows, and each window's text."""
    begins = [windows_of(len(t), WINDOW, STEP) for t in texts]
    owner = np.repeat(np.arange(len(texts)), list(map(len, begins)))
    lengths = np.array(list(map(len, texts)), dtype=np.int64)
    base = np.cumsum(lengths) - lengths
    begin = np.concatenate(begins)
    at = begin[None, :] + np.arange(WINDOW)[:, None]
    there = at < lengths[owner][None, :]
    flat = np.concatenate(texts)
    return flat[np.where(there, at, 0) + base[owner][None, :]], there, owner


def logits(network: Network, p: Parameters, rows: tuple[np.ndarray, np.ndarray], ids: np.ndarray, there: np.ndarray) -> np.ndarray:
    out = np.empty(ids.shape[1], dtype=np.float64)
    for at in range(0, len(out), AT_ONCE):
        cut = slice(at, at + AT_ONCE)
        # Windows of a batch are cut to the longest of them.
        longest = int(there[:, cut].any(axis=1).sum())
        out[cut] = network.forward(p, rows, ids[:longest, cut], there[:longest, cut])[0]
    return out


def train(texts: list[str | None], labels: np.ndarray, weights: np.ndarray) -> tuple[Network, Parameters]:
    """The network fitted to whole texts with labels 0 and 1."""
    numbered = Numbered()
    each = [numbered(t) for t in texts]
    words = list(numbered.number)
    core = list(map(Network.core, words))
    holders, toxic = Counter(), Counter()
    for ids, label in zip(each, labels):
        own = {core[i] for i in np.unique(ids)} - {""}
        holders.update(own)
        toxic.update(own if label else ())
    network = Network([w for w, n in sorted(holders.items(), key=lambda x: (-x[1], x[0]))[:VOCABULARY] if n > 2])
    p = network.fresh()
    ones, all_ = int(labels.sum()), len(labels)
    mass = float(weights[labels > 0].sum())
    p["out_bias"][0] = np.log((mass + 0.5) / (float(weights.sum()) - mass + 1))

    def odds(word: str) -> float:
        return np.log((toxic[word] + 0.5) / (ones + 1)) - np.log((holders[word] - toxic[word] + 0.5) / (all_ - ones + 1))

    for word, i in network.number.items():
        p["word"][i, 0] += 0.3 * np.clip(odds(word), -3, 3)
    if not all_:
        return network, p
    ids, there, owner = window_rows(each)
    suspect = np.array([odds(c) if holders[c] > 2 else 0.0 for c in core])
    value = np.where(there, suspect[ids], -np.inf).max(axis=0)
    adam, draw = Adam(0.01), np.random.default_rng(3)
    first = np.searchsorted(owner, np.arange(all_))
    count = np.diff(first, append=len(owner))
    turn = 0
    while turn < EPOCHS or adam.turn < LEAST_STEPS:
        turn += 1
        best = np.lexsort((np.arange(len(owner)), -value, owner))[first]
        other = first + (draw.random(all_) * count).astype(np.int64)
        shown = np.concatenate((best, other[(labels == 0) & (count > 1)]))
        shown = shown[draw.permutation(len(shown))]
        for at in range(0, len(shown), BATCH):
            some = shown[at : at + BATCH]
            longest = int(there[:, some].any(axis=1).sum())
            used, own = np.unique(ids[:longest, some], return_inverse=True)
            g, _ = network.gradients(p, [words[i] for i in used], own.reshape(longest, -1), there[:longest, some], labels[owner[some]], weights[owner[some]])
            adam(p, g)
        value = logits(network, p, network.rows(p, network.vectors(p, words)[0]), ids, there)
    return network, p


class Scorer:
    """Scores texts; gate values of words are computed once and held."""

    def __init__(self, network: Network, p: Parameters):
        self.network, self.p = network, p
        self._clear()

    def _clear(self) -> None:
        self.numbered, self.rows = Numbered(), None

    def _gates(self) -> tuple[np.ndarray, np.ndarray]:
        known = 0 if self.rows is None else len(self.rows[0])
        new = list(self.numbered.number)[known:]
        if new:
            more = self.network.rows(self.p, self.network.vectors(self.p, new)[0])
            self.rows = more if self.rows is None else tuple(np.concatenate(both) for both in zip(self.rows, more))
        return self.rows

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        out, at = np.empty(len(texts)), 0
        while at < len(texts):
            some, n, begin = [], 0, at
            while at < len(texts) and n < AT_ONCE * STEP:
                some.append(self.numbered(texts[at]))
                n, at = n + len(some[-1]), at + 1
            ids, there, owner = window_rows(some)
            found = logits(self.network, self.p, self._gates(), ids, there)
            out[begin:at] = np.maximum.reduceat(found, np.searchsorted(owner, np.arange(len(some))))
            if len(self.numbered.number) > HELD:
                self._clear()
        # The last digits depend on what else is in a batch.
        return np.round(1 / (1 + np.exp(-out)), 6)


def labelled(docs: DataFrame, labels: DataFrame, text: str, id: str, label: str) -> DataFrame:
    """(text, label, weight) of at most SAMPLE rows of each label; they stand for all that may be learned from."""
    known = labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("label").alias("label"))
    # Rows are chosen by ids and hashes; texts are fetched for the chosen few.
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("h")).where("id IS NOT NULL")
    found = staged(rows.select("id", "h").join(known, "id").distinct(), "labels")
    counts = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}  # two rows
    parts = [found.limit(0).withColumn("weight", F.lit(1.0))]
    for value, n in sorted(counts.items()):
        some = found.where(F.col("label") == value).orderBy(F.xxhash64(F.col("id").cast("string")), "h").limit(SAMPLE)
        parts.append(some.withColumn("weight", F.lit(max(n / SAMPLE, 1.0))))
    chosen = staged(functools.reduce(DataFrame.unionAll, parts), "chosen")
    # At most SAMPLE rows of each label are broadcast, and as many texts come back, however often they are repeated.
    texts = rows.join(F.broadcast(chosen), ["id", "h"]).groupBy("id", "h", "label", "weight").agg(F.first("text").alias("text"))
    return staged(texts.select("text", "label", "weight"), "sample")


def fit(sample: DataFrame) -> tuple[Network, Parameters]:
    """The network, trained in one task on a bounded sample."""

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([pd.DataFrame({"text": [], "label": [], "weight": []}), *batches])
        order = sorted(range(len(rows)), key=lambda i: (rows["text"].iloc[i] or "", rows["label"].iloc[i]))  # reruns agree
        rows = rows.iloc[order]
        network, p = train(rows["text"].tolist(), rows["label"].to_numpy(np.float32), rows["weight"].to_numpy(np.float32))
        yield pd.DataFrame({"model": [pickle.dumps((list(network.number), p))]})

    found = sample.coalesce(1).mapInPandas(learn, "model binary").collect()
    if not found:
        return train([], np.zeros(0, np.float32), np.zeros(0, np.float32))
    words, p = pickle.loads(found[0]["model"])
    return Network(words), p


def score(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """The id, held_out, score and predicted of every row of ``docs``."""
    network, p = fit(labelled(docs, labels, text, id, label))
    model = docs.sparkSession.sparkContext.broadcast((list(network.number), p))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights = model.value
        scorer = Scorer(Network(words), weights)
        for batch in batches:
            found = scorer(batch.column(2).to_pylist())
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.float64()), pa.array(found >= 0.5).cast(pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[id, "held_out", "score", "predicted"])

    rows = docs.select(F.col(id).alias("id"), held_out(F.col(id)).alias("held_out"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(judge, f"`{id}` {kind}, held_out boolean, score double, predicted int")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
