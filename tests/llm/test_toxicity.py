"""The toxicity network: gradients by differences, scores by a plain forward pass, labels that it has not seen."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from daygrid.llm import toxicity
from daygrid.llm.bigru import Network, trigrams, windows_of

SCHEMA = "doc_id {id}, text string, toxic int, held_out string, score string, label string"


def bare(network, p, words):
    """The logit of one window, number by number."""
    vectors = []
    for word in words:
        marked = f"\x02{word}\x03" if word else "\x02\x02\x03"
        hashes, _ = trigrams([word], network.grams)
        assert len(hashes) == len(marked) - 2
        vectors.append(p["word"][network.number.get(network.core(word), 0)] + p["gram"][hashes].mean(axis=0))
    n, states = network.state, {}
    for way, order in (("on", range(len(words))), ("back", range(len(words) - 1, -1, -1))):
        h = np.zeros(n)
        for t in order:
            x, again = vectors[t] @ p[f"{way}_in"] + p[f"{way}_bias"], h @ p[f"{way}_again"]
            z, r = (1 / (1 + np.exp(-(x[k * n : k * n + n] + again[k * n : k * n + n]))) for k in (0, 1))
            new = np.tanh(x[2 * n :] + r * (again[2 * n :] + p[f"{way}_shift"]))
            h = z * h + (1 - z) * new
            states[way, t] = h
    rows = [np.concatenate((states["on", t], states["back", t])) for t in range(len(words))]
    look = np.array([np.tanh(s @ p["pool"] + p["pool_bias"]) @ p["look"] for s in rows])
    weight = np.exp(look - look.max())
    return float((weight / weight.sum()) @ np.array(rows) @ p["out"] + p["out_bias"][0])


def small():
    network = Network(["good", "bad"], grams=50, inputs=5, state=4, attention=3)
    p = {k: v.astype(np.float64) + 0.01 for k, v in network.fresh().items()}
    words = ["", "good", "bad", "ugly", "x1", "é"]
    draw = np.random.default_rng(1)
    ids, there = draw.integers(0, 6, (7, 4)), np.arange(7)[:, None] < np.array([7, 3, 1, 5])
    return network, p, words, ids, there


def test_gradients_by_differences():
    network, p, words, ids, there = small()
    labels, weights = np.array([1.0, 0, 0, 1]), np.array([1.0, 2, 1, 3])
    g, _ = network.gradients(p, words, ids, there, labels, weights)
    draw = np.random.default_rng(2)
    for name in p:
        for _ in range(6):
            at = tuple(int(draw.integers(n)) for n in p[name].shape)
            if name == "word" and at[0] == 0:
                continue
            losses = []
            for step in (1e-5, -1e-5):
                q = {k: v.copy() for k, v in p.items()}
                q[name][at] += step
                losses.append(network.gradients(q, words, ids, there, labels, weights)[1])
            assert abs((losses[0] - losses[1]) / 2e-5 - g[name][at]) < 1e-6, (name, at)


def test_forward_pass():
    network, p, words, ids, there = small()
    found = network.forward(p, network.rows(p, network.vectors(p, words)[0]), ids, there)[0]
    for k, n in enumerate(there.sum(axis=0)):
        assert abs(found[k] - bare(network, p, [words[i] for i in ids[:n, k]])) < 1e-9


def test_windows_cover_the_text():
    for n in range(1, 200):
        begins = windows_of(n, 32, 16)
        assert begins[0] == 0 and begins[-1] + 32 >= n and all(np.diff(begins) == 16)
        assert n <= 32 and len(begins) == 1 or begins[-2] + 32 < n


def talk(seed, n, *insults):
    draw = random.Random(seed)
    words = ["".join(draw.choice("aeioulmnrst") for _ in range(draw.randint(2, 7))) for _ in range(n)]
    for insult in insults:
        words.insert(draw.randrange(len(words) + 1), insult)
    return " ".join(words)


def small_rows():
    rows = [(i, talk(i, 20 + 11 * (i % 30), *([["vile", "zzyzx" + talk(i, 1)][i // 4 % 2]] * 2 if i % 4 == 0 else [])), int(i % 4 == 0)) for i in range(300)]
    return rows + [(1000, None, 0), (1001, "", 0), (1002, " \n\t ", 0), (1003, "x" * 50_000, 0), (1004, talk(5, 60_000, "vile"), 1)]


def frame(spark, rows, id="long"):
    return spark.createDataFrame([(i, t, x, "h", "s", "l") for i, t, x in rows], SCHEMA.format(id=id)).repartition(3)


def test_scores(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SLICE", 1000)
    monkeypatch.setattr(toxicity, "HELD", 5000)
    rows = small_rows()
    rows += [(2**60 + 1, rows[0][1], 1), (-(2**60) - 1, rows[1][1], 0), (None, rows[4][1], 1), (None, None, None), rows[8], rows[8]]
    docs = frame(spark, rows)
    labels = docs.select("doc_id", "toxic", "text").unionAll(docs.selectExpr("doc_id", "7 AS toxic", "text"))
    found = toxicity.score(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    got = found.collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted((r[0] for r in rows), key=repr)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    told = {i: x for i, _, x in rows if i is not None}
    assert sum(r.predicted == told[r.doc_id] for r in got if r.doc_id is not None) >= 0.9 * len(got)
    again = {(r.doc_id, r.score) for r in toxicity.score(docs, labels).collect()}
    assert again == {(r.doc_id, r.score) for r in got}
    # The same network, window by window.
    network, p = toxicity.fit(toxicity.labelled(docs, labels, "text", "doc_id", "toxic"))
    scores = {r.doc_id: r.score for r in got}
    for i, text, _ in [r for r in rows if r[0] in (3, 4, 29, 1000, 1001, 1002, 1003)]:
        words = (text or "").lower().split() or [""]
        logit = max(bare(network, p, words[b : b + 32]) for b in windows_of(len(words), 32, 16))
        assert abs(1 / (1 + np.exp(-logit)) - scores[i]) < 1e-4


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = frame(spark, small_rows()[:120])
    other = docs.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    one, two = ({(r.doc_id, r.score) for r in toxicity.score(docs, labels).collect()} for labels in (docs, other))
    assert one == two


@pytest.mark.parametrize("labels", [[], [("a", "t", None)], [(None, "t", 1)], [("d", "t", 1)]])
def test_few_labels_and_no_rows(spark, labels):
    docs = frame(spark, [("a", "one two", 0), (None, None, 0), ("a", "one two", 0), ("d", "three four", 1)], "string")
    got = toxicity.score(docs, frame(spark, labels, "string")).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got) and len({r.score for r in got if r.doc_id == "a"}) == 1
    assert toxicity.score(docs.limit(0), docs).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = toxicity.op13_toxicity(spark, folder).where("held_out").join(labels, "doc_id").collect()
    toxic, clean = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)
    assert sum(r.predicted for r in toxic) >= 0.7 * len(toxic)
    better = sum(a.score > b.score for a in toxic for b in clean)
    assert better >= 0.95 * len(toxic) * len(clean)
