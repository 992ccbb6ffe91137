"""The alignment of two tokenizers against loops over all pairs of tokens."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daygrid.llm import alignment

SCHEMA = "doc_id {id}, text string, run int, cell string, head string, n_a string, rows int"


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(*[open(path, "rb").read() for path in (alignment.FIRST, alignment.SECOND)])


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(alignment.FIRST)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.SECOND)


def plain(rows, tokenizers):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of every row."""
    first, second = tokenizers
    byte_of = alignment._byte_of()
    texts = []
    for i, text in rows:
        texts.append((i, [], []))
        if not text:
            continue
        spans = []
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        for ids, piece in ((a, lambda i: bytes(byte_of[c] for c in first.id_to_token(i))), (b, lambda i: bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode())):
            at, joined = 0, []
            spans.append([])
            for token in ids:
                joined.append(piece(token))
                spans[-1].append((token, at, at + len(joined[-1])))
                at += len(joined[-1])
            if b"".join(joined) != (" " + text).encode():
                spans = [[], []]
                break
        texts[-1] = (i, *spans)
    links = [[(x[0], y[0]) for y in b for x in a if x[1] < y[2] and y[1] < x[2]] if len(a) < 400 else _swept(a, b) for _, a, b in texts]
    count = Counter(pair for own in links for pair in own)
    most = {}
    for (_, y), n in count.items():
        most[y] = max(most.get(y, 0), n)
    out = []
    for (i, a, b), own in zip(texts, links):
        common = sorted({x[2] for x in a} & {x[2] for x in b})
        names, begin = [], 0
        for end in common:
            names.append("|".join(",".join(str(x[0]) for x in side if begin < x[2] <= end) for side in (a, b)) if len(a) < 400 else None)
            begin = end
        if a and len(a) >= 400:
            names = _grouped(a, b, set(common))
        digest = hashlib.sha256(";".join(names).encode()).hexdigest() if a else ""
        out.append((i, len(a), len(b), len(common), len(own), sum(count[p] == most[p[1]] for p in own), sum(count[p] for p in own), digest))
    return sorted(out, key=repr)


def _swept(a, b):
    out, j = [], 0
    for y in b:
        while a[j][2] <= y[1]:
            j += 1
        k = j
        while k < len(a) and a[k][1] < y[2]:
            out.append((a[k][0], y[0]))
            k += 1
    return out


def _grouped(a, b, common):
    out = []
    for side in (a, b):
        groups = [[]]
        for token, _, end in side:
            groups[-1].append(str(token))
            if end in common:
                groups.append([])
        out.append([",".join(g) for g in groups[:-1]])
    return ["|".join(pair) for pair in zip(*out)]


def texts():
    draw = random.Random(4)
    stems = ["the", "over", "tion", "ing", "straße", "été", "niño", "Ελλάδα", "北京", "🙂", "don't", "3,14", "re", "<s>", "<|endoftext|>", "<0x41>", "x" * 40]
    out = [" ".join(draw.choice(stems) for _ in range(n)) for n in (1, 2, 5, 20, 60, 90)]
    out += [None, "", " ", "  lead", "trail  ", "a\tb\nc\r\n\n d", "nul\0byte", "a▁b", "ﬁ Å é ​﻿", "　wide", "…—“”", "ab1 " * 3000, " " * 5000 + "x", "\n" * 300]
    return out + [out[4]] * 30 + [out[0]] * 3


def frame(spark, rows, id="long"):
    return spark.createDataFrame([(i, t, 1, "c", "h", "n", 2) for i, t in rows], SCHEMA.format(id=id)).repartition(4)


def result(df):
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"RUN": 60, "FAN": 2, "FRAME": 8}, {"TEXTS": 4, "FAN": 3, "ROWS": 5}])
def test_against_plain_version(spark, tokenizers, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(alignment, name, value)
    rows = list(enumerate(texts()))
    rows += [(2**60 + 1, rows[3][1]), (-(2**60) - 1, rows[4][1]), (None, rows[5][1]), (None, None), (7, rows[7][1]), rows[2], rows[2]]
    assert result(alignment.align(frame(spark, rows))) == plain(rows, tokenizers)


def test_edges(spark, tokenizers):
    assert result(alignment.align(frame(spark, []))) == []
    rows = [(None, None), ("a", ""), ("b", "a▁b")]
    assert result(alignment.align(frame(spark, rows, "string"))) == plain(rows, tokenizers)
    assert all(r[1:] == (0, 0, 0, 0, 0, 0, "") for r in plain(rows, tokenizers))


def test_pairs(spark, tokenizers, aligner):
    rows = list(enumerate(texts()[:6]))
    found = {(r.a, r.b): (r.links, r.best) for r in alignment.Alignment(frame(spark, rows), cells=3).pairs().collect()}
    encoded = [aligner.encode(t) for _, t in rows]
    links = alignment.Links(aligner, [e for e in encoded if e is not None])
    count = Counter(zip(links.a.tolist(), links.b.tolist()))
    most = {y: max(n for (_, z), n in count.items() if z == y) for _, y in count}
    assert found == {p: (n, n == most[p[1]]) for p, n in count.items()}


def test_given_table(spark, tokenizers):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(alignment.align(docs)) == plain(rows, tokenizers)


def test_every_token_by_both_encoders(aligner, tokenizers):
    """The faster encoder takes a piece that is a token at once; merges must give the same."""
    assert aligner.a.fast is not None
    pieces = [t.decode() for t in aligner.a.bytes if t.isascii()]
    assert [aligner.a.fast.encode_ordinary(p) for p in pieces] == [e.ids for e in tokenizers[0].encode_batch(pieces, add_special_tokens=False)]


def test_long_texts(aligner, tokenizers):
    for text in (" " * 1_000_000, "^" * 100_000, "a" * 100_000 + " b", "\n \t" * 20_000):
        assert aligner.a.encode(text) == tokenizers[0].encode(text, add_special_tokens=False).ids


def test_merge_of_runs():
    draw = np.random.default_rng(5)
    runs, count = [], Counter()
    for _ in range(9):
        keys = np.unique(draw.integers(0, 400, int(draw.integers(0, 300))))
        counts = draw.integers(1, 9, len(keys))
        count.update(dict(zip(keys.tolist(), counts.tolist())))
        cuts = [slice(at, at + 7) for at in range(0, len(keys), 7)]
        runs.append(iter([[keys[c], counts[c]] for c in cuts]))
    found = [(k, n) for keys, counts in alignment.merged(runs) for k, n in zip(keys.tolist(), counts.tolist())]
    assert found == sorted(count.items())
