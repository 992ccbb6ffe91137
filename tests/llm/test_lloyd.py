"""Clustering against a plain version in Python's whole numbers."""

from __future__ import annotations

import hashlib
import math
import random

import pytest

from daygrid.llm import lloyd

SCHEMA = "vec_id {id}, embedding array<{kind}>, cluster string, chunk int, block int, ids string, body string"


def plain(rows, dims, clusters, rounds):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    whole = [[math.floor(64 * x) if abs(x) < 2**53 else 64 * int(x) for x in v] for _, v in kept]
    name = [hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest() for i, _ in kept]
    first = sorted(range(len(kept)), key=lambda r: (name[r], kept[r][1]))[:clusters]
    centroids = [whole[r] for r in first]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids)) for v in whole]

    for _ in range(rounds):
        own = [k for _, k in assign()]
        for k in range(len(centroids)):
            mine = [v for v, o in zip(whole, own) if o == k]
            if mine:
                centroids[k] = [sum(column) // len(mine) for column in zip(*mine)]
    found = assign()
    inertia = [sum(d for d, k in found if k == c) for c in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    top = 2**63 - 1
    cut = [(i, k, min(d, top), min(inertia[k], top), min(sum(min(x, top**9) for x in inertia), top), digest[k]) for (i, _), (d, k) in zip(kept, found)]
    return sorted(cut, key=repr)


def vectors(dims, n, spread, seed=1):
    draw = random.Random(seed)
    return [[draw.gauss(i % 7, 1) * spread for _ in range(dims)] for i in range(n)]


def run(spark, rows, dims=10, clusters=5, rounds=3, width=4, id="long", kind="double"):
    full = [(i, v, "c", 1, 2, "x", "y") for i, v in rows]
    frame = spark.createDataFrame(full, SCHEMA.format(id=id, kind=kind)).repartition(3)
    found = lloyd.cluster(frame, dims=dims, clusters=clusters, rounds=rounds, width=width)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, found.collect()), key=repr)


def odd(rows, dims):
    more = [(2**60 + 1, rows[0][1]), (-(2**60) - 1, rows[1][1]), (None, rows[2][1]), (None, rows[2][1]), (None, None), (900, [])]
    more += [(901, [0.0] * (dims - 1)), (902, [None] + [0.0] * (dims - 1)), (903, [math.nan] * dims), (904, [math.inf] + [0.0] * (dims - 1))]
    return rows + more + [rows[3]] * 40 + [(905, [0.0] * dims), (906, [-0.0] * dims)]


@pytest.mark.parametrize("rows", [lloyd.ROWS, 16])
def test_against_plain_version(spark, monkeypatch, rows):
    monkeypatch.setattr(lloyd, "ROWS", rows)
    given = odd(list(enumerate(vectors(10, 150, 0.3))), 10)
    assert run(spark, given) == plain(given, 10, 5, 3)


def test_joined_slices(spark, monkeypatch):
    monkeypatch.setattr(lloyd, "BROADCAST_BYTES", -1)
    given = list(enumerate(vectors(10, 60, 0.3)))
    assert run(spark, given) == plain(given, 10, 5, 3)


@pytest.mark.parametrize("spread", [1e5, 1e8, 1e30, 1e300])
def test_large_components_are_exact(spark, spread):
    given = list(enumerate(vectors(6, 40, spread)))
    got, expected = run(spark, given, dims=6), plain(given, 6, 5, 3)
    if spread < 1e15:
        assert got == expected
    else:  # inertias are sums of longs that are cut already
        assert [(r[0], r[1], r[2], r[5]) for r in got] == [(r[0], r[1], r[2], r[5]) for r in expected]


def test_few_none_and_equal_vectors(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, [1.0])]) == []
    few = list(enumerate(vectors(10, 3, 0.3)))
    assert run(spark, few) == plain(few, 10, 5, 3)
    same = [(i, [0.5] * 10) for i in range(30)]
    got = run(spark, same)
    assert got == plain(same, 10, 5, 3) and {r[1] for r in got} == {0}


def test_string_ids_and_floats(spark):
    given = [(None if i == 4 else f"v{i}", [float(round(x * 256)) / 256 for x in v]) for i, v in enumerate(vectors(8, 40, 0.3))]
    assert run(spark, given, dims=8, id="string", kind="float") == plain(given, 8, 5, 3)
