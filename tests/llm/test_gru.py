"""The recurrent network's inner loops: memory used again, and logits that are cut off, and numbers of words."""

from __future__ import annotations

import zlib

import numpy as np

from daygrid.llm import gru, lm
from tests.llm.test_operators import small_model


def window(draw, model, rows=7, steps=6):
    words = draw.integers(0, model.start, (steps + 1, rows))
    there = np.arange(steps)[:, None] < draw.integers(1, steps + 1, rows)
    return words[:-1], np.where(there, words[1:], 0), there, draw.uniform(-1, 1, (rows, model.state))


def test_windows_share_their_memory_and_nothing_else():
    _, model, p, draw = small_model()
    first, second, room = window(draw, model), window(draw, model), gru.Room()
    alone = model.gradients(p, *second)
    before = model.gradients(p, *first, room)
    kept = {name: x.copy() for name, x in before[0].items()}
    held, state = dict(room.held), before[1].copy()
    after = model.gradients(p, *second, room)
    assert held and all(room.held[name] is x for name, x in held.items())
    assert all(np.array_equal(alone[0][name], after[0][name]) for name in p) and np.array_equal(alone[1], after[1]) and alone[2] == after[2]
    assert all(np.array_equal(kept[name], before[0][name]) for name in p) and np.array_equal(state, before[1])
    # Another number of rows takes room of its own size.
    wider = window(draw, model, rows=9)
    assert np.array_equal(model.gradients(p, *wider, room)[0]["into"], model.gradients(p, *wider)[0]["into"])


def test_logits_are_cut_off_only_where_they_could_overflow(monkeypatch):
    _, model, p, draw = small_model()
    states, words = draw.uniform(-1, 1, (40, model.state)), draw.integers(0, model.start, 40)
    assert model._tame(p["to_class"], p["class_bias"])
    logs = model.logs(p, states, words, gru.Room())
    monkeypatch.setattr(gru.Model, "_tame", staticmethod(lambda *_: False))
    assert np.array_equal(logs, model.logs(p, states, words))
    monkeypatch.undo()
    # Logits that float32 cannot raise to a power.
    q = {name: x.astype(np.float32) for name, x in p.items()} | {"class_bias": (p["class_bias"] + 500).astype(np.float32)}
    assert not model._tame(q["to_class"], q["class_bias"]) and np.isfinite(model.logs(q, states.astype(np.float32), words)).all()


def test_words_are_numbered_by_rank_or_by_ending():
    model = gru.Model(3, 2, 5, 2)
    number = lm._Numbers([b"the", b"\n", b"of"], model)
    words = [b"of", b"other", b"another", b"x", b"\n", b"\xc3\xa9", b"the"]
    known = {b"the": 0, b"\n": 1, b"of": 2}
    for _ in range(2):
        assert [number[w] for w in words] == [known.get(w, 3 + zlib.crc32(w[-2:]) % 5) for w in words]
    assert len(number) == 3  # rare words are not kept, only their endings
