"""A bidirectional gated recurrent classifier in numpy: character and word inputs, attention over the states, one logit.

A word comes as a vector: the vector of the word, if the vocabulary has it, plus the mean of its hashed character trigrams' vectors.
"""

from __future__ import annotations

import re

import numpy as np

Parameters = dict[str, np.ndarray]
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def trigrams(words: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes below ``size`` of the trigrams of each marked word, one after another, and where each word's begin."""
    marked = [f"\x02{w}\x03" if w else "\x02\x02\x03" for w in words]
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    lengths = np.array(list(map(len, marked)), dtype=np.int64)
    first = np.cumsum(lengths) - lengths
    inside = np.ones(len(points), dtype=bool)
    inside[np.concatenate((first + lengths - 1, first + lengths - 2))] = False
    at = np.flatnonzero(inside)
    mixed = (points[at] * np.uint64(0x9E3779B97F4A7C15)) ^ (points[at + 1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (points[at + 2] * np.uint64(0x165667B19E3779F9))
    return ((mixed >> np.uint64(20)) % np.uint64(size)).astype(np.int64), np.cumsum(lengths - 2) - (lengths - 2)


class Network:
    """``words`` is the vocabulary; ``grams`` trigram vectors of ``inputs`` numbers; ``state`` numbers in each direction."""

    def __init__(self, words: list[str], grams: int = 4096, inputs: int = 16, state: int = 12, attention: int = 8):
        self.number = {word: i + 1 for i, word in enumerate(words)}  # 0: any other word
        self.grams, self.inputs, self.state, self.attention = grams, inputs, state, attention

    @staticmethod
    def core(word: str) -> str:
        """The letters of a word, by which the vocabulary knows it."""
        return _NOT_LETTERS.sub("", word)

    def fresh(self, seed: int = 5) -> Parameters:
        draw, e, h = np.random.default_rng(seed), self.inputs, self.state
        shapes = {"word": (len(self.number) + 1, e), "gram": (self.grams, e), "pool": (2 * h, self.attention), "pool_bias": (self.attention,)}
        shapes |= {"look": (self.attention,), "out": (2 * h,), "out_bias": (1,)}
        for way in ("on", "back"):
            shapes |= {f"{way}_in": (e, 3 * h), f"{way}_bias": (3 * h,), f"{way}_again": (h, 3 * h), f"{way}_shift": (h,)}
        scale = {"word": 0.05, "gram": 0.05}
        p = {k: (draw.standard_normal(s) * scale.get(k, 0.3)).astype(np.float32) for k, s in shapes.items()}
        for k in p:
            if "bias" in k or "shift" in k:
                p[k][:] = 0
        p["word"][0] = 0
        return p

    def vectors(self, p: Parameters, words: list[str]) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        """A vector for each word, and what the gradient needs."""
        numbers = np.array([self.number.get(self.core(w), 0) for w in words], dtype=np.int64)
        hashes, first = trigrams(words, self.grams)
        sizes = np.diff(first, append=len(hashes)).astype(np.float32)
        mean = np.add.reduceat(p["gram"][hashes], first, axis=0) / sizes[:, None]
        return p["word"][numbers] + mean, (numbers, hashes, sizes)

    def rows(self, p: Parameters, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each word puts into the gates, in both directions."""
        return vectors @ p["on_in"] + p["on_bias"], vectors @ p["back_in"] + p["back_bias"]

    def _run(self, p: Parameters, way: str, rows: np.ndarray, ids: np.ndarray, there: np.ndarray, kept: list | None) -> np.ndarray:
        """States (time, row, state) of one direction; ids and there are (time, row)."""
        n, out = self.state, np.zeros((*ids.shape, self.state), dtype=rows.dtype)
        h = np.zeros((ids.shape[1], n), dtype=rows.dtype)
        steps = range(len(ids)) if way == "on" else range(len(ids) - 1, -1, -1)
        for t in steps:
            x, again = np.take(rows, ids[t], axis=0), h @ p[f"{way}_again"]
            gates = 1 / (1 + np.exp(-(x[:, : 2 * n] + again[:, : 2 * n])))
            z, r = gates[:, :n], gates[:, n:]
            inner = again[:, 2 * n :] + p[f"{way}_shift"]
            new = np.tanh(x[:, 2 * n :] + r * inner)
            after = new + z * (h - new)
            if kept is not None:
                kept.append((t, h, z, r, inner, new))
            h = out[t] = np.where(there[t][:, None], after, h)
        return out

    def forward(self, p: Parameters, rows: tuple[np.ndarray, np.ndarray], ids: np.ndarray, there: np.ndarray, keep: bool = False) -> tuple:
        """The logit of every window; ids and there are (time, row)."""
        kept = ([], []) if keep else (None, None)
        sides = [self._run(p, way, side, ids, there, memory) for way, side, memory in zip(("on", "back"), rows, kept)]
        states = np.concatenate(sides, axis=2)
        looked = np.tanh(states @ p["pool"] + p["pool_bias"])
        weight = np.where(there, looked @ p["look"], -np.inf)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * states).sum(axis=0)
        return pooled @ p["out"] + p["out_bias"][0], (kept, states, looked, weight, pooled)

    def gradients(self, p: Parameters, words: list[str], ids: np.ndarray, there: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[Parameters, float]:
        """Of the weighted mean cross-entropy; ids number ``words``."""
        vectors, (numbers, hashes, sizes) = self.vectors(p, words)
        rows = self.rows(p, vectors)
        logits, (kept, states, looked, weight, pooled) = self.forward(p, rows, ids, there, keep=True)
        share = weights / weights.sum()
        probability = 1 / (1 + np.exp(-logits))
        loss = float((share * (np.logaddexp(0, logits) - labels * logits)).sum())
        d_logit = share * (probability - labels)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["out"], g["out_bias"][0] = d_logit @ pooled, d_logit.sum()
        d_pooled = d_logit[:, None] * p["out"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = (states * d_pooled).sum(axis=2)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["look"] = np.einsum("tn,tna->a", d_score, looked)
        d_looked = d_score[:, :, None] * p["look"] * (1 - looked * looked)
        g["pool"], g["pool_bias"] = np.einsum("tns,tna->sa", states, d_looked), d_looked.sum(axis=(0, 1))
        d_states = d_states + d_looked @ p["pool"].T
        d_vectors = np.zeros_like(vectors)
        n = self.state
        for way, memory, d_side in zip(("on", "back"), kept, (d_states[:, :, :n], d_states[:, :, n:])):
            d_rows, carried = np.zeros((len(words), 3 * n), dtype=vectors.dtype), np.zeros_like(d_side[0])
            for t, before, z, r, inner, new in reversed(memory):
                whole = d_side[t] + carried
                total = whole * there[t][:, None]
                d_new = total * (1 - z) * (1 - new * new)
                d_z = total * (before - new) * z * (1 - z)
                d_r = d_new * inner * r * (1 - r)
                d_again = np.concatenate((d_z, d_r, d_new * r), axis=1)
                g[f"{way}_again"] += before.T @ d_again
                g[f"{way}_shift"] += d_again[:, 2 * n :].sum(axis=0)
                np.add.at(d_rows, ids[t], np.concatenate((d_z, d_r, d_new), axis=1))
                carried = (whole - total) + total * z + d_again @ p[f"{way}_again"].T
            g[f"{way}_in"], g[f"{way}_bias"] = vectors.T @ d_rows, d_rows.sum(axis=0)
            d_vectors += d_rows @ p[f"{way}_in"].T
        np.add.at(g["word"], numbers, d_vectors)
        np.add.at(g["gram"], hashes, np.repeat(d_vectors / sizes[:, None], sizes.astype(np.int64), axis=0))
        g["word"][0] = 0
        return g, loss


def windows_of(n: int, size: int, step: int) -> np.ndarray:
    """Where the windows of a text of ``n`` words begin: every ``step`` words until one reaches the end."""
    return np.arange(0, max(n - size, 0) + step, step)[: 1 + -(-max(n - size, 0) // step)]
