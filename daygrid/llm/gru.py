"""A gated recurrent language model in numpy, with a class-factored output.

Words come as numbers: frequent words 0..F-1 (the end token is one of them) in classes of equal size, all others as the class of
their ending. P(word) = P(class | state) * P(word | class), where the second factor is a softmax over the class's words for
frequent ones and, for the others, a fixed share that the caller knows. An input word is a row of gate values, so the step
needs one small matrix product.
"""

from __future__ import annotations

import numpy as np

Parameters = dict[str, np.ndarray]
CHUNK = 1024


class Model:
    """``frequent`` words in classes of ``size``, and ``endings`` further classes."""

    def __init__(self, frequent: int, size: int, endings: int, state: int):
        self.frequent, self.size, self.endings, self.state = frequent, size, endings, state
        self.heads = -(-frequent // size)
        self.classes = self.heads + endings
        self.start = frequent + endings  # the input before the first word

    def shapes(self) -> dict[str, tuple[int, ...]]:
        h = self.state
        return {
            "into": (self.start + 1, 3 * h),
            "again": (h, 3 * h),
            "shift": (h,),
            "to_class": (h, self.classes),
            "class_bias": (self.classes,),
            "to_word": (self.heads, h, self.size),
            "word_bias": (self.heads, self.size),
        }

    def fresh(self, class_logs: np.ndarray, word_logs: np.ndarray) -> Parameters:
        """Small weights from a fixed seed; with these biases the model starts as the counts' unigram model."""
        draw, p = np.random.default_rng(7), {}
        for name, shape in self.shapes().items():
            scale = {"into": 0.3, "again": 0.3}.get(name, 0.02)
            p[name] = (draw.standard_normal(shape) * scale).astype(np.float32)
        p["shift"][:] = 0
        p["class_bias"][:] = class_logs
        p["word_bias"][:] = word_logs
        return p

    def pack(self, p: Parameters) -> np.ndarray:
        return np.concatenate([p[name].ravel() for name in self.shapes()])

    def unpack(self, flat: np.ndarray) -> Parameters:
        p, at = {}, 0
        for name, shape in self.shapes().items():
            n = int(np.prod(shape))
            p[name] = flat[at : at + n].reshape(shape).astype(np.float32)
            at += n
        return p

    def class_of(self, words: np.ndarray) -> np.ndarray:
        return np.where(words < self.frequent, words // self.size, words - self.frequent + self.heads)

    def gates(self, p: Parameters) -> np.ndarray:
        """``into`` with the two gates and the new state apart, so that each is one block of memory."""
        return np.ascontiguousarray(p["into"].reshape(-1, 3, self.state).transpose(1, 0, 2))

    def step(self, p: Parameters, into: np.ndarray, inputs: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """The next state, and what backpropagation needs; ``into`` as ``gates`` gives it."""
        n = self.state
        x, again = np.take(into, inputs, axis=1), h @ p["again"]
        both = x[:2]
        both[0] += again[:, :n]
        both[1] += again[:, n : 2 * n]
        np.negative(both, out=both)
        np.exp(both, out=both)
        both += 1
        np.reciprocal(both, out=both)
        z, r = both
        inner = again[:, 2 * n :] + p["shift"]
        new = x[2]
        new += r * inner
        np.tanh(new, out=new)
        after = h - new
        after *= z
        after += new
        return after, z, r, inner, new

    def _by_head(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of frequent words, by class, and where each class begins."""
        places = np.flatnonzero(words < self.frequent)
        heads = words[places] // self.size
        by = np.argsort(heads.astype(np.int16), kind="stable")  # a radix sort
        return places[by], np.searchsorted(heads[by], np.arange(self.heads + 1))

    @staticmethod
    def _log_share(logits: np.ndarray, at: np.ndarray, tame: bool) -> np.ndarray:
        """Logarithms of the softmax at the places ``at``; ``logits`` is used up."""
        if not tame:
            np.minimum(logits, 80, out=logits)  # beyond, float32 overflows
        own = logits[np.arange(len(at)), at]
        np.exp(logits, out=logits)
        return own - np.log(logits @ np.ones(logits.shape[1], dtype=logits.dtype))

    def logs(self, p: Parameters, states: np.ndarray, words: np.ndarray, room: Room | None = None) -> np.ndarray:
        """Natural logarithms of P(class) and, for frequent words, P(word | class) at each state."""
        kind, room = np.result_type(states, p["to_class"]), room or Room()
        classes, out = self.class_of(words), np.empty(len(words), dtype=kind)
        tame = self._tame(p["to_class"], p["class_bias"])
        # One product for all: a cut one may round its edges in another way.
        logits = np.matmul(states, p["to_class"], out=room("logits", (len(words), self.classes), kind))
        for lo in range(0, len(words), CHUNK):  # small enough for the cache
            cut = slice(lo, lo + CHUNK)
            logits[cut] += p["class_bias"]
            out[cut] = self._log_share(logits[cut], classes[cut], tame)
        places, cuts = self._by_head(words)
        inside, states = words[places] % self.size, states[places]
        tame = self._tame(p["to_word"], p["word_bias"])
        for c, cut in enumerate(map(slice, cuts[:-1], cuts[1:])):
            if cut.start < cut.stop:
                within = states[cut] @ p["to_word"][c]
                within += p["word_bias"][c]
                out[places[cut]] += self._log_share(within, inside[cut], tame)
        return out

    @staticmethod
    def _tame(weights: np.ndarray, bias: np.ndarray) -> bool:
        """Whether no state, all of whose places are within -1 and 1, can make a logit that must be cut off."""
        return bool((bias + np.abs(weights).sum(axis=-2)).max() < 80)

    def gradients(
        self, p: Parameters, inputs: np.ndarray, targets: np.ndarray, there: np.ndarray, h: np.ndarray, room: Room | None = None
    ) -> tuple[Parameters, np.ndarray, float]:
        """Backpropagation through one window (time, row) from state ``h``; ``there`` marks words that exist.

        Training carries rounding on, so the order of sums and products decides the last digits of every score.
        """
        (steps, rows), n, kind = inputs.shape, self.state, h.dtype
        room = room or Room()
        into = self.gates(p)
        kept, states = [], room("states", (steps + 1, rows, n), kind)
        states[0] = h
        for t in range(steps):
            new_h, *rest = self.step(p, into, inputs[t], states[t])
            kept.append(rest)
            states[t + 1] = np.where(there[t][:, None], new_h, states[t])
        h = states[steps].copy()
        flat, words, real = states[1:].reshape(-1, n), targets.ravel(), there.ravel()
        g = {name: np.zeros(shape, dtype=kind) for name, shape in self.shapes().items()}
        share = 1.0 / max(int(real.sum()), 1)
        classes, loss = self.class_of(words), 0.0
        weight = (real * share).astype(kind)[:, None]
        back = room("back", flat.shape, kind)
        for lo in range(0, len(words), CHUNK):  # small enough for the cache
            cut = slice(lo, lo + CHUNK)
            probability = np.matmul(flat[cut], p["to_class"], out=room("probability", (len(words[cut]), self.classes), kind))
            probability += p["class_bias"]
            probability -= probability.max(axis=1, keepdims=True)
            np.exp(probability, out=probability)
            probability /= probability.sum(axis=1, keepdims=True)
            own = np.arange(len(probability)), classes[cut]
            loss -= float(np.log(probability[own] + 1e-30)[real[cut]].sum())
            probability[own] -= 1
            probability *= weight[cut]
            g["to_class"] += flat[cut].T @ probability
            g["class_bias"] += probability.sum(axis=0)
            np.matmul(probability, p["to_class"].T, out=back[cut])
        places, cuts = self._by_head(np.where(real, words, self.frequent))
        inside, by_head, back_by_head = words[places] % self.size, flat[places], np.empty((len(places), n), dtype=kind)
        for c, cut in enumerate(map(slice, cuts[:-1], cuts[1:])):
            if cut.start == cut.stop:
                continue
            mine = np.arange(cut.stop - cut.start), inside[cut]
            within = by_head[cut] @ p["to_word"][c]
            within += p["word_bias"][c]
            within -= within.max(axis=1, keepdims=True)
            np.exp(within, out=within)
            within /= within.sum(axis=1, keepdims=True)
            loss -= float(np.log(within[mine] + 1e-30).sum())
            within[mine] -= 1
            within *= within.dtype.type(share)
            g["to_word"][c], g["word_bias"][c] = by_head[cut].T @ within, within.sum(axis=0)
            np.matmul(within, p["to_word"][c].T, out=back_by_head[cut])
        back[places] += back_by_head
        back = back.reshape(steps, rows, n)
        carried = np.zeros((rows, n), dtype=kind)
        d_into, d_again = room("into", (steps, rows, 3 * n), kind), room("again", (rows, 3 * n), kind)
        for t in range(steps - 1, -1, -1):
            (z, r, inner, new), before = kept[t], states[t]
            whole = back[t] + carried
            total = whole * there[t][:, None]
            rest = 1 - z
            d_new = total * rest
            square = new * new
            d_new *= np.subtract(1, square, out=square)
            d_z = before - new
            d_z *= total
            d_z *= z
            d_z *= rest
            d_r = d_new * inner
            d_r *= r
            d_r *= np.subtract(1, r, out=rest)
            d_inner = d_new * r
            for k, d in enumerate((d_z, d_r, d_new)):
                d_into[t, :, k * n : (k + 1) * n] = d
            d_again[:, : 2 * n] = d_into[t, :, : 2 * n]
            d_again[:, 2 * n :] = d_inner
            g["again"] += before.T @ d_again
            g["shift"] += d_inner.sum(axis=0)
            whole -= total
            total *= z
            whole += total
            whole += d_again @ p["again"].T
            carried = whole
        which = inputs.ravel()
        by = np.argsort(which.astype(np.int16) if self.start < 1 << 15 else which, kind="stable")
        first = np.flatnonzero(np.diff(which[by], prepend=-1))
        g["into"][which[by[first]]] = np.add.reduceat(d_into.reshape(-1, 3 * n)[by], first, axis=0)
        return g, h, loss


class Room:
    """Arrays that one window after the other uses, by name: fresh memory costs more than the work on it."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, shape: tuple[int, ...], kind: np.dtype) -> np.ndarray:
        held, size = self.held.get(name), int(np.prod(shape))
        if held is None or held.size < size or held.dtype != kind:
            held = self.held[name] = np.empty(size, dtype=kind)
        return held[:size].reshape(shape)


class Adam:
    """Steps of a size that follows each weight's recent gradients."""

    def __init__(self, rate: float = 0.01):
        self.rate, self.turn = rate, 0
        self.mean: Parameters = {}
        self.square: Parameters = {}

    def __call__(self, p: Parameters, g: Parameters) -> None:
        self.turn += 1
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        shrink = min(1.0, 1.0 / (norm + 1e-9))
        rate = self.rate * np.sqrt(1 - 0.99**self.turn) / (1 - 0.9**self.turn)
        for name, x in g.items():
            x = x * np.float32(shrink)
            mean = self.mean.setdefault(name, np.zeros_like(x))
            square = self.square.setdefault(name, np.zeros_like(x))
            mean += (x - mean) * np.float32(0.1)
            square += (x * x - square) * np.float32(0.01)
            p[name] -= np.float32(rate) * mean / (np.sqrt(square) + np.float32(1e-6))


def train(model: Model, p: Parameters, segments: list[np.ndarray], window: int, rows: int, adam: Adam) -> None:
    """Truncated backpropagation over segments, each from its first word to its last.

    The state is carried from window to window, its gradient is not.
    """
    order, room = np.random.default_rng(11).permutation(len(segments)), Room()
    for at in range(0, len(order), rows):
        some = [segments[i] for i in order[at : at + rows]]
        longest = max(map(len, some))
        words = np.full((longest, len(some)), model.start, dtype=np.int64)
        for column, segment in enumerate(some):
            words[: len(segment), column] = segment
        there = np.arange(1, longest)[:, None] < np.array([len(s) for s in some])[None, :]
        targets = np.where(there, words[1:], 0)
        h = np.zeros((len(some), model.state), dtype=np.float32)
        for t in range(0, longest - 1, window):
            cut = slice(t, min(t + window, longest - 1))
            g, h, _ = model.gradients(p, words[:-1][cut], targets[cut], there[cut], h, room)
            adam(p, g)


def score(model: Model, p: Parameters, texts: list[np.ndarray], window: int = 32, rows: int = 512) -> np.ndarray:
    """Natural log-likelihood of every text (numbers of its words); the state is carried through the whole text."""
    total = np.zeros(len(texts))
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    into, room = model.gates(p), Room()
    for at in range(0, len(order), rows):
        some = order[at : at + rows]
        sizes = np.array([len(texts[i]) for i in some])
        begin = np.cumsum(sizes) - sizes
        words = np.concatenate([texts[i] for i in some]) if len(some) else np.zeros(0, dtype=np.int64)
        h = np.zeros((len(some), model.state), dtype=np.float32)
        inputs = np.full(len(some), model.start)
        for t in range(0, int(sizes[0]), window):
            states, targets, who = [], [], []
            for u in range(t, min(t + window, int(sizes[0]))):
                # Texts are sorted by length: those that still go on come first.
                n = int(np.searchsorted(-sizes, -u, "left"))
                h = model.step(p, into, inputs[:n], h[:n])[0]
                inputs = words[begin[:n] + u]
                states.append(h)
                targets.append(inputs)
                who.append(np.arange(n))
            logs = model.logs(p, np.concatenate(states), np.concatenate(targets), room)
            total[some] += np.bincount(np.concatenate(who), logs, minlength=len(some))
    return total
