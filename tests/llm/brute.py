"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import xxhash


def words(text):
    return (text or "").encode().lower().split()


def fingerprint(text):
    w = words(text)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(prints):
    """Smallest id for each fingerprint's component."""
    distinct = sorted(set(p for _, p in prints))
    parent = {p: p for p in distinct}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    least = {}
    for doc, p in prints:
        if doc is not None:
            least[root(p)] = min(least.get(root(p), doc), doc)
    return {p: least.get(root(p)) for p in distinct}


def hits(text, items):
    split = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    windows = defaultdict(set)
    for item, body in items:
        w = split((body or "").encode().lower())
        size = min(13, len(w))
        for k in range(len(w) - size + 1) if w else ():
            windows[tuple(w[k : k + size])].add(item)
    w, hit, found = split((text or "").encode().lower()), set(), set()
    for size in {len(x) for x in windows}:
        for k in range(len(w) - size + 1):
            if tuple(w[k : k + size]) in windows:
                hit.update(range(k, k + size))
                found |= {str(i) for i in windows[tuple(w[k : k + size])] if i is not None}
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)


def secrets(text):
    text, spans = text or "", []
    rules = (
        (r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6, re.I | re.A),
        (r"AKIA[A-Z0-9]+", 0, 20, 0),
        (r"[0-9a-f]+", 0, 24, 0),
    )
    for kind, (pattern, group, least, flags) in enumerate(rules):
        spans += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text, flags) if len(m.group(group)) >= least]
    names = ("assign", "access", "hex")
    return [f"{names[kind]}:{a}:{b}" for a, kind, b in sorted(spans)]


def without_repeats(docs, length):
    """(bytes, removed, runs, digest) for each (id, text), ids unique; a null id comes last."""
    seen, out = set(), {}
    for doc, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            window = data[k : k + length]
            if window in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(window)
        kept = bytes(x for x, y in zip(data, gone) if not y)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        out[doc] = len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest()
    return out


def base_scores(docs):
    split = {i: [*words(t), b"\n"] for i, t in enumerate(t for _, t in docs)}
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in docs]
    counts = Counter(w for i, ws in split.items() if not held[i] for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    base = [sum(log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws) for ws in split.values()]
    return held, [len(ws) for ws in split.values()], [sum(counts[w] > 0 for w in ws) for ws in split.values()], total, base
