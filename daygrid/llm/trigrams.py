"""Which trigrams a text must hold for a regular expression to match it.

``query(pattern)`` gives alternatives, each a set of trigrams: a text that matches holds every trigram of at least one of
them. ``None`` means that nothing is mandatory. Letters are taken in lower case, so the index is built on lower-cased
text; for patterns that mind the case this only lets more candidates through to the exact check.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as op
from re import _parser

Query = frozenset[frozenset[str]] | None
#: Larger sets of strings are given up: the part then counts as any text.
MOST_STRINGS = 16
_NOTHING = frozenset({""})


@dataclass(frozen=True)
class Part:
    """What is known of the texts that a part of a pattern matches.

    ``exact``: all of them, if they are few. Else ``first`` and ``last`` hold what they can begin and end with ("" for
    anything), and ``query`` what they must hold.
    """

    exact: frozenset[str] | None = None
    first: frozenset[str] = _NOTHING
    last: frozenset[str] = _NOTHING
    query: Query = None


_ANY = Part()


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    joined = _least({x | y for x in a for y in b})
    return joined if len(joined) <= MOST_STRINGS else max(a, b, key=lambda q: min(map(len, q)))


def _least(sets) -> frozenset[frozenset[str]]:
    """Without the alternatives that another alternative already covers."""
    sets = set(sets)
    return frozenset(s for s in sets if not any(t < s for t in sets))


def _of_strings(strings: frozenset[str]) -> Query:
    if any(len(s) < 3 for s in strings):
        return None
    return _least(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _loose(part: Part) -> Part:
    """The same part without its exact strings."""
    return part if part.exact is None else Part(None, part.exact, part.exact, _of_strings(part.exact))


def _then(a: Part, b: Part) -> Part:
    if a.exact is not None and b.exact is not None:
        both = frozenset(x + y for x in a.exact for y in b.exact)
        if len(both) <= MOST_STRINGS:
            return Part(both)
    seam = frozenset(x + y for x in _loose(a).last for y in _loose(b).first)
    across = _of_strings(seam) if len(seam) <= MOST_STRINGS else None
    query = _both(_both(_loose(a).query, _loose(b).query), across)
    first = _loose(a).first if a.exact is None else frozenset(x + y for x in a.exact for y in _loose(b).first)
    last = _loose(b).last if b.exact is None else frozenset(x + y for x in _loose(a).last for y in b.exact)
    return Part(None, first if len(first) <= MOST_STRINGS else _NOTHING, last if len(last) <= MOST_STRINGS else _NOTHING, query)


def _or(parts: list[Part]) -> Part:
    if all(p.exact is not None for p in parts):
        strings = frozenset().union(*(p.exact for p in parts))
        if len(strings) <= MOST_STRINGS:
            return Part(strings)
    loose = [_loose(p) for p in parts]
    queries = [p.query for p in loose]
    query = None if any(q is None for q in queries) else _least(frozenset().union(*queries))
    first, last = (frozenset().union(*(getattr(p, side) for p in loose)) for side in ("first", "last"))
    return Part(None, first if len(first) <= MOST_STRINGS else _NOTHING, last if len(last) <= MOST_STRINGS else _NOTHING, query)


def _part(items) -> Part:
    whole = Part(_NOTHING)
    for kind, value in items:
        if kind is op.LITERAL:
            part = Part(frozenset({chr(value).lower()}))
        elif kind is op.IN:
            chars = [chr(v) for k, v in value if k is op.LITERAL]
            few = len(chars) == len(value) and len(chars) <= MOST_STRINGS // 2
            part = Part(frozenset(c.lower() for c in chars)) if few else _ANY
        elif kind is op.SUBPATTERN:
            part = _part(value[-1])
        elif kind is op.BRANCH:
            part = _or([_part(branch) for branch in value[1]])
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            least, most, inner = value
            inner = _part(inner)
            if least == 0:
                part = _or([inner, Part(_NOTHING)]) if most == 1 else _ANY
            else:
                part = inner
                for _ in range(min(least, 3) - 1):
                    part = _then(part, inner)
                part = part if least == most <= 3 else _loose(part)
        elif kind is op.AT:
            continue
        else:
            part = _ANY
        whole = _then(whole, part)
    return whole


def query(pattern: str) -> Query:
    return _loose(_part(_parser.parse(pattern))).query
