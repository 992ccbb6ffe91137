"""Ids come back as they were, whatever else is in a batch."""

from __future__ import annotations

import pytest

from daygrid.llm import html, lm, passages, pii, suffix
from tests.llm.test_operators import prose

LONGS = [2**60 + 1, -(2**60) - 1, 2**63 - 1, None, 0, 5, None]
STRINGS = ["b", "a", "", None, "10", "9", None]
TEXTS = [f"{prose(1, 60)} {prose(2, 20)}", prose(1, 60), "x a.b@example.org y", None, "", prose(3, 50), prose(1, 60)]


def frame(spark, ids, kind):
    rows = [(i, t, "u") for i, t in zip(ids, TEXTS)]
    return spark.createDataFrame(rows, f"id {kind}, text string, url string").coalesce(1)


@pytest.mark.parametrize("ids, kind", [(LONGS, "long"), (STRINGS, "string")])
def test_ids(spark, ids, kind):
    docs = frame(spark, ids, kind)

    def back(found):
        return sorted((r[0] for r in found.select("id").collect()), key=repr)

    given = sorted(ids, key=repr)
    assert back(html.extract(docs, html="text", keep=("id", "url"))) == given
    assert back(lm.score(docs, id="id", keep=("id",))) == given
    assert back(pii.replace(docs, keep=("id",))) == given
    cut = suffix.remove_repeats(docs, id="id", keep=("id",))
    assert back(cut) == given
    # Of the three equal passages the smallest id's stays whole; null comes last.
    gone = {r.id: r.n_removed for r in cut.collect() if r.id is not None}
    assert gone[ids[1]] == 0 and gone[ids[0]] == len(TEXTS[1])
    found = passages.shared_passages(docs, id="id").collect()
    assert {x for r in found for x in (r.id, r.source_id)} <= set(ids) and len(found) >= 2
    assert {ids[0], ids[1]} <= {x for r in found for x in (r.id, r.source_id)}
