"""SQL, for DuckDB, of the queries that SQL can express.

The others are tested against brute force (``tests/llm``): SimHash needs XXH64, the suffix arrays, passages, surrogates, extraction,
mixing, tokenizers and the networks have no SQL form.
"""

from __future__ import annotations

from collections.abc import Sequence

from daygrid.llm import quality, secrets
from daygrid.llm.common import UPPER


def _listed(words: Sequence[str]) -> str:
    return ", ".join("'" + word.replace("'", "''") + "'" for word in words)


_STOPS = _listed(sorted({form for word in quality.STOP_WORDS for form in (word, word[:1].upper() + word[1:])}))
_DOCS = "SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents"


def _broken(rule: quality.Rule) -> str:
    bounds = [f"{rule.measure} {sign} {bound}" for sign, bound in (("<", rule.low), (">", rule.high)) if bound is not None]
    speaks = f"n_words >= {rule.words} AND n_lines >= {rule.lines}" + (" AND NOT other_language" if rule.stops else "")
    return f"({speaks} AND ({' OR '.join(bounds)}))"


_QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
    lower(regexp_extract(coalesce(lang, ''), '^\\s*([A-Za-z]{{2,3}})([^A-Za-z]|$)', 1)) AS said FROM documents),
s AS (SELECT *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM s)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM g) WHERE c > 1),
n AS (SELECT rid, sum(least(5, coalesce(later - i, 5)))::BIGINT AS n_repeat_words
    FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS later FROM r) GROUP BY rid),
m AS (SELECT doc_id, length(regexp_replace(t, '[\\P{{L}}\\p{{Latin}}]+', '', 'g')) > length(regexp_replace(t, '[^\\p{{Latin}}]+', '', 'g'))
        OR (said <> '' AND said NOT IN ({_listed(quality.LANGUAGES)})) AS other_language,
    len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(ls) AS n_lines,
    list_filter(ws, lambda x: x IN ({_STOPS})) AS stops,
    len(list_filter(ls, lambda x: regexp_matches(x, '^\\s*[-*•‣▪●]'))) AS bullets,
    len(list_filter(ls, lambda x: regexp_matches(x, '(\\.\\.\\.|…)\\s*$'))) AS ellipses
    FROM s LEFT JOIN n USING (rid)),
f AS (SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
    CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_ratio,
    CASE WHEN n_words > 0 THEN len(stops) / n_words ELSE 0 END AS stop_ratio, len(list_distinct(stops)) AS n_stop_words,
    CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeat_ratio,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
    CASE WHEN n_lines > 0 THEN bullets / n_lines ELSE 0 END AS bullet_ratio,
    CASE WHEN n_lines > 0 THEN ellipses / n_lines ELSE 0 END AS ellipsis_ratio FROM m),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR {" OR ".join(_broken(rule) for rule in quality.RULES)}) AS kept FROM b
"""


def _spans(place: int, rule: secrets.Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""SELECT rid, {place} AS kind, k, list_sum(list_transform(ps[1:k], lambda x: length(x)))
        + coalesce(list_sum(list_transform(ms[1:k - 1], lambda x: length(x))), 0) AS b, length(ms[k]) AS n, length(gs[k]) AS g, {rule.least} AS least
    FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS k FROM (SELECT rid, regexp_extract_all(t, '{pattern}') AS ms,
        regexp_extract_all(t, '{pattern}', {rule.group}) AS gs, string_split_regex(t, '{pattern}') AS ps FROM d))"""


_KINDS = _listed([rule.kind for rule in secrets.RULES])
_SECRETS = f"""
WITH d AS ({_DOCS}),
a AS ({" UNION ALL ".join(_spans(place, rule) for place, rule in enumerate(secrets.RULES))}),
s AS (SELECT rid, kind, b, ([{_KINDS}])[kind + 1] || ':' || b::BIGINT || ':' || (b + n)::BIGINT AS span FROM a WHERE g >= least),
j AS (SELECT rid, {", ".join(f"count(*) FILTER (kind = {place}) AS n_{rule.kind}" for place, rule in enumerate(secrets.BASE))},
    string_agg(span, ',' ORDER BY b, kind) FILTER (kind < {len(secrets.BASE)}) AS base, string_agg(span, ',' ORDER BY b, kind) AS spans FROM s GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{rule.kind}, 0) AS n_{rule.kind}" for rule in secrets.BASE)},
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN j USING (rid)
"""

_WORDS = f"list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
_DECONTAMINATION = f"""
WITH i AS (SELECT item_id, ws, least(len(ws), 13) AS w FROM (SELECT item_id, {_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0),
iw AS (SELECT DISTINCT item_id::VARCHAR AS item_id, w, array_to_string(ws[p:p + w - 1], ' ') AS g
    FROM (SELECT *, unnest(range(1, len(ws) - w + 2)) AS p FROM i)),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
dw AS (SELECT rid, p, w, array_to_string(ws[p:p + w - 1], ' ') AS g
    FROM (SELECT rid, ws, w, unnest(range(1, len(ws) - w + 2)) AS p FROM d, (SELECT DISTINCT w FROM iw))),
o AS (SELECT rid, p, dw.w, item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.w = iw.w),
h AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(p, p + w)) AS pos FROM o) GROUP BY rid),
n AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT rid, item_id FROM o) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN n USING (rid)
"""



def _lloyd(dims: int, clusters: int, rounds: int) -> str:
    def nearest(turn: int) -> str:
        return f"""d{turn} AS MATERIALIZED (SELECT r, k, sum((f.x - c.x) * (f.x - c.x)) AS d FROM f JOIN c{turn} c USING (i) GROUP BY r, k),
a{turn} AS MATERIALIZED (SELECT r, k, d FROM d{turn} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)"""

    def update(turn: int) -> str:
        return f"""c{turn} AS MATERIALIZED (SELECT k, i, coalesce((s - ((s % n) + n) % n) // n, x)::BIGINT AS x FROM c{turn - 1}
    LEFT JOIN (SELECT k, i, sum(x) AS s, count(*) AS n FROM f JOIN a{turn - 1} USING (r) GROUP BY k, i) USING (k, i))"""

    steps = [nearest(0)] + [text for turn in range(1, rounds + 1) for text in (update(turn), nearest(turn))]
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding AS e FROM embeddings
    WHERE len(embedding) = {dims} AND len([x for x in embedding if coalesce(isfinite(x), false)]) = {dims}),
f AS MATERIALIZED (SELECT r, i, floor(64 * e[i]::DOUBLE)::BIGINT AS x FROM v, range(1, {dims + 1}) t(i)),
first AS (SELECT r, row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), e) - 1 AS k FROM v QUALIFY k < {clusters}),
c0 AS MATERIALIZED (SELECT k, i, x FROM first JOIN f USING (r)),
{", ".join(steps)},
g AS (SELECT k, sum(d) AS own FROM a{rounds} GROUP BY k),
h AS (SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY k)
SELECT vec_id, k::INTEGER AS cluster, d::BIGINT AS distance, own::BIGINT AS cluster_inertia,
    (SELECT sum(own) FROM g)::BIGINT AS inertia, centroid_sha256
FROM v JOIN a{rounds} USING (r) JOIN g USING (k) JOIN h USING (k)
"""


ORACLE = {
    "op6_quality_rules": _QUALITY,
    "op8_secret_scans": _SECRETS,
    "op10_benchmark_decontamination": _DECONTAMINATION,
    "op12_centroid_clustering": _lloyd(64, 16, 3),
}
