"""Secret scans through a trigram inverted index, with DataFrame functions alone.

Each rule's regular expression is turned into a Boolean query of trigrams (``trigrams.query``). The index holds, for the
trigrams that some rule asks for, one posting per distinct text with the trigram; it is a written table. Postings are
intersected by counting, per text and alternative, the trigrams that are there. Texts that pass are verified by the
expression itself. A rule without mandatory trigrams (``hex``) is tried on every text.

Copies of a text share their postings, so a group of copies is one candidate. The candidates are broadcast if there are
at most ``BROADCAST_ROWS`` of them; beyond that the texts are shuffled to them by a hash of the text.

A match is found as a regular expression engine finds it: from the left, without overlaps, separately for each rule.
Positions are code points, the end exclusive.

Nulls and edge cases: a null text counts as empty and has no spans. Repeated rows and repeated or null ids are judged row by
row, since nothing depends on the id. Other columns are not looked at; an empty table gives an empty result. A text may
hold the control characters that mark matches here: they are replaced by another one before, and no rule speaks of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.llm.common import computed, sha256_of, small_enough, staged, table
from daygrid.llm.trigrams import query


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose group ``group`` has at least ``least`` characters. The group ends the pattern."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


BASE = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Formats that their issuers publish.
MORE = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"sk_live_[0-9A-Za-z]{20,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE + MORE
_MARK, _SPLIT, _OTHER = "\x01", "\x02", "\x03"
#: Values that ``running`` scans at a time.
BLOCK = 512
_SPANS = "array<struct<start:int,kind:int,end:int>>"


def postings(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(trigram, key) for every distinct text and every trigram that it holds and some rule asks for."""
    asked = sorted({t for rule in rules for alternative in query(rule.pattern) or () for t in alternative})
    low = texts.select("key", F.lower("text").alias("low"))
    held = F.filter(F.array(*[F.lit(t) for t in asked]), lambda t: F.contains(F.col("low"), t))
    return low.select("key", F.explode_outer(held).alias("trigram")).where("trigram IS NOT NULL").distinct()


def candidates(index: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(key, rules): the rules whose trigram query a text meets, by their place in ``rules``."""
    terms = [
        (place, number, len(alternative), trigram)
        for place, rule in enumerate(rules)
        for number, alternative in enumerate(sorted(map(sorted, query(rule.pattern) or ())))
        for trigram in alternative
    ]
    names = ("rule", "alternative", "need", "trigram")
    rows = [F.struct(*[F.lit(value).alias(name) for name, value in zip(names, term)]) for term in terms]
    asked = index.sparkSession.range(1).select(F.inline(F.array(*rows)))
    return (
        index.join(F.broadcast(asked), "trigram")  # as many rows as the rules have trigrams
        .groupBy("key", "rule", "alternative", "need")
        .count()
        .where("count = need")
        .groupBy("key")
        .agg(F.sort_array(F.collect_set("rule")).alias("rules"))
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For every value (a long) of an array what ``join`` makes, from 0, of the values before it.

    Growing an array one by one costs its square. Blocks of ``BLOCK`` values are scanned by themselves and then by their totals.
    """
    empty = F.array().cast("array<bigint>")

    def scanned(some: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out"))
        return F.aggregate(
            some, start, lambda s, v: F.struct(join(s["at"], v).alias("at"), F.array_append(s["out"], s["at"]).alias("out"))
        )

    def of(values: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(values) / BLOCK) - 1, F.lit(0)))
        blocks = F.transform(starts, lambda k: scanned(F.slice(values, (k * BLOCK + 1).cast("int"), F.lit(BLOCK))))
        return _let(blocks, whole)

    def whole(blocks: Column) -> Column:
        carried = scanned(F.transform(blocks, lambda b: b["at"]))["out"]
        return F.flatten(F.zip_with(blocks, carried, lambda b, c: F.transform(b["out"], lambda v: join(c, v))))

    return _let(values, of)


def _spans(rule: Rule, place: int) -> Column:
    """All kept matches of the rule in the column _text."""
    marked = F.regexp_replace("_text", rule.pattern, f"{_MARK}$0{_SPLIT}${rule.group}{_MARK}")
    # Every second part is a match, followed by its group.
    parts = F.transform(
        F.split(marked, _MARK),
        lambda part, i: F.struct(
            F.when(i % 2 == 1, F.length(F.substring_index(part, _SPLIT, 1))).otherwise(F.length(part)).cast("long").alias("n"),
            ((i % 2 == 1) & (F.length(F.substring_index(part, _SPLIT, -1)) >= rule.least)).alias("kept"),
        ),
    )

    def spans(parts: Column) -> Column:
        begins = running(F.transform(parts, lambda p: p["n"]), lambda a, b: a + b)
        placed = F.zip_with(
            parts,
            begins,
            lambda p, at: F.struct(p["kept"].alias("kept"), at.cast("int").alias("start"), F.lit(place).alias("kind"), (at + p["n"]).cast("int").alias("end")),
        )
        return F.transform(F.filter(placed, lambda s: s["kept"]), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))

    return _let(parts, spans)


def scan(docs: DataFrame, text: str = "text", keep: Sequence[str] = (), rules: Sequence[Rule] = RULES) -> DataFrame:
    """The columns ``keep`` and ``spans``: (start, kind, end) of every secret, ordered; kind is a place in ``rules``."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*[F.col(c) for c in keep], body.alias("_text"), F.xxhash64(body).alias("_key"))
    index = staged(postings(rows.select(F.col("_key").alias("key"), F.col("_text").alias("text")), rules), "trigrams")
    passed = staged(candidates(index, rules), "candidates").withColumnRenamed("key", "_key").withColumnRenamed("rules", "_rules")
    safe = F.when(F.col("_text").rlike(f"[{_MARK}{_SPLIT}]"), F.translate("_text", _MARK + _SPLIT, _OTHER * 2)).otherwise(F.col("_text"))
    joined = rows.join(small_enough(passed), "_key", "left").select(*keep, "_rules", safe.alias("_text"))
    none = F.array().cast(_SPANS)
    each = []
    for place, rule in enumerate(rules):
        tried = F.col("_text").rlike(rule.pattern)
        if query(rule.pattern) is not None:
            tried = F.array_contains("_rules", place) & tried
        each.append(F.when(tried, _spans(rule, place)).otherwise(none))
    return joined.select(*keep, F.sort_array(F.concat(*each)).alias("spans"))


def _named(spans: Column, rules: Sequence[Rule]) -> Column:
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    return F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"]))


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = computed(scan(table(spark, sf_dir, "documents"), keep=("doc_id",)))
    # Not by a lambda with a default argument: Spark would pass it the position.
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, place))).cast("long").alias(f"n_{rule.kind}") for place, rule in enumerate(BASE)
    ]
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return found.select(
        "doc_id",
        *counts,
        sha256_of(_named(base, RULES)).alias("base_sha256"),
        F.array_join(_named(F.col("spans"), RULES), ",").alias("spans"),
    )


def blank(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every secret is replaced by ``[secret]``; no document goes. ``n_chars`` follows the new text."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    found = computed(scan(docs.select(row, F.col("text")), keep=("doc",)))

    reach = running(F.transform("spans", lambda s: s["end"].cast("long")), F.greatest)
    found = computed(found.select("doc", "spans", reach.alias("_reach")))
    # Spans of different rules may overlap: one that begins within those before it only makes them longer.
    apart = F.filter(
        F.zip_with("spans", "_reach", lambda s, at: F.struct(s["start"].cast("long").alias("start"), at.alias("at"))),
        lambda s: (s["start"] > s["at"]) | (s["at"] == 0),
    )
    last = F.array_max(F.transform("spans", lambda s: s["end"].cast("long")))

    def cleaned(wide: Column) -> Column:
        """From four bytes for each code point: a piece is then found by its place, without counting from the beginning."""

        def text(begin: Column, end: Column) -> Column:
            return F.decode(F.substring(wide, (begin * 4 + 1).cast("int"), ((end - begin) * 4).cast("int")), "UTF-32")

        pieces = F.transform(apart, lambda s: F.concat(text(s["at"], s["start"]), F.lit("[secret]")))
        return F.concat(F.array_join(pieces, ""), text(last, F.length("doc.text").cast("long")))

    clean = F.when(F.size("spans") == 0, F.col("doc.text")).otherwise(_let(F.encode("doc.text", "UTF-32"), cleaned))
    out = computed(found.select("doc", clean.alias("_clean")))
    same = F.col("_clean").eqNullSafe(F.col("doc.text"))
    columns = {"text": F.col("_clean")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(same, F.col("doc.n_chars")).otherwise(F.length("_clean").cast("long"))
    return out.select(*[columns.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
