"""Quality rules: a threshold table compiled into one projection, without user functions.

``RULES`` is data: a measure, its bounds, and from which length on the rule speaks. ``judge`` turns the table into plain
Spark columns over one row, so a document is judged where it is read: no shuffle, no Python, no state.

Nulls and edge cases: a null text has no words and fails. Empty and blank texts have no words and fail. Of other columns
only a ``lang`` is looked at, by the rules for stop words; repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.llm.common import computed, neighbours, table, words_of

WINDOW = 5
#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "a an and are as at be but by for from had has have he her his in is it its not of on or she that the their they "
    "this to was were which with you "
    "au aux avec ce ces dans de des du elle en est et il la le les leur mais ne ou par pas pour qu que qui se son sur un "
    "une "
    "als auch auf aus bei das dass dem den der des die ein eine einen er es für ich im ist mit nicht sich sie sind und "
    "von war werden wie wir zu "
    "al como con del el es está la las lo los más no para pero por que se su sus un una y"
).split()


#: Their languages. A text says its own in the column ``LANG``, if there is one; its script is looked at in any case.
LANG, LANGUAGES = "lang", ("en", "fr", "de", "es")


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie within [low, high]; the rule speaks from ``words`` words and ``lines`` lines on."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    words: int = 0
    lines: int = 0
    #: The rule speaks only of texts in a script and language that ``STOP_WORDS`` has words for.
    stops: bool = False


#: Bounds from published filters for web text; the rules that need a sample of the text speak only from 50 words on.
RULES = (
    Rule("words", "n_words", low=10),
    Rule("repeated_words", "repeat_ratio", high=0.2),
    Rule("mean_word_length", "mean_word_chars", low=3.0, high=10.0, words=50),
    Rule("symbols", "symbol_ratio", high=0.1),
    Rule("stop_words", "stop_ratio", low=0.02, words=50, stops=True),
    Rule("distinct_stop_words", "n_stop_words", low=2, words=50, stops=True),
    Rule("repeated_lines", "dup_line_ratio", high=0.34, lines=3),
    Rule("bullet_lines", "bullet_ratio", high=0.9, lines=3),
    Rule("ellipsis_lines", "ellipsis_ratio", high=0.3, lines=3),
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def measures(docs: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: the columns ``keep`` and every measure that a rule may name."""
    stop = sorted({form for word in STOP_WORDS for form in (word, word[:1].upper() + word[1:])})
    body = F.coalesce(F.col(text), F.lit(""))
    has_word = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    # Foreign: more letters of other scripts than Latin ones, or a language without stop words.
    other = F.length(F.regexp_replace(body, r"[\P{L}\p{IsLatin}]+", "")) > F.length(F.regexp_replace(body, r"[^\p{IsLatin}]+", ""))
    foreign = F.when(body.rlike(r"[\p{L}&&[^\p{IsLatin}]]"), other).otherwise(F.lit(False))
    if LANG in docs.columns and docs.schema[LANG].dataType.simpleString() == "string":
        named = F.lower(F.regexp_extract(F.col(LANG), r"^\s*([A-Za-z]{2,3})(?![A-Za-z])", 1))
        foreign = foreign | F.coalesce((named != "") & ~named.isin(*LANGUAGES), F.lit(False))
    read = docs.select(*keep, foreign.alias("_foreign"), body.alias("_text"), words_of(F.col(text)).alias("_words"), has_word.alias("_lines"))

    def windows(pair: Callable[[Column, Column], Column], frame: DataFrame, first: Column) -> DataFrame:
        """Adds _w, one value for each 5-word window, from values of 1, then 2, then 4 words."""
        frame = frame.withColumn("_1", first).withColumn("_2", neighbours("_1", "_1", 1, pair))
        frame = frame.withColumn("_4", neighbours("_2", "_2", 2, pair))
        rest = F.slice("_1", F.lit(WINDOW), F.greatest(F.size("_1") - (WINDOW - 1), F.lit(0)))
        return frame.withColumn("_w", F.zip_with(F.slice("_4", F.lit(1), F.size(rest)), rest, pair)).drop("_1", "_2", "_4")

    # Equal windows have equal hashes: only a text with equal hashes has its windows written out, sorted and compared.
    hashed = windows(lambda a, b: F.xxhash64(a, b), read, F.transform("_words", lambda w: F.xxhash64(w)))
    doubtful = F.size(F.array_distinct("_w")) < F.size("_w")
    some = F.when(doubtful, F.col("_words")).otherwise(F.array().cast("array<string>"))
    written = windows(lambda a, b: F.concat_ws(" ", a, b), hashed.withColumn("_some", some).drop("_w"), F.col("_some"))
    placed = F.sort_array(F.transform("_w", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    sorted_ = written.withColumn("_sorted", placed).drop("_w", "_some")
    nothing = F.array().cast("array<int>")
    sorted_ = sorted_.withColumn(
        "_pairs",
        neighbours("_sorted", "_sorted", 1, lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])).otherwise(nothing)),
    )
    found = sorted_.withColumn("_at", F.sort_array(F.array_distinct(F.flatten("_pairs"))))
    gaps = F.zip_with("_at", F.slice("_at", F.lit(2), F.size("_at")), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    stops = F.filter("_words", lambda w: w.isin(stop))
    counted = found.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate(gaps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        stops.alias("_stops"),
        "_foreign",
        F.size(F.filter("_lines", lambda x: x.rlike(r"^\s*[-*•‣▪●]"))).alias("_bullets"),
        F.size(F.filter("_lines", lambda x: x.rlike(r"(\.\.\.|…)\s*$"))).alias("_ellipses"),
    )
    words, lines = F.col("n_words"), F.col("n_lines")
    return counted.select(
        *keep,
        *("n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines".split()),
        F.size(F.array_distinct("_stops")).cast("long").alias("n_stop_words"),
        _ratio(F.col("word_chars"), words).alias("mean_word_chars"),
        _ratio(F.col("n_symbols"), words).alias("symbol_ratio"),
        _ratio(F.size("_stops"), words).alias("stop_ratio"),
        _ratio(F.col("n_repeat_words"), words).alias("repeat_ratio"),
        _ratio(F.col("n_dup_lines"), lines).alias("dup_line_ratio"),
        _ratio(F.col("_bullets"), lines).alias("bullet_ratio"),
        _ratio(F.col("_ellipses"), lines).alias("ellipsis_ratio"),
        F.col("_foreign").alias("foreign"),
    )


def failures(rules: Sequence[Rule] = RULES) -> Column:
    """The threshold table as one column: the names of the rules that a row of measures breaks."""
    broken = []
    for rule in rules:
        value, bad = F.col(rule.measure), F.lit(False)
        if rule.low is not None:
            bad = bad | (value < rule.low)
        if rule.high is not None:
            bad = bad | (value > rule.high)
        speaks = (F.col("n_words") >= rule.words) & (F.col("n_lines") >= rule.lines)
        if rule.stops:
            speaks = speaks & ~F.col("foreign")
        broken.append(F.when(speaks & bad, F.lit(rule.name)))
    return F.array_compact(F.array(*broken))


def judge(docs: DataFrame, text: str = "text", keep: Sequence[str] = (), rules: Sequence[Rule] = RULES) -> DataFrame:
    """Measures, the rules each row breaks, and ``kept``: it breaks none."""
    judged = computed(measures(docs, text, keep).withColumn("broken_rules", failures(rules)))
    return judged.withColumn("kept", F.size("broken_rules") == 0)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), keep=("doc_id",))
    words, repeated = F.col("n_words"), F.col("n_repeat_words")
    failed = (words < 10) | (100 * repeated > 20 * words)
    base = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words".split()
    return judged.select(*base, failed.alias("base_failed"), (F.col("kept") & ~failed).alias("kept"))


def reject(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that break no rule."""
    # The language goes along: its rule speaks here as it does in the query.
    said = [F.col(LANG)] if LANG in docs.columns else []
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text"), *said)
    return judge(inner, keep=("doc",)).where("kept").select("doc.*")
