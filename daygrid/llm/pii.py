"""Personal data replaced by surrogates.

1. Mentions of persons, e-mail addresses, phone numbers, IP addresses, payment cards, social security numbers and IBANs are found
   in the whole text. Spellings of one entity share one canonical form (lower case, digits without separators).
2. Every distinct entity gets a core, drawn with a keyed hash from values of its type: names of the same gender and script made of
   syllables, reserved address ranges, numbers with valid check digits where the original's are valid. Cores that two
   entities share, or that are themselves an entity of the corpus, are drawn again until no two are equal, so different
   entities stay different and one entity is the same everywhere.
3. Each mention is written with its entity's core in the mention's own format: separators, grouping and upper or lower case
   stay. Given names and surnames are entities of their own, so "Dr. Anna Berg" and "Frau Berg" keep their common part.

Entities, not mentions, go through the collision rounds, and only (document, entity) pairs are joined: the
texts stay where they are if the pairs may be broadcast (``BROADCAST_ROWS``), else they are shuffled once.

Nulls and edge cases: a null text stays null and an empty one empty, with no entities. Repeated rows get equal texts, whatever their
id. The result depends on the key alone, not on partitions. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.llm.common import beside, small_enough, staged, table

#: The key of the registered query; a real run passes its own and keeps it secret.
KEY = b"surrogates"
ROUNDS = 60

# Titles and frequent given names, by gender and script.
TITLES = {
    "m": "Mr Herr Monsieur Sr Señor Signor Господин",
    "f": "Mrs Ms Miss Frau Mme Madame Mlle Sra Señora Srta Signora Госпожа",
    "n": "Dr Prof Professor",
}
GIVEN = {
    ("m", "latin"): "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Peter Paul Hans "
    "Klaus Jürgen Wolfgang Pierre Jean Jacques François Carlos José Luis Juan Miguel Antonio Javier Pablo",
    ("f", "latin"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Emma Laura Anna Maria Ursula "
    "Monika Petra Sabine Marie Sophie Camille Chloé Isabelle Carmen Lucía Sofía Elena Pilar Teresa",
    ("m", "cyrillic"): "Иван Пётр Алексей Сергей Дмитрий Андрей Николай Михаил Владимир Александр",
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Екатерина Светлана Юлия",
}
_ONSETS = {"latin": "b d f g h j k l m n p r s t v br dr kl tr st".split(), "cyrillic": "б в г д ж з к л м н п р с т ф х бр др кр ст".split()}
_VOWELS = {"latin": "a e i o u".split(), "cyrillic": "а е и о у".split()}
_ENDS = {
    ("m", "latin"): "n r s l d k t rt".split(),
    ("f", "latin"): "a ia ina ella".split(),
    ("n", "latin"): "n l s k er en".split(),
    ("s", "latin"): "mann berg ston feld rez son ard ley".split(),
    ("m", "cyrillic"): "н р с л м".split(),
    ("f", "cyrillic"): "а ия ина".split(),
    ("n", "cyrillic"): "н р л".split(),
    ("s", "cyrillic"): "ов ин ев енко ский".split(),
}
_NAMES = {name: (gender, script) for (gender, script), names in GIVEN.items() for name in names.split()}
_TITLE = {title: gender for gender, titles in TITLES.items() for title in titles.split()}
_UPPER, _LOWER = "A-ZÀ-ÖØ-ÞА-ЯЁ", "a-zß-öø-ÿа-яё"
_WORD = rf"[{_UPPER}](?:[{_LOWER}]+|[{_UPPER}]+)(?:[-’'][{_UPPER}][{_LOWER}]+)?"
_OPENING = "([\"'“«"
_ALONE = rf"(?<![^\s{re.escape(_OPENING)}])"
_PERSON = re.compile(rf"{_ALONE}({'|'.join(sorted(_TITLE, key=len, reverse=True))})\.?\s({_WORD})(?:\x20({_WORD}))?(?!\w)")
_GIVEN = re.compile(rf"{_ALONE}({'|'.join(sorted(_NAMES, key=len, reverse=True))})\x20({_WORD})(?!\w)")
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_NUMBERS = re.compile(
    rf"(?P<email>{_EMAIL})"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b)"
    rf"|(?P<ip>(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\d]|\.\d))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[\x20.-]?)?\(\d{2,4}\)[\x20.-]?\d{3,4}[\x20.-]?\d{3,4}(?!\d)"
    r"|(?<![\w+])\+\d{1,3}(?:[\x20.-]?\d{2,4}){2,5}(?!\d)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-]))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w.])[3-6]\d{3}(?:([\x20-]?)\d{4}(?:\7\d{4}){1,2}\7?\d{0,4}|\d{9,15})(?!\w))".replace(r"\7", r"(?:[\x20-]?)")
)
# Tokens, between white space, that a text must hold for the slower expressions to match.
_TITLE_TOKENS = frozenset(o + t + end for o in ("", *_OPENING) for t in _TITLE for end in ("", "."))
_GIVEN_TOKENS = frozenset(o + n for o in ("", *_OPENING) for n in _NAMES)
_HAS_NUMBER = re.compile(r"[0-9@]")


def _script(word: str) -> str:
    return "cyrillic" if re.match("[А-Яа-яЁё]", word) else "latin"


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(begin, end, kind, canonical form) of every entity, in order and without overlaps."""
    found = []
    if _HAS_NUMBER.search(text):
        for match in _NUMBERS.finditer(text):
            kind, value = match.lastgroup, match.group()
            if kind is None:
                kind = next(k for k, v in match.groupdict().items() if v)
            canonical = value.lower() if kind == "email" else re.sub(r"[^0-9A-Za-z.+]" if kind in ("ip", "phone") else r"[\x20-]", "", value)
            if kind == "card" and _luhn(canonical):
                continue  # a number, but no card's
            found.append((match.start(), match.end(), kind, canonical.replace(".", "") if kind == "phone" else canonical))

    def name(match: re.Match, group: int, kind: str) -> None:
        word = match.group(group)
        if word:
            found.append((match.start(group), match.end(group), f"{kind}-{_script(word)}", word.lower()))

    tokens = set(text.split())
    if not tokens.isdisjoint(_TITLE_TOKENS):
        for match in _PERSON.finditer(text):
            if match.group(3):
                gender = _TITLE[match.group(1)]
                name(match, 2, _NAMES[match.group(2)][0] if gender == "n" and match.group(2) in _NAMES else gender)
                name(match, 3, "s")
            else:
                name(match, 2, "s")
    if not tokens.isdisjoint(_GIVEN_TOKENS):
        for match in _GIVEN.finditer(text):
            name(match, 1, _NAMES[match.group(1)][0])
            name(match, 2, "s")
    found.sort(key=lambda f: (f[0], -f[1]))
    out = []
    for entity in found:
        if not out or entity[0] >= out[-1][1]:
            out.append(entity)
    return out


class _Draw:
    """Numbers from a keyed hash of (kind, canonical form, turn)."""

    def __init__(self, key: bytes, *parts: object):
        self.key, self.seed, self.block, self.left = key, "\x00".join(map(str, parts)).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hmac.new(self.key, self.seed + b"\x00" + str(self.block).encode(), hashlib.sha256).digest()
            self.block += 1
        number, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return number % n

    def one(self, values):
        return values[self.below(len(values))]

    def like(self, text: str) -> str:
        """Digits for digits, letters for letters of the same case, all else as it is."""
        out = []
        for c in text:
            if c.isdigit():
                out.append(str(self.below(10)))
            elif "a" <= c <= "z":
                out.append(chr(97 + self.below(26)))
            elif "A" <= c <= "Z":
                out.append(chr(65 + self.below(26)))
            else:
                out.append(c)
        return "".join(out)


def _luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def core(key: bytes, kind: str, canonical: str, turn: int = 0) -> str:
    """The entity's surrogate, in canonical form."""
    draw = _Draw(key, kind, canonical, turn)
    if kind == "email":
        local, _, domain = canonical.partition("@")
        # The domain is an entity of its own: addresses that share one keep that.
        labels = domain.split(".")
        host = _Draw(key, "domain", domain, 0)
        return f"{draw.like(local)}@{'.'.join(host.like(x) for x in labels[:-1])}.example"
    if kind == "ip":
        return f"{240 + draw.below(15)}.{draw.below(256)}.{draw.below(256)}.{draw.below(256)}"
    if kind == "phone":
        # The country code stays; a lone first digit of a number without one is not zero.
        digits = canonical.lstrip("+")
        kept = max(len(digits) - 10, 0) if canonical.startswith("+") else 0
        rest = str(2 + draw.below(8)) + draw.like(digits[kept + 1 :])
        return "+" * canonical.startswith("+") + digits[:kept] + rest
    if kind == "card":
        drawn = canonical[0] + draw.like(canonical[1:])
        return next(drawn[:-1] + str(d) for d in range(10) if _luhn(drawn[:-1] + str(d)) == 0)
    if kind == "ssn":
        return "9" + draw.like(canonical[1:])
    if kind == "iban":
        drawn = canonical[:2] + "00" + draw.like(canonical[4:])
        return drawn[:2] + (f"{98 - _mod97(drawn):02d}" if _mod97(canonical) == 1 else draw.like(canonical[2:4])) + drawn[4:]
    gender, script = kind.split("-")
    syllables = 2 + (turn > 8) + (turn > 24)
    stem = "".join(draw.one(_ONSETS[script]) + draw.one(_VOWELS[script]) for _ in range(syllables))
    return stem + draw.one(_ENDS[gender, script])


def dress(kind: str, mention: str, surrogate: str) -> str:
    """The surrogate in the mention's format."""
    if kind in ("phone", "card", "ssn", "iban"):
        left = iter(surrogate)
        return "".join(next(left, "") if c.isalnum() or c == "+" else c for c in mention)
    if kind == "ip":
        return surrogate
    if kind == "email":
        return surrogate.upper() if mention.isupper() else surrogate
    if mention.isupper() and len(mention) > 1:
        return surrogate.upper()
    return surrogate[:1].upper() + surrogate[1:]


def surrogates(entities: DataFrame, key: bytes = KEY, draw: Callable[[bytes, str, str, int], str] = core) -> DataFrame:
    """Adds core to the distinct ``entities`` (kind, canonical): no two of a kind are equal, and none is an entity."""

    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["core"] = [draw(key, k, c, t) for k, c, t in zip(batch["kind"], batch["canonical"], batch["turn"])]
            yield batch

    schema = "kind string, canonical string, turn int, core string"
    entities = staged(entities.select("kind", "canonical").distinct(), "entities")
    real = entities.select("kind", F.col("canonical").alias("core"), F.lit(True).alias("taken"))
    named = staged(entities.withColumn("turn", F.lit(0)).mapInPandas(drawn, schema), "cores")
    for _ in range(ROUNDS):
        # Of the entities that share a core the first by turn and form keeps it: one that had it before is not moved.
        first = named.groupBy("kind", "core").agg(F.min(F.struct("turn", "canonical")).alias("first"), F.count("*").alias("n"))
        first = first.join(real, ["kind", "core"], "left").where("n > 1 OR taken")
        clash = named.join(first, ["kind", "core"], "left")
        again = (F.col("taken").isNotNull()) | (F.col("n").isNotNull() & (F.col("first.canonical") != F.col("canonical")))
        clash = staged(clash.select("kind", "canonical", "turn", "core", F.coalesce(again, F.lit(False)).alias("again")), "clashes")
        if not clash.where("again").limit(1).count():
            return named.select("kind", "canonical", "core")
        moved = clash.where("again").select("kind", "canonical", (F.col("turn") + 1).alias("turn")).mapInPandas(drawn, schema)
        named = staged(clash.where("NOT again").select("kind", "canonical", "turn", "core").unionAll(moved), "cores")
    raise RuntimeError(f"surrogates still collide after {ROUNDS} rounds")


def replace(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = (), key: bytes = KEY) -> DataFrame:
    """The columns ``keep``, the text with surrogates, and entities: kind and place (begin, end) in the old text."""
    rows = docs.select(*[F.col(c) for c in keep], F.col(text).alias("_text"), F.xxhash64(F.col(text)).alias("_key"))

    def mentions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = {(k, kind, form) for k, t in zip(batch["_key"], batch["_text"]) if t for _, _, kind, form in find(t)}
            if out:
                yield pd.DataFrame(sorted(out), columns=["_key", "kind", "canonical"])

    found = rows.select("_key", "_text").mapInPandas(mentions, "_key long, kind string, canonical string")
    found = staged(found.distinct(), "mentions")
    named = staged(found.join(surrogates(found, key), ["kind", "canonical"]), "named")
    by_text = named.groupBy("_key").agg(F.collect_list(F.struct("kind", "canonical", "core")).alias("_named"))
    # Broadcast by the number of pairs, which bounds the bytes.
    few = small_enough(named) is not named
    joined = rows.join(F.broadcast(by_text) if few else by_text, "_key", "left").drop("_key")

    def write(batch: pd.DataFrame) -> pd.DataFrame:
        texts, places = [], []
        for text, pairs in zip(batch["_text"], batch["_named"]):
            if not text or pairs is None or not len(pairs):
                texts.append(text)
                places.append([])
                continue
            names = {(p["kind"], p["canonical"]): p["core"] for p in pairs}
            out, at, spans = [], 0, find(text)
            for begin, end, kind, form in spans:
                out += [text[at:begin], dress(kind, text[begin:end], names[kind, form])]
                at = end
            texts.append("".join([*out, text[at:]]))
            places.append([f"{kind}:{begin}:{end}" for begin, end, kind, _ in spans])
        return pd.DataFrame({"text": texts, "entities": places})

    return beside(joined, keep, write, "text string, entities array<string>")


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = replace(table(spark, sf_dir, "documents"), keep=("doc_id",))
    return found.select("doc_id", F.size("entities").cast("long").alias("n_entities"), F.array_join("entities", ",").alias("entities"), "text")
