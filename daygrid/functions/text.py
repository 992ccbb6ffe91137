"""Reading typed values out of delivered text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from daygrid import fixed_values as fixed

# A plain decimal or exponent number, or an infinity. Java forms such as "1.5d" or "0x1p3", which CAST accepts, do not
# match as a whole.
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"

# One CSV field of a line that was given a leading comma: a quoted field or a run of non-commas.
_QUOTED_OR_PLAIN_FIELD = r',[ ]*("[^"]*(?:""[^"]*)*"|[^,]*)'


def sql_quoted(text: str) -> str:
    """A Spark SQL string literal."""
    for special in ("\\", "'"):
        text = text.replace(special, "\\" + special)
    return f"'{text}'"


def sql_list(texts: Iterable[str]) -> str:
    return ", ".join(sql_quoted(text) for text in texts)


def text_array(texts: Iterable[str]) -> Column:
    return F.expr(f"array({sql_list(texts)})")


def lenient_double(text: Column) -> Column:
    """A double, or NULL where the text is not a number. Never fails, never drops the row.

    The text is named once: a filter on the result is pushed below the projection and repeats what it is made of.
    """
    return F.regexp_extract(text, NUMBER_PATTERN, 0).try_cast("double")


def number_or_nan(text: Column) -> Column:
    """Like ``lenient_double``, with NaN as a value of its own.

    Nearly all delivered values hold nothing but digits, signs, points and exponents. A cast reads those just as the pattern
    does, as it is only other characters (type suffixes, ``x``, spaces) on which the two differ.
    """
    careful = F.coalesce(lenient_double(text), F.when(text.rlike(r"^\s*[+-]?(?i:nan)\s*$"), F.lit(float("nan"))))
    return F.when(text.rlike(r"[^0-9+\-.eE]"), careful).otherwise(text.try_cast("double"))


def missing_to_null(text: str, tokens: Iterable[str] = fixed.NA_TOKENS) -> str:
    """SQL for: NULL where the field holds one of the words that mean "missing"; any other text as it is."""
    return f"CASE WHEN {text} NOT IN ({sql_list(tokens)}) THEN {text} END"


def csv_fields(line: Column) -> Column:
    """The fields of one CSV line as an array of any width.

    Leading spaces of a field are skipped and trailing ones kept; a quoted field may hold commas, and ``""`` inside it
    is one quote. Lines without a quote take the cheap split.
    """
    plain = F.split(F.ltrim(F.regexp_replace(line, ", +", ",")), ",", -1)
    quoted = F.transform(
        F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_QUOTED_OR_PLAIN_FIELD), F.lit(1)),
        lambda field: F.when(
            field.startswith('"'),
            F.regexp_replace(F.regexp_replace(field, r'^"|"$', ""), '""', '"'),
        ).otherwise(field),
    )
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(plain)


def has_open_quote(line: Column) -> Column:
    """True when the quotes of a line do not pair up, so the line is only a piece of a record."""
    return F.pmod(F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit(""))), F.lit(2)) == 1
