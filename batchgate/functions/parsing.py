"""Text to typed value, null where the text does not parse.

The grammars accepted are those of Python's ``float()`` and
``strptime('%Y-%m-%d')``: a partner file that passes there passes here.
Each parser tries the plain ASCII spelling first; the rarer spellings are
only looked at when that fails.
"""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

PLAIN_NUMBER = r"\A[+-]?[0-9]{1,18}(?:\.[0-9]{1,18})?\z"

_SPACES = r"\t-\r\x85\p{Z}"
_DIGITS = r"\p{Nd}(?:_?\p{Nd})*"
FINITE = (
    rf"\A[{_SPACES}]*[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})"
    rf"(?:[eE][+-]?{_DIGITS})?[{_SPACES}]*\z"
)
INFINITE = rf"(?i)\A[{_SPACES}]*[+]?inf(?:inity)?[{_SPACES}]*\z"
MINUS_INFINITE = rf"(?i)\A[{_SPACES}]*-inf(?:inity)?[{_SPACES}]*\z"
NOT_A_NUMBER = rf"(?i)\A[{_SPACES}]*[+-]?nan[{_SPACES}]*\z"

PLAIN_DATE = r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_MONTH_AND_DAY = r"(?:1[0-2]|0?[1-9])-(?:3[01]|[12]\p{Nd}|0?[1-9]| [1-9])"


@cache
def _decimal_digits() -> tuple[str, str]:
    digits = [
        chr(c)
        for c in range(0x80, 0x110000)
        if unicodedata.category(chr(c)) == "Nd"
    ]
    return "".join(digits), "".join(str(unicodedata.digit(d)) for d in digits)


def ascii_digits(text: Column) -> Column:
    """Decimal digits of any script as 0-9; other characters stay."""
    return F.translate(text, *_decimal_digits())


def is_blank(text: Column) -> Column:
    """Empty or absent. White space alone is not blank."""
    return F.coalesce(text, F.lit("")) == ""


def shown(text: Column) -> Column:
    """How an absent value appears inside a detail text."""
    return F.coalesce(text, F.lit("None"))


# One cast at the end of each parser: generated code stays within what the JVM
# is willing to compile, also where a filter repeats the expression.


def parse_number(text: Column) -> Column:
    bare = F.regexp_replace(ascii_digits(text), f"[_{_SPACES}]", "")
    return (
        F.when(text.rlike(PLAIN_NUMBER), text)
        .when(text.rlike(FINITE), bare)
        .when(text.rlike(NOT_A_NUMBER), F.lit("NaN"))
        .when(text.rlike(INFINITE), F.lit("Infinity"))
        .when(text.rlike(MINUS_INFINITE), F.lit("-Infinity"))
        .try_cast("double")
    )


def parse_iso_date(text: Column) -> Column:
    digits, values = _decimal_digits()
    zeros = "0" + "".join(d for d, v in zip(digits, values) if v == "0")
    unusual = rf"\A(?![{zeros}]{{4}})\p{{Nd}}{{4}}-{_MONTH_AND_DAY}\z"
    padded = F.replace(ascii_digits(text), F.lit("- "), F.lit("-0"))
    return F.when(text.rlike(PLAIN_DATE), text).when(text.rlike(unusual), padded).try_cast("date")
