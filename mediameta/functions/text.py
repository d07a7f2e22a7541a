"""Text and number cleaning as column expressions.

Expressions use their input once, so that nothing is evaluated twice when
projections are merged or a filter is pushed through them. Null words need no
treatment before a number is read: they are no numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# All characters a bare ``str.strip()`` removes.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Texts that stand for a missing value (case-sensitive).
NULL_WORDS = ["nan", "NaN", "None", "NULL"]

_OUTER_QUOTES = r"""(?s)\A(["'])(.*)\1\z"""
_NULL_WORD = r"\A(?:" + "|".join(NULL_WORDS) + r")\z"
_NUMBER = r"(?i)\A[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:e[+-]?\d+)?\z|\A[+-]?inf(?:inity)?\z"
_INTEGER = r"\A[+-]?\d+\z"
_BRACKETED_CRC = r"\A\[([A-Fa-f0-9]{8})\]\z"

# Tolerances of the "close to an integer" test.
ABSOLUTE_TOLERANCE = 1e-9
RELATIVE_TOLERANCE = 1e-5


def trim_text(c: Column) -> Column:
    """Trim whitespace of any kind from both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def strip_quotes(c: Column) -> Column:
    """Trim, drop one pair of equal outer quotes, trim again."""
    return trim_text(F.regexp_replace(trim_text(c), _OUTER_QUOTES, "$2"))


def clean_text(c: Column) -> Column:
    """``strip_quotes`` with the empty text and the null words made null."""
    return F.nullif(F.regexp_replace(strip_quotes(c), _NULL_WORD, ""), F.lit(""))


def number(c: Column) -> Column:
    """DOUBLE of a raw text; null for anything that is not wholly a number."""
    return F.regexp_extract(strip_quotes(c), _NUMBER, 0).try_cast("double")


def to_nullable_int(c: Column) -> Column:
    """BIGINT for texts within tolerance of an integer, else null.

    Rounds half-even. From 2^53 on, where DOUBLE has gaps, plain digits convert
    directly. Infinite and too large values are null. The number is bound by a
    one-element array, so it is parsed once even where a pushed-down filter
    repeats the expression.
    """
    digits = F.regexp_extract(strip_quotes(c), _INTEGER, 0)

    def rounded(x: Column) -> Column:
        r = F.rint(x)
        near = F.abs(x - r) <= ABSOLUTE_TOLERANCE + RELATIVE_TOLERANCE * F.abs(r)
        # A failing cast raises and catches an exception, so only huge values meet one.
        exact = F.when(F.abs(r) < 2.0**53, r.cast("bigint")).otherwise(
            F.coalesce(digits.try_cast("bigint"), F.when(F.abs(r) < 2.0**63, r.cast("bigint")))
        )
        return F.when(near, exact)

    return F.element_at(F.transform(F.array(number(c)), rounded), 1)


def to_confidence(c: Column, default: float = 0.0) -> Column:
    """DOUBLE clipped to [0, 1]; anything unreadable becomes ``default``."""
    x = F.coalesce(number(c), F.lit(float(default)))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def normalize_crc(c: Column) -> Column:
    """Cleaned text in upper case, without the brackets around exactly 8 hex digits."""
    return F.upper(F.regexp_replace(clean_text(c), _BRACKETED_CRC, "$1"))


def crc_matches(c: Column) -> Column:
    """True for exactly eight upper-case hex digits; null for null."""
    return c.rlike(r"\A[A-F0-9]{8}\z")
