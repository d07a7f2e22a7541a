"""Checks of an extracted object: keys, member types, ranges.

``with_members`` parses the object once per row; the checks read its columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediameta.functions.text import crc_matches
from mediameta.schema import TARGET_KEYS

_NUMERIC = r"\A(?:BIGINT|BOOLEAN|DOUBLE|FLOAT|DECIMAL\(.*)\z"
# An integer beyond BIGINT parses as a decimal of at least 19 digits.
_INT_OR_NULL = r"\A(?:BIGINT|BOOLEAN|VOID|DECIMAL\((?:19|2\d|3\d),0\))\z"


# The texts of the checks, in their order.
EXPECTED_KEYS = "['" + "', '".join(TARGET_KEYS) + "']"
MESSAGES = {
    "keys": f"Keys/order mismatch. Expected {EXPECTED_KEYS}, got ",
    "show_name": "show_name must be a non-empty string.",
    "season": "season must be int or null.",
    "episode": "episode must be int or null.",
    "required": "episode is required but was null.",
    "crc_type": "crc_hash must be string or null.",
    "crc_form": "crc_hash must match ^[A-F0-9]{8}$ when present.",
    "confidence_type": "confidence must be a number.",
    "confidence_range": "confidence must be in [0, 1].",
    "reasoning": "reasoning must be a string.",
}


class Members:
    """Columns of one parsed object; ``type_of`` is VOID for an absent member."""

    def __init__(self, prefix: str):
        self.prefix = prefix

    def variant(self) -> Column:
        return F.col(f"_{self.prefix}_v")

    def keys(self) -> Column:
        return F.col(f"_{self.prefix}_keys")

    def type_of(self, member: str) -> Column:
        return F.col(f"_{self.prefix}_t.{member}")

    def text(self, member: str) -> Column:
        return F.try_variant_get(self.variant(), f"$.{member}", "string")

    def number(self, member: str) -> Column:
        return F.try_variant_get(self.variant(), f"$.{member}", "double")

    # Checks. Each is true or false for every non-null object.

    def non_empty(self) -> Column:
        """The object has at least one key."""
        return F.coalesce(F.size(self.keys()) > 0, F.lit(False))

    def keys_in_order(self) -> Column:
        return F.coalesce(self.keys() == F.array(*[F.lit(k) for k in TARGET_KEYS]), F.lit(False))

    def text_present(self, member: str) -> Column:
        return (self.type_of(member) == "STRING") & (self.text(member) != "")

    def is_text(self, member: str) -> Column:
        return self.type_of(member) == "STRING"

    def is_null(self, member: str) -> Column:
        return self.type_of(member) == "VOID"

    def int_or_null(self, member: str) -> Column:
        return self.type_of(member).rlike(_INT_OR_NULL)

    def is_number(self, member: str) -> Column:
        return self.type_of(member).rlike(_NUMERIC)

    def in_unit_range(self, member: str) -> Column:
        return F.coalesce(self.number(member).between(0.0, 1.0), F.lit(False))

    def crc_valid(self) -> Column:
        return self.is_null("crc_hash") | (
            self.is_text("crc_hash") & F.coalesce(crc_matches(self.text("crc_hash")), F.lit(False))
        )


def with_members(df: DataFrame, obj: str) -> tuple[DataFrame, Members, list[str]]:
    """Add the parsed form of column ``obj``; returns also the helper columns to drop."""
    m = Members(obj)
    v, keys, types = f"_{obj}_v", f"_{obj}_keys", f"_{obj}_t"
    parsed = df.withColumn(v, F.try_parse_json(F.col(obj)))
    member_types = [
        F.coalesce(
            F.schema_of_variant(F.variant_get(F.col(v), f"$.{k}", "variant")), F.lit("VOID")
        ).alias(k)
        for k in TARGET_KEYS
    ]
    parsed = parsed.withColumns(
        {
            # Only valid JSON may reach json_object_keys, which tolerates junk.
            keys: F.when(F.col(v).isNotNull(), F.json_object_keys(F.col(obj))),
            types: F.struct(*member_types),
        }
    )
    return parsed, m, [v, keys, types]


def _python_list(keys: Column) -> Column:
    return F.when(F.size(keys) == 0, "[]").otherwise(
        F.concat(F.lit("['"), F.array_join(keys, "', '"), F.lit("']"))
    )


def object_errors(m: Members, require_episode: bool) -> Column:
    """Error texts in check order; an empty array for a valid object."""
    t = MESSAGES
    checks = [
        F.when(~m.keys_in_order(), F.concat(F.lit(t["keys"]), _python_list(m.keys()))),
        F.when(~m.text_present("show_name"), t["show_name"]),
        F.when(~m.int_or_null("season"), t["season"]),
        F.when(~m.int_or_null("episode"), t["episode"]),
        F.when(m.is_null("episode"), t["required"]) if require_episode else None,
        F.when(~m.is_null("crc_hash") & ~m.is_text("crc_hash"), t["crc_type"]).when(~m.crc_valid(), t["crc_form"]),
        F.when(~m.is_number("confidence"), t["confidence_type"]).when(~m.in_unit_range("confidence"), t["confidence_range"]),
        F.when(~m.is_text("reasoning"), t["reasoning"]),
    ]
    return F.array_compact(F.array(*[c for c in checks if c is not None]))


def validate_objects(
    df: DataFrame, obj: str = "obj", out: str = "errors", *, require_episode: bool = True
) -> DataFrame:
    """Add the ordered error list of each object.

    A null object passes on its extraction error from ``<obj>_error``; an empty
    object counts as a failure.
    """
    parsed, m, helpers = with_members(df, obj)
    no_object = (
        F.array(F.coalesce(F.col(f"{obj}_error"), F.lit("no object")))
        if f"{obj}_error" in df.columns
        else F.array(F.lit("no object"))
    )
    errors = (
        F.when(F.col(obj).isNull(), no_object)
        .when(~m.non_empty(), F.array(F.lit("empty object")))
        .otherwise(object_errors(m, require_episode))
    )
    return parsed.withColumn(out, errors).drop(*helpers)


def score_flags(m: Members) -> dict[str, Column]:
    """Row flags of a non-empty parsed prediction, without the label comparison."""
    typed = (
        m.text_present("show_name")
        & m.int_or_null("season")
        & m.int_or_null("episode")
        & m.crc_valid()
        & m.is_number("confidence")
        & m.in_unit_range("confidence")
        & m.is_text("reasoning")
    )
    valid = m.non_empty()
    return {
        "json_validity": valid,
        "key_order_match": valid & m.keys_in_order(),
        "field_type_valid": valid & typed,
        "episode_present": valid & ~m.is_null("episode"),
        "crc_format": valid & m.crc_valid(),
    }


# Parts of a JSON text that are strings, or else numbers and truth values; with and without the marks of ``_tagged``.
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_VALUE = r"-?[0-9][0-9.eE+-]*+|true|false"
_PLAIN_PARTS = rf"({_STRING})|({_VALUE})"
_TAGGED_PARTS = r'("s(?:[^"\\]++|\\.)*+")|"n([^"]*+)"'
# Numbers which a parsed form may have rounded: many digits, or an exponent.
_LONG_NUMBER = r"[0-9]{16}|[0-9][eE]"

#: A double is a whole number of this many bits times a power of two.
_BITS = 53
#: Whole numbers that lie within half of 2 ** 971 of each other and agree modulo all of these are the same.
_PRIME_BITS, _PRIMES_NEEDED = 31, 34


def _primes() -> list[int]:
    found, n = [], 2**_PRIME_BITS - 1
    small = [d for d in range(2, 1 << 16) if all(d % f for f in range(2, math.isqrt(d) + 1))]
    while len(found) < _PRIMES_NEEDED:
        if all(n % d for d in small if d * d <= n):
            found.append(n)
        n -= 2
    return found


def _tagged(obj: Column) -> Column:
    """The object as text with sorted keys, each string behind an s, and each number and truth value as a string behind an n.

    So the parser sorts keys and resolves escapes, and the digits stay as they are written.
    """
    strings = F.regexp_replace(obj, _STRING_BODY, '"s$1"')
    return F.to_json(F.try_parse_json(F.regexp_replace(strings, _NEXT_VALUE, '$1"n$2"')))


_STRING_BODY = r'"((?:[^"\\]++|\\.)*+)"'
# From the last match on: what is no value, strings as a whole, then a value.
_NEXT_VALUE = rf'\G((?:[^"0-9tf-]++|{_STRING})*+)({_VALUE})'


def _digits(number: Column) -> Column:
    """A whole number's text without leading zeros and the sign of zero; truth values as 1 and 0."""
    return F.when(number == "true", "1").when(number == "false", "0").when(number == "-0", "0").otherwise(number)


def _rest(number: Column, prime: Column) -> Column:
    """A whole number's digits modulo a prime, nine digits at a time."""
    digits = F.ltrim(number, F.lit("-"))
    padded = F.lpad(digits, F.ceil(F.length(digits) / 9).cast("int") * 9, F.lit("0"))
    return F.aggregate(
        F.sequence(F.lit(0), (F.length(padded) / 9).cast("int") - 1),
        F.lit(0).cast("bigint"),
        lambda acc, i: (acc * 1_000_000_000 + F.substr(padded, i * 9 + 1, F.lit(9)).cast("bigint")) % prime,
    )


def _rest_of_double(value: Column, prime: Column) -> Column:
    """The same of a whole double from 2 ** 53 on: its leading bits, doubled as often as its exponent says."""
    power = F.greatest(F.floor(F.log2(F.abs(value))).cast("int") - _BITS, F.lit(0))
    # Scaling by a power of two is exact; the logarithm may be off by one, which leaves a bit more or less.
    lead = (F.abs(value) / F.pow(F.lit(2.0), power)).cast("bigint")
    return F.aggregate(F.sequence(F.lit(1), F.greatest(power, F.lit(1))), lead % prime, lambda acc, i: F.when(i <= power, acc * 2 % prime).otherwise(acc))


def _equal_numbers(a: Column, b: Column) -> Column:
    """Two written numbers are one value: whole ones by their digits, others by the nearest double, a mix of both exactly."""
    whole = lambda c: c.rlike(r"\A(?:-?[0-9]+|true|false)\z")
    both, x, y = whole(a) & whole(b), _digits(a), _digits(b)
    left, right = x.try_cast("double"), y.try_cast("double")
    # One is whole, the other a double. Below 2 ** 53 doubles are exact; from there on the nearest may be another number.
    number, value = F.when(whole(a), x).otherwise(y), F.when(whole(a), right).otherwise(left)
    exact = F.forall(F.array(*[F.lit(p).cast("bigint") for p in _PRIMES]), lambda p: _rest(number, p) == _rest_of_double(value, p))
    mixed = F.when((left != right) | (F.abs(value) == float("inf")), False).when(F.abs(value) < 2.0**_BITS, True).otherwise(exact)
    return F.when(both, x == y).when(whole(a) | whole(b), mixed).otherwise(left == right)


_PRIMES = _primes()


def _equal_by_digits(a: Column, b: Column) -> Column:
    """Objects of equal strings whose numbers are equal pair by pair."""
    numbers = lambda c: F.regexp_extract_all(c, F.lit(_TAGGED_PARTS), F.lit(2))
    bare = lambda c: F.regexp_replace(c, _TAGGED_PARTS, "$1#")
    pairs = F.zip_with(numbers(a), numbers(b), lambda x, y: F.when(x == y, True).otherwise(_equal_numbers(x, y)))
    return F.when(bare(a) == bare(b), F.forall(pairs, lambda x: x)).otherwise(False)


def same_object(left: Members, right: Members) -> Column:
    """Equal objects regardless of key order and of how a number is written: 1, 1.0, 1e0 and true are one value.

    ``to_json`` sorts keys. Its texts decide where they are equal without long numbers, and where they differ in more
    than numbers. Only what is left is compared number by number, with all digits that the object was written with.
    """
    a, b = F.to_json(left.variant()), F.to_json(right.variant())
    bare = lambda c: F.regexp_replace(c, _PLAIN_PARTS, "$1#")
    long = F.col(left.prefix).rlike(_LONG_NUMBER) | F.col(right.prefix).rlike(_LONG_NUMBER)
    numbers = _equal_by_digits(_tagged(F.col(left.prefix)), _tagged(F.col(right.prefix)))
    return F.coalesce(F.when((a == b) & ~long, True).when(bare(a) != bare(b), False).otherwise(numbers), F.lit(False))
