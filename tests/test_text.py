import pytest
from pyspark.sql import functions as F

from mediameta.functions import text
from mediameta.functions.text import WHITESPACE


def values(spark, expression, inputs):
    df = spark.createDataFrame(list(enumerate(inputs)), "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_whitespace_is_what_str_strip_removes():
    assert len(WHITESPACE) == 29
    assert f"{WHITESPACE}a{WHITESPACE}".strip() == "a"


def test_strip_quotes(spark):
    cases = {
        ' "hello" ': "hello",
        "'a'": "a",
        '"': '"',
        '""': "",
        "'a\"": "'a\"",
        '""a""': '"a"',
        '" a\nb "': "a\nb",
        " 'x'　\x1f": "x",
        None: None,
    }
    assert values(spark, text.strip_quotes, list(cases)) == list(cases.values())


def test_clean_text(spark):
    cases = {
        ' "hello" ': "hello",
        "nan": None,
        "NaN": None,
        "None": None,
        "NULL": None,
        "": None,
        ' "nan" ': None,
        None: None,
        "null": "null",
        "NA": "NA",
        "none": "none",
        "nan ok": "nan ok",
    }
    assert values(spark, text.clean_text, list(cases)) == list(cases.values())


def test_to_nullable_int(spark):
    cases = {
        "1": 1, "02": 2, "3.0": 3, "4.5": None, None: None,
        "2.00001": 2, "2.0001": None, "100000.5": 100000,
        "1d": None, "0x10": None, "1_000": None, "TRUE": None,
        " 7 ": 7, "+5": 5, "1e3": 1000, "-3": -3, ".0": 0,
        "inf": None, "-Infinity": None, "nan": None, "": None,
        "9007199254740993": 9007199254740993, "9223372036854775807": 9223372036854775807,
        "-9223372036854775808": -9223372036854775808,
        "9223372036854775808": None, "1e20": None, "99999999999999999999": None, "1e400": None,
        "'12'": 12,
    }
    assert values(spark, text.to_nullable_int, list(cases)) == list(cases.values())


def test_to_confidence(spark):
    cases = {"1.7": 1.0, "-1": 0.0, "bad": 0.0, None: 0.0, "0.25": 0.25, "inf": 1.0, "-inf": 0.0, "NaN": 0.0, "1f": 0.0}
    assert values(spark, text.to_confidence, list(cases)) == list(cases.values())
    assert values(spark, lambda c: text.to_confidence(c, 0.5), ["bad", "0.1"]) == [0.5, 0.1]


def test_normalize_crc(spark):
    cases = {"[abcDEF12]": "ABCDEF12", "[abc]": "[ABC]", "zzzzzzzz": "ZZZZZZZZ", " '[00ff00ff]' ": "00FF00FF", "nan": None}
    assert values(spark, text.normalize_crc, list(cases)) == list(cases.values())


@pytest.mark.parametrize("crc,ok", [("ABCDEF12", True), ("ABCDEF12\n", False), ("abcdef12", False), ("ABCDEF123", False)])
def test_crc_matches(spark, crc, ok):
    assert values(spark, text.crc_matches, [crc]) == [ok]
