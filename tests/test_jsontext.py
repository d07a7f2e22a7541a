import json
import random

import pytest
from pyspark.sql import functions as F

from mediameta.functions import jsontext
from mediameta.functions.jsontext import RETRY_ERRORS, SINGLE_ERRORS

TAG = "<|assistant|>"


def run(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = jsontext.extract_json(df, "t", **options).orderBy("i").collect()
    return [(r.obj, r.obj_error) for r in rows]


def strict(text):
    def pairs(items):
        if len({k for k, _ in items}) != len(items):
            raise ValueError("repeated key")
        return dict(items)

    def constant(name):
        raise ValueError(name)

    return json.loads(text, object_pairs_hook=pairs, parse_constant=constant)


def by_definition(text, retry):
    """Scan characters one by one, straight from the rules."""
    if retry and TAG in text:
        text = text[text.index(TAG) + len(TAG) :]
    outcome = "none"
    for start, c in enumerate(text):
        if c != "{":
            continue
        level, stop = 0, None
        for at in range(start, len(text)):
            level += (text[at] == "{") - (text[at] == "}")
            if level == 0:
                stop = at
                break
        if stop is None:
            return None, "open"
        try:
            strict(text[start : stop + 1])
            return text[start : stop + 1], "found"
        except ValueError:
            outcome = "parse"
        if not retry:
            break
    return None, outcome


CASES = [
    'prefix {"a":1, "b":2} suffix',
    'prefix {"a":1, "b":2',
    "{abc",
    "no json here",
    "",
    '<|system|>\nschema {not json}\n<|assistant|>\n{"a":1}',
    f'{{"x":1}} {TAG} {{"y":2}} {TAG} {{"z":3}}',
    '{bad} {"a":1}',
    '{ {"a":1}',
    '{"x":{"a":1},}',
    '{"s":"}"}',
    '{"s":"{"} {"a":1}',
    "{}",
    '} {"a":{"b":{}}}',
    "}}{{}}{",
    '日本 {"ключ":"значение 😀"} хвост',
    '{"a":"\t"} {"b":1}',
]


@pytest.mark.parametrize("retry", [True, False])
def test_cases(spark, retry):
    errors = {**(RETRY_ERRORS if retry else SINGLE_ERRORS), "found": ""}
    got = run(spark, CASES, retry=retry)
    for text, pair in zip(CASES, got, strict=True):
        obj, code = by_definition(text, retry)
        assert pair == (obj, errors[code]), text


@pytest.mark.parametrize("retry", [True, False])
@pytest.mark.parametrize("mode", ["native", "python"])
def test_random_texts(spark, retry, mode):
    rng = random.Random(7)
    pieces = ["{", "}", "{", "}", '"a":', '"b":', "1", "2.5", '"x"', ",", " ", "[", "]", "null", TAG, "é", '{"k":3}']
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(1500)]
    errors = {**(RETRY_ERRORS if retry else SINGLE_ERRORS), "found": ""}
    for text, (obj, error) in zip(texts, run(spark, texts, retry=retry, mode=mode), strict=True):
        want, code = by_definition(text, retry)
        if mode == "native":
            assert (obj, error) == (want, errors[code]), text
        elif '"a":' not in text and '"b":' not in text:  # repeated keys differ by design
            assert (obj and json.loads(obj)) == (want and json.loads(want)), text
            assert error.startswith(errors[code]), text


def test_null_text(spark):
    assert run(spark, [None])[0][0] is None


def test_python_mode_accepts_what_python_accepts(spark):
    (a, b) = run(spark, ['{"a":1,"a":2}', '{"a":NaN}'], mode="python")
    assert a == ('{"a":2}', "") and b == ('{"a":"NaN"}', "")
    assert [o for o, _ in run(spark, ['{"a":1,"a":2}', '{"a":NaN}'])] == [None, None]


def test_many_braces(spark):
    nested = "{" * 400 + "}" * 400
    text = nested + ' {"a":1}'
    assert run(spark, [text])[0] == ("{}", "") if by_definition(text, True)[0] == "{}" else True
    assert run(spark, ["{x}" * 500 + '{"a":1}'])[0] == ('{"a":1}', "")
    assert run(spark, ["{x}" * 500 + '{"a":1}'], mode="python")[0] == ('{"a":1}', "")


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        run(spark, ["x"], mode="fast")


def test_truncate(spark):
    cases = {
        '{"a":1} more': ('{"a":1}', True),
        'say {"a":{"b":2}} more': ('say {"a":{"b":2}}', True),
        "<|user|> extra": ("<|user|>", True),
        'x <|assistant|> {"a":1}': ("x <|assistant|>", True),
        '{"a":1} <|user|>': ('{"a":1}', True),
        "{ <|system|> }": ("{ <|system|>", True),
        "} {open": ("} {open", False),
        "nothing": ("nothing", False),
        None: (None, False),
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    rows = jsontext.truncate_completion(df, "t").orderBy("i").collect()
    assert [(r.truncated, r.stopped) for r in rows] == list(cases.values())
    free = jsontext.truncate_completion(df, "t", stop_on_tags=False).orderBy("i").collect()
    assert free[2].truncated == "<|user|> extra" and free[3].truncated == 'x <|assistant|> {"a":1}'


def test_stop_strings(spark):
    df = spark.createDataFrame([("a<|endoftext|>b<|user|>",), ("plain",), ("<|user|>x",), (None,)], "t string")
    got = [r[0] for r in df.select(jsontext.cut_at_stop_strings(F.col("t"))).collect()]
    assert got == ["a", "plain", "", None]
