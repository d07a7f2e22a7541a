import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from mediameta.functions.checks import validate_objects
from mediameta.functions.jsontext import extract_json
from mediameta.operators import attempts, generate, score
from mediameta.operators.generate import object_errors_of
from mediameta.schema import METRICS

GOOD = '{"show_name":"Lantern Coast","season":4,"episode":11,"crc_hash":"0F1E2D3C","confidence":0.8,"reasoning":"both marked"}'
BAD = '{"show_name":"Lantern Coast","season":null,"episode":null,"crc_hash":"0F1E","confidence":-0.3,"reasoning":[1]}'
WRONG = {"show_name": "", "season": [4], "episode": "eleven", "crc_hash": "0F1E2D3G", "confidence": 7, "reasoning": None}


def errors_of(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = extract_json(df, "t", retry=False)
    return [r.errors for r in validate_objects(found, **options).orderBy("i").collect()]


def scores(spark, rows):
    df = spark.createDataFrame(rows, "pred string, label string")
    return tuple(score.score_completions(df).first())


def test_every_error(spark):
    (errors,) = errors_of(spark, [json.dumps(WRONG)])
    assert len(errors) == 6
    for word in WRONG:
        assert any(word in e for e in errors)


def test_valid_and_missing(spark):
    ok, no_episode, empty, none = errors_of(spark, [GOOD, GOOD.replace('"episode":11', '"episode":null'), "{}", "x"])
    assert ok == [] and no_episode == ["episode is required but was null."]
    assert empty == ["empty object"] and none == ["No '{' found."]
    assert errors_of(spark, [GOOD.replace('"episode":11', '"episode":null')], require_episode=False) == [[]]


def test_native_and_python_checks_agree(spark):
    odd = ["1", "1.0", "true", "null", '"x"', "12345678901234567890", "1e2", "[1]", '{"a":1}', '""', '"ABCDEF12"', "0.5", "-0.1", "1"]
    texts = ["{}", '{"episode":1}']
    for member in json.loads(GOOD):
        texts += [json.dumps({**json.loads(GOOD), member: "@"}).replace('"@"', o) for o in odd]
    native = errors_of(spark, texts)
    for text, got in zip(texts, native, strict=True):
        obj = json.loads(text)
        assert got == (object_errors_of(obj, True) if obj else ["empty object"]), text


def test_scores(spark):
    assert scores(spark, [(GOOD, GOOD)]) == (1, 1, 1, 1, 1, 1)
    assert scores(spark, [(BAD, GOOD)]) == (1, 1, 0, 0, 0, 0)
    assert scores(spark, [("", "")]) == (0,) * 6
    assert scores(spark, [("{}", "{}")]) == (0,) * 6
    swapped = json.dumps(dict(reversed(json.loads(GOOD).items())))
    assert scores(spark, [(swapped, GOOD)]) == (1, 0, 1, 1, 1, 1)
    prompt = "<|system|>\nschema {not json}\n<|assistant|>\n"
    assert scores(spark, [(prompt + GOOD, prompt + GOOD)]) == (1,) * 6
    assert scores(spark, [(GOOD, None), (GOOD, GOOD), (None, GOOD), ("x", GOOD)]) == (0.5,) * 5 + (0.25,)
    assert scores(spark, []) == (0,) * 6
    assert scores(spark, [(GOOD.replace("0.8", "0.80"), GOOD)]) == (1,) * 6
    no_crc = GOOD.replace('"crc_hash":"0F1E2D3C",', "")
    assert scores(spark, [(no_crc, GOOD)]) == (1, 0, 1, 1, 1, 0)


def test_python_mode_scores(spark):
    df = spark.createDataFrame([(GOOD, GOOD), (BAD, GOOD)], "pred string, label string")
    assert tuple(score.score_completions(df, mode="python").first()) == (1, 1, 0.5, 0.5, 0.5, 0.5)


def test_logits_and_ids(spark):
    logits = spark.createDataFrame([([[0.0]], "x")], "pred array<array<double>>, label string")
    with pytest.warns(UserWarning):
        assert score.score_completions(logits).first().asDict() == dict.fromkeys(METRICS, 0.0)
    ids = spark.createDataFrame([([1], "x")], "pred array<bigint>, label string")
    with pytest.raises(TypeError):
        score.score_completions(ids)


NUMBERS = ["1", "1.0", "1e0", "10e-1", "true", "0", "-0", "0.0", "false", "100", "1e2", "0.00005", "5e-05", "5.0E-5", "0.1", "0.10", "1e-1", "0.3", "0.30000000000000004", "null", '"1"', '"1.0"', "12345678901234567890", "2.5e3", "2500"]


def test_equality_by_value(spark):
    rng = random.Random(9)

    names = ["a", "b", "1e2", r't\"rue']

    def value(depth=0):
        kind = rng.random()
        if depth < 3 and kind < 0.2:
            return "[" + ",".join(value(depth + 1) for _ in range(rng.randrange(3))) + "]"
        if depth < 3 and kind < 0.4:
            return "{" + ",".join(f'"{k}":{value(depth + 1)}' for k in rng.sample(names, rng.randrange(3))) + "}"
        return rng.choice(NUMBERS)

    def other(text):
        for _ in range(rng.randrange(3)):
            text = text.replace(*rng.choice([("100", "1e2"), ("1.0", "true"), ("0.10", "0.1"), ("5e-05", "0.00005"), ("false", "0"), ("2500", "2.5e3")]), 1)
        return text

    rows = []
    for i in range(1500):
        a = '{"x":' + value() + ',"y":' + value() + "}"
        rows.append((i, a, other(a) if i % 2 else '{"x":' + value() + "}"))
    rows += [(9001, '{"a":1e2}', '{"a":100}'), (9002, '{"a":5e-05}', '{"a":0.00005}'), (9003, '{"a":true}', '{"a":1}')]
    df = spark.createDataFrame(rows, "i int, pred string, label string")
    got = {r.i: r.exact_json_match for r in score.score_rows(df).collect()}

    def read(text):
        try:
            return json.loads(text)
        except ValueError:
            return text

    for i, a, b in rows:
        assert got[i] == (read(a) == read(b)), (a, b)


def test_labels_are_unique(spark):
    preds = spark.createDataFrame([(1, GOOD), (2, GOOD), (None, GOOD)], "id bigint, pred string")
    labels = spark.createDataFrame([(1, GOOD), (1, BAD), (None, GOOD), (None, GOOD)], "id bigint, label string")
    with pytest.raises(PySparkException, match="more than one label"):
        score.pair_labels(preds, labels).collect()
    assert score.pair_labels(preds, labels.filter("id IS NULL OR label LIKE '%0F1E2D3C%'")).count() == 3


def test_missing_label_still_counts(spark):
    preds = spark.createDataFrame([(1, GOOD), (2, GOOD)], "id bigint, pred string")
    labels = spark.createDataFrame([(1, GOOD), (3, GOOD)], "id bigint, label string")
    assert tuple(score.score_completions(score.pair_labels(preds, labels)).first()) == (1,) * 5 + (0.5,)


def tried(spark, texts, **options):
    rows = [(1, n, t, 10 * n) for n, t in enumerate(texts, 1)]
    df = spark.createDataFrame(rows, "id bigint, attempt int, decoded string, gen_tokens int")
    return attempts.first_valid_attempt(df, **options).first()


def test_first_valid_attempt(spark):
    r = tried(spark, ["x", "{}", GOOD, GOOD])
    assert (r.status, r.attempt, r.temperature, r.top_p, r.gen_tokens, r.errors) == ("ok", 3, 0.2, 0.9, 30, [])
    r = tried(spark, ["x", BAD, "{", GOOD])
    assert (r.status, r.attempt, r.obj) == ("fail", 3, None) and r.errors
    assert tried(spark, [GOOD, GOOD]).attempt == 1
    assert tried(spark, ["x", "x", "x", GOOD], max_retries=4).attempt == 4
    for none in (0, -1):
        r = tried(spark, [GOOD], max_retries=none)
        assert (r.status, r.attempt, len(r.errors)) == ("fail", 0, 1)


def test_every_id_gets_a_record(spark):
    rows = [(1, 5, GOOD, 7), (2, 1, "x", 1), (2, 9, GOOD, 2), (3, None, GOOD, 3), (None, 2, GOOD, 4), (4, 0, "x", 1), (4, 2, BAD, 6)]
    df = spark.createDataFrame(rows, "id bigint, attempt int, decoded string, gen_tokens int")
    found = attempts.first_valid_attempt(df)
    got = {r.id: (r.status, r.attempt, r.gen_tokens) for r in found.collect()}
    assert got == {1: ("fail", 0, 0), 2: ("fail", 1, 1), 3: ("fail", 0, 0), None: ("ok", 2, 4), 4: ("fail", 2, 6)}
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_run_summary(spark):
    df = spark.createDataFrame([("ok", 1, 5), ("ok", 3, 6), ("fail", 3, 1)], "status string, attempt int, gen_tokens int")
    got = {r.status: (r.n, r.gen_tokens, r.attempts, r.max_attempt) for r in attempts.run_summary(df).collect()}
    assert got == {"ok": (2, 11, 4, 3), "fail": (1, 1, 3, 3)}


def make_by_prompt():
    def answer(prompts, temperature, top_p):
        need = {"first": 0.0, "second": 0.1, "never": 9.0}
        return [GOOD if temperature >= need[p] else "no json here" for p in prompts]

    return answer


def test_batch_generate(spark):
    df = spark.createDataFrame([(1, "first"), (2, "second"), (3, "never")], "id bigint, prompt string")
    rows = {r.id: r for r in generate.batch_generate(df, make_by_prompt).collect()}
    assert (rows[1].status, rows[1].attempt) == ("ok", 1)
    assert (rows[2].status, rows[2].attempt, rows[2].temperature, rows[2].top_p) == ("ok", 2, 0.1, 0.95)
    assert (rows[3].status, rows[3].attempt) == ("fail", 3) and rows[3].errors == ["No '{' found."]
    assert json.loads(rows[1].obj) == json.loads(GOOD) and rows[1].seconds >= 0
    one = generate.batch_generate(df, make_by_prompt, max_retries=1).filter("id = 2").first()
    assert one.status == "fail"
    zero = generate.batch_generate(df, make_by_prompt, max_retries=0).first()
    assert (zero.status, zero.attempt, zero.decoded) == ("fail", 0, "")


def test_failing_rows_alone_are_called_again(spark, tmp_path):
    log = str(tmp_path / "calls")

    def make():
        inner = make_by_prompt()

        def logged(prompts, temperature, top_p):
            with open(log, "a") as f:
                f.write(f"{temperature}:{len(prompts)}\n")
            return inner(prompts, temperature, top_p)

        return logged

    df = spark.createDataFrame([(1, "first"), (2, "second"), (3, "never")], "id bigint, prompt string").coalesce(1)
    generate.batch_generate(df, make).collect()
    with open(log) as f:
        assert f.read().split() == ["0.0:3", "0.1:2", "0.2:1"]


def test_decode_tokens(spark):
    def make():
        return lambda rows: ["".join(map(chr, r)) for r in rows]

    df = spark.createDataFrame([([72, 105],), (None,)], "ids array<bigint>")
    assert [r.t for r in generate.decode_tokens(df, "ids", "t", make).collect()] == ["Hi", None]
    already = df.select(F.lit("text").alias("ids"))
    assert generate.decode_tokens(already, "ids", "t", make).first().t == "text"


def some_number(rng):
    kind = rng.randrange(8)
    digits = lambda n: str(rng.randrange(1, 10)) + "".join(rng.choice("0123456789") for _ in range(n - 1))
    if kind == 0:
        return str(rng.choice([0, 1, 2, 10, 100, 2**53, 2**53 + 1, 10**15, 10**16, 10**22, 10**23, -1, -(2**63), 2**64]))
    if kind == 1:
        return rng.choice(["true", "false", "-0", "0.0", "-0.0", "1.0", "1e0", "10e-1", "100E-2", "0.1e1"])
    if kind == 2:
        return digits(rng.choice([16, 17, 19, 40]))
    if kind == 3:
        return str(2 ** rng.randrange(50, 300) * rng.choice([1, 3, -1, -5]))
    if kind == 4:
        return f"{rng.choice([1, 2, 5, 12, 100])}e{rng.choice([0, 1, 15, 16, 22, 23, 40, -3, -400, 300])}"
    if kind == 5:
        return f"{rng.randrange(5)}.{rng.randrange(3)}e{rng.choice(['+', '-', ''])}{rng.randrange(400)}"
    if kind == 6:
        return repr(rng.choice([0.1, 1 / 3, 2.0**60, 1e300, 123456789012345678.0]))
    return f"{digits(rng.randrange(1, 20))}.{digits(3)}"


def rewritten(rng, text):
    """The same value in another form, or a near one."""
    value = json.loads(text)
    forms = [text, text]
    if not isinstance(value, bool) and value == value and abs(value) < 1e308:
        forms += [repr(float(value)), f"{float(value):.17e}"]
        if value == int(value):
            forms += [str(int(value)), str(int(value) + 1), f"{int(value)}.0", f"{int(value) or 1}0e-1", f"{int(float(value))}"]
    return rng.choice(forms)


def test_numbers_are_equal_as_in_python(spark):
    rng = random.Random(17)
    pairs = [("1e400", "1e401"), ("9007199254740993", "9007199254740992.0"), ("1e23", str(10**23)), ("1e22", str(10**22)), (str(2**200), f"{2.0**200!r}")]
    for _ in range(1500):
        text = some_number(rng)
        pairs.append((text, rewritten(rng, text) if rng.random() < 0.8 else some_number(rng)))
    finite = [p for p in pairs if all(abs(json.loads(x)) < 1e308 for x in p)]
    shape = '{{"b":"n1\\"n2 : 3","a":[{0},{{"c":{0}}}],"s1":"0"}}'
    rows = [(i, shape.format(a), '{{ "s1": "0", "a": [ {0} , {{"c":{0}}}], "b": "\\u006e1\\"n2 : 3" }}'.format(b)) for i, (a, b) in enumerate(finite)]
    got = {r.id: r.exact_json_match for r in score.score_rows(spark.createDataFrame(rows, "id int, pred string, label string").repartition(4)).collect()}
    want = {i: json.loads(p) == json.loads(t) for i, p, t in rows}
    assert sum(want.values()) > 300 and sum(not w for w in want.values()) > 200
    assert [(rows[i][1], rows[i][2], got[i]) for i in want if got[i] != want[i]] == []


def counting_generator(folder, poison=None):
    """Answers every prompt, notes each call in a file of its own, and ends the job at one prompt."""

    def make():
        import uuid

        def generate_(prompts, temperature, top_p):
            with open(f"{folder}/{uuid.uuid4().hex}", "w", encoding="utf-8") as f:
                f.write("\n".join(prompts))
            if poison in prompts:
                raise RuntimeError("ended")
            return [GOOD for _ in prompts]

        return generate_

    return make


def test_resumed_run_asks_for_open_rows_only(spark, tmp_path):
    rows = [(i, f"prompt {i % 190}" + "x" * (i % 7)) for i in range(200)] + [(None, "none"), (None, "none"), (3, None)]
    df = spark.createDataFrame(rows, "row_id int, prompt string")
    store = str(tmp_path / "store")
    calls = [tmp_path / "first", tmp_path / "second", tmp_path / "third"]
    for c in calls:
        c.mkdir()
    asked = lambda c: [line for f in c.iterdir() for line in f.read_text().split("\n")]
    with pytest.raises(PySparkException, match="RuntimeError"):
        generate.generate_resumable(df, counting_generator(str(calls[0]), rows[77][1]), store, waves=6)
    key = df.schema["row_id"]
    kept = generate.stored_results(spark, store, key).count()
    assert 0 < kept < 202
    records = generate.generate_resumable(df.filter("prompt IS NOT NULL"), counting_generator(str(calls[1])), store, waves=6).collect()
    assert len(records) == 202 and all(r.status == "ok" and r.obj for r in records)
    # Rows of one id and prompt are asked once.
    assert len(asked(calls[1])) == 201 - kept
    # A changed prompt is asked again, the others are not.
    changed = df.filter("prompt IS NOT NULL").withColumn("prompt", F.when(F.col("row_id") == 5, "other").otherwise(F.col("prompt")))
    generate.generate_resumable(changed, counting_generator(str(calls[2])), store, waves=6).collect()
    assert asked(calls[2]) == ["other"]


def test_pair_positions(spark, tmp_path):
    for name, n, files in (("p", 100, 4), ("t", 73, 3)):
        spark.range(n).repartitionByRange(files, "id").sortWithinPartitions("id").withColumnRenamed("id", name).write.parquet(str(tmp_path / name))
    sides = [spark.read.parquet(str(tmp_path / n)) for n in "pt"]
    for pair in (sides, sides[::-1]):
        assert sorted((r.position, r.p, r.t) for r in score.pair_positions(*pair).collect()) == [(i, i, i) for i in range(73)]
    with pytest.raises(ValueError, match="both sides"):
        score.pair_positions(sides[0], sides[0])


def test_token_stop(spark):
    decode = lambda: lambda rows: ["".join(chr(i) for i in ids) for ids in rows]
    texts = ["{}", "{", "}{a}b", "no", "", "x{a{b}}c{d}", "<|user|> {", "a{}", "{{{}" * 40, "y" * 500 + "{q}" + "z" * 500]
    df = spark.createDataFrame([(i, [ord(c) for c in t]) for i, t in enumerate(texts)] + [(99, None)], "i int, ids array<bigint>")
    for tags in (False, True):
        rows = generate.truncate_token_stop(df, "ids", "cut", decode, stop_on_tags=tags).orderBy("i").collect()
        for text, r in zip(texts, rows, strict=False):
            stops = [n for n in range(2, len(text) + 1) if generate.python_stops(text[:n], tags)]
            assert (r.cut_text, r.stopped) == ((text[: stops[0]], True) if stops else (text, False))
            assert len(r.cut) == len(r.cut_text)
        assert rows[-1].cut is None and rows[-1].cut_text is None and rows[-1].stopped is False
