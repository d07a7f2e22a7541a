import json

import pytest
from pyspark.sql import functions as F

from mediameta.functions import render, tokens
from mediameta.operators.examples import training_examples

CLEAN = "row_id bigint, name string, show_name string, season bigint, episode bigint, reasoning string, confidence double, crc_hash string"


def targets(spark, rows):
    df = spark.createDataFrame(rows, CLEAN)
    return [r[0] for r in df.orderBy("row_id").select(render.row_target_json()).collect()]


def test_target_json_matches_python(spark):
    confidences = [0.9, 1.0, 0.0, 0.1, 0.25, 0.001, 0.0005, 0.00012, 5e-05, 1.5e-07, 1e-10, 1.234e-300, 0.3333333333333333]
    rows = [
        (i, "n.mkv", 'A "q" \\ ü\n\t/', i, None, "r", c, "ABCDEF12") for i, c in enumerate(confidences)
    ]
    for row, got in zip(rows, targets(spark, rows), strict=True):
        want = {"show_name": row[2], "season": row[3], "episode": row[4], "crc_hash": row[7], "confidence": row[6], "reasoning": row[5]}
        assert got == json.dumps(want, ensure_ascii=False, separators=(",", ":"))


def test_target_json_order_and_nulls(spark):
    (got,) = targets(spark, [(0, None, None, None, None, None, None, None)])
    assert got == '{"show_name":"","season":null,"episode":null,"crc_hash":null,"confidence":0.0,"reasoning":""}'


def test_braces_at_the_ends_of_values_stay(spark):
    (got,) = targets(spark, [(0, "n", "{a}}", 1, 2, "{{r}", 0.5, "x}}")])
    assert json.loads(got) == {"show_name": "{a}}", "season": 1, "episode": 2, "crc_hash": "x}}", "confidence": 0.5, "reasoning": "{{r}"}


def test_training_text(spark):
    df = spark.createDataFrame([(0, "c$2\\d.mp4", "Low Tide", 3, 14, "read", 0.65, "00FF11EE"), (1, None, "Low Tide", 3, 14, "read", 0.65, None)], CLEAN)
    first, second = [r.text for r in training_examples(df, "SYS").orderBy("row_id").collect()]
    assert first == (
        '<|system|>\nSYS\n<|user|>\nFilename: "c$2\\d.mp4"\nExtract metadata.\n<|assistant|>\n'
        '{"show_name":"Low Tide","season":3,"episode":14,"crc_hash":"00FF11EE","confidence":0.65,"reasoning":"read"}<|endoftext|>'
    )
    assert 'Filename: ""' in second


def test_prompt_layouts(spark):
    row = spark.range(1).select(
        render.inference_prompt(F.lit("S"), F.lit("U")).alias("a"),
        render.serving_prompt(F.lit("S"), F.lit("U")).alias("b"),
        render.chat_messages(F.lit("S"), F.lit("U")).alias("m"),
    ).first()
    assert row.a == "<|system|>\nS\n<|user|>\nU\n<|assistant|>\n"
    assert row.b == "<|system|>\nS\n\n<|user|>\nU\n\n<|assistant|>\n"
    assert [tuple(m) for m in row.m] == [("system", "S"), ("user", "U")]


def test_templates():
    assert render.template_parts("a {filename} {{b}}") == ["a ", None, " {", "b}"]
    for bad in ("no placeholder", "{filename} {other}", "{filename:>5}"):
        with pytest.raises(ValueError):
            render.template_parts(bad)


def test_token_arrays(spark):
    df = spark.createDataFrame([([-100, 65, -100, 0],)], "ids array<bigint>")
    ids, n = F.col("ids"), F.lit(1)
    row = df.select(
        tokens.attention_mask(ids, 0).alias("m"),
        tokens.attention_mask(ids, None).alias("all"),
        tokens.replace_ignored(ids, None, 1).alias("eos"),
        tokens.replace_ignored(ids, 0, 1).alias("pad"),
        tokens.replace_ignored(ids).alias("zero"),
        tokens.truncate_ids(ids, 2).alias("cut"),
        tokens.generated_suffix(ids, n).alias("suffix"),
        tokens.generated_suffix(ids, F.lit(9)).alias("none"),
        tokens.generated_count(ids, n).alias("count"),
    ).first()
    assert row.m == [1, 1, 1, 0] and row.all == [1, 1, 1, 1]
    assert row.eos == [1, 65, 1, 0] and row.pad == [0, 65, 0, 0] == row.zero
    assert row.cut == [-100, 65] and row.suffix == [65, -100, 0] and row.none == [] and row["count"] == 3
