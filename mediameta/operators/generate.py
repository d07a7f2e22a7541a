"""Distributed batch generation with a caller's model, and token decoding."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediameta.functions import render
from mediameta.functions.checks import MESSAGES
from mediameta.functions.jsontext import python_extract, python_stops, python_truncate
from mediameta.operators.attempts import empty_record
from mediameta.schema import ATTEMPT_SCHEDULE, GENERATION_SCHEMA, TARGET_KEYS

#: The column of a store that names the prompt.
DIGEST = "prompt_sha256"

# generate(prompts, temperature, top_p) -> one (text, token count) or text per prompt
Generator = Callable[[list[str], float, float], Sequence]


def batch_generate(
    df: DataFrame,
    make_generator: Callable[[], Generator],
    *,
    prompt: str = "prompt",
    max_retries: int = 3,
    require_episode: bool = True,
    cut: bool = False,
) -> DataFrame:
    """Replace ``prompt`` by the generation record and ``seconds`` of each row.

    ``make_generator`` must be picklable; it runs once per task, so a model is
    loaded once. Every round calls the model only for rows that still fail.
    ``cut`` ends each answer where generation should have stopped: at a chat tag
    or the end of the first object; a count of words then follows the cut text.
    The other columns pass through. Set the batch size with
    ``spark.sql.execution.arrow.maxRecordsPerBatch``.
    """
    kept = [f for f in df.schema.fields if f.name != prompt]
    schedule = ATTEMPT_SCHEDULE[: max(max_retries, 0)]
    if not schedule:
        return df.select(*[f.name for f in kept], *empty_record(), F.lit(0.0).alias("seconds"))

    schema = T.StructType([*kept, *GENERATION_SCHEMA.fields, T.StructField("seconds", T.DoubleType())])
    names = [f.name for f in kept]
    fields = [f.name for f in GENERATION_SCHEMA.fields] + ["seconds"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generate = make_generator()
        for batch in batches:
            records = _rounds(list(batch[prompt]), generate, schedule, require_episode, cut)
            made = pd.DataFrame(records, columns=fields, index=batch.index)
            yield pd.concat([batch[names], made], axis=1)

    return df.mapInPandas(run, schema)


def stored_results(spark: SparkSession, store: str, key: T.StructField) -> DataFrame:
    """The records in a store of ``generate_resumable`` so far; a new store is begun without any."""
    schema = T.StructType([key, T.StructField(DIGEST, T.StringType()), *GENERATION_SCHEMA.fields, T.StructField("seconds", T.DoubleType())])
    spark.createDataFrame([], schema).write.mode("ignore").parquet(store)
    return spark.read.schema(schema).parquet(store)


def generate_resumable(
    df: DataFrame,
    make_generator: Callable[[], Generator],
    store: str,
    *,
    row_id: str = "row_id",
    prompt: str = "prompt",
    waves: int = 8,
    **options,
) -> DataFrame:
    """``batch_generate`` that goes on where a run was ended: the model is called for rows without a stored answer only.

    ``store`` is a folder that only grows. Records are kept by row id and a digest of the prompt, so a changed prompt is
    answered anew and old answers stay. Open rows go in ``waves``, each a job that appends when all its tasks are done: a
    killed run loses one wave at most, and what it leaves unfinished is not read. Rows are dealt to tasks by digest and
    sorted by the prompt's length, so tasks have equal shares and a batch holds prompts of like length. Row ids may be
    null; rows of one id and prompt share one answer. Options are those of ``batch_generate``.
    """
    spark = df.sparkSession
    digest = F.coalesce(F.sha2(prompt, 256), F.lit(""))
    wanted = df.select(F.col(row_id), F.col(prompt), digest.alias(DIGEST)).dropDuplicates([row_id, DIGEST])
    key = df.schema[row_id]
    for wave in range(waves):
        part = wanted.filter(F.pmod(F.xxhash64(row_id, DIGEST), F.lit(waves)) == wave)
        done = stored_results(spark, store, key).select(F.col(row_id).alias("_id"), F.col(DIGEST).alias("_digest"))
        same = part[row_id].eqNullSafe(done["_id"]) & (part[DIGEST] == done["_digest"])
        still = part.join(done, same, "left_anti").repartition(DIGEST, row_id)
        batches = still.withColumn("_length", F.length(prompt)).sortWithinPartitions("_length", DIGEST).drop("_length")
        batch_generate(batches, make_generator, prompt=prompt, **options).write.mode("append").parquet(store)
    found = stored_results(spark, store, key)
    # A record stored twice, by two runs at once, counts once.
    single = found.dropDuplicates([row_id, DIGEST]).select(F.col(row_id).alias("_id"), F.col(DIGEST).alias("_digest"), *[F.col(c) for c in found.columns[2:]])
    rows = df.withColumn("_wanted", digest)
    joined = rows.join(single, rows[row_id].eqNullSafe(single["_id"]) & (rows["_wanted"] == single["_digest"]), "left")
    return joined.drop("_wanted", "_id", "_digest", prompt)


def infer_metadata(
    names: DataFrame,
    make_generator: Callable[[], Generator],
    system: str,
    template: str = render.USER_TEMPLATE,
    *,
    name: str = "name",
    **options,
) -> DataFrame:
    """The whole chain for filenames: prompt, generation, cut, extraction, checks, retries; one record per row."""
    prompt = render.inference_prompt(F.lit(system), render.user_prompt(F.col(name), template))
    return batch_generate(names.withColumn("_prompt", prompt), make_generator, prompt="_prompt", cut=True, **options)


def _rounds(prompts: list[str], generate: Generator, schedule, require_episode: bool, cut: bool) -> list[tuple]:
    """One record per prompt: the first valid answer, else the last one."""
    records: list[tuple] = [()] * len(prompts)
    open_rows = list(range(len(prompts)))
    spent = [0.0] * len(prompts)
    for attempt, (temperature, top_p) in enumerate(schedule, 1):
        if not open_rows:
            break
        began = time.monotonic()
        answers = generate([prompts[i] for i in open_rows], temperature, top_p)
        share = (time.monotonic() - began) / len(open_rows)
        failing = []
        for i, answer in zip(open_rows, answers, strict=True):
            text, tokens = answer if isinstance(answer, tuple) else (answer, None)
            text = (python_truncate(text) if cut else text).strip()
            tokens = len(text.split()) if tokens is None else tokens
            spent[i] += share
            obj, error = python_extract(text, retry=False, after_tag=False)
            if obj is None:
                errors = [error]
            elif obj == "{}":
                errors = ["empty object"]
            else:
                errors = object_errors_of(json.loads(obj), require_episode)
            status = "fail" if errors else "ok"
            records[i] = (status, attempt, temperature, top_p, tokens, text, obj, errors, spent[i])
            if errors:
                failing.append(i)
        open_rows = failing
    return records


def object_errors_of(obj: dict, require_episode: bool) -> list[str]:
    """The checks of ``functions.checks.object_errors`` for one object inside a generation task."""
    crc, confidence = obj.get("crc_hash"), obj.get("confidence")
    numeric = isinstance(confidence, int | float)
    keys = list(obj)
    t = MESSAGES
    rules = [
        (keys != TARGET_KEYS, f"{t['keys']}{keys}"),
        (not (isinstance(obj.get("show_name"), str) and obj["show_name"]), t["show_name"]),
        (not isinstance(obj.get("season"), int | None), t["season"]),
        (not isinstance(obj.get("episode"), int | None), t["episode"]),
        (require_episode and obj.get("episode") is None, t["required"]),
        (not isinstance(crc, str | None), t["crc_type"]),
        (isinstance(crc, str) and not re.fullmatch("[A-F0-9]{8}", crc), t["crc_form"]),
        (not numeric, t["confidence_type"]),
        (numeric and not 0.0 <= float(confidence) <= 1.0, t["confidence_range"]),
        (not isinstance(obj.get("reasoning"), str), t["reasoning"]),
    ]
    return [message for broken, message in rules if broken]


def truncate_token_stop(
    df: DataFrame, ids: str, out: str, make_decoder: Callable[[], Callable[[list[list[int]]], list[str]]], *, stop_on_tags: bool = False
) -> DataFrame:
    """Add ``out``, the ids generated when generation stops, ``<out>_text`` and ``stopped``.

    ``ids`` are the generated ids alone, without the prompt. After each id from the second on, generation stops if the
    text so far holds a closed first object, or with ``stop_on_tags`` a chat tag. Text only grows at its end, so the stop
    is found by halving: all rows of a batch decode one prefix per round. Null ids give null, and do not stop.
    """
    schema = "ids array<bigint>, text string, stopped boolean"

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        decode = make_decoder()
        for batch in batches:
            rows = [None if x is None else list(map(int, x)) for x in batch]
            given = [i for i, x in enumerate(rows) if x is not None]
            texts: list[str | None] = [None] * len(rows)
            for i, text in zip(given, decode([rows[i] for i in given]) if given else [], strict=True):
                texts[i] = text
            stopped = [x is not None and len(x) > 1 and python_stops(t, stop_on_tags) for x, t in zip(rows, texts, strict=True)]
            # The least number of ids at which it stops lies in (low, high].
            low = {i: 1 for i in given if stopped[i]}
            high = {i: len(rows[i]) for i in low}
            while open_rows := [i for i in low if high[i] - low[i] > 1]:
                middle = {i: (low[i] + high[i]) // 2 for i in open_rows}
                for i, text in zip(open_rows, decode([rows[i][: middle[i]] for i in open_rows]), strict=True):
                    if python_stops(text, stop_on_tags):
                        high[i], texts[i] = middle[i], text
                    else:
                        low[i] = middle[i]
            cut = [x if i not in high else x[: high[i]] for i, x in enumerate(rows)]
            yield pd.DataFrame({"ids": cut, "text": texts, "stopped": stopped})

    p = f"_{out}_stop"
    return df.withColumn(p, run(F.col(ids))).withColumns({out: F.col(f"{p}.ids"), f"{out}_text": F.col(f"{p}.text"), "stopped": F.col(f"{p}.stopped")}).drop(p)


def decode_tokens(
    df: DataFrame, ids: str, out: str, make_decoder: Callable[[], Callable[[list[list[int]]], list[str]]]
) -> DataFrame:
    """Add the decoded text of an id array; a text column passes through unchanged."""
    if isinstance(df.schema[ids].dataType, T.StringType):
        return df.withColumn(out, F.col(ids))

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = make_decoder()
        for batch in batches:
            present = batch.notna()
            texts = pd.Series([None] * len(batch), index=batch.index, dtype=object)
            if present.any():
                texts[present] = run([list(map(int, x)) for x in batch[present]])
            yield texts

    return df.withColumn(out, decode(F.col(ids)))
