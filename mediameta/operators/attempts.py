"""Choice among stored generation attempts, and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediameta.functions.checks import validate_objects
from mediameta.functions.jsontext import extract_json
from mediameta.schema import ATTEMPT_SCHEDULE

# Failed attempts count down from here.
_LAST = 1 << 40
NO_ATTEMPTS = "no generation attempts: max_retries <= 0"


def judge_attempts(df: DataFrame, *, require_episode: bool = True) -> DataFrame:
    """Add ``obj``, ``errors`` and ``ok`` to each attempt's ``decoded`` text.

    An empty object fails, like a text without an object.
    """
    found = extract_json(df, "decoded", "obj", retry=False)
    checked = validate_objects(found, "obj", "errors", require_episode=require_episode)
    return checked.withColumn("ok", F.size("errors") == 0).drop("obj_error")


def first_valid_attempt(
    df: DataFrame, *, max_retries: int = 3, require_episode: bool = True, key: str = "id"
) -> DataFrame:
    """Per key the first valid attempt, else the last one, as a generation record.

    Every key gets a record; one without an attempt in the allowed range gets the empty one. Attempts are unique per key.
    Judging leaves one number per attempt, whose minimum is a hash aggregate combined map-side. Only the chosen
    attempts' texts are then fetched, and judged once more for the record.
    """
    schedule = ATTEMPT_SCHEDULE[: max(max_retries, 0)]
    if not schedule:
        return df.select(key).distinct().select(key, *empty_record())
    inside = F.coalesce(F.col("attempt").between(1, len(schedule)), F.lit(False))
    tried = judge_attempts(df.select(key, "attempt", F.when(inside, F.col("decoded")).alias("decoded")), require_episode=require_episode)
    number = F.col("attempt").cast("bigint")
    code = F.when(inside, F.when(F.col("ok"), number).otherwise(_LAST - number))
    best = tried.groupBy(key).agg(F.min(code).alias("_code")).select(
        F.col(key).alias("_key"), F.when(F.col("_code") < _LAST // 2, F.col("_code")).otherwise(_LAST - F.col("_code")).alias("_attempt")
    )
    given = df.select(key, number.alias("attempt"), "gen_tokens", "decoded")
    rows = best.join(given, best["_key"].eqNullSafe(given[key]) & (best["_attempt"] == given["attempt"]), "left")
    judged = judge_attempts(rows, require_episode=require_episode)
    none = F.col("_attempt").isNull()
    temperature = F.array(*[F.lit(t) for t, _ in schedule])
    top_p = F.array(*[F.lit(p) for _, p in schedule])
    at = F.col("_attempt").cast("int")
    record = [
        F.when(F.col("ok") & ~none, "ok").otherwise("fail").alias("status"),
        at.alias("attempt"),
        F.get(temperature, at - 1).alias("temperature"),
        F.get(top_p, at - 1).alias("top_p"),
        F.col("gen_tokens").cast("int").alias("gen_tokens"),
        F.col("decoded").alias("decoded"),
        F.col("obj").alias("obj"),
        F.col("errors").alias("errors"),
    ]
    names = ["status", "attempt", "temperature", "top_p", "gen_tokens", "decoded", "obj", "errors"]
    chosen = [F.when(none, e).otherwise(r).alias(n) for n, e, r in zip(names, empty_record(), record, strict=True)]
    return judged.select(F.col("_key").alias(key), *chosen)


def empty_record() -> list[Column]:
    """The record of a run in which no attempt was allowed."""
    null = F.lit(None)
    return [
        F.lit("fail").alias("status"),
        F.lit(0).alias("attempt"),
        null.cast("double").alias("temperature"),
        null.cast("double").alias("top_p"),
        F.lit(0).alias("gen_tokens"),
        F.lit("").alias("decoded"),
        null.cast("string").alias("obj"),
        F.array(F.lit(NO_ATTEMPTS)).alias("errors"),
    ]


def run_summary(records: DataFrame) -> DataFrame:
    """Per status: records, tokens, attempts; and seconds when the records carry them."""
    seconds = [F.sum("seconds").alias("seconds")] if "seconds" in records.columns else []
    return records.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("gen_tokens").alias("gen_tokens"),
        F.sum("attempt").alias("attempts"),
        F.max("attempt").alias("max_attempt"),
        *seconds,
    )
