"""From raw table to training texts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediameta.functions import render
from mediameta.operators.clean import clean_metadata, require_episode
from mediameta.operators.profile import write_and_profile
from mediameta.operators.split import train_eval
from mediameta.schema import ISSUES, Params
from mediameta.sources.tables import manifest_row, write_manifest, write_training_text


def training_examples(clean: DataFrame, system: str, template: str = render.USER_TEMPLATE) -> DataFrame:
    """(row_id, text) of each cleaned row."""
    user = render.user_prompt(F.col("name"), template)
    return clean.select(
        "row_id", render.training_text(F.lit(system), user, render.row_target_json()).alias("text")
    )


@dataclass(frozen=True)
class Prepared:
    """The lazy results of one preparation run."""

    clean: DataFrame
    kept: DataFrame
    train: DataFrame
    evaluation: DataFrame


def prepare(raw: DataFrame, system: str, template: str = render.USER_TEMPLATE, params: Params | None = None) -> Prepared:
    """Clean, filter, split and render.

    The split reads its input several times; for costly sources write ``clean``
    to a table first and pass that on.
    """
    params = params or Params()
    clean = clean_metadata(raw)
    kept = require_episode(clean) if params.require_episode else clean
    train, held = train_eval(kept, params.eval_fraction, cap=params.eval_max_samples, seed=params.seed)
    return Prepared(
        clean, kept, training_examples(train, system, template), training_examples(held, system, template)
    )


def prepare_run(
    raw: DataFrame, out: str, system: str, template: str = render.USER_TEMPLATE, params: Params | None = None, version: str = "unknown"
) -> DataFrame:
    """The whole preparation: clean, guard, report, split, render, and write it all under ``out``.

    ``clean`` (Parquet, the input of all that follows), ``profile``, ``issues``, ``train``, ``evaluation`` and
    ``manifest``. The counts in these come from the pass that writes ``clean``; only duplicates take another, over the
    names alone. Raises ``RuntimeError`` when no row is left. Returns the manifest.
    """
    params = params or Params()
    spark = raw.sparkSession
    report = write_and_profile(clean_metadata(raw), f"{out}/clean", params.max_name_len)
    counts = report.first()
    spark.createDataFrame([counts], report.schema).coalesce(1).write.json(f"{out}/profile")
    totals = spark.createDataFrame([(i, counts[i]) for i in ISSUES], "issue string, n long")
    totals.coalesce(1).write.json(f"{out}/issues")
    left = counts["row_count"] - (counts["episode_nulls"] if params.require_episode else 0)
    if not left:
        raise RuntimeError("no rows with an episode are left; the episode column is not readable")
    clean = spark.read.parquet(f"{out}/clean")
    kept = require_episode(clean) if params.require_episode else clean
    train, evaluation = train_eval(kept, params.eval_fraction, cap=params.eval_max_samples, seed=params.seed)
    write_training_text(training_examples(train, system, template), f"{out}/train")
    write_training_text(training_examples(evaluation, system, template), f"{out}/evaluation")
    write_manifest(manifest_row(spark, left, params.as_dict(), version), f"{out}/manifest")
    return spark.read.json(f"{out}/manifest")
