"""Scores of completions against labels."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediameta.functions.checks import same_object, score_flags, with_members
from mediameta.functions.jsontext import extract_json
from mediameta.functions.tokens import replace_ignored
from mediameta.operators.generate import decode_tokens
from mediameta.schema import METRICS
from mediameta.sources.pieces import number_rows


def pair_labels(predictions: DataFrame, labels: DataFrame, key: str = "id") -> DataFrame:
    """Every prediction with its label, or null. A second label of one key raises: it would change all denominators."""
    rest = [c for c in labels.columns if c != key]
    twice = F.raise_error(F.concat(F.lit("more than one label for "), F.col(key).cast("string"))).cast("boolean")
    single = labels.groupBy(key).agg(F.count(F.lit(1)).alias("_labels"), *[F.any_value(c).alias(c) for c in rest])
    checked = single.filter(F.when(F.col(key).isNull() | (F.col("_labels") == 1), True).otherwise(twice))
    return predictions.join(checked.drop("_labels"), key, "left")


def pair_positions(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """The n-th prediction beside the n-th label, as far as both go, with their ``position``.

    Both are plain file scans without a column of one name. Each numbers its own rows by its files' pieces, nothing is
    copied or sorted, and rows meet by number, so they spread evenly. What the longer side has beyond is left out.
    """
    clash = set(predictions.columns) & set(labels.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    return number_rows(predictions, "position").join(number_rows(labels, "position"), "position")


def score_rows(df: DataFrame, pred: str = "pred", label: str = "label", mode: str = "native") -> DataFrame:
    """Add the six row flags. The label object is read only for the equality."""
    work = extract_json(df, pred, "_pred", mode=mode)
    work = extract_json(work, label, "_label", mode=mode)
    work, p, drop_p = with_members(work, "_pred")
    work, t, drop_t = with_members(work, "_label")
    flags = score_flags(p)
    flags["exact_json_match"] = flags["json_validity"] & t.non_empty() & same_object(p, t)
    return work.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in flags.items()}).drop(
        "_pred", "_pred_error", "_label", "_label_error", *drop_p, *drop_t
    )


def score_completions(
    df: DataFrame, pred: str = "pred", label: str = "label", mode: str = "native"
) -> DataFrame:
    """One row of six ratios over all predictions; zeros for no rows and for logits."""
    kind = df.schema[pred].dataType
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType):
        warnings.warn("predictions are logits, not completions; all scores are zero", stacklevel=2)
        return df.agg(*[F.coalesce(F.avg(F.size(pred) * F.lit(0.0)), F.lit(0.0)).alias(m) for m in METRICS])
    if not isinstance(kind, T.StringType):
        raise TypeError("decode token ids to text before scoring")
    flags = score_rows(df, pred, label, mode)
    return flags.agg(*[F.coalesce(F.avg(F.col(m).cast("double")), F.lit(0.0)).alias(m) for m in METRICS])


def score_token_ids(
    df: DataFrame,
    make_decoder: Callable,
    *,
    pred: str = "pred_ids",
    label: str = "label_ids",
    pad_id: int | None = 0,
    end_id: int | None = None,
    mode: str = "native",
) -> DataFrame:
    """``score_completions`` of id arrays: ignore markers are replaced on both sides, ids decoded, texts scored."""
    ready = df.select(
        replace_ignored(F.col(pred), pad_id, end_id).alias("_pred"), replace_ignored(F.col(label), pad_id, end_id).alias("_label")
    )
    texts = decode_tokens(decode_tokens(ready, "_pred", "pred", make_decoder), "_label", "label", make_decoder)
    return score_completions(texts.select("pred", "label"), mode=mode)
