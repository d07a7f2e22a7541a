"""Reproducible split, sample, cap and packing.

Membership depends on row id and seed alone, never on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediameta.operators.ordering import balanced_ranges, first_by_hash, order_key
from mediameta.sources.storage import materialize


def eval_size(total: Column, fraction: float, cap: int | None = None) -> Column:
    """ceil(total * fraction), at most ``cap``."""
    size = F.ceil(total.cast("double") * F.lit(float(fraction)))
    return size if cap is None else F.least(size, F.lit(cap).cast("bigint"))


def assign_split(
    df: DataFrame, fraction: float = 0.1, *, cap: int | None = None, seed: int = 14789, row_id: str = "row_id"
) -> DataFrame:
    """Add ``split`` (``train`` or ``eval``); exactly ceil(n * fraction) rows are ``eval``.

    With ``cap`` only so many first ones of them are, in split order, and the others ``unused``. Both limits come from one
    pass over the ids.
    """
    if cap is None:
        (held,) = first_by_hash(df, row_id, seed, lambda n: eval_size(n, fraction))
        return df.withColumn("split", F.when(held, "eval").otherwise("train"))
    held, chosen = first_by_hash(df, row_id, seed, lambda n: eval_size(n, fraction), lambda n: eval_size(n, fraction, cap))
    return df.withColumn("split", F.when(chosen, "eval").when(held, "unused").otherwise("train"))


def train_eval(df: DataFrame, fraction: float = 0.1, **options) -> tuple[DataFrame, DataFrame]:
    """The two sides of ``assign_split``."""
    both = assign_split(df, fraction, **options)
    return tuple(both.filter(F.col("split") == s).drop("split") for s in ("train", "eval"))


def capped_eval(
    df: DataFrame, cap: int, fraction: float = 0.1, *, seed: int = 14789, row_id: str = "row_id"
) -> DataFrame:
    """The first ``cap`` eval rows in split order, found by rank like the split itself."""
    return df.filter(first_by_hash(df, row_id, seed, lambda n: eval_size(n, fraction, cap))[0])


def sample_rows(df: DataFrame, n: int = 5, *, seed: int = 14789, row_id: str = "row_id") -> DataFrame:
    """A few rows without replacement, for reading: a distributed top-n."""
    return df.orderBy(order_key(F.col(row_id), seed), row_id).limit(n)


def short_run(df: DataFrame, n: int = 1, row_id: str = "row_id") -> DataFrame:
    """The first rows by id, to try a model on."""
    return df.orderBy(row_id).limit(n)


def pack_sequences(
    df: DataFrame,
    length: Column,
    limit: int = 2048,
    *,
    row_id: str = "row_id",
    rows_per_bucket: int = 4096,
) -> DataFrame:
    """(row_id, n_tokens, bucket, sequence, start): where each example begins in its packed sequence.

    Examples are laid end to end in order of their ids and cut every ``limit`` tokens, anew in each bucket: a range of
    row ids, named by its start, with at most ``rows_per_bucket`` rows, however the ids are spread. So no window grows
    with the table. Row ids must be unique.
    """
    lengths = materialize(df.select(F.col(row_id), length.cast("bigint").alias("n_tokens")), "lengths")
    sized = balanced_ranges(lengths, row_id, rows_per_bucket)
    before = Window.partitionBy("bucket").orderBy(row_id).rowsBetween(Window.unboundedPreceding, -1)
    return sized.withColumn("_at", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).select(
        row_id,
        "n_tokens",
        "bucket",
        F.floor(F.col("_at") / limit).cast("bigint").alias("sequence"),
        (F.col("_at") % limit).alias("start"),
    )
