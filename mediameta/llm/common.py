"""What several corpus operators share: word patterns, tables in the shared folder, lookups that bear hot keys."""

from __future__ import annotations

import gc
import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediameta.sources.storage import scratch_path

# White space and words of the corpus contracts.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"

#: A key is hot when it holds more than one row in this many, so there are fewer hot keys than this.
HOT_SHARE = 1000


def kept_by_worker() -> dict:
    """What this worker keeps between tasks. Functions are sent to workers by value, so it is kept with the interpreter."""
    return sys.__dict__.setdefault("_mediameta_kept", {})


def forget_kept() -> None:
    """Drop what another operator's tasks have left in this worker: a worker lives on through all stages of a pipeline."""
    if kept_by_worker():
        kept_by_worker().clear()
        gc.collect()
    pa.default_memory_pool().release_unused()


def keep(name: str, make: Callable[[], object]):
    """The thing of this name that this worker keeps, made when it has none; it keeps one at a time."""
    if name not in kept_by_worker():
        forget_kept()
        kept_by_worker()[name] = make()
    return kept_by_worker()[name]


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which all executors share."""
    return scratch_path(spark, label)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a frame as Parquet to the shared folder and read it back: it is computed once and its lineage ends."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def look_up(rows: DataFrame, index: DataFrame, key: str | list[str], count: str) -> DataFrame:
    """Inner join of ``rows`` with ``index``, which has one row per key and the key's number of rows in ``count``.

    Both are read more than once, so give written tables. Keys with over a ``HOT_SHARE``-th of all rows, fewer than
    ``HOT_SHARE`` by arithmetic, are broadcast, and their rows stay where they are; the rest joins by key, where adaptive
    execution splits what is still uneven. Rows with a null key have no match.
    """
    total = index.agg(F.sum(count)).first()[0] or 0
    hot, cold = index.filter(F.col(count) * HOT_SHARE > total), index.filter(F.col(count) * HOT_SHARE <= total)
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key))


def row_keys(docs: DataFrame, id_col: str, text_col: str, label: str) -> DataFrame:
    """``docs`` with __key: a row's id where no other row has it, else a digest of id and text, which comes behind most ids.

    So rows that share an id, or have none, are told apart unless they are equal in id and text.
    """
    i = F.col(id_col).cast("long")
    repeated = written(docs.filter(i.isNotNull()).groupBy(i.alias("__repeated")).count().filter("count > 1").select("__repeated"), label)
    digest = F.shiftrightunsigned(F.xxhash64(i, text_col), 2).bitwiseOR(F.lit(1 << 62))
    joined = docs.join(repeated, i == repeated["__repeated"], "left")
    return joined.withColumn("__key", F.when(i.isNull() | F.col("__repeated").isNotNull(), digest).otherwise(i)).drop("__repeated")
