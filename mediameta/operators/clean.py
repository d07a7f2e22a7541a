"""Typed cleaning of labelled tables, and the episode filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediameta.functions.text import clean_text, normalize_crc, to_confidence, to_nullable_int
from mediameta.schema import canonical
from mediameta.sources.tables import read_labelled_csv


def clean_metadata(raw: DataFrame) -> DataFrame:
    """One projection from seven texts to the typed table; ``row_id`` is kept."""
    df = canonical(raw)
    return df.select(
        *(["row_id"] if "row_id" in df.columns else []),
        clean_text(F.col("name")).alias("name"),
        clean_text(F.col("show_name")).alias("show_name"),
        to_nullable_int(F.col("season")).alias("season"),
        to_nullable_int(F.col("episode")).alias("episode"),
        clean_text(F.col("reasoning")).alias("reasoning"),
        to_confidence(F.col("confidence")).alias("confidence"),
        normalize_crc(F.col("crc_hash")).alias("crc_hash"),
    )


def load_clean(spark: SparkSession, path: str, **options) -> DataFrame:
    """The cleaned table of a labelled CSV; options as for ``read_labelled_csv``."""
    return clean_metadata(read_labelled_csv(spark, path, **options))


def require_episode(df: DataFrame) -> DataFrame:
    """Rows with an episode."""
    return df.filter(F.col("episode").isNotNull())


def require_rows(df: DataFrame) -> DataFrame:
    """The frame itself, or ``RuntimeError`` when it is empty. Runs a job that stops at the first row."""
    if df.isEmpty():
        raise RuntimeError("no rows with an episode are left; the episode column is not readable")
    return df


def filter_counts(df: DataFrame) -> DataFrame:
    """One row: how many rows there are and how many have an episode."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count("episode").alias("rows_after")
    )
