"""Stable row ids in read order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediameta.sources.pieces import number_rows


def with_row_id(df: DataFrame, key: str | None = None) -> DataFrame:
    """Add ``row_id`` as the first column.

    With ``key`` the caller's unique column is used as it is. Otherwise the
    frame must be a plain file scan: ids count from 0 in the order of file name
    and position, whatever the number of partitions or the split size.
    """
    if key is None:
        return number_rows(df)
    rest = [c for c in df.columns if c not in (key, "row_id")]
    return df.select(F.col(key).cast("bigint").alias("row_id"), *rest)
