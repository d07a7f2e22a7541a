"""Issue detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediameta.functions.text import crc_matches
from mediameta.schema import ISSUES

# At most this many names are broadcast: the most frequent ones. The next one holds under a thousandth of all rows.
HOT_NAMES = 1_000
# Their rows are spread over this many keys.
HOT_SALTS = 1_024


def _long_name(limit: int) -> Column:
    return F.coalesce(F.length("name") > limit, F.lit(False))


def _bad_crc() -> Column:
    return F.coalesce(~crc_matches(F.col("crc_hash")), F.lit(False))


def row_issues(max_name_len: int = 200) -> dict[str, Column]:
    """The issues that a row has by itself, by name: all but duplicates."""
    conditions = [_long_name(max_name_len), None, _bad_crc(), F.col("episode").isNull()]
    return {issue: c for issue, c in zip(ISSUES, conditions, strict=True) if c is not None}


def with_name_count(
    df: DataFrame, name: str = "name", out: str = "name_count", *, hot_names: int = HOT_NAMES
) -> DataFrame:
    """Add how many rows share the row's name; nulls count as one name.

    Counting combines before its shuffle. Joining the counts back would send all
    rows of a hot name to one task, so the hottest names (a bounded number) come
    by broadcast and their rows are salted evenly over the shuffle, where
    they match nothing. The plan is the same at every size, and the result exact. Adaptive
    execution may split a lesser name's rows once more.
    """
    repeated = df.groupBy(name).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    hot = (
        repeated.orderBy(F.desc("_n"), name)
        .limit(hot_names)
        .select(F.col(name).alias("_hot_name"), F.col("_n").alias("_hot_n"))
    )
    cold = repeated.select(F.col(name).alias("_cold_name"), F.col("_n").alias("_cold_n"))
    marked = df.join(F.broadcast(hot), F.col(name).eqNullSafe(F.col("_hot_name")), "left")
    is_cold = F.col("_hot_n").isNull()
    spread = ["row_id"] if "row_id" in df.columns else df.columns
    salt = F.pmod(F.xxhash64(*spread), F.lit(HOT_SALTS)).cast("string")
    keyed = marked.withColumn("_key", F.when(is_cold, F.col(name)).otherwise(salt))
    # A salt that happens to equal a name is kept from matching by the second condition.
    joined = keyed.join(cold, F.col("_key").eqNullSafe(F.col("_cold_name")) & is_cold, "left")
    return joined.select(*df.columns, F.coalesce("_hot_n", "_cold_n", F.lit(1)).cast("bigint").alias(out))


def duplicate_names(df: DataFrame, **options) -> DataFrame:
    """All rows whose name occurs more than once, with the count."""
    return with_name_count(df, **options).filter("name_count > 1")


def issue_rows(df: DataFrame, max_name_len: int = 200, **options) -> DataFrame:
    """(issue, row_id), one row per issue of a row."""
    flagged = df.select(
        "row_id",
        "name",
        _long_name(max_name_len).alias("_long"),
        _bad_crc().alias("_crc"),
        F.col("episode").isNull().alias("_episode"),
    )
    counted = with_name_count(flagged, **options)
    found = [F.col("_long"), F.col("name_count") > 1, F.col("_crc"), F.col("_episode")]
    issues = F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in zip(ISSUES, found, strict=True)]))
    return counted.select(F.explode(issues).alias("issue"), "row_id")


def issue_counts(df: DataFrame, max_name_len: int = 200) -> DataFrame:
    """(issue, n) for all four issues, zeros included; one shuffle on the name, no join."""
    per_name = df.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(_bad_crc()).alias("crc"),
        F.count_if(F.col("episode").isNull()).alias("episode"),
    )

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    totals = per_name.agg(
        total(F.when(_long_name(max_name_len), F.col("n"))).alias(ISSUES[0]),
        total(F.when(F.col("n") > 1, F.col("n"))).alias(ISSUES[1]),
        total(F.col("crc")).alias(ISSUES[2]),
        total(F.col("episode")).alias(ISSUES[3]),
    )
    return totals.unpivot([], ISSUES, "issue", "n")

