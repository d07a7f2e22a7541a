"""Profile of a cleaned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from mediameta.operators.ordering import exact_quantiles
from mediameta.operators.quality import row_issues
from mediameta.operators.split import sample_rows
from mediameta.schema import ISSUES, RAW_COLUMNS


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the row count and the null count per column, in one aggregate."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in RAW_COLUMNS],
    )


def describe_column(df: DataFrame, column: str) -> DataFrame:
    """One row: count, mean, std (n-1), min, quartiles (linear interpolation), max over non-null values.

    An empty column gives count 0 and nulls.
    """
    basic = df.agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).cast("double").alias("min"),
        F.max(column).cast("double").alias("max"),
    )
    quartiles = exact_quantiles(df, column, [0.25, 0.5, 0.75]).scalar()
    return basic.withColumn("_q", quartiles).select(
        "count",
        "mean",
        "std",
        "min",
        F.get("_q", F.lit(0)).alias("q25"),
        F.get("_q", F.lit(1)).alias("q50"),
        F.get("_q", F.lit(2)).alias("q75"),
        "max",
    )


def value_counts(df: DataFrame, column: str, top: int = 20) -> DataFrame:
    """(value, n) of the most frequent non-null values; ties by smaller value."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "value")
        .limit(top)
    )


def coverage(df: DataFrame, column: str) -> DataFrame:
    """One row: the share of non-null values in percent."""
    return df.agg(F.avg(F.when(F.col(column).isNotNull(), 100.0).otherwise(0.0)).alias("percent"))


def profile(df: DataFrame, *, seed: int = 14789, sample: int = 5) -> dict[str, DataFrame]:
    """The parts of the report by name, all lazy; cache or write ``df`` before using several."""
    return {
        "nulls": null_counts(df),
        "episode": describe_column(df, "episode"),
        "episode_values": value_counts(df, "episode"),
        "season_coverage": coverage(df, "season"),
        "confidence": describe_column(df, "confidence"),
        "sample": sample_rows(df, sample, seed=seed),
    }


def write_and_profile(df: DataFrame, path: str, max_name_len: int = 200) -> DataFrame:
    """Write a cleaned table as Parquet to ``path``; returns one row of what was counted while it was written.

    Rows, nulls per column, season coverage in percent, count, mean, std, least and greatest episode and confidence, and
    the four issue totals. Duplicate names need all names together, so these alone are counted afterwards, from the
    written names. Observed counts are of the tasks that write, so a task that is run again counts once.
    """
    described = [
        f(F.col(c)).alias(f"{c}_{name}")
        for c in ("episode", "confidence")
        for name, f in (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
    ]
    issues = [F.count_if(condition).alias(issue) for issue, condition in row_issues(max_name_len).items()]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in RAW_COLUMNS]
    covered = F.avg(F.when(F.col("season").isNotNull(), 100.0).otherwise(0.0)).alias("season_coverage")
    seen = Observation("profile")
    df.observe(seen, F.count(F.lit(1)).alias("row_count"), *nulls, covered, *described, *issues).write.parquet(path)
    found = seen.get
    spark = df.sparkSession
    names = spark.read.schema(df.schema).parquet(path).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    repeated = names.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias(ISSUES[1]))
    kinds = {"mean": "double", "std": "double", "coverage": "double"} | {"confidence_min": "double", "confidence_max": "double"}
    kind = lambda c: kinds.get(c, kinds.get(c.rsplit("_", 1)[-1], "bigint"))
    return repeated.select(*[F.lit(v).cast(kind(c)).alias(c) for c, v in found.items()], F.col(ISSUES[1]).cast("bigint"))
