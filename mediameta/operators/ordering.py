"""Exact selection by rank without a global sort.

A row's place is decided by comparing it with one cut value. The cut comes from
histograms of fixed size, so no task ever holds an ordered copy of the table,
and the last step is a filter-like projection without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediameta.sources.storage import materialize

# Digits of the hash used per histogram: 16^4 buckets at most.
_DIGITS = 4
_LEVELS = 2
# Buckets of a value histogram, and how often it is refined.
_BUCKETS = 65536
_ZOOMS = 5


def order_key(row_id: Column, seed: int) -> Column:
    """A pseudo-random but reproducible order: the md5 of seed and row id."""
    return F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")))


def rank_cuts(df: DataFrame, row_id: str, seed: int, ranks: Sequence[Callable[[Column], Column]]) -> DataFrame:
    """One row with ``cuts``: by number of the rank, (hash, row id) of the row at it; a rank of 0 has no entry.

    Each of ``ranks`` maps the row count to a wanted 1-based rank. Row ids must be unique and not null: others raise.
    Hashes and ids are written once to shared storage, so the source is read once for all ranks and levels. Each level
    counts rows per hash prefix in one histogram, finds the buckets that hold the ranks, and looks only into those; two
    levels leave n / 2^32 rows per rank.
    """
    sound = F.coalesce(F.col(row_id), F.raise_error(F.lit(f"null in {row_id}")).cast(df.schema[row_id].dataType))
    rows = materialize(df.select(order_key(sound, seed).alias("h"), F.col(row_id).alias("id")), "ranks")
    for level in range(_LEVELS):
        digits = F.substring("h", 1 + level * _DIGITS, _DIGITS)
        # At most 65,536 rows per rank reach these windows, whatever the table's size.
        if level == 0:
            hist = rows.groupBy(digits.alias("b")).agg(F.count(F.lit(1)).alias("n"))
            total = F.sum("n").over(Window.partitionBy())
            upto = F.sum("n").over(Window.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow))
            wanted = F.array(*[F.struct(F.lit(i).alias("i"), r(total).cast("bigint").alias("place")) for i, r in enumerate(ranks)])
            placed = hist.select("b", "n", upto.alias("upto"), wanted.alias("w")).select("b", "n", "upto", F.inline("w"))
        else:
            hist = rows.groupBy("i", digits.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.first("need").alias("place"))
            running = Window.partitionBy("i").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            placed = hist.select("i", "b", "n", F.sum("n").over(running).alias("upto"), "place")
        # One row per rank: the bucket in which it lies.
        target = placed.filter("upto - n < place and place <= upto").select(F.col("i").alias("_i"), "b", F.expr("place - (upto - n)").alias("_need"))
        same = (digits == F.col("b")) if level == 0 else (digits == F.col("b")) & (F.col("i") == F.col("_i"))
        rows = rows.join(F.broadcast(target), same).select("h", "id", F.col("_i").alias("i"), F.col("_need").alias("need"))
    last = Window.partitionBy("i").orderBy("h", "id")
    # Equal ids have equal hashes; where a cut falls on them, it is not one row.
    twin = F.lead("id").over(last).eqNullSafe(F.col("id")) | F.lag("id").over(last).eqNullSafe(F.col("id"))
    single = F.when(twin, F.raise_error(F.lit(f"{row_id} is not unique")).cast("boolean")).otherwise(True)
    found = rows.select("i", F.struct("h", "id").alias("cut"), "need", F.row_number().over(last).alias("r"), single.alias("ok")).filter("r = need and ok")
    return found.agg(F.map_from_entries(F.collect_list(F.struct("i", "cut"))).alias("cuts"))


def first_by_hash(df: DataFrame, row_id: str, seed: int, *ranks: Callable[[Column], Column]) -> list[Column]:
    """For each of ``ranks`` a column: true for the rows among so many first ones of the seeded order."""
    cuts = rank_cuts(df, row_id, seed, ranks).scalar()
    mine = F.struct(order_key(F.col(row_id), seed).alias("h"), F.col(row_id).alias("id"))
    return [F.coalesce(mine <= cuts[F.lit(i)], F.lit(False)) for i in range(len(ranks))]


def balanced_ranges(df: DataFrame, row_id: str, most: int, out: str = "bucket") -> DataFrame:
    """Add ``out``, the start of a range of row ids that holds at most ``most`` rows; ids are unique whole numbers.

    Ranges come from a histogram between the least and the greatest id, each as wide as ``most`` rows take on average. A bucket with more
    rows is divided the same way between its own least and greatest id, and so on, so neither outliers nor clusters fill
    a range. ``df`` is read once per level; evenly spread ids take one. More than ``most`` rows of one id raise.
    """
    lo, hi, n = F.col("__lo"), F.col("__hi"), F.col("__n")
    limits = [F.min(row_id).alias("__lo"), F.max(row_id).alias("__hi"), F.count(F.lit(1)).alias("__n")]
    # Whole numbers in decimals: ids may span more than a bigint holds.
    wide = lambda c: c.cast("decimal(20,0)")
    span, share = wide(hi) - wide(lo) + 1, F.lit(most).cast("decimal(10,0)")
    even = span * share + wide(n) - 1
    # As wide as ``most`` rows take on average, but no more than half.
    width = F.least(wide((even - even % wide(n)) / wide(n)), wide((span + 1 - (span + 1) % 2) / 2))
    at = F.col(row_id)
    inner = (wide(at) - wide(lo) - (wide(at) - wide(lo)) % width + wide(lo)).cast("bigint")
    whole = df.agg(*limits).select(F.when(n > most, F.struct("__lo", "__hi", "__n")).alias("s")).scalar()
    rows = df.withColumns({"__lo": whole["__lo"], "__hi": whole["__hi"], "__n": whole["__n"]})
    least = df.agg(F.min(row_id)).scalar()
    rows = rows.withColumn(out, F.when(n.isNull(), least).otherwise(inner)).drop("__lo", "__hi", "__n")
    while True:
        sizes = rows.groupBy(out).agg(*limits).filter(n > most)
        one = F.raise_error(F.concat(F.lit(f"too many rows of one {row_id}: "), lo.cast("string"))).cast("boolean")
        full = materialize(sizes.filter(F.when(lo < hi, True).otherwise(one)).withColumnRenamed(out, "__full"), "ranges")
        if full.isEmpty():
            return rows
        # Few of the ranges are full, or else the ids are; adaptive execution chooses how to join them.
        joined = rows.join(full, F.col(out) == F.col("__full"), "left")
        rows = joined.withColumn(out, F.when(n.isNull(), F.col(out)).otherwise(inner)).drop("__lo", "__hi", "__n", "__full")


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float]) -> DataFrame:
    """One row with the array ``q``: exact quantiles with linear interpolation; null without values.

    Nulls are ignored, other values must be finite. The values alone are written once to shared storage. Each level counts
    them in a histogram of at most ``_BUCKETS`` buckets per wanted bucket, combined map-side: first by the logarithm, then
    three times between the extremes of the buckets that hold the wanted ranks, at most two per probability. Four levels
    separate any two doubles, so what is left has one value per bucket, or a few neighbouring doubles, however the values
    are spread and repeated. No value is shuffled or sorted. The driver sees the wanted buckets, a few rows per level.
    """
    spark = df.sparkSession
    v = F.col("v")
    values = materialize(df.filter(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v")), "values")
    total = values.count()
    exact = [(total - 1) * float(p) for p in probs]
    places = sorted({int(r) for h in exact for r in (math.floor(h), math.ceil(h))}) if total else []
    # Wanted intervals of values: (least, greatest, values before).
    wanted: list[tuple[float, float, int]] = []
    sign = F.signum(v)
    bucket, group, kept = F.floor(sign * (F.log(F.abs(v)) + 800) * 20), F.lit(0), F.lit(True)
    bucket = F.when(v == 0, 0).otherwise(bucket)
    starts = {0: 0}
    for level in range(_ZOOMS + 1 if total else 0):
        if level:
            starts = {i: before for i, (_, _, before) in enumerate(wanted)}
            group = F.coalesce(*[F.when(v.between(lo, hi), i) for i, (lo, hi, _) in enumerate(wanted)])
            kept = group.isNotNull()
            bucket = F.coalesce(
                *[F.when(v.between(lo, hi), F.floor((v - lo) / (hi - lo) * _BUCKETS) if math.isfinite(hi - lo) and hi > lo else F.lit(0)) for lo, hi, _ in wanted]
            )
        hist = (
            values.filter(kept)
            .groupBy(group.alias("g"), bucket.alias("b"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        )
        before = F.create_map(*[F.lit(x).cast("bigint") for pair in starts.items() for x in pair])[F.col("g").cast("bigint")]
        # At most one histogram's rows per wanted interval.
        running = Window.partitionBy("g").orderBy("lo").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = hist.withColumn("start", before + F.sum("n").over(running) - F.col("n"))
        held = _any([(F.col("start") <= r) & (F.col("start") + F.col("n") > r) for r in places])
        wanted = sorted((r.lo, r.hi, r.start) for r in placed.filter(held).select("lo", "hi", "start").collect())
        if all(lo == hi for lo, hi, _ in wanted):
            break
    at = {r: next(lo for lo, _, start in reversed(wanted) if start <= r) for r in places}
    found = [at[math.floor(h)] + (at[math.ceil(h)] - at[math.floor(h)]) * (h - math.floor(h)) for h in exact] if total else None
    q = F.array(*[F.lit(x) for x in found]) if found else F.lit(None).cast("array<double>")
    return spark.range(1).select(q.alias("q"))


def _any(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out
