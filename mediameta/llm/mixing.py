"""Operator 6, mixing sources to target weights: weighted fair queueing, with DataFrame functions only.

Each source queues its documents in a seeded shuffled order, and may run through them ``EPOCHS`` times. A copy's virtual
finish time is the words of its source up to its end, divided by the source's weight. Served in order of finish time
until the total budget is spent, every source gets words in proportion to its weight, and what an exhausted source
leaves goes to the others by weight. The mix is that order, range-sorted over the whole table and cut at the budget.

The running words of a hot source do not go through one task: its order is cut into ranges of the shuffle
digest, whose totals are summed first. Only sources, one row each, pass an unpartitioned window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediameta.llm.common import WORDS, written

WEIGHTS = (1, 2, 3)
EPOCHS = 3
SEED = 17
#: Hex digits of the shuffle digest that name a cell: 4,096 per source.
DIGITS = 3


def words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """Source, source_size -> also sid (rank by code point, null last), weight, target, quota (its whole words).

    With all sizes as the budget, a source served at its weight for the virtual time v gets ``weight * v`` words, and at
    most ``epochs`` times its size. v solves the sum. Sources in order of the time they run dry: v is fixed at the first
    one that the rest of the budget does not exhaust.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    listed = sources.withColumn("sid", F.row_number().over(by_name)).withColumn(
        "weight", F.get(F.array(*[F.lit(w) for w in weights]), ((F.col("sid") - 1) % len(weights)).cast("int")).cast("long")
    )
    # Order by dry time size/weight, exactly: sizes times the product of the weights are whole numbers.
    product = 1
    for w in set(weights):
        product *= w
    dry = (F.col("source_size") * product / F.col("weight")).cast("decimal(38,0)")
    before = Window.orderBy(dry, "sid").rowsBetween(Window.unboundedPreceding, -1)
    here = Window.orderBy(dry, "sid").rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    solved = (
        listed.withColumn("__cap", F.col("source_size") * epochs)
        .withColumn("__left", F.sum("source_size").over(everything) - F.coalesce(F.sum("__cap").over(before), F.lit(0)))
        .withColumn("__open", F.sum("weight").over(here))
        .withColumn("__ends", F.col("__left") * F.col("weight") <= F.col("__cap") * F.col("__open"))
        .withColumn("__at", F.min(F.when(F.col("__ends"), F.struct(dry.alias("d"), "sid", "__left", "__open"))).over(everything))
    )
    open_ = F.struct(dry.alias("d"), F.col("sid")) >= F.struct(F.col("__at.d"), F.col("__at.sid"))
    share = F.col("weight") * (F.col("__at.__left").cast("double") / F.col("__at.__open").cast("double"))
    quota = F.expr("weight * __at.__left DIV __at.__open")
    return solved.select(
        "source", "source_size", "sid", "weight",
        F.when(open_, F.least(share, F.col("__cap").cast("double"))).otherwise(F.col("__cap").cast("double")).alias("target"),
        F.when(open_, F.least(quota, F.col("__cap"))).otherwise(F.col("__cap")).alias("quota"),
    )


def schedule(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, seed: int = SEED, digits: int = DIGITS,
) -> DataFrame:
    """One row per document: id, size, source, cell and place (its position), peer (its number among rows of
    the same id, source and size), start (the source's words before it), and
    the columns of ``targets``.

    Null text has size 0. Null sources are one source. Rows with equal ids are queued each for itself, by size.
    """
    sized = docs.select(docs[id_col].alias(id_col), docs[source_col].alias("source"), words(docs[text_col]).alias("size"))
    shuffled = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    sized = written(sized.withColumn("__h", shuffled).withColumn("cell", F.substring("__h", 1, digits)), "mix-sizes")
    cell = sized.groupBy("source", "cell").agg(F.sum("size").alias("__cell"))
    shares = targets(cell.groupBy("source").agg(F.sum("__cell").alias("source_size")), weights, epochs)
    firsts = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cell.select(F.col("source").alias("__s"), F.col("cell").alias("__c"), F.coalesce(F.sum("__cell").over(firsts), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("source", "cell").orderBy("__h", id_col, "size")
    placed = sized.withColumn("place", F.row_number().over(inside)).withColumn(
        "start", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    peers = Window.partitionBy("source", "cell", id_col, "size").orderBy("place")
    placed = placed.withColumn("peer", F.row_number().over(peers))
    starts = written(starts.join(shares, F.col("__s").eqNullSafe(F.col("source"))).drop("source"), "mix-starts")
    joined = placed.join(starts, placed["source"].eqNullSafe(starts["__s"]) & (placed["cell"] == starts["__c"]))
    return joined.select(
        id_col, "size", "source", "cell", "place", "peer", (F.col("start") + F.col("__base")).alias("start"),
        "source_size", "sid", "weight", "target", "quota",
    )


def copies(scheduled: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """The mix: each copy that begins within its source's quota, with epoch, finish time and words taken, range-sorted.

    The copy at the cut is taken in part: ``words`` may be less than ``size``. Documents without words are not in the mix.
    """
    each = scheduled.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    begin = F.col("start") + F.col("epoch") * F.col("source_size")
    taken = F.greatest(F.least(F.col("size"), F.col("quota") - begin), F.lit(0))
    each = each.withColumn("words", taken).withColumn("finish", (begin + F.col("size")).cast("double") / F.col("weight"))
    order = ["finish", "sid", "cell", "place", "epoch"]
    return each.filter("words > 0").repartitionByRange(*order).sortWithinPartitions(*order)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", epochs: int = EPOCHS, **options) -> DataFrame:
    """Whole documents in mix order, with all their columns; one may come up to ``epochs`` times.

    A copy at a source's cut comes if at least half of it lies within. Documents without words do not come. Rows that
    share id, source and size come each as often as the first of them.
    """
    queue = copies(schedule(docs, id_col, text_col, source_col, epochs=epochs, **options), epochs)
    whole = queue.filter((F.col("words") * 2 >= F.col("size")) & (F.col("peer") == 1))
    order = ["finish", "sid", "cell", "place", "epoch"]
    whole = whole.select(F.col(id_col).alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__words"), *order)
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    i, t, s = (f"c{docs.columns.index(c)}" for c in (id_col, text_col, source_col))
    rows = named.withColumn("__size", words(F.col(t)))
    on = rows[i].eqNullSafe(whole["__id"]) & rows[s].eqNullSafe(whole["__source"]) & (rows["__size"] == whole["__words"])
    served = rows.join(whole, on).repartitionByRange(*order).sortWithinPartitions(*order)
    return served.select(*named.columns).toDF(*docs.columns)
