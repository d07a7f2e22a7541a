"""Operator 10, exact deduplication: an extendible-hash index on shared files, built with DataFrame functions only.

1. Every text is normalised and hashed. Grouping by (bucket, hash, normalised text) compares bytes: copies meet in the
   map-side hash tables first, so of a text with a billion copies each task sends one. Rows with equal hash and other
   bytes stay apart and form a chain.
2. The directory starts with one bucket and doubles: a bucket with more texts than ``capacity`` is split by the next bit
   of the hash. The depth of each bucket follows from counts over ``2 ** MAX_DEPTH`` prefixes, a table of fixed size.
3. Owner tasks, each with a range of buckets, write the index: bucket, hash, chain position, digest, the row that stays,
   the number of copies. All later reads take those files, so a lost executor costs nothing.
4. Every document probes the index: its hash's slot in the directory names the bucket, there the hash names the chain,
   and along it the digest of the text. Hot texts probe a broadcast of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from mediameta.llm.common import SPACES, look_up, written

#: Entries a bucket holds before it is split.
CAPACITY = 200_000
#: The directory doubles at most this often; its size is then 65,536 slots. Beyond, buckets only grow.
MAX_DEPTH = 16


def normalised(text: Column) -> Column:
    """White space runs become one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def prefix(hashed: Column) -> Column:
    """The first ``MAX_DEPTH`` bits of the hash: the finest directory slot."""
    return F.shiftrightunsigned(hashed, 64 - MAX_DEPTH)


def directory(counts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(slot, depth, bucket) for each finest slot in ``counts`` (slot, entries).

    A slot's depth is the least number of bits at which its bucket has no more than ``capacity`` entries: what doubling
    with splits of overfull buckets reaches. All windows are over at most ``2 ** MAX_DEPTH`` rows.
    """
    deep = F.lit(MAX_DEPTH)
    out = counts
    for depth in range(MAX_DEPTH):
        w = Window.partitionBy(F.shiftright("slot", MAX_DEPTH - depth))
        out = out.withColumn(f"__{depth}", F.sum("entries").over(w))
    for depth in reversed(range(MAX_DEPTH)):
        deep = F.when(F.col(f"__{depth}") <= capacity, depth).otherwise(deep)
    out = out.select("slot", deep.cast("int").alias("depth"))
    return out.withColumn("bucket", F.expr(f"shiftleft(shiftright(slot, {MAX_DEPTH} - depth), {MAX_DEPTH} - depth)"))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """Write the index of all distinct normalised texts and its directory, and return both, read from their files.

    Index: bucket, hash, chain (1 for the first text with this hash), text_sha256, keep_id (smallest id, null if all are),
    group_size. Directory: slot, depth, bucket; at most ``2 ** MAX_DEPTH`` rows.
    """
    rows = docs.select(docs[id_col].alias("id"), normalised(docs[text_col]).alias("body"))
    rows = rows.withColumn("hash", F.xxhash64("body"))
    texts = rows.groupBy("hash", "body").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    entries = written(
        texts.select(
            prefix(F.col("hash")).alias("slot"), "hash", F.sha2(F.col("body").cast("binary"), 256).alias("text_sha256"), "keep_id", "group_size"
        ),
        "exact-entries",
    )
    slots = written(directory(entries.groupBy("slot").agg(F.count(F.lit(1)).alias("entries")), capacity), "exact-directory")
    chain = F.row_number().over(Window.partitionBy("bucket", "hash").orderBy("text_sha256"))
    owned = entries.join(F.broadcast(slots), "slot").repartitionByRange("bucket", "hash").withColumn("chain", chain)
    return written(owned.select("bucket", "hash", "chain", "text_sha256", "keep_id", "group_size"), "exact-index"), slots


def to_buckets(rows: DataFrame, slots: DataFrame, hashed: str) -> DataFrame:
    """Rows with the bucket that the directory names for their hash."""
    named = F.broadcast(slots.select(F.col("slot").alias("__slot"), "bucket"))
    return rows.join(named, prefix(F.col(hashed)) == F.col("__slot")).drop("__slot")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty ones. A row with a null id stays only if its whole group has null ids; repeated ids and
    rows are counted as they come, and each row with the kept id is marked kept. An empty table gives an empty result.
    """
    index, slots = build_index(docs, id_col, text_col, capacity)
    # By position, as the caller's id may have any name.
    body = normalised(docs[text_col])
    digests = docs.select(docs[id_col].alias("__id"), F.sha2(body.cast("binary"), 256).alias("text_sha256"), F.xxhash64(body).alias("hash"))
    rows = written(to_buckets(digests, slots, "hash"), "exact-rows")
    probe = index.select("bucket", "hash", "text_sha256", "keep_id", "group_size")
    found = look_up(rows, probe, ["bucket", "hash", "text_sha256"], "group_size")
    return found.select(F.col("__id").alias(id_col), "keep_id", "group_size", F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The documents that stay, with all their columns: one row of each group of equal texts.

    Of repeated rows with the kept id, the least by text and the other columns stays.
    """
    index, slots = build_index(docs, id_col, text_col, capacity)
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    i, t = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    body = normalised(F.col(t))
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    hashed = named.withColumns({"hash": F.xxhash64(body), "text_sha256": F.sha2(body.cast("binary"), 256), "__id": some(i)})
    rows = to_buckets(hashed, slots, "hash")
    # At most the rows that share both text and id come through, so the window below sees few rows at a time.
    keep = index.select("bucket", "hash", "text_sha256", some("keep_id").alias("__id"))
    stay = rows.join(keep, ["bucket", "hash", "text_sha256", "__id"])
    order = [F.col(c).asc_nulls_last() if not isinstance(named.schema[c].dataType, MapType | VariantType) else F.lit(0) for c in named.columns]
    ranked = stay.withColumn("__n", F.row_number().over(Window.partitionBy("bucket", "hash", "text_sha256", "__id").orderBy(*order)))
    return ranked.filter("__n = 1").select(*named.columns).toDF(*docs.columns)
