"""Operator 1, sharding: a lookup table that the shards fill in turns, each by its own permutation of the slots.

Every shard walks the slots of a prime-sized table in an order of its own (an offset and a step drawn from its name) and
in each turn claims its next free slot. Shares differ by at most one slot, and adding or removing a shard moves few slots
besides those it gains or loses. A document's key hashes to a slot, the broadcast table names the shard.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Production parameters: 64 shards, a prime table of about a thousand slots per shard.
SHARDS = tuple(f"shard-{i:04d}" for i in range(64))
SLOTS = 65_537


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def preference(shard: str, slots: int) -> tuple[int, int]:
    """Offset and step of the shard's walk; as ``slots`` is prime, every step visits all slots."""
    digest = hashlib.sha256(shard.encode()).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:16], "big") % (slots - 1) + 1


def fill(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> list[int]:
    """The table: for each slot the position of its shard in ``shards``. Its size is fixed by ``slots``."""
    if not is_prime(slots):
        raise ValueError("the table size must be a prime")
    if not 0 < len(shards) <= slots or len(set(shards)) < len(shards):
        raise ValueError("shards need distinct names, and at least a slot each")
    walks = [preference(s, slots) for s in shards]
    at = [offset for offset, _ in walks]
    table = [-1] * slots
    left = slots
    while left:
        for i, (_, step) in enumerate(walks):
            while table[at[i]] >= 0:
                at[i] = (at[i] + step) % slots
            table[at[i]] = i
            left -= 1
            if not left:
                break
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key, from 60 bits of its MD5 digest; a null key has the slot of the empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long") % slots


def table_frame(spark: SparkSession, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """The table as a frame (``slot``, ``shard``); ``slots`` rows, whatever the data."""
    names = F.array(*[F.lit(s) for s in shards])
    filled = F.lit(",".join(map(str, fill(shards, slots))))
    return spark.range(1).select(F.posexplode(F.split(filled, ",")).alias("slot", "i")).select(
        F.col("slot").cast("long").alias("slot"), F.get(names, F.col("i").cast("int")).alias("shard")
    )


def place(df: DataFrame, key: str = "doc_id", shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """All rows and columns of ``df`` with ``slot`` and ``shard``; nothing is shuffled.

    Null keys share the empty text's slot, equal keys share a shard, an empty table stays empty. Columns named ``slot`` or
    ``shard`` are replaced.
    """
    base = df.drop(*[c for c in df.columns if c.lower() in ("slot", "shard") and c != key])
    table = F.broadcast(table_frame(df.sparkSession, shards, slots))
    # By position, so that no column of the caller's is in the way.
    named = base.toDF(*[f"c{i}" for i in range(len(base.columns))])
    keyed = named.withColumn("at", slot_of(F.col(f"c{base.columns.index(key)}"), slots))
    joined = keyed.join(table, keyed["at"] == table["slot"])
    return joined.select(*named.columns, "slot", "shard").toDF(*base.columns, "slot", "shard")


def write_shards(df: DataFrame, path: str, key: str = "doc_id", parts: int = 4, **options) -> None:
    """Write one folder per shard with up to ``parts`` files each: the slot picks the file, so no task gets a whole shard."""
    placed = place(df, key, **options)
    placed.repartition("shard", F.col("slot") % parts).drop("slot").write.partitionBy("shard").parquet(path)
