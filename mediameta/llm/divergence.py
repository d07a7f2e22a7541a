"""How the sources of a language differ in their words, counted through a minimal acyclic transducer.

One pass finds in how many documents of its language each term occurs. The terms kept are range-sorted, and each range
becomes a transducer in a task of its own; ordinals count on from range to range. A second pass streams every whole text
through the transducers: a stretch of letters that reaches a final state counts for the ordinal summed on its way. From
there on terms are ordinals, also where equal values are ranked, and only the rows reported are turned back into words.

Transducers are broadcast in rounds of at most ``ROUND_BYTES``. A larger vocabulary takes more rounds, each one more pass
over the texts, so a task's memory does not grow with the corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from mediameta.llm.common import look_up, written
from mediameta.llm.transducer import Transducer

# Fixed values of the contract.
LEAST_DOCUMENTS, PRIOR, SCALE, TERMS_REPORTED = 30, 5, 1_000_000_000, 50
#: Terms and bytes of terms in one transducer, bytes of transducers in memory at once.
BLOCK_TERMS, BLOCK_BYTES, ROUND_BYTES = 1 << 17, 1 << 21, 64 << 20
#: Text handled at once, and counts that a task holds before it hands them on.
CHUNK_BYTES, HELD = 4 << 20, 400_000
#: Ordinals and sources compared in one tile.
TILE_TERMS, TILE_SOURCES = 2048, 256

# A byte of a term, with A-Z lower-cased, or a blank: terms are runs of letters and of anything beyond ASCII.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in held], pa.string()), pa.array([k[1] for k in held], pa.binary()), pa.array(held.values(), pa.int64())],
            ["lang", "term", "docs"],
        )

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1)), strict=True):
            held.update((lang, t) for t in set(text.translate(_BYTES).split()))
            if len(held) > HELD:
                yield out()
                held.clear()
    if held:
        yield out()


def _build_blocks(block_terms: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, terms, size = None, [], 0

        def out() -> pa.RecordBatch:
            row = [[lang], [terms[0]], [len(terms)], [Transducer.build(terms).pack()]]
            kinds = [pa.string(), pa.binary(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["lang", "first", "n", "data"])

        for batch in batches:
            for at, term in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if terms and (at != lang or len(terms) == block_terms or size + len(term) > block_bytes):
                    yield out()
                    terms, size = [], 0
                lang = at
                terms.append(term)
                size += len(term)
        if terms:
            yield out()

    return run


def vocabulary(docs: DataFrame, least: int = LEAST_DOCUMENTS, block_terms: int = BLOCK_TERMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, first, n, data, start): transducers of the terms in at least ``least`` documents of ``lang``, in byte order.

    ``docs`` has (lang, text) without nulls. ``start`` is the ordinal of the block's first term in its language.
    """
    spark = docs.sparkSession
    counts = docs.select("lang", "text").mapInArrow(_document_counts, "lang string, term binary, docs long")
    kept = written(counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least).select("lang", "term"), "divergence-terms")
    ranges = kept.count() // block_terms + 1
    ordered = kept.repartitionByRange(ranges, "lang", "term").sortWithinPartitions("lang", "term")
    blocks = written(ordered.mapInArrow(_build_blocks(block_terms, block_bytes), "lang string, first binary, n long, data binary"), "divergence-blocks")
    # One row per block: a hundred-thousandth of the terms, without the transducers themselves.
    before = Window.partitionBy("lang").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("lang", "first", "n").withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return written(blocks.join(starts.select("lang", "first", "start"), ["lang", "first"]), "divergence-vocabulary")


def rounds(blocks: DataFrame, limit: int = ROUND_BYTES) -> Iterator[dict[str, list[tuple[int, int, bytes]]]]:
    """The blocks by language, as (start, n, data), in lots of at most ``limit`` bytes (one block at least)."""
    sizes = blocks.select("lang", "start", F.length("data").alias("size")).orderBy("lang", "start").collect()
    lot: list = []
    for row in [*sizes, None]:
        if lot and (row is None or sum(r["size"] for r in lot) + row["size"] > limit):
            low, high = lot[0], lot[-1]
            lang, start = F.col("lang"), F.col("start")
            inside = ((lang > low["lang"]) | ((lang == low["lang"]) & (start >= low["start"]))) & (
                (lang < high["lang"]) | ((lang == high["lang"]) & (start <= high["start"]))
            )
            out: dict[str, list] = {}
            for b in blocks.filter(inside).select("lang", "start", "n", "data").collect():
                out.setdefault(b["lang"], []).append((b["start"], b["n"], bytes(b["data"])))
            yield out
            lot = []
        if row is not None:
            lot.append(row)


def _stream(shared):
    """Counts of (lang, source, ordinal): all terms of a chunk of texts walk through the transducers side by side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = {lang: [(start, Transducer.unpack(data)) for start, _, data in rows] for lang, rows in shared.value.items()}
        groups: dict[tuple[str, str], int] = {}
        keys, counts, held = [], [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            found, where = np.unique(np.concatenate(keys), return_inverse=True)
            return found, np.bincount(where, np.concatenate(counts), len(found)).astype(np.int64)

        def out() -> pa.RecordBatch:
            found, n = merged()
            names = list(groups)
            group = found >> 40
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([g[0] for g in names], pa.string()).take(pa.array(group)),
                    pa.array([g[1] for g in names], pa.string()).take(pa.array(group)),
                    pa.array(found & ((1 << 40) - 1)),
                    pa.array(n),
                ],
                ["lang", "source", "ordinal", "count"],
            )

        def count(lang: str, texts: list[bytes], group: list[int]) -> None:
            nonlocal held
            text = np.frombuffer(b" ".join(texts).translate(_BYTES), np.uint8)
            edge = np.diff(np.concatenate(([False], text != 32, [False])).astype(np.int8))
            starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            offsets = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
            owner = np.array(group, np.int64)[np.searchsorted(offsets, starts, "right") - 1] << 40
            for start, transducer in blocks[lang]:
                ordinal = transducer.ordinals(text, starts, ends - starts)
                hit = ordinal >= 0
                found, n = np.unique(owner[hit] + ordinal[hit] + start, return_counts=True)
                keys.append(found)
                counts.append(n)
                held += len(found)

        for batch in batches:
            lots: dict[str, tuple[list[bytes], list[int], int]] = {}
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _texts(batch.column(2)), strict=True):
                if lang not in blocks or not text:
                    continue
                texts, owners, size = lots.get(lang, ([], [], 0))
                texts.append(text)
                owners.append(groups.setdefault((lang, source), len(groups)))
                lots[lang] = (texts, owners, size + len(text))
                if size + len(text) > CHUNK_BYTES:
                    count(lang, texts, owners)
                    del lots[lang]
            for lang, (texts, owners, _) in lots.items():
                count(lang, texts, owners)
            if held > 2 * HELD:
                found, n = merged()
                keys, counts, held = [found], [n], len(found)
                if held > HELD:
                    yield out()
                    groups.clear()
                    keys, counts, held = [], [], 0
        if held:
            yield out()

    return run


def recount(docs: DataFrame, blocks: DataFrame, limit: int = ROUND_BYTES) -> DataFrame:
    """(lang, source, ordinal, count) of every kept term that occurs; one pass over ``docs`` per round of transducers."""
    spark = docs.sparkSession
    columns = "lang string, source string, ordinal long, count long"
    parts = [docs.select("lang", "source", "text").mapInArrow(_stream(spark.sparkContext.broadcast(lot)), columns) for lot in rounds(blocks, limit)]
    found = reduce(DataFrame.unionByName, parts, spark.createDataFrame([], columns))
    return found.groupBy("lang", "source", "ordinal").agg(F.sum("count").alias("count"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), in decimals; null without terms."""
    whole = lambda c: c.cast("decimal(19,0)")
    top, base = whole(count + PRIOR) * F.lit(SCALE).cast("decimal(10,0)"), whole(total + PRIOR * terms)
    # The remainder makes the quotient whole before it is rounded.
    return F.when(terms > 0, (((top - top % base) / base).cast("decimal(19,0)") + 1).cast("long"))


def _tile(terms: int):
    def run(key, rows):
        import pandas as pd

        lang, _, a, b = key
        # So that a pair has the same order in every block.
        rows = rows.sort_values("source", ignore_index=True)
        width = int(rows["width"].iloc[0])
        shares = np.repeat(rows["none"].to_numpy(np.int64, na_value=0)[:, None], width, axis=1)
        for i, (at, p) in enumerate(zip(rows["ordinals"], rows["shares"], strict=True)):
            if at is not None and len(at):
                shares[i, np.asarray(at, np.int64) % terms] = p
        sources, tiles = rows["source"].to_numpy(), rows["tile"].to_numpy()
        left = np.flatnonzero(tiles == a)
        source, item, value = [], [], []
        for n, i in enumerate(left):
            others = left[n + 1 :] if a == b else np.flatnonzero(tiles == b)
            source += [sources[i]] * len(others)
            item += sources[others].tolist()
            value += np.abs(shares[others] - shares[i]).sum(axis=1).tolist()
        # With their types, as there may be no row.
        names = {k: pd.Series(v, dtype=object) for k, v in (("lang", [lang] * len(value)), ("source", source), ("item", item))}
        return pd.DataFrame({**names, "value": pd.Series(value, dtype="int64")})

    return run


def pairs(counts: DataFrame, groups: DataFrame, tile_terms: int = TILE_TERMS, tile_sources: int = TILE_SOURCES) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of sources of a language: the L1 distance of their shares.

    ``counts`` has shares ``p`` of the terms that occur; ``groups`` has every group with its share ``none`` of an absent
    term and its language's ``terms`` and ``sources``. Ordinals are cut into tiles of ``tile_terms``, sources by a hash
    into about ``tile_sources``; a task holds two tiles of sources over one tile of ordinals.
    """
    packed = (
        counts.withColumn("block", F.floor(F.col("ordinal") / tile_terms))
        .groupBy("lang", "source", "block")
        .agg(F.collect_list(F.struct("ordinal", "p")).alias("cells"))
        .select("lang", "source", "block", F.col("cells.ordinal").alias("ordinals"), F.col("cells.p").alias("shares"))
    )
    tiles = F.greatest(F.ceil(F.col("sources") / tile_sources), F.lit(1))
    every = (
        groups.withColumn("tiles", tiles)
        .withColumn("tile", F.pmod(F.xxhash64("source"), "tiles"))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("terms") / tile_terms), F.lit(1)) - 1)))
        .withColumn("width", F.least(F.lit(tile_terms), F.col("terms") - F.col("block") * tile_terms))
        .join(packed, ["lang", "source", "block"], "left")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        .select(
            "lang", "source", "block", "tile", "width", "none", "ordinals", "shares",
            F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"),
        )
    )
    parts = every.groupBy("lang", "block", "a", "b").applyInPandas(_tile(tile_terms), "lang string, source string, item string, value long")
    once = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    return once.select("lang", both.alias("x"), "value").select("lang", "x.source", "x.item", "value")


def _words(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = {lang: [(s, n, Transducer.unpack(d)) for s, n, d in rows] for lang, rows in shared.value.items()}
        for batch in batches:
            at, words = [], []
            for i, (lang, ordinal) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("ordinal").to_pylist(), strict=True)):
                for start, n, transducer in blocks.get(lang, ()):
                    if start <= ordinal < start + n:
                        at.append(i)
                        words.append(transducer.term(ordinal - start).decode())
            some = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array(words, pa.string())], [*some.schema.names, "item"])

    return run


def with_words(rows: DataFrame, blocks: DataFrame, limit: int = ROUND_BYTES) -> DataFrame:
    """``rows`` with ``item``, the term of (lang, ordinal), read off the transducers."""
    spark = rows.sparkSession
    schema = T.StructType([*rows.schema.fields, T.StructField("item", T.StringType())])
    parts = [rows.mapInArrow(_words(spark.sparkContext.broadcast(lot)), schema) for lot in rounds(blocks, limit)]
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], schema))


def audit(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least: int = LEAST_DOCUMENTS,
    reported: int = TERMS_REPORTED,
    block_terms: int = BLOCK_TERMS,
    round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """(lang, source, part, item, value, rank): which sources of a language differ, and by which terms.

    Part ``pair`` has each other source of the language by the distance of the two, part ``term`` the ``reported`` terms
    a source has most in excess of its language. Equal values are ranked by the bytes of the item, terms by ordinal.

    Null text, language and source count as empty, and rows are documents whatever their ids, so repeated rows count
    again. A text without letters counts as a document and brings its group. A language without kept terms has pairs of
    value 0 and no terms; one source alone has no pairs; an empty table gives no rows. Other columns are not read.
    """
    filled = lambda c: F.coalesce(docs[c].cast("string"), F.lit(""))
    plain = docs.select(filled(lang).alias("lang"), filled(source).alias("source"), filled(text).alias("text"))
    blocks = vocabulary(plain, least, block_terms)
    counts = written(recount(plain, blocks, round_bytes), "divergence-counts")

    sums = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count("*").alias("rows"))
    sizes = blocks.groupBy("lang").agg(F.sum("n").alias("terms"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    each = plain.select("lang", "source").distinct().join(sums, ["lang", "source"], "left")
    # One row per language.
    langs = each.groupBy("lang").agg(F.count("*").alias("sources"), F.coalesce(F.sum("total"), F.lit(0)).alias("all"))
    langs = langs.join(sizes, "lang", "left").select("lang", "sources", "all", zero("terms"))
    groups = each.join(langs, "lang").select("lang", "source", "sources", "all", "terms", zero("total"), zero("rows"))
    groups = written(groups.withColumn("none", share(F.lit(0), F.col("total"), F.col("terms"))), "divergence-groups")

    shares = look_up(counts, groups, ["lang", "source"], "rows").withColumn("p", share(F.col("count"), F.col("total"), F.col("terms")))
    shares = written(shares.select("lang", "source", "ordinal", "p", "all", "terms"), "divergence-shares")
    overall = counts.groupBy("lang", "ordinal").agg(F.sum("count").alias("in_lang"))
    excess = shares.join(overall, ["lang", "ordinal"]).withColumn("q", share(F.col("in_lang"), F.col("all"), F.col("terms")))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    top = excess.filter("p > q").select("lang", "source", "ordinal", (F.col("p") - F.col("q")).alias("value")).withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= reported)
    terms = with_words(written(top, "divergence-top"), blocks, round_bytes).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    far = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    apart = pairs(shares, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(far).alias("rank"))
    return apart.unionByName(terms)
