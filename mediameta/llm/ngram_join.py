"""Operator 9, n-gram Jaccard join: a blocked sparse product of the document by n-gram incidence with its transpose.

Documents with equal sets are one class, and one row of the matrix. Two sets of at least ``t`` similarity share a column
among the first ``n - ceil(t n) + 1`` of each, whatever the common order of the columns. Columns that occur once come first
and frequent ones last, so a passage that some documents share starts no pairs. What orders the columns are counts of all
n-grams: documents are bundled, bundles send their n-grams to slots by hash, and each slot sends those that it met twice or
more back to their bundles with a count; errors there cost time and no result. No task holds more than a bundle or a slot.
Only columns with two classes count. Three steps find all components:

1. Every class is paired with one class of each of its columns, that of the least document, a number of pairs in proportion to the columns.
2. Columns whose classes are then in one component are done. The rest is multiplied in blocks: within a block of classes of
   a cluster of columns, or of one column, the counts of shared leading columns are accumulated for pairs from different
   components alone, and a pair goes on only if sizes and positions leave room for the threshold.
3. Pairs of either step are verified by the overlap of whole sets. Components of the verified links are those of all links:
   a pair is left out only if it is in one component already, or cannot reach the threshold.

N-grams are 64-bit hashes; two different ones in a pair of documents meet with a chance of about 1e-13.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediameta.llm.common import forget_kept, look_up, written
from mediameta.llm.components import components

#: Production parameters: words per n-gram, threshold.
N = 5
THRESHOLD = Fraction(3, 4)
#: Counts of repeated n-grams are told apart up to this one.
FREQUENT = 1 << 17
#: N-grams in a bundle, which a task sorts at a time, and how often it tells of one of them.
COUNTED, TOLD = 1 << 22, 8
#: Bits of the sieves that keep back what cannot match; a sieve that is too full only keeps back less.
SIEVE = 1 << 27
#: Stands for a null document id where the least one is wanted.
LAST_ID = (1 << 63) - 1
#: Classes in a block.
BLOCK = 1024
#: Rows of a block multiplied together.
STRIP = 256

#: Words whose hashes a task remembers.
REMEMBERED = 250_000


class WordHashes(dict):
    """64-bit hash of each word; a word is hashed when it is first asked for."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingler(n: int):
    """A function from a text to the sorted hashes of its distinct n-grams; of a shorter text, of all its words.

    On UTF-8 bytes, lower-casing takes A-Z alone and splitting the six white-space characters of the contract.
    """
    forget_kept()
    hash_of = WordHashes().__getitem__
    factor, spread = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)

    def grams(text: str | None) -> np.ndarray:
        words = (text or "").encode(errors="surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.int64)
        h = np.fromiter(map(hash_of, words), np.uint64, len(words))
        size = min(n, len(words))
        last = len(h) - size + 1
        total = h[:last] + np.uint64(size)
        for i in range(1, size):
            total *= factor
            total ^= total >> spread
            total += h[i : last + i]
        total *= factor
        total ^= total >> spread
        return np.unique(total).view(np.int64)

    return grams


def class_of(grams: np.ndarray) -> tuple[int, bytes]:
    """The class of a set: 64 bits that name it and all 128."""
    import xxhash

    digest = xxhash.xxh3_128_digest(grams.tobytes())
    return int.from_bytes(digest[:8], "little", signed=True), digest


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))


def slot_bits(texts: DataFrame) -> int:
    """How many leading bits of the hashes name a slot, so that about ``2 ** 20`` n-grams fall in one."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(24, max(4, (size // 6 >> 20).bit_length()))


#: What a bundle knows of a document: id, whether it has one, size, class, digest, number among the bundle's classes or -1.
NODE = np.dtype([("id", np.int64), ("known", bool), ("n", np.int64), ("cls", np.int64), ("digest", np.uint8, 16), ("who", np.int32)])
#: Rows between the tasks. A bundle's own row has its documents as ``own`` and n-grams that it needs not tell of.
SENT = "slot int, bundle long, low binary, who binary, own binary"
MET = "slot int, bundle long, low binary, who binary, times binary, own binary"


def blobs(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The values cut into pieces of these lengths, each as bytes."""
    stops = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths * values.itemsize, out=stops[1:])
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(stops), pa.py_buffer(np.ascontiguousarray(values))])


def starts_of(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.empty(0, np.int64)


def sent(texts: DataFrame, n: int, bits: int) -> DataFrame:
    """The n-grams of all documents in bundles of ``COUNTED``: for each slot a row of 32 bits of each and whose it is.

    Of one n-gram a bundle tells ``TOLD`` times, so none fills a slot; the bundle's own row has the others.
    """
    rest, room_ = np.uint64(32 - bits), min(16, 32 - bits)
    below = np.uint64(room_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        grams_of, seen = shingler(n), set()
        task, done = TaskContext.get(), 0
        parts: list[np.ndarray] = []
        nodes: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal parts, nodes, size, done
            keys = np.concatenate([*parts, np.empty(0, np.uint64)])
            own = np.array(nodes, NODE).tobytes()
            parts, nodes, size = [], [], 0
            # The same if the task runs again on the same rows; other rows give another bundle.
            bundle = np.uint64(xxhash.xxh3_64_intdigest(own, (task.partitionId() << 32) + done)).astype(np.int64)
            done += 1
            keys.sort()
            who = (keys & np.uint64((1 << room_) - 1)).astype(np.uint16)
            keys >>= below
            more = np.ones(len(keys), bool)
            more[TOLD:] = keys[TOLD:] != keys[:-TOLD]
            aside, whose = (keys[:0], who[:0]) if more.all() else (keys[~more], who[~more])
            if len(aside):
                keys, who = keys[more], who[more]
            slots = (keys >> np.uint64(32)).astype(np.int32)
            edges = starts_of(slots)
            lengths = np.diff(np.r_[edges, len(slots)])
            low = keys.astype(np.uint32)
            del keys
            place = pa.array(np.r_[slots[edges], np.int32(int(bundle) % (1 << bits))].astype(np.int32))
            columns = [
                place, pa.array(np.full(len(place), bundle)),
                pa.concat_arrays([blobs(low, lengths), pa.array([aside.tobytes()], pa.binary())]),
                pa.concat_arrays([blobs(who, lengths), pa.array([whose.tobytes()], pa.binary())]),
                pa.array([None] * len(edges) + [own], pa.binary()),
            ]
            return pa.record_batch(columns, names=["slot", "bundle", "low", "who", "own"])

        held = 0
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), (t.as_py() for t in batch.column(1)), strict=True):
                grams = grams_of(text)
                who, cls, digest = -1, 0, bytes(16)
                if len(grams):
                    cls, digest = class_of(grams)
                    if cls not in seen:
                        if len(seen) < COUNTED:
                            seen.add(cls)
                        who, held = held, held + 1
                        keys = grams.view(np.uint64) >> rest
                        keys <<= below
                        keys |= np.uint64(who)
                        parts.append(keys)
                        size += len(keys)
                nodes.append((name or 0, name is not None, len(grams), cls, np.frombuffer(digest, np.uint8), who))
                if size >= COUNTED or held >> room_ or len(nodes) >= 1 << 16:
                    yield flush()
                    held = 0
        if nodes:
            yield flush()

    return texts.mapInArrow(run, SENT)


def met(told: DataFrame) -> DataFrame:
    """Of the rows of ``sent``, the n-grams that occur twice or more, by slot and bundle with their counts; own rows stay.

    The counts are too low for n-grams that a bundle holds more than ``TOLD`` times; each has one count for all bundles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, held = None, []

        def close() -> pa.RecordBatch:
            bundles, lows, whose = zip(*held, strict=True)
            low, who = np.frombuffer(b"".join(lows), np.uint32), np.frombuffer(b"".join(whose), np.uint16)
            keys = low.astype(np.uint64)
            keys <<= np.uint64(32)
            keys |= np.arange(len(low), dtype=np.uint64)
            keys.sort()
            edges = starts_of(keys >> np.uint64(32))
            runs = np.diff(np.r_[edges, len(keys)])
            # Of n-grams that come once nothing is kept.
            stays = np.repeat(runs > 1, runs)
            at = (keys[stays] & np.uint64(0xFFFFFFFF)).astype(np.int64)
            del keys
            times = np.zeros(len(low), np.uint32)
            times[at] = np.repeat(runs[runs > 1], runs[runs > 1])
            more = times > 1
            lengths = np.array([len(x) // 4 for x in lows])
            kept = np.diff(np.r_[0, np.cumsum(more)][np.r_[0, np.cumsum(lengths)]])
            full = kept > 0
            columns = [
                pa.array(np.full(full.sum(), slot, np.int32)), pa.array(np.array(bundles, np.int64)[full]),
                *(blobs(values[more], kept[full]) for values in (low, who, times)), pa.nulls(int(full.sum()), pa.binary()),
            ]
            return pa.record_batch(columns, names=["slot", "bundle", "low", "who", "times", "own"])

        for batch in batches:
            mine = batch.filter(pa.compute.is_valid(batch.column("own")))
            if len(mine):
                yield pa.record_batch([*mine.columns[:4], pa.nulls(len(mine), pa.binary()), mine.column("own")], names=["slot", "bundle", "low", "who", "times", "own"])
            for s, bundle, low, who, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own is not None:
                    continue
                if s != slot:
                    if held:
                        yield close()
                    slot, held = s, []
                held.append((bundle, low, who))
        if held:
            yield close()

    return told.repartition("slot").sortWithinPartitions("slot").mapInArrow(run, MET)


def repeated(texts: DataFrame, n: int, bits: int) -> DataFrame:
    """Rows (prefix, times): the leading ``bits + 32`` bits of n-grams that occur twice or more, and a count of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slot, low, times in zip(*(batch.column(c).to_pylist() for c in ("slot", "low", "times")), strict=True):
                prefix = (np.int64(slot) << np.int64(32)) | np.frombuffer(low, np.uint32).astype(np.int64)
                yield pa.record_batch([pa.array(prefix), pa.array(np.frombuffer(times, np.uint32).astype(np.int64))], names=["prefix", "times"])

    return met(sent(texts, n, bits)).filter("own IS NULL").mapInArrow(run, "prefix long, times long").distinct()


def sieve(values: DataFrame, columns: list, size: int = SIEVE) -> np.ndarray:
    """A bit set of the columns' values modulo its size: at most ``size / 64`` rows come to the driver."""
    at = F.explode(F.array(*[F.coalesce(c, F.lit(0)).bitwiseAND(F.lit(size - 1)) for c in columns]))
    rows = values.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("b")).toArrow()
    out = np.zeros(size // 64, np.int64)
    out[rows.column("w").to_numpy()] = rows.column("b").to_numpy()
    return out


def passes(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    low = values & np.int64(len(bits) * 64 - 1)
    return (bits[low >> 6] >> (low & 63)) & 1 == 1


def leading(nodes: np.ndarray, prefix: np.ndarray, who: np.ndarray, times: np.ndarray, threshold: Fraction, frequent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The leading columns of a bundle's classes that may occur elsewhere, from all their repeated n-grams: column, class, place.

    The common order: those that come once, then by count up to ``frequent``, then by hash. A column is named by its prefix.
    Where two of a class's n-grams have one, its places are told lower by their number, so no bound is too low.
    """
    n = nodes["n"]
    repeated_ = np.bincount(who, minlength=len(nodes))
    once = n - repeated_
    # The first ``n - ceil(t n) + 1`` lead.
    live = n + (-threshold.numerator * n) // threshold.denominator + 1 - once
    wanted = live[who] > 0
    prefix, who, place = prefix[wanted], who[wanted], np.minimum(times[wanted], frequent + 1)
    order = np.lexsort((prefix, place, who))
    prefix, who = prefix[order], who[order].astype(np.int64)
    edges = starts_of(who)
    rank = np.arange(len(who)) - np.repeat(edges, np.diff(np.r_[edges, len(who)]))
    again = np.bincount(who[1:][(who[1:] == who[:-1]) & (prefix[1:] == prefix[:-1])], minlength=len(nodes))
    first = rank < live[who]
    return prefix[first], who[first], (once[who] + rank - again[who])[first]


def columns_of(texts: DataFrame, n: int, threshold: Fraction, bits: int, frequent: int) -> DataFrame:
    """One pass: a row (doc_id, n, cls, digest) per document, and rows (gram, cls, n, pos, doc_id) for each class's leading
    columns that may occur elsewhere, once per task. cls is null for documents without words."""
    kinds = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("digest", pa.binary()), ("gram", pa.int64()), ("pos", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, mine = None, [], None

        def close() -> Iterator[pa.RecordBatch]:
            if mine is None:
                raise RuntimeError("a task that ran again met its rows in another order; run the query again, over a written table")
            nodes = np.frombuffer(mine[0], NODE)
            bare, nameless = nodes["n"] == 0, ~nodes["known"]
            digests = [None if b else d.tobytes() for b, d in zip(bare.tolist(), nodes["digest"], strict=True)]
            ids, cls = pa.array(nodes["id"].copy(), mask=nameless), pa.array(nodes["cls"].copy(), mask=bare)
            yield pa.RecordBatch.from_arrays([ids, pa.array(nodes["n"].copy()), cls, pa.array(digests, pa.binary()), *[pa.nulls(len(nodes), pa.int64())] * 2], schema=kinds)
            if not held:
                return
            slots, lows, whose, counts = zip(*held, strict=True)
            low, who, times = (np.frombuffer(b"".join(x), t) for x, t in ((lows, np.uint32), (whose, np.uint16), (counts, np.uint32)))
            prefix = np.repeat(np.array(slots, np.int64) << np.int64(32), [len(x) // 4 for x in lows])
            prefix |= low
            aside = np.frombuffer(mine[1], np.int64)
            if len(aside):
                # The bundle told of each of them, so each has a count.
                named, at = np.unique(prefix, return_index=True)
                times = np.r_[times, times[at[np.searchsorted(named, aside)]]]
                prefix, who = np.r_[prefix, aside], np.r_[who, np.frombuffer(mine[2], np.uint16)]
            classes = nodes[nodes["who"] >= 0]
            gram, who, pos = leading(classes, prefix, who, times, threshold, frequent)
            own = np.where(classes["known"], classes["id"], LAST_ID)[who]
            size, cls = classes["n"][who], classes["cls"][who]
            for a in range(0, len(gram), 1 << 16):
                cut = slice(a, a + (1 << 16))
                row = [pa.array(c[cut]) for c in (own, size, cls)]
                yield pa.RecordBatch.from_arrays([*row, pa.nulls(len(row[0]), pa.binary()), pa.array(gram[cut]), pa.array(pos[cut])], schema=kinds)

        for batch in batches:
            for slot, bundle, low, who, times, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bundle != key:
                    if key is not None:
                        yield from close()
                    key, held, mine = bundle, [], None
                if own is None:
                    held.append((slot, low, who, times))
                else:
                    mine = own, low, who
        if key is not None:
            yield from close()

    bundles = met(sent(texts, n, bits)).repartition("bundle").sortWithinPartitions("bundle")
    return bundles.mapInArrow(run, "doc_id long, n long, cls long, digest binary, gram long, pos long")


def sets_of(texts: DataFrame, n: int, classes: DataFrame) -> DataFrame:
    """Rows (cls, grams) for ``classes`` (cls, doc_id: one document of each), from those documents and few others."""
    named, wanted = sieve(classes, [F.col("doc_id")]), sieve(classes, [F.col("cls")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams_of, seen = shingler(n), set()
        for batch in batches:
            batch = batch.filter(pa.array(passes(named, batch.column(0).fill_null(0).to_numpy())))
            found, sets = [], []
            for text in (t.as_py() for t in batch.column(1)):
                grams = grams_of(text)
                if not len(grams) or (cls := class_of(grams)[0]) in seen or not passes(wanted, np.array([cls]))[0]:
                    continue
                if len(seen) < COUNTED:
                    seen.add(cls)
                found.append(cls)
                sets.append(grams)
            offsets = np.concatenate([[0], np.cumsum([len(g) for g in sets])]).astype(np.int32)
            flat = np.concatenate([*sets, np.empty(0, np.int64)])
            yield pa.record_batch([pa.array(found, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["cls", "grams"])

    return texts.mapInArrow(run, "cls long, grams array<long>")


def reaches(overlap, size_a, size_b, threshold: Fraction):
    """Whether overlap over union is at least the threshold, in whole numbers."""
    return overlap * threshold.denominator >= threshold.numerator * (size_a + size_b - overlap)


def verified(pairs: DataFrame, texts: DataFrame, n: int, classes: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs (a, b) of a written table whose whole sets reach the threshold."""
    ends = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    sets = written(sets_of(texts, n, written(classes.join(ends, "cls").select("cls", "doc_id"), "ngram-wanted")), "ngram-sets")
    one = sets.select(F.col("cls").alias("a"), F.col("grams").alias("ga"))
    two = sets.select(F.col("cls").alias("b"), F.col("grams").alias("gb"))
    both = pairs.join(one, "a").join(two, "b")
    overlap = F.size(F.array_intersect("ga", "gb"))
    return both.filter(reaches(overlap, F.size("ga"), F.size("gb"), threshold)).select("a", "b").distinct()


def room(shared, last_a, last_b, n_a, n_b, least, most, threshold: Fraction):
    """Whether two sets may reach the threshold: beyond their last shared leading columns all else would have to be shared."""
    bound = shared + least(n_a - 1 - last_a, n_b - 1 - last_b)
    return reaches(bound, n_a, n_b, threshold) & (least(n_a, n_b) * threshold.denominator >= threshold.numerator * most(n_a, n_b))


def star_pairs(live: DataFrame, threshold: Fraction) -> DataFrame:
    """Step 1: pairs (a, b) of each class b and the centres a of its columns, if they may reach the threshold."""
    centre = live.filter("cls = pivot").select("gram", F.col("n").alias("n_a"), F.col("pos").alias("pos_a"))
    each = live.filter("cls <> pivot").join(centre, "gram")
    pairs = each.groupBy(F.col("pivot").alias("a"), F.col("cls").alias("b"), "n_a", F.col("n").alias("n_b")).agg(
        F.count(F.lit(1)).alias("shared"), F.max("pos_a").alias("last_a"), F.max("pos").alias("last_b")
    )
    names = ("shared", "last_a", "last_b", "n_a", "n_b")
    return pairs.filter(room(*map(F.col, names), F.least, F.greatest, threshold)).select("a", "b")


def strip_pairs(column, rows, cls, size, comp, gram, pos, who, stops, threshold: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of these rows with all of the block, from the entries (gram, pos, who) sorted by gram, which end at ``stops``.

    A pair counts in the block of its least shared column alone; where a block is of a cluster (column is None), in that.
    """
    row_of = np.full(len(cls), -1)
    row_of[rows] = np.arange(len(rows))
    shared = np.zeros((len(rows), len(cls)), np.int32)
    last_a, last_b = np.zeros_like(shared), np.zeros_like(shared)
    here = np.zeros(shared.shape, bool)
    for a, b in zip(np.r_[0, stops[:-1]].tolist(), stops.tolist(), strict=True):
        members, at = who[a:b], pos[a:b]
        left = row_of[members] >= 0
        if b - a < 2 or not left.any():
            continue
        cell = np.ix_(row_of[members[left]], members)
        if column is None:
            here[cell] = True
        elif gram[a] <= column:
            here[cell] = (shared[cell] == 0) & (gram[a] == column)
        shared[cell] += 1
        last_a[cell] = np.maximum(last_a[cell], at[left][:, None])
        last_b[cell] = np.maximum(last_b[cell], at[None, :])
    i, j = np.nonzero(here & (comp[rows][:, None] != comp[None, :]))
    ok = room(shared[i, j], last_a[i, j], last_b[i, j], size[rows[i]], size[j], np.minimum, np.maximum, threshold)
    a, b = cls[rows[i[ok]]], cls[j[ok]]
    return np.minimum(a, b), np.maximum(a, b)


def multiply(column, cls, size, root, grams: list, at: list, threshold: Fraction) -> list[tuple[np.ndarray, np.ndarray]]:
    """The product of one block with itself: pairs of classes of different components with room for the threshold."""
    cls, first = np.unique(cls, return_index=True)
    size, grams, at = size[first], [grams[i] for i in first], [at[i] for i in first]
    roots, comp, members = np.unique(root[first], return_inverse=True, return_counts=True)
    if len(roots) < 2:
        return []
    # Rows: all that are not in the largest component. Every pair of two components has one of them.
    rows = np.flatnonzero(comp != members.argmax())
    who = np.repeat(np.arange(len(cls)), [len(g) for g in grams])
    gram, pos = np.concatenate(grams), np.concatenate(at)
    order = np.argsort(gram, kind="stable")
    gram, pos, who = gram[order], pos[order], who[order]
    stops = np.flatnonzero(np.r_[gram[1:] != gram[:-1], True]) + 1
    return [strip_pairs(column, strip, cls, size, comp, gram, pos, who, stops, threshold) for strip in np.split(rows, range(STRIP, len(rows), STRIP))]


def block_products(threshold: Fraction):
    """A task's blocks, one after the other, from rows (cluster, gram, i, j, cls, n, root, grams, at) sorted by the first four."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, pairs = None, [], []

        def close() -> None:
            nonlocal held
            if len(held) > 1:
                cls, size, root, grams, at = zip(*held, strict=True)
                pairs.extend(multiply(key[1], np.array(cls), np.array(size), np.array(root), grams, at, threshold))
            held = []

        for batch in batches:
            keys = list(zip(*[batch.column(c).to_pylist() for c in ("cluster", "gram", "i", "j")], strict=True))
            flat = [batch.column(c).flatten().to_numpy() for c in ("grams", "at")]
            ends = np.cumsum(batch.column("grams").value_lengths().to_numpy())
            rest = [batch.column(c).to_numpy() for c in ("cls", "n", "root")]
            for k, own in enumerate(keys):
                if own != key:
                    close()
                    key = own
                a, b = (ends[k - 1] if k else 0), ends[k]
                held.append((*[c[k] for c in rest], *[f[a:b] for f in flat]))
            yield drained(pairs)
        close()
        yield drained(pairs)

    def drained(pairs: list) -> pa.RecordBatch:
        found = np.unique(np.concatenate([np.stack(p, axis=1) for p in pairs] or [np.empty((0, 2), np.int64)]), axis=0)
        pairs.clear()
        return pa.record_batch([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], names=["a", "b"])

    return run


def cross_pairs(live: DataFrame, roots: DataFrame, threshold: Fraction, block: int = BLOCK) -> DataFrame:
    """Step 2: pairs (a, b) of classes of different components that may reach the threshold.

    Columns that share classes make a cluster, and two classes of one column are in one cluster. A cluster is multiplied as a
    whole, so that two classes meet once and not in each of their columns; unless it has more pairs than its columns together
    have: then columns are multiplied one by one, those with the same classes once. What has more than ``block`` classes is
    cut into groups, and each two of its groups are a block, so no task holds more than two groups.
    """
    named = live.join(roots, live["cls"] == roots["node"], "left").select("gram", "cls", "n", "pos", F.coalesce("root", "cls").alias("root"))
    named = written(named, "named-columns")
    member = F.xxhash64("cls").cast("decimal(38,0)")
    stats = named.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), F.sum(member).alias("sum"), F.min("cls").alias("low"), F.max("cls").alias("high"), F.min("root").alias("r0"), F.max("root").alias("r1"))
    open_ = written(stats.filter("r0 <> r1").drop("r0", "r1"), "open-columns")
    unlike = written(open_.groupBy("m", "sum", "low", "high").agg(F.min("gram").alias("gram")).select("gram", "m", "low"), "unlike-columns")
    inside = written(named.join(unlike, "gram").select("gram", "cls", "m", "low"), "open-classes")
    found = written(components(inside.select(F.col("low").alias("a"), F.col("cls").alias("b"))), "cluster-classes")
    clustered = unlike.join(found, unlike["low"] == found["node"]).select("gram", F.col("m").cast("double").alias("m"), F.col("root").alias("cluster"))
    pairs = clustered.groupBy("cluster").agg(F.sum(F.col("m") * F.col("m")).alias("pairs"))
    sizes = found.groupBy(F.col("root").alias("cluster")).agg(F.count(F.lit(1)).cast("double").alias("m"))
    sizes = written(sizes.join(pairs, "cluster").select("cluster", "m", (F.col("m") * F.col("m") <= F.col("pairs")).alias("at_once")), "clusters")
    at_once = sizes.filter("at_once").select("cluster", "m")
    one_by_one = clustered.select("gram", "cluster").join(sizes.filter("NOT at_once").select("cluster"), "cluster", "left_semi").select("gram")
    gram_or_none, groups = F.lit(None).cast("long").alias("gram"), F.ceil(F.col("m") / block).cast("int").alias("groups")
    rows = found.join(at_once, found["root"] == at_once["cluster"]).select("cluster", gram_or_none, F.col("node").alias("cls"), groups)
    rows = rows.unionByName(inside.join(one_by_one, "gram").select(F.lit(None).cast("long").alias("cluster"), "gram", "cls", groups))
    # The counts need all of a class's columns that pairs of different components can share, also those of other blocks.
    all_ = F.collect_list(F.struct("gram", "pos")).alias("all")
    whole = named.join(open_.select("gram"), "gram").groupBy("cls").agg(F.min("n").alias("n"), F.min("root").alias("root"), all_)
    rows = rows.join(whole, "cls")
    own = F.pmod(F.xxhash64(F.lit(1), "cls"), F.col("groups")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("groups") - 1))
    cells = rows.withColumn("own", own).withColumn("other", other).select(
        "cluster", "gram", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "cls", "n", "root",
        F.col("all.gram").alias("grams"), F.col("all.pos").alias("at"),
    )
    keys = ["cluster", "gram", "i", "j"]
    return cells.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(block_products(threshold), "a long, b long").distinct()


def ngram_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: Fraction = THRESHOLD, block: int = BLOCK, frequent: int = FREQUENT) -> tuple[DataFrame, DataFrame]:
    """The classes of all documents (doc_id, n_shingles, cls) and links (a, b) between classes that span all components."""
    texts = texts_of(docs, id_col, text_col)
    seen = written(columns_of(texts, n, threshold, slot_bits(texts), frequent), "ngram-columns")
    nodes = seen.filter("gram IS NULL").select("doc_id", F.col("n").alias("n_shingles"), "cls", "digest")
    classes = nodes.filter("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
    # A class met in several tasks gives the same rows.
    columns = seen.filter("gram IS NOT NULL").groupBy("gram", "cls").agg(F.min("n").alias("n"), F.min("pos").alias("pos"), F.min("doc_id").alias("doc_id"))
    # Copies tend to come after what they are copied from, so the class of the least document is the best centre of a star.
    ends = (F.min("cls").alias("lo"), F.max("cls").alias("hi"))
    pivots = columns.groupBy("gram").agg(F.min_by("cls", "doc_id").alias("pivot"), *ends).filter("lo <> hi")
    live = written(columns.join(pivots.select("gram", "pivot"), "gram").drop("doc_id"), "ngram-live")
    stars = written(star_pairs(live, threshold), "ngram-stars")
    linked = written(verified(stars, texts, n, classes, threshold), "ngram-star-links")
    crossed = written(cross_pairs(live, components(linked), threshold, block), "ngram-cross-pairs")
    return nodes, written(linked.unionByName(verified(crossed, texts, n, classes, threshold)), "ngram-links")


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Null and empty texts, and those without words, have an empty set and are their own component, null ids included. Equal
    sets are linked. An empty table gives an empty result. Of repeated ids each row counts.
    """
    nodes, links = ngram_links(docs, id_col, text_col, **options)
    classes = nodes.filter("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("times"))
    roots = components(links)
    named = classes.join(roots, classes["cls"] == roots["node"], "left").select("cls", "least", "times", F.coalesce("root", "cls").alias("root"))
    named = written(named, "class-roots")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    answer = written(named.join(least, "root").select("cls", "times", "component_id"), "class-components")
    full = look_up(nodes.filter("cls IS NOT NULL"), answer, "cls", "times")
    alone = nodes.filter("cls IS NULL").withColumn("component_id", F.col("doc_id"))
    names = ["doc_id", "n_shingles", "component_id"]
    return full.select(*names).unionByName(alone.select(*names))


