"""Operator 4, substring deduplication: every passage of ``LEAST_SPAN`` bytes or more that occurs before, found exactly.

Each window of ``LEAST_SPAN`` bytes has a seed, the ``WINDOW`` bytes within it whose gear rolling hash is least, so equal
windows have equal seeds at the same place. Neighbouring windows with one seed are a run, about one in 48 bytes.

1. Runs with an equal seed and digest are equal: all but the first by (document, position) are repeated as a whole.
   All runs of a seed are sorted in one task, as rows of numbers that spill: a seed that very many runs have makes it long.
2. Runs that differ have equal windows only if they share the seed. Such runs, each different one once, are brought
   together with their bytes, by seed, and their windows are compared there. Of a seed with more than ``MANY`` different
   runs the windows are compared by digest instead, so no group of different runs has to fit in a task's memory.
3. Repeated windows that touch or overlap form a span, so a span ends where the match ends.

``chunk`` cuts texts at content-defined places alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediameta.llm.common import look_up, row_keys, written

#: Production parameters: cut on 5 zero bits, so about every 32 bytes beyond the least.
CUT_BITS = 5
LEAST, MOST = 24, 1024
WINDOW = 32
#: Spans with fewer bytes are chance or phrase, and stay. Passages of 50 words have over 200.
LEAST_SPAN = 128
#: A span's ends move to whole words by at most so many bytes; less than half of ``LEAST_SPAN``.
WORD_REACH = 32
#: Different runs of one seed that a task compares at a time, some 5 MB of text.
MANY = 20_000
#: Bytes hashed together.
PART = 1 << 22


def gear(seed: int = 20_240_501) -> np.ndarray:
    """256 random 32-bit numbers from a seed; a number shifted out of its 32 bits is out of the window."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Gear hash at each byte: the sum over the last ``WINDOW`` bytes of table[byte] shifted by its distance, by doubling."""
    h = table[data]
    step = 1
    while step < WINDOW:
        shifted = h[:-step] << np.uint32(step)
        h = h.copy()
        h[step:] += shifted
        step *= 2
    return h


def candidates(data: bytes, table: np.ndarray) -> np.ndarray:
    """Positions behind which a chunk may end."""
    out = []
    raw = np.frombuffer(data, np.uint8)
    for at in range(0, len(raw), PART):
        low = max(0, at - WINDOW)
        h = rolling(raw[low : at + PART], table)[at - low :]
        out.append(np.flatnonzero(h >> np.uint32(WINDOW - CUT_BITS) == 0) + at + 1)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def cuts(ends: np.ndarray, size: int) -> list[int]:
    """Ends of chunks of at least ``LEAST`` and at most ``MOST`` bytes, the last one shorter."""
    out, last = [], 0
    for end in ends.tolist():
        if end - last < LEAST:
            continue
        while end - last > MOST:
            last += MOST
            out.append(last)
        if end - last >= LEAST:
            out.append(end)
            last = end
    while size - last > MOST:
        last += MOST
        out.append(last)
    if size > last:
        out.append(size)
    return out


def chunk(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start and length (bytes of the UTF-8 text), digest (128 bits) of each chunk; null and empty texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        table = gear()
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            joined = b"".join(texts)
            ends = candidates(joined, table)
            ids: list = []
            starts: list[int] = []
            lengths: list[int] = []
            digests: list[bytes] = []
            at = 0
            for name, data in zip(batch.column(0).to_pylist(), texts, strict=True):
                # Cuts near the beginning would look at the text before: they are found anew.
                low, high = np.searchsorted(ends, [at + WINDOW, at + len(data)], "right")
                own = candidates(data[:WINDOW], table)
                begin = 0
                for end in cuts(np.concatenate([own[own <= WINDOW], ends[low:high] - at]), len(data)):
                    ids.append(name)
                    starts.append(begin)
                    lengths.append(end - begin)
                    digests.append(xxhash.xxh3_128_digest(data[begin:end]))
                    begin = end
                at += len(data)
            columns = [pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(digests, pa.binary())]
            yield pa.record_batch(columns, names=["doc_id", "start", "length", "digest"])

    read = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return read.mapInArrow(run, "doc_id long, start long, length long, digest binary")


def parts(names: list, texts: list[bytes], least: int) -> Iterator[tuple[bytes, list]]:
    """Texts joined to about ``PART`` bytes, with (name, place in the join, bytes, offset of its first byte, whole size).

    Longer texts come in parts that share ``least - 1`` bytes, so each window is in one part.
    """
    joined, listed, size = [], [], 0
    for name, data in zip(names, texts, strict=True):
        for at in range(0, max(1, len(data) - least + 1), PART):
            piece = data[at : at + PART + least - 1]
            if len(piece) < least:
                continue
            joined.append(piece)
            listed.append((name, size, len(piece), at, len(data)))
            size += len(piece)
            if size >= PART:
                yield b"".join(joined), listed
                joined, listed, size = [], [], 0
    if listed:
        yield b"".join(joined), listed


def seeds(raw: np.ndarray, table: np.ndarray, least: int) -> np.ndarray:
    """For each window of ``least`` bytes, the first byte of its seed: the leftmost of least gear hash."""
    width = least - WINDOW + 1
    h = rolling(raw, table)[WINDOW - 1 :].astype(np.uint64) << np.uint64(32) | np.arange(len(raw) - WINDOW + 1, dtype=np.uint64)
    step = 1
    while step * 2 <= width:
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    if step < width:
        h = np.minimum(h[: len(h) - (width - step)], h[width - step :])
    return (h & np.uint64(0xFFFFFFFF)).astype(np.int64)


def runs(listed: list, raw: np.ndarray, table: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each listed text, its number and its runs: first window, last window, seed, as places in the join."""
    seed = seeds(raw, table, least)
    change = np.flatnonzero(np.diff(seed)) + 1
    for k, (_, at, size, _, _) in enumerate(listed):
        stop = at + size - least + 1
        low, high = np.searchsorted(change, [at, stop], "right")
        first = np.r_[at, change[low:high]]
        first = first[first < stop]
        yield k, first, np.r_[first[1:], stop] - 1, seed[first]


def word_edges(raw: np.ndarray, edge: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a word begins, and where one ends; texts begin at ``edge`` and end at ``stop``."""
    space = np.isin(raw, np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))
    begins, ends = np.flatnonzero(space[:-1] & ~space[1:]) + 1, np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.union1d(begins, edge), np.union1d(ends, stop)


def whole_words(first: np.ndarray, stop: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes before the first whole word and behind the last one; 0 where none is within ``WORD_REACH``."""
    nearest = np.r_[begins, np.iinfo(np.int64).max][np.searchsorted(begins, first)]
    lead = np.where(nearest - first <= WORD_REACH, nearest - first, 0)
    nearest = np.r_[-(WORD_REACH + 1), ends][np.searchsorted(ends, stop, "right")]
    return lead, np.where(stop - nearest <= WORD_REACH, stop - nearest, 0)


RUNS = "key long, digest long, doc_id long, run long, shape long"
#: A repeated piece of a document. ``whole`` is the number of runs it counts for; ``first`` has the window at ``seen``.
PIECES = "doc_id long, run long, start long, length long, lead int, tail int, whole int, seen long, first long"
#: What a row of the marks is: a piece, a run to compare, a window of a run that another run answers for, a window to compare.
PIECE, COMPARE, ASK, WINDOWS = range(4)
MARKS = PIECES + ", kind int, key long, nth int, at int, text binary, edge int, digest long, more long"


def scan(docs: DataFrame, least: int) -> DataFrame:
    """All runs: key (hash of the seed) and digest, doc_id, run (its first byte), and shape: length (bytes), at (place of the
    seed in it), lead and tail (bytes of words in part) in 24, 24, 6 and 6 bits."""

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        table, digest = gear(), xxhash.xxh3_64_digest
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            for data, listed in parts(batch.column(0).to_pylist(), texts, least):
                raw = np.frombuffer(data, np.uint8)
                found = list(runs(listed, raw, table, least))
                text = np.repeat([k for k, *_ in found], [len(x) for _, x, *_ in found])
                first, last, seed = (np.concatenate([x[c] for x in found]) for c in (1, 2, 3))
                edge = np.array([at for _, at, _, offset, _ in listed if not offset], np.int64)
                stop = np.array([at + size for _, at, size, offset, whole in listed if offset + size == whole], np.int64)
                lead, tail = whole_words(first, last + least, *word_edges(raw, edge, stop))
                moved = np.array([offset - at for _, at, _, offset, _ in listed], np.int64)[text]
                key = b"".join([digest(data[a : a + WINDOW]) for a in seed.tolist()])
                own = b"".join([digest(data[a : b + least]) for a, b in zip(first.tolist(), last.tolist(), strict=True)])
                ids = pa.array([name for name, *_ in listed], pa.int64()).take(pa.array(text))
                shape = (last - first + least) | (seed - first) << 24 | lead << 48 | tail << 54
                columns = [np.frombuffer(x, ">i8").astype(np.int64) for x in (key, own)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), ids, pa.array(first + moved), pa.array(shape)], names=["key", "digest", "doc_id", "run", "shape"])

    return docs.mapInArrow(listing, RUNS)


def marked(rows: DataFrame, least: int) -> DataFrame:
    """Of the runs, those that are repeated as a whole, with the document where they occur first, and those whose seed different
    runs have, without one: doc_id, run, shape, key, nth (number of the run among the ``runs`` different ones of the seed), first.

    Within a document, the first occurrence stays whole, so an overlap with it does not count.
    """
    equal, seed = Window.partitionBy("key", "digest").orderBy("doc_id", "run"), Window.partitionBy("key")
    named = rows.select("*", F.first("doc_id").over(equal).alias("__doc"), F.first("run").over(equal).alias("__run"), F.dense_rank().over(seed.orderBy("digest")).alias("nth"))
    named = named.withColumn("runs", F.max("nth").over(seed))
    apart = (F.col("doc_id") != F.col("__doc")) | (F.col("run") >= F.col("__run") + least)
    return named.withColumn("first", F.when(apart, F.col("__doc"))).filter("first IS NOT NULL OR runs > 1").select("doc_id", "run", "shape", "key", "nth", "runs", "first")


def numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    """Columns of integers, null as 0."""
    return [pc.fill_null(batch.column(n), 0).to_numpy(zero_copy_only=False).astype(np.int64) for n in names]


def batch_of(schema: pa.Schema, size: int, **columns: object) -> pa.RecordBatch:
    """A batch of ``schema``; a column that is not given is null, a single value is all rows'."""
    full = [columns.get(f.name) for f in schema]
    made = [pa.nulls(size, f.type) if c is None else pa.array(np.full(size, c) if isinstance(c, int) else c, f.type, from_pandas=False) for f, c in zip(schema, full, strict=True)]
    return pa.RecordBatch.from_arrays(made, schema=schema)


def schema_of(ddl: str) -> pa.Schema:
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, types[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


class Laid:
    """Windows of runs, run after run: ``row`` is a window's run, ``pos`` its place in the joined bytes ``raw``, and run k's
    are those from ``base[k]`` on. A run's text has a byte more before it (``edge`` 1) and behind it (2) unless its document ends there."""

    def __init__(self, texts: list[bytes], edge: np.ndarray, low: np.ndarray, times: np.ndarray):
        self.data = b"".join(texts)
        self.raw = np.frombuffer(self.data, np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        at = np.cumsum(sizes) - sizes
        self.base = np.cumsum(times) - times
        self.row = np.repeat(np.arange(len(texts)), times)
        self.offset = np.arange(len(self.row)) - self.base[self.row] + low[self.row]
        self.pos = (at + (edge & 1))[self.row] + self.offset
        self.edges = word_edges(self.raw, at[edge & 1 == 0], (at + sizes)[edge & 2 == 0])


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def window_hashes(raw: np.ndarray, least: int) -> np.ndarray:
    """A 64-bit hash of the ``least`` bytes from each place on, by doubling."""
    h, step, odd = raw.astype(np.uint64), 1, np.uint64(0x9E3779B97F4A7C15)
    while step < 8:
        h = h[:-step] | h[step:] << np.uint64(8 * step)
        step *= 2
    h = mixed(h)
    while step * 2 <= least:
        h = mixed(h[:-step] * odd + h[step:])
        step *= 2
    return mixed(h[: len(h) - (least - step)] * odd + h[least - step :]) if step < least else h


def lay_out(docs: DataFrame, marks: DataFrame, least: int, many: int) -> DataFrame:
    """The marks joined with their documents' texts: pieces of runs that are repeated as a whole, and what is to be compared.

    Runs that follow one another are one piece. Where a span can begin in it, the document that has the window at its
    first whole word is asked for, since that may come before the one that has the whole run.
    """
    schema = schema_of(MARKS)

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        held, before = b"", (None, None)
        for batch in batches:
            if not batch.num_rows:
                continue
            doc, run, shape, key, nth, of, first = numbers(batch, "doc_id", "run", "shape", "key", "nth", "runs", "first")
            text, known = batch.column("text"), pc.is_valid(batch.column("first")).to_numpy(zero_copy_only=False)
            again = np.r_[(doc[0], run[0]) == before, (doc[1:] == doc[:-1]) & (run[1:] == run[:-1])]
            before = (doc[-1], run[-1])
            places = np.flatnonzero(run < 0)

            def sliced(rows: np.ndarray) -> tuple[list[bytes], np.ndarray]:
                """The runs' bytes with one more on either side, and which of these there are."""
                out, edge, now, data = [], [], -1, held  # noqa: B023
                for t, a, b in zip((np.searchsorted(places, rows) - 1).tolist(), run[rows].tolist(), stop[rows].tolist(), strict=True):  # noqa: B023
                    if t != now:
                        now, data = t, text[int(places[t])].as_py()  # noqa: B023
                    out.append(data[max(a - 1, 0) : b + 1])
                    edge.append((a > 0) + 2 * (b < len(data)))
                return out, np.array(edge, np.int64)

            length, at, lead, tail = shape & 0xFFFFFF, shape >> 24 & 0xFFFFFF, shape >> 48 & 63, shape >> 54
            stop, last = run + length, run + length - least
            whole = np.flatnonzero(known & ~again & (run >= 0))
            if len(whole):
                prior = whole[:-1]
                joins = np.r_[False, (doc[whole[1:]] == doc[prior]) & (run[whole[1:]] == last[prior] + 1)]
                begin = np.flatnonzero(~joins)
                a, z, count = whole[begin], whole[np.r_[begin[1:], len(whole)] - 1], np.diff(np.r_[begin, len(whole)])
                yield batch_of(schema, len(a), kind=PIECE, doc_id=doc[a], run=run[a], start=run[a], length=stop[z] - run[a], lead=lead[a], tail=tail[z], whole=count)
                # A span begins with a word of the piece's first run, or of the next if that has none.
                joins[1:] &= (run + lead <= last)[prior]
                asks = whole[~joins]
                word = np.minimum(run + lead, last)
                for kind, rows in ((PIECE, asks[of[asks] == 1]), (ASK, asks[(of[asks] > 1) & (of[asks] <= many)])):
                    yield batch_of(
                        schema, len(rows), kind=kind, doc_id=doc[rows], run=run[rows], start=word[rows], length=least, lead=(run + lead - word)[rows],
                        tail=0, whole=0, seen=word[rows], first=first[rows], key=key[rows], nth=nth[rows],
                    )
            else:
                asks, word = whole, run
            part = np.flatnonzero(~known & ~again & (run >= 0))
            few = part[of[part] <= many]
            cut, edge = sliced(few)
            yield batch_of(schema, len(few), kind=COMPARE, doc_id=doc[few], run=run[few], length=length[few], key=key[few], nth=nth[few], at=at[few], text=cut, edge=edge)
            for rows, all_of in ((part[of[part] > many], True), (asks[of[asks] > many], False)):
                for some in np.split(rows, range(1000, len(rows), 1000)):
                    cut, edge = sliced(some)
                    laid = Laid(cut, edge, 0 * some if all_of else (word - run)[some], (last - run)[some] + 1 if all_of else 0 * some + 1)
                    own, start = some[laid.row], run[some[laid.row]] + laid.offset
                    lead_, tail_ = whole_words(laid.pos, laid.pos + least, *laid.edges)
                    digests = b"".join([xxhash.xxh3_128_digest(laid.data[p : p + least]) for p in laid.pos.tolist()])
                    halves = np.frombuffer(digests, ">i8").astype(np.int64).reshape(-1, 2)
                    yield batch_of(
                        schema, len(own), kind=WINDOWS, doc_id=doc[own], run=run[own], start=start, length=least, lead=lead_, tail=tail_,
                        whole=int(all_of), digest=halves[:, 0].copy(), more=halves[:, 1].copy(),
                    )
            if len(places):
                held = text[int(places[-1])].as_py()

    none = [F.lit(None).cast(t).alias(c) for c, t in (("shape", "long"), ("key", "long"), ("nth", "int"), ("runs", "int"), ("first", "long"))]
    texts = docs.filter(F.octet_length("text") >= least).select("doc_id", F.lit(-1).cast("long").alias("run"), *none, F.col("text").cast("binary").alias("text"))
    both = texts.unionByName(marks.withColumn("text", F.lit(None).cast("binary")))
    return both.repartition("doc_id").sortWithinPartitions("doc_id", "run").mapInArrow(listing, MARKS)


def compared(marks: DataFrame, least: int) -> DataFrame:
    """``PIECES``: the repeated windows of the runs to compare, those that follow one another as one, and the windows asked for."""
    schema = schema_of(PIECES)

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            # Runs of one seed come by document and place: those of the last batch's last seed are all that may come before.
            told = held.num_rows if held is not None and held.column("key")[0] == batch.column("key")[0] else 0
            rows = pa.concat_batches([held, batch]) if told else batch
            kind, key = numbers(rows, "kind", "key")
            runs_ = rows.filter(pa.array(kind == COMPARE))
            held = runs_.filter(pa.array(key[kind == COMPARE] == key[-1]))
            held = held if held.num_rows else None
            if not runs_.num_rows:
                continue
            doc, run, length, own, nth, at, edge = numbers(runs_, "doc_id", "run", "length", "key", "nth", "at", "edge")
            laid = Laid(runs_.column("text").to_pylist(), edge, 0 * run, length - least + 1)
            row, start = laid.row, run[laid.row] + laid.offset
            tag = mixed(own.view(np.uint64)[row] + mixed((laid.offset - at[row]).astype(np.uint64)))
            h = mixed(window_hashes(laid.raw, least)[laid.pos] * np.uint64(0x9E3779B97F4A7C15) + tag)
            order = np.argsort(h, kind="stable")
            new = np.r_[True, h[order[1:]] != h[order[:-1]]]
            head = np.empty(len(h), np.int64)
            head[order] = order[np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))]
            found = (row >= told) & ((doc[row] != doc[row[head]]) | (start >= start[head] + least))
            side = np.r_[False, found[:-1] & (row[1:] == row[:-1])], np.r_[found[1:] & (row[1:] == row[:-1]), False]
            a, z = np.flatnonzero(found & ~side[0]), np.flatnonzero(found & ~side[1])
            lead, tail = whole_words(laid.pos[a], laid.pos[z] + least, *laid.edges)
            word = np.minimum(a + lead, z)
            yield batch_of(
                schema, len(a), doc_id=doc[row[a]], run=run[row[a]], start=start[a], length=start[z] + least - start[a], lead=lead, tail=tail,
                whole=1, seen=start[word], first=doc[row[head[word]]],
            )
            asks = rows.filter(pa.array(kind == ASK))
            if asks.num_rows:
                place = {name: k for k, name in enumerate(zip(own.tolist(), nth.tolist(), strict=True))}
                key, nth, run, start = numbers(asks, "key", "nth", "run", "start")
                of = np.array([place[name] for name in zip(key.tolist(), nth.tolist(), strict=True)], np.int64)
                first = doc[row[head[laid.base[of] + start - run]]]
                yield batch_of(schema, asks.num_rows, **{n: asks.column(n) for n in schema.names if n != "first"}, first=first)

    few = marks.filter(F.col("kind").isin(COMPARE, ASK)).drop("digest", "more")
    return few.repartition("key").sortWithinPartitions("key", "kind", "doc_id", "run").mapInArrow(listing, PIECES)


def again(windows: DataFrame, least: int, label: str) -> DataFrame:
    """``PIECES``: the windows whose bytes occur before, with the document where they occur first."""
    place = F.struct("doc_id", "start")
    groups = windows.groupBy("digest", "more").agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("at_first")).filter("times > 1")
    found = look_up(windows.drop("at", "first"), written(groups, label), ["digest", "more"], "times")
    apart = (F.col("doc_id") != F.col("at_first.doc_id")) | (F.col("start") >= F.col("at_first.start") + least)
    found = found.filter(apart).withColumn("first", F.col("at_first.doc_id")).withColumn("seen", F.col("start"))
    return found.select(*schema_of(PIECES).names)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_span: int = LEAST_SPAN) -> DataFrame:
    """doc_id, start, length (bytes), chunks, first_doc_id, row: the spans that repeat earlier text, of ``least_span`` bytes or more.

    A span is the union of windows of ``least_span`` bytes which occur before, by (doc_id, start), null ids last; all are
    found. Words that a span takes in part, and white space at its ends, are left out of it, so it may be shorter by
    up to ``WORD_REACH`` bytes at either end. chunks is the number of its runs, first_doc_id the first document with the
    window at its first whole word. Rows are told apart by ``row``, the key of ``row_keys``: rows without an id of their own
    come after the others, and only rows equal in id and text are one. Clean documents do not appear; an empty table gives
    an empty result.
    """
    if least_span < 2 * WINDOW:
        raise ValueError(f"least_span is at least {2 * WINDOW}")
    plain = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    keyed = row_keys(plain, "id", "text", "chunk-repeated-ids")
    read = keyed.select(F.col("__key").alias("doc_id"), "text")
    marks = written(lay_out(read, marked(scan(read, least_span), least_span), least_span, MANY), "chunk-marks")
    pieces = marks.filter(F.col("kind") == PIECE).select(*schema_of(PIECES).names).unionByName(compared(marks, least_span))
    windows = marks.filter(F.col("kind") == WINDOWS)
    if not windows.isEmpty():
        pieces = pieces.unionByName(again(windows, least_span, "chunk-window-index"))
    order = Window.partitionBy("doc_id").orderBy("start", "length")
    end = F.max(F.col("start") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = pieces.withColumn("__new", F.coalesce((F.col("start") > end).cast("int"), F.lit(1)))
    spans = spans.withColumn("span", F.sum("__new").over(order)).withColumn("end", F.col("start") + F.col("length"))
    out = spans.groupBy("doc_id", "span").agg(
        F.min(F.struct("start", "lead")).alias("from"),
        F.max(F.struct("end", "tail")).alias("to"),
        F.collect_set(F.struct("run", "whole")).alias("runs"),
        F.min(F.when(F.col("first").isNotNull(), F.struct(F.col("start") + F.col("lead"), -F.col("seen"), "first"))).alias("first"),
    )
    start, stop = F.col("from.start") + F.col("from.lead"), F.col("to.end") - F.col("to.tail")
    chunks = F.aggregate("runs", F.lit(0).cast("long"), lambda n, run: n + run["whole"]).alias("chunks")
    found = out.select(F.col("doc_id").alias("row"), start.alias("start"), (stop - start).alias("length"), chunks, F.col("first.first").alias("first"))
    # Keys of rows without an id of their own back to ids.
    made = keyed.filter("id IS NULL OR id <> __key").select(F.col("__key").alias("key"), "id").distinct()
    named = found
    for key, name in (("row", "doc_id"), ("first", "first_doc_id")):
        ids = made.select(F.col("key").alias("__made"), F.col("id").alias("__id"))
        named = named.join(ids, named[key] == ids["__made"], "left")
        named = named.withColumn(name, F.when(F.col("__made").isNull(), F.col(key)).otherwise(F.col("__id"))).drop("__made", "__id")
    return named.select("doc_id", "start", "length", "chunks", "first_doc_id", "row")


def cut_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the spans' bytes, row by row; a character that a span takes in part goes whole. Null texts stay null."""

    @F.pandas_udf("string")
    def without(texts: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for text, own in zip(texts, lists, strict=True):
            if text is not None and own is not None:
                data, at, kept = text.encode(), 0, []
                for begin, size in sorted((int(x["start"]), int(x["length"])) for x in own):
                    kept.append(data[at:begin])
                    at = max(at, begin + size)
                text = b"".join([*kept, data[at:]]).decode(errors="ignore")
            out.append(text)
        return pd.Series(out, dtype=object)

    lists = spans.select("row", "start", "length").distinct().groupBy("row").agg(F.collect_list(F.struct("start", "length")).alias("__spans"))
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    i, t = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    keyed = row_keys(named, i, t, "cut-repeated-ids")
    joined = keyed.join(lists, keyed["__key"] == lists["row"], "left")
    return joined.withColumn(t, without(F.col(t), F.col("__spans"))).select(*named.columns).toDF(*docs.columns)
