"""Operator 2, best-fit packing: bounded-space online best fit over token pieces.

Documents are encoded and cut where they are read; only piece lengths move on. Each packing task keeps a fixed number of
open bins, found through a bitset keyed by free space: the lowest set bit at or above a piece's length is the best fit.
If none fits and all bins are open, the fullest closes. Pieces arrive in hash order, so every task sees the same mix of
lengths, whatever the order of the table, and a repeated task packs alike. Of each wave of arrivals the longest go first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediameta.llm.tokens import encoder

#: Production parameters.
TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048
OPEN_BINS = 16_384
END_ID = 0
#: Pieces that are looked at together: of so many arrivals the longest go first.
WAVE = 32_768

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece of at most ``capacity`` tokens: doc_id, piece, start, length, ids_crc32 and, if asked, the ids.

    A document is its tokens and ``end_id``, so a null or empty text is one piece of length 1. Ids stay as they are, null
    and repeated ones too. The encoded ids are little-endian unsigned 32-bit integers.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = int(end_id).to_bytes(4, "little")
        width = capacity * 4
        for batch in batches:
            out: list[tuple] = []
            names = batch.column(0).to_pylist()
            for name, ids in zip(names, encode(batch.column(1)), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    out.append((name, k, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else b""))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][: 5 + with_ids]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=False)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids])

    read = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return read.mapInArrow(cut, PIECES + (", ids binary" if with_ids else ""))


class Bins:
    """Open bins by free space: ``bits`` has a bit for each free space that some open bin has."""

    def __init__(self, capacity: int, most: int) -> None:
        self.capacity, self.most = capacity, most
        self.bits, self.count, self.made = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, length: int) -> tuple[int, int]:
        """Bin number and offset for a piece."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.count == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
            number, free = self.made, self.capacity
            self.made += 1
        if free > length:
            self.by_free[free - length].append(number)
            self.bits |= 1 << (free - length)
            self.count += 1
        return number, self.capacity - free

    def _take(self, free: int) -> int:
        """Take an open bin with this free space out of the bitset."""
        number = self.by_free[free].pop()
        self.count -= 1
        if not self.by_free[free]:
            self.bits &= ~(1 << free)
        return number


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """Add sequence_id and offset to pieces (of any further columns): no sequence has more than ``capacity`` tokens,
    offsets are gapless from 0. Pieces longer than ``capacity`` are refused; zero lengths are put where they fit.

    Sequence ids are the packing task's number and the bin's number in it. Columns of the two names are replaced.
    """
    pieces = pieces.drop(*[c for c in pieces.columns if c.lower() in ("sequence_id", "offset")])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bins = Bins(capacity, open_bins)
        task = TaskContext.get().partitionId() << 40

        def placed(wave: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(wave)
            lengths = table.column("length").to_numpy()
            numbers, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            for i in np.argsort(-lengths, kind="stable").tolist():
                numbers[i], offsets[i] = bins.put(int(lengths[i]))
            table = table.append_column("sequence_id", pa.array(numbers + task)).append_column("offset", pa.array(offsets))
            yield from table.to_batches()

        wave: list[pa.RecordBatch] = []
        for batch in batches:
            wave.append(batch)
            if sum(b.num_rows for b in wave) >= WAVE:
                yield from placed(wave)
                wave = []
        if wave:
            yield from placed(wave)

    checked = pieces.withColumn("length", F.when(F.col("length") <= capacity, F.col("length")).otherwise(F.raise_error(F.lit("a piece is longer than a sequence"))))
    key = F.xxhash64("doc_id", "piece")
    mixed = checked.repartition(key).sortWithinPartitions(key, "doc_id", "piece", "length", "ids_crc32")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return mixed.mapInArrow(fill, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (of pieces made ``with_ids``, joined in order), n_tokens."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("n_tokens"))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID, open_bins: int = OPEN_BINS) -> DataFrame:
    """All documents as packed pieces; an empty table gives none."""
    return pack(pieces(docs, id_col, text_col, tokenizer, capacity, end_id), capacity, open_bins)
