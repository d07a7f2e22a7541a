"""Operator 5, token-ID output: binary files of Simple-8b words, in ascending order of document ids, and their reader.

A file: the magic text, then (little-endian) the numbers of documents, ids, blocks and words as 64-bit integers; the
documents' ids (64-bit) with a byte each that tells a null one; their token counts (64-bit); the first word of each block
(64-bit); the words. Files hold about ``FILE_IDS`` ids and whole documents.

Range partitioning orders the documents; each task writes its files under names of their own to the shared folder, and the
manifest, a Parquet table which Spark commits, lists those that count. A retried task's earlier files are never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mediameta.llm import simple8b
from mediameta.llm.common import shared_dir
from mediameta.llm.tokens import encoder

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: A file is closed when it has so many ids, some 10 MB.
FILE_IDS = 1 << 22
# Fixed value: what a file begins with.
MAGIC = b"S8BIDS01"


def dump(doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    """A file's bytes."""
    words, blocks = simple8b.encode(ids)
    null = np.array([d is None for d in doc_ids], np.uint8)
    names = np.array([0 if d is None else d for d in doc_ids], "<i8")
    head = np.array([len(names), len(ids), len(blocks), len(words)], "<i8")
    parts = (head, names, null, np.array(counts, "<i8"), blocks.astype("<i8"), words.astype("<u8"))
    return MAGIC + b"".join(p.tobytes() for p in parts)


def parse(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, which of them are null, token counts, ids."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    n_docs, n_ids, n_blocks, n_words = np.frombuffer(data, "<i8", 4, 8).tolist()
    at = 40
    names = np.frombuffer(data, "<i8", n_docs, at)
    null = np.frombuffer(data, np.uint8, n_docs, at := at + 8 * n_docs)
    counts = np.frombuffer(data, "<i8", n_docs, at := at + n_docs)
    blocks = np.frombuffer(data, "<i8", n_blocks, at := at + 8 * n_docs)
    words = np.frombuffer(data, "<u8", n_words, at + 8 * n_blocks)
    return names, null.astype(bool), counts, simple8b.decode(words, n_ids, blocks)


def write_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode all documents, write the files to ``path``/ids and the manifest to ``path``/manifest, and return the manifest:
    part, seq (their order), name, n_docs, n_ids.

    A null or empty text is the end id alone. Null document ids come first, equal ones in order of their texts. An empty
    table writes no file. ``path`` must be one that all executors share, of a kind that pyarrow can write.
    """

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        encode = encoder(tokenizer)
        end = int(end_id).to_bytes(4, "little")
        part, seq = TaskContext.get().partitionId(), 0
        store, folder = fs.FileSystem.from_uri(path)
        names: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal names, held, size, seq
            data = dump(names, [len(x) // 4 for x in held], np.frombuffer(b"".join(held), "<u4"))
            name = f"{part:06d}-{seq:06d}-{uuid.uuid4().hex}.s8b"
            with store.open_output_stream(f"{folder}/ids/{name}") as out:
                out.write(data)
            row = pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "name": name, "n_docs": len(names), "n_ids": size}])
            names, held, size, seq = [], [], 0, seq + 1
            return row

        kinds = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("name", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1)), strict=True):
                names.append(name)
                held.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= file_ids:
                    yield flush().cast(kinds)
        if names:
            yield flush().cast(kinds)

    spark = docs.sparkSession
    read = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    ordered = read.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/ids")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    ordered.mapInArrow(save, "part long, seq long, name string, n_docs long, n_ids long").write.parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Read the files that the manifest lists: doc_id, start (ids of all documents before), n_tokens, ids_crc32 and, if
    asked, the ids as little-endian unsigned 32-bit integers. An empty folder gives an empty result."""

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, data in zip(batch["path"], batch["content"], strict=True):
                names, null, counts, ids = parse(bytes(data))
                stops = np.cumsum(counts)
                starts = stops - counts
                flat = ids.astype("<u4")
                parts = [flat[a:b].tobytes() for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
                frame = pd.DataFrame({"name": name.rpartition("/")[2], "doc_id": pd.array(names, "Int64"), "local": starts, "n_tokens": counts, "ids_crc32": [zlib.crc32(p) for p in parts]})
                frame.loc[null, "doc_id"] = pd.NA
                if with_ids:
                    frame["ids"] = parts
                yield frame

    manifest = spark.read.parquet(f"{path}/manifest")
    # Totals by part first: each window is over the files of one part, or over one row per part.
    by_part = manifest.groupBy("part").agg(F.sum("n_ids").alias("__ids"))
    parts = by_part.withColumn("__base", F.coalesce(F.sum("__ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = manifest.withColumn("__in", inside).join(parts, "part").select("name", (F.col("__base") + F.col("__in")).alias("base"))
    files = spark.read.format("binaryFile").load(f"{path}/ids").select("path", "content")
    rows = files.mapInPandas(load, "name string, doc_id long, local long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else ""))
    return rows.join(bases, "name").select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write all documents to a new shared folder and read them back."""
    spark = docs.sparkSession
    path = shared_dir(spark, "token-ids")
    write_ids(docs, path, **options)
    return read_ids(spark, path)
