"""Operator 8, exact top-k search by inner product, pruned with multi-resolution segment statistics.

A vector is cut into 1, then 4, then 16 segments; of each its mean and deviation are kept. For a query q and a vector x,
the squared distance is at least the sum over segments of length * ((mean q - mean x)^2 + (deviation q - deviation x)^2).
As the inner product is (|q|^2 + |x|^2 - distance^2) / 2, that bounds it from above. Each level drops the pairs that cannot
reach the query's k-th best score so far; the rest gets a finer bound, and the survivors exact products.

Queries come in blocks of ``QUERY_BLOCK`` (a stated set: every 100th row), each broadcast alone: a bounded size. The
vectors are read in partitions and never shuffled; a task keeps k rows per query, and a task's best meet in a last ranking.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediameta.llm.common import shared_dir, written

K = 10
EVERY = 100
SCALE = 1024
LEVELS = (1, 4, 16)
#: Queries broadcast at a time.
QUERY_BLOCK = 4096
#: Vectors looked at together.
ROWS = 2048
#: Larger components leave no room for exact sums in 64 bits.
LARGEST = 1 << 26


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """vec_id, v, the vector as whole numbers floor(scale * x), and row, a number of its own. Vectors which are null, or hold null or non-finite
    components, are left out; so are rows with a null id."""
    read = vectors.select(vectors[id_col].cast("long").alias("vec_id"), F.transform(vectors[vector_col], lambda x: x.cast("double")).alias("v"))
    unsound = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = read.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~unsound)
    too_large = F.raise_error(F.lit("a component is too large for exact sums")).cast("long")
    return kept.select("vec_id", F.transform("v", lambda x: F.when(F.abs(x * scale) <= LARGEST, F.floor(x * scale)).otherwise(too_large)).alias("v"), F.monotonically_increasing_id().alias("row"))


def statistics(rows: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means and deviations of each segment, times the root of its length; the segments' lengths."""
    edges = np.linspace(0, rows.shape[1], min(segments, max(1, rows.shape[1])) + 1).astype(int)
    lengths = np.diff(edges)
    if not rows.shape[1]:
        return np.zeros((len(rows), 1)), np.zeros((len(rows), 1)), np.ones(1)
    sums = np.add.reduceat(rows, edges[:-1], axis=1)
    squares = np.add.reduceat(rows * rows, edges[:-1], axis=1)
    means = sums / lengths
    deviations = np.sqrt(np.maximum(squares / lengths - means * means, 0))
    root = np.sqrt(lengths)
    return means * root, deviations * root, lengths


def upper_bounds(q: list, x: list, level: int, pairs: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Bounds on inner products from the segments' statistics: of all pairs, or of those listed.

    (|q|^2 + |x|^2 - lower distance^2) / 2 is, segment by segment, mean*mean + deviation*deviation, each times the length.
    A little is added for rounding.
    """
    (qm, qd, _), (xm, xd, _) = q[level], x[level]
    if pairs is None:
        bound = qm @ xm.T + qd @ xd.T
    else:
        i, j = pairs
        bound = np.einsum("ij,ij->i", qm[i], xm[j]) + np.einsum("ij,ij->i", qd[i], xd[j])
    return bound + np.abs(bound) * 1e-9 + 1


class Best:
    """The k best (score, vec_id) per query so far."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.rows: list[list[tuple[int, int]]] = [[] for _ in range(queries)]

    def floor(self) -> np.ndarray:
        """What a score must reach to enter, per query."""
        return np.array([r[-1][0] if len(r) == self.k else -np.inf for r in self.rows], float)

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        order = np.lexsort((ids, -scores, queries))
        queries, scores, ids = queries[order], scores[order], ids[order]
        begins = np.flatnonzero(np.r_[True, queries[1:] != queries[:-1]]) if len(queries) else []
        for a, b in zip(begins, [*begins[1:], len(queries)], strict=True) if len(queries) else ():
            b = min(b, a + self.k)
            held = self.rows[queries[a]] + list(zip(scores[a:b].tolist(), ids[a:b].tolist(), strict=True))
            held.sort(key=lambda r: (-r[0], r[1]))
            self.rows[queries[a]] = held[: self.k]


class Search:
    """The k best of each query of one length, batch by batch."""

    def __init__(self, queries: np.ndarray, numbers: np.ndarray, k: int, levels: tuple[int, ...] = LEVELS) -> None:
        self.queries, self.numbers, self.k, self.levels = queries, numbers, k, levels
        self.best = Best(len(queries), k)
        self.stats = [statistics(queries.astype(float), s) for s in levels]

    def look(self, ids: np.ndarray, numbers: np.ndarray, rows: np.ndarray) -> None:
        queries, best = self.queries, self.best
        stats = [statistics(rows.astype(float), s) for s in self.levels]
        bound = upper_bounds(self.stats, stats, 0)
        bound[self.numbers[:, None] == numbers[None, :]] = -np.inf
        if any(len(r) < self.k for r in best.rows):
            # Start from the pairs that look best.
            some = min(self.k, len(rows))
            j = np.argpartition(-bound, some - 1, axis=1)[:, :some].ravel()
            i = np.repeat(np.arange(len(queries)), some)
            real = ~np.isneginf(bound[i, j])
            i, j = i[real], j[real]
            best.add(i, (queries[i] * rows[j]).sum(axis=1), ids[j])
            bound[i, j] = -np.inf
        floor = best.floor()
        i, j = np.nonzero((bound >= floor[:, None]) & ~np.isneginf(bound))
        for a in range(0, len(i), 1 << 16):
            p, r = i[a : a + (1 << 16)], j[a : a + (1 << 16)]
            for level in range(1, len(self.levels)):
                near = upper_bounds(self.stats, stats, level, (p, r)) >= floor[p]
                p, r = p[near], r[near]
            score = (queries[p] * rows[r]).sum(axis=1)
            enter = score >= floor[p]
            best.add(p[enter], score[enter], ids[r[enter]])


def searcher(block: list[tuple[int, list[int], int]], k: int):
    """A task's search for one block of queries: (vec_id, whole numbers, number of the row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length: dict[int, list[int]] = {}
        for n, (_, v, _) in enumerate(block):
            by_length.setdefault(len(v), []).append(n)
        searches = {
            length: Search(np.array([block[n][1] for n in rows], np.int64).reshape(len(rows), length), np.array([block[n][2] for n in rows]), k)
            for length, rows in by_length.items()
        }
        for batch in batches:
            ids, numbers = batch.column("vec_id").to_numpy(), batch.column("row").to_numpy()
            lists = batch.column("v")
            lengths = lists.value_lengths().to_numpy()
            for length, search in searches.items():
                here = np.flatnonzero(lengths == length)
                for a in range(0, len(here), ROWS):
                    some = here[a : a + ROWS]
                    flat = lists.take(pa.array(some)).flatten().to_numpy()
                    search.look(ids[some], numbers[some], flat.reshape(len(some), length))
        found = [(block[n][0], n, v, s) for length, rows in by_length.items() for n, best in zip(rows, searches[length].best.rows, strict=True) for s, v in best]
        columns = list(zip(*found, strict=True)) or [[]] * 4
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["query_id", "row", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = EVERY, scale: int = SCALE, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of each row whose id is divisible by ``every``
    with all other rows, ties to the smaller id; all, if there are fewer.

    Only the query's own row is no candidate of its: another row of the same id is one. Repeated ids count as they come,
    and so may fill several ranks; a repeated query is answered as often as it comes. Vectors that are null or not finite take no part, vectors of
    another length than the query's are no candidates, and empty vectors score 0. An empty table gives an empty result.
    Components of over 2^26 after scaling are refused.
    """
    spark = vectors.sparkSession
    rows = written(whole_numbers(vectors, id_col, vector_col, scale), "topk-vectors")
    path = shared_dir(spark, "topk-found")
    order = Window.partitionBy("query_id", "row").orderBy(F.col("score").desc(), "vec_id")

    def answer(block: list[tuple[int, list[int], int]]) -> None:
        found = rows.mapInArrow(searcher(block, k), "query_id long, row long, vec_id long, score long")
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        ranked.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)

    block: list[tuple[int, list[int], int]] = []
    for row in rows.filter(F.col("vec_id") % every == 0).toLocalIterator():
        block.append((row["vec_id"], row["v"], row["row"]))
        if len(block) == query_block:
            answer(block)
            block = []
    answer(block)
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(path)
