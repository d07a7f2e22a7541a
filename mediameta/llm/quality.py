"""Operator 7, quality classifier: co-training of a text view and a page-metadata view.

Each view has a logistic classifier of its own. In each round both learn from their labelled rows, and each hands its most
confident verdicts on unlabelled rows to the other as labels. On rows held out, each view is calibrated, and the calibrated
views are combined; the threshold is set there too. Then every document is scored where it is read.

The classifiers are fitted on bounded samples, ``LABELLED`` labelled and ``UNLABELLED`` other documents with the least
hashes of their ids; whole texts are read. Everything else covers all documents.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediameta.llm.common import forget_kept

#: Production parameters: sizes of the samples, rounds, labels handed over per class and round, their least confidence.
LABELLED = 6000
UNLABELLED = 4000
ROUNDS = 3
HANDED = 400
CONFIDENT = 0.95
#: The threshold keeps at least this share of good held-out documents.
KEEP_GOOD = 0.985
SEED = 11

#: Hashed features: shapes of words, words, metadata.
SHAPES, WORDS, META = 256, 256, 192
#: Further text features: repeats of the word before, and the number of words.
MEASURES = 2
REMEMBERED = 400_000

LETTERS, DIGITS = re.compile(r"[^\W\d_]+"), re.compile(r"\d+")
REPEATED = re.compile(r"(.)\1\1+")


def bucket(text: str, size: int) -> int:
    return zlib.crc32(text.encode(errors="replace")) % size


def shape(word: str) -> str:
    """Upper-case, lower-case and digit runs as A, a and 9; other characters as they are, at most three alike."""
    out = DIGITS.sub("9", LETTERS.sub(lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "Aa" if m[0][0].isupper() else "a", word))
    return REPEATED.sub(r"\1\1\1", out)[:40]


def text_features():
    """A function from a text to its row: shares of word shapes and of words, by hash, and the measures."""
    forget_kept()
    known: dict[str, int] = {}

    def row(text: str | None) -> np.ndarray:
        words = (text or "").split()
        out = np.zeros(SHAPES + WORDS + MEASURES, np.float32)
        if not words:
            return out
        if len(known) > REMEMBERED:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = bucket(shape(w), SHAPES) << 16 | bucket("w" + w.lower(), WORDS)
        codes = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        out[:SHAPES] = np.sqrt(np.bincount(codes >> 16, minlength=SHAPES) / len(words))
        out[SHAPES : SHAPES + WORDS] = np.sqrt(np.bincount(codes & 0xFFFF, minlength=WORDS) / len(words))
        out[-2] = np.sqrt((codes[1:] == codes[:-1]).mean()) * 2 if len(words) > 1 else 0
        out[-1] = np.log2(len(words)) / 8
        return out

    return row


def meta_features(lang: str | None, source: str | None, n_chars: int | None, lines: int) -> np.ndarray:
    """A page's metadata: language, source, both together, length and lines by powers of two; nulls have values of their own."""
    out = np.zeros(META, np.float32)
    size = n_chars if n_chars is not None and n_chars >= 0 else None
    for name in (f"l{lang}", f"s{source}", f"n{None if size is None else int(size).bit_length()}", f"b{lines.bit_length()}", f"r{None if size is None else (size // max(1, lines)).bit_length()}"):
        out[bucket(name, META)] += 1
    return out


@dataclass
class Logistic:
    """Logistic regression with a ridge, by Newton steps."""

    ridge: float = 1e-3
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Logistic:
        x = np.hstack([x, np.ones((len(x), 1))]).astype(float)
        w = np.zeros(x.shape[1])
        mass = np.ones(len(y)) if weight is None else weight
        mass = mass / mass.sum()
        ridge = np.full(x.shape[1], self.ridge)
        ridge[-1] = 1e-9
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (mass * (p - y)) + ridge * w
            hess = (x * (mass * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
            step = np.linalg.solve(hess, grad)
            size = np.abs(step).max()
            w -= step * min(1.0, 5 / max(size, 1e-12))
            if size < 1e-6:
                break
        self.weights = w
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)


@dataclass
class Model:
    """Two calibrated views, their combination, and the threshold on the combined probability."""

    text: Logistic
    meta: Logistic
    text_scale: tuple[float, float]
    meta_scale: tuple[float, float]
    mix: np.ndarray
    threshold: float

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of good quality: of each view, and together."""
        t = self.text.logit(text) * self.text_scale[0] + self.text_scale[1]
        m = self.meta.logit(meta) * self.meta_scale[0] + self.meta_scale[1]
        both = np.column_stack([t, m, np.ones(len(t))]) @ self.mix
        return tuple(1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (t, m, both))


def balanced(y: np.ndarray) -> np.ndarray:
    good = max(y.mean(), 1e-9)
    return np.where(y == 1, 0.5 / good, 0.5 / max(1 - good, 1e-9))


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_meta: np.ndarray, rounds: int = ROUNDS, seed: int = SEED) -> Model | None:
    """Fit on labelled rows ``y`` and a pool without labels; None if a class has fewer than 10 rows."""
    if min((y == 1).sum(), (y == 0).sum()) < 10:
        return None
    order = np.random.default_rng(seed).permutation(len(y))
    held = np.zeros(len(y), bool)
    for c in (0, 1):
        mine = order[y[order] == c]
        held[mine[: max(3, len(mine) // 4)]] = True
    views = {"text": (text, pool_text), "meta": (meta, pool_meta)}
    labels = {v: (np.empty(0, int), np.empty(0, int)) for v in views}
    models: dict[str, Logistic] = {}
    for turn in range(rounds + 1):
        for v, (own, pool) in views.items():
            rows, given = labels[v]
            target = np.concatenate([y[~held], given])
            models[v] = Logistic().fit(np.vstack([own[~held], pool[rows]]), target, balanced(target))
        if turn == rounds or not len(pool_text):
            break
        scale = {v: calibrated(models[v].logit(own[held]), y[held]) for v, (own, _) in views.items()}
        for v, other in (("text", "meta"), ("meta", "text")):
            p = 1 / (1 + np.exp(-np.clip(models[v].logit(views[v][1]) * scale[v][0] + scale[v][1], -30, 30)))
            fresh = ~np.isin(np.arange(len(p)), labels[other][0])
            for c, sure in ((1, p), (0, 1 - p)):
                best = np.flatnonzero(fresh & (sure >= CONFIDENT))
                best = best[np.argsort(-sure[best], kind="stable")][:HANDED]
                labels[other] = (np.concatenate([labels[other][0], best]), np.concatenate([labels[other][1], np.full(len(best), c)]))
    scales = {v: calibrated(models[v].logit(own[held]), y[held]) for v, (own, _) in views.items()}
    cal = np.column_stack([models[v].logit(views[v][0][held]) * scales[v][0] + scales[v][1] for v in views])
    joint = Logistic(1e-2).fit(cal, y[held])
    model = Model(models["text"], models["meta"], scales["text"], scales["meta"], joint.weights, 0.5)
    model.threshold = threshold(model.scores(text[held], meta[held])[2], y[held])
    return model


def calibrated(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt scaling: slope and intercept; a view that says nothing gets a slope near 0."""
    fit = Logistic(1e-3).fit(logits[:, None], y)
    return max(float(fit.weights[0]), 0.0), float(fit.weights[1])


def threshold(scores: np.ndarray, y: np.ndarray) -> float:
    """Where most of both classes fall on their side, among thresholds that keep ``KEEP_GOOD`` of the good ones."""
    good, bad = np.sort(scores[y == 1]), np.sort(scores[y == 0])
    most = good[int((1 - KEEP_GOOD) * len(good))]
    at = np.concatenate([[0.0], np.unique(scores)])
    middle = np.append((at[1:] + at[:-1]) / 2, at[-1])
    middle = middle[middle <= most]
    if not len(middle):
        return 0.0
    worth = 1 - np.searchsorted(good, middle) / len(good) + np.searchsorted(bad, middle) / len(bad)
    best = np.flatnonzero(worth >= worth.max() - 1e-12)
    return float(middle[best[len(best) // 2]])


COLUMNS = ("text", "lang", "source", "n_chars")


def features_of(batch: pa.RecordBatch, row) -> tuple[np.ndarray, np.ndarray]:
    texts = batch.column("text").to_pylist()
    text = np.array([row(t) for t in texts]).reshape(len(texts), SHAPES + WORDS + MEASURES)
    others = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("n_chars").to_pylist(), texts, strict=True)
    meta = np.array([meta_features(a, b, c, (t or "").count("\n") + 1) for a, b, c, t in others]).reshape(len(texts), META)
    return text, meta


def sample(docs: DataFrame, labels: DataFrame, id_col: str, label_col: str, labelled: int, unlabelled: int) -> pd.DataFrame:
    """Text and metadata features of the labelled and unlabelled sample, with ``y`` (-1: no label); at most both bounds' rows.

    A document with contradicting labels gets the more frequent one, and none if they are even.
    """
    key = F.xxhash64(F.lit(SEED), "id")
    votes = labels.select(labels[id_col].cast("long").alias("id"), labels[label_col].cast("double").alias("y")).filter("id IS NOT NULL AND y IN (0, 1)")
    votes = votes.groupBy("id").agg(F.avg("y").alias("y")).filter("y <> 0.5").select("id", F.round("y").cast("int").alias("y"))
    ids = docs.select(docs[id_col].cast("long").alias("id")).filter("id IS NOT NULL")
    with_label = ids.join(votes, "id").distinct().orderBy(key, "id").limit(labelled)
    others = ids.join(votes, "id", "left_anti").distinct().orderBy(key, "id").limit(unlabelled).withColumn("y", F.lit(-1))
    chosen = F.broadcast(with_label.unionByName(others))
    rows = docs.select(docs[id_col].cast("long").alias("id"), *[docs[c].alias(c) for c in COLUMNS]).join(chosen, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = text_features()
        for batch in batches:
            text, meta = features_of(batch, row)
            yield pa.record_batch(
                [batch.column("id").cast(pa.int64()), batch.column("y").cast(pa.int32()), pa.array([x.tobytes() for x in text], pa.binary()), pa.array([x.tobytes() for x in meta], pa.binary())],
                names=["id", "y", "t", "m"],
            )

    found = rows.mapInArrow(run, "id long, y int, t binary, m binary").groupBy("id", "y").agg(F.min("t").alias("t"), F.min("m").alias("m"))
    return found.orderBy("id").toPandas()


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", labelled: int = LABELLED, unlabelled: int = UNLABELLED, rounds: int = ROUNDS) -> Model | None:
    """The co-trained model; None if there are too few labels."""
    got = sample(docs, labels, id_col, label_col, labelled, unlabelled)
    text = np.array([np.frombuffer(x, np.float32) for x in got["t"]]).reshape(len(got), SHAPES + WORDS + MEASURES)
    meta = np.array([np.frombuffer(x, np.float32) for x in got["m"]]).reshape(len(got), META)
    y = got["y"].to_numpy(int)
    known = y >= 0
    return co_train(text[known], meta[known], y[known], text[~known], meta[~known], rounds)


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", keep_columns: bool = False) -> DataFrame:
    """doc_id, text_score, meta_score, score (probabilities of good quality) and kept for each row; or, with
    ``keep_columns``, the kept rows with their own columns.

    Null metadata are values like others, a null text counts as empty. Without a model all scores are null and all rows
    are kept. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = text_features()
        names = ["doc_id", "text_score", "meta_score", "score", "kept"]
        for batch in batches:
            read = pa.RecordBatch.from_arrays([batch.column(i) for i in at], names=["id", *COLUMNS])
            if model is None:
                some = [pa.nulls(batch.num_rows, pa.float64())] * 3
                kept = np.ones(batch.num_rows, bool)
            else:
                got = model.scores(*features_of(read, row))
                some = [pa.array(s) for s in got]
                kept = got[2] >= model.threshold
            if keep_columns:
                yield batch.filter(pa.array(kept))
            else:
                yield pa.record_batch([read.column("id").cast(pa.int64()), *some, pa.array(kept)], names=names)

    wanted = [id_col, *COLUMNS]
    if keep_columns:
        at = [docs.columns.index(c) for c in wanted]
        return docs.mapInArrow(run, docs.schema)
    at = range(len(wanted))
    return docs.select(*[docs[c] for c in wanted]).mapInArrow(run, "doc_id long, text_score double, meta_score double, score double, kept boolean")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", keep_columns: bool = False, **options) -> DataFrame:
    """Train on the labelled documents and score them all, see ``train`` and ``score``."""
    return score(docs, train(docs, labels, id_col, label_col, **options), id_col, keep_columns)
