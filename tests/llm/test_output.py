"""Packing, token files, mixing, sharding."""

import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from mediameta.llm import mixing, packing, sharding, simple8b, tokenids, tokens

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for i in range(300):
        n = rng.choice([0, 1, 3, 40, 200, 900])
        text = " ".join(rng.choice(["Straße", "été", "the", "Thing,", "3.14", "a\u0301b", "line\nbreak", "x" * 30]) for _ in range(n))
        out.append((i * 7, text, "en", f"s{rng.randrange(4)}", len(text)))
    out += [(None, "no id", None, None, None), (None, None, None, None, None), (5, None, "en", None, 0), (7, "again", "en", "s1", 5), (7, "again", "en", "s1", 5), (8, "word " * 9000, "en", "z", 1)]
    return out


def reference_ids(tokenizer, text, end):
    """By the library's plain call, without any setting of ours."""
    model = Tokenizer.from_file(public_tokenizers.path(tokenizer))
    return [*model.encode(text or "", add_special_tokens=False).ids, end]


def test_units_give_whole_text_ids(monkeypatch):
    rng = random.Random(1)
    odd = list("\t\n\x0b\x0c\r\x1c\x1d \x85\xa0\u1680\u2003\u2028\u202f\u3000\u200b\u0301\u0327\u0130Σςßœ<|endoftext|>'s're") + ["a", " ", " ", "B", "9", ","]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randrange(50))) for _ in range(1500)] + ["", "ΟΔΟΣ Σ", "<|endoftext|> x", "foo <|endoftext|> bar", "a<|startoftext|>b  <|endoftext|>", "<|endoftext|>" * 3 + "\n", " lead  and trail ", "one\n two \nthree"]
    for part in (1 << 20, 5):
        monkeypatch.setattr(tokens, "PART", part)
        for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
            model = Tokenizer.from_file(public_tokenizers.path(name))
            for text, got in zip(texts, tokens.encoder(name)(texts), strict=True):
                assert np.frombuffer(got, "<u4").tolist() == model.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_with_any_marks_go_the_short_way(monkeypatch, name):
    rng = random.Random(6)
    marks = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    texts = [" ".join("".join(rng.choices("abcéÀßsStTdD", k=rng.randrange(1, 9))) + "".join(rng.choices(marks, k=rng.randrange(4))) for _ in range(60)).replace(", ", ",\n") for _ in range(300)]
    model = Tokenizer.from_file(public_tokenizers.path(name))
    words = tokens.Words(tokens.load(name))
    monkeypatch.setattr(tokens.Units, "whole", lambda self, unit: pytest.fail(f"{unit!r} went through the whole tokenizer"))
    for text in texts:
        assert np.frombuffer(words.encode(text), "<u4").tolist() == model.encode(text, add_special_tokens=False).ids


def test_workers_keep_few_units():
    texts = [" ".join(f"{chr(97 + i % 26)}{'abcdefghij'[i // 26 % 10]}" + "".join("klmnopqrst"[int(d)] for d in str(i)) for i in range(k, k + 1000)) + f" {k}" for k in range(0, 150_000, 1000)]
    kept = tokens.worker_words("byte_bpe_50k.json")
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text, ids in zip(texts, tokens.encoder("byte_bpe_50k.json")(texts + [None]), strict=False):
        assert np.frombuffer(ids, "<u4").tolist() == model.encode(text, add_special_tokens=False).ids
    assert len(kept.units) + len(kept.units.pieces) + (len(kept) if isinstance(kept, dict) else 0) < 100_000


def test_added_tokens_of_marks_are_found():
    model = tokens.load("byte_bpe_50k.json")
    model.add_special_tokens(["$$"])
    assert np.frombuffer(tokens.Words(model).encode("a word$$ more"), "<u4").tolist() == model.encode("a word$$ more", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.just(0), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=3000))
def test_simple8b_round_trip(values):
    given_ = np.array(values, np.uint64)
    words, blocks = simple8b.encode(given_)
    assert simple8b.decode(words, len(given_), blocks).tolist() == values
    if len(blocks) > 1:
        # A block can be read alone.
        alone = simple8b.decode(words[blocks[1] : blocks[2] if len(blocks) > 2 else None], min(1024, len(values) - 1024), np.array([0]))
        assert alone.tolist() == values[1024:2048]


def test_simple8b_runs_and_sizes():
    zeros = np.zeros(2400, np.uint64)
    words, blocks = simple8b.encode(zeros)
    assert len(words) < 20 and (simple8b.decode(words, 2400, blocks) == 0).all()
    assert len(simple8b.encode(np.full(1020, 7, np.uint64))[0]) == 51


def test_token_files(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("name", F.lit("clash")).withColumn("start", F.lit(0))
    path = tokenids.shared_dir(spark, "test-ids")
    manifest = tokenids.write_ids(docs, path, file_ids=5000)
    assert manifest.count() > 3 and manifest.agg(F.sum("n_docs")).first()[0] == len(rows)
    got = tokenids.read_ids(spark, path, with_ids=True).orderBy("start").collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at = 0
    assert len(got) == len(rows)
    for r, (doc_id, text, *_) in zip(got, ordered, strict=True):
        ids = reference_ids(tokenids.TOKENIZER, text, 2)
        assert (r.doc_id, r.start, r.n_tokens) == (doc_id, at, len(ids))
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_token_files_of_nothing(spark, rows):
    assert tokenids.round_trip(spark.createDataFrame(rows, SCHEMA).limit(0)).count() == 0
    with pytest.raises(ValueError):
        tokenids.parse(b"something else")


def test_packing(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("sequence_id", F.lit("clash"))
    pieces = packing.pieces(docs, with_ids=True)
    packed = packing.pack(pieces).persist()
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        by_doc[r.doc_id].append(r)
        by_bin[r.sequence_id].append(r)
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    for doc_id, text, *_ in rows:
        if doc_id in (None, 7):
            continue
        own = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and all(r.length == 2048 for r in own[:-1])
        assert np.frombuffer(b"".join(r.ids for r in own), "<u4").tolist() == reference_ids(packing.TOKENIZER, text, 0)
        assert [r.start for r in own] == [2048 * k for k in range(len(own))]
    repeated = [len(reference_ids(packing.TOKENIZER, r[1], 0)) for r in rows if r[0] == 7]
    assert len(by_doc[None]) == 2 and sum(r.length for r in by_doc[7]) == sum(repeated)
    for own in by_bin.values():
        at = 0
        for r in sorted(own, key=lambda r: (r.offset, r.length)):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    joined = packing.sequences(packed)
    assert {r.sequence_id: len(r.ids) // 4 for r in joined.collect()} == {k: sum(r.length for r in v) for k, v in by_bin.items()}
    packed.unpersist()


@pytest.mark.parametrize("most", [1, 3, 10_000])
def test_bins(most):
    rng = random.Random(most)
    bins, free, open_ = packing.Bins(100, most), {}, set()
    for _ in range(3000):
        n = rng.randrange(0, 101)
        fitting = [free[b] for b in open_ if free[b] >= n]
        number, offset = bins.put(n)
        still = {b for by_free in bins.by_free for b in by_free}
        if fitting:
            assert free[number] == min(fitting)
        else:
            assert number not in free
            closed = open_ - still
            assert len(closed) == (len(open_) == most)
            assert all(free[b] == min(free[x] for x in open_) for b in closed)
            open_ -= closed
            free[number] = 100
            open_.add(number)
        assert offset == 100 - free[number]
        free[number] -= n
        if not free[number]:
            open_.discard(number)
        assert open_ == still and len(open_) <= most
        assert bins.bits == sum(1 << f for f in {free[b] for b in open_})


def test_packing_is_tight(spark):
    rng = random.Random(2)
    sizes = [rng.randrange(1, 2049) for _ in range(6000)]
    pieces = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(sizes)], packing.PIECES)
    bins = packing.pack(pieces).select("sequence_id").distinct().count()
    assert bins <= sum(sizes) / 2048 * 1.06
    with pytest.raises(Exception, match="longer than a sequence"):
        packing.pack(pieces.withColumn("length", F.lit(2049))).collect()


def fair_targets(sizes, weights=(1, 2, 3), times=3):
    """Shares of the whole by weight; what exceeds ``times`` the size goes to the others, until none does."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = Fraction(sum(sizes.values())), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > times * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = Fraction(times * sizes[s])
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=9))
def test_targets(spark, sizes):
    given_ = {f"s{i}" if i else None: n for i, n in enumerate(sizes)}
    frame = spark.createDataFrame(list(given_.items()), "source string, source_size long")
    got = {r.source: r for r in mixing.targets(frame).collect()}
    want = fair_targets(given_)
    for s in given_:
        assert got[s].target == pytest.approx(float(want[s])) and got[s].quota == int(want[s])


def test_mixing(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("words", F.lit("clash")).withColumn("finish", F.lit(None).cast("string"))
    planned = mixing.schedule(docs)
    taken, sizes = Counter(), Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len((text or "").split())
    want = fair_targets(sizes)
    queue = mixing.copies(planned).collect()
    for r in queue:
        taken[r.source] += r.words
        assert 0 < r.words <= r["size"] and r.epoch < 3
    assert all(taken[s] == int(want[s]) for s in sizes)
    assert [r.finish for r in queue] == sorted(r.finish for r in queue)
    again = mixing.copies(mixing.schedule(docs.repartition(7))).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, queue))
    whole = mixing.mix(docs)
    assert whole.columns == docs.columns
    counts = Counter(r.doc_id for r in whole.collect())
    assert max(n for d, n in counts.items() if d not in (None, 7)) <= 3
    scheduled = Counter(r.doc_id for r in queue if 2 * r.words >= r["size"])
    assert all(counts[d] == n for d, n in scheduled.items() if d not in (None, 7))
    assert mixing.copies(mixing.schedule(docs.limit(0))).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


def test_sharding(spark, rows):
    shards = tuple(f"n{i}" for i in range(7))
    table = sharding.fill(shards, 1009)
    counts = Counter(table)
    assert len(counts) == 7 and max(counts.values()) - min(counts.values()) <= 1
    # Each slot belongs to the first shard, in turns, that came by.
    walks = {i: iter([(o + k * s) % 1009 for k in range(1009)]) for i, (o, s) in enumerate(sharding.preference(n, 1009) for n in shards)}
    slow = {}
    while len(slow) < 1009:
        for i in range(7):
            slot = next((x for x in walks[i] if x not in slow), None)
            if slot is not None:
                slow[slot] = i
    assert [slow[i] for i in range(1009)] == table
    fewer = sharding.fill(shards[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != 6)
    assert moved < 0.25 * 1009
    with pytest.raises(ValueError):
        sharding.fill(shards, 1000)
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("slot", F.lit(-1)).withColumn("i", F.lit(3))
    placed = sharding.place(docs, shards=shards, slots=1009)
    got = placed.collect()
    assert len(got) == len(rows) and all(r.shard == shards[table[r.slot]] for r in got)
    assert len({r.shard for r in got if r.doc_id is None}) == 1 and sharding.place(docs.limit(0)).count() == 0
    path = tokenids.shared_dir(spark, "test-shards")
    sharding.write_shards(docs, path, shards=shards, slots=1009)
    assert spark.read.parquet(path).count() == len(rows)


def test_columns_of_our_names_stay(spark):
    rows = [(1, "keepme", 5, "x"), (2, "too", 6, "y")]
    placed = sharding.place(spark.createDataFrame(rows, "doc_id long, __slot string, at long, c0 string")).orderBy("doc_id").collect()
    assert [(r.doc_id, r["__slot"], r["at"], r.c0) for r in placed] == rows
    pieces = spark.createDataFrame([(1, 0, 0, 9, 5, 77, 88)], "doc_id long, piece int, start long, length long, ids_crc32 long, Offset long, sequence_id long")
    packed = packing.pack(pieces)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert packed.first().offset == 0
