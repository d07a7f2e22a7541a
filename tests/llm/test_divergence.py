"""Source divergence against brute force, and its transducer against a sorted list."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from mediameta.llm import divergence
from mediameta.llm.transducer import Transducer

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, ordinal long, term string"


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text)]


def plain_audit(rows, least):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source, found = lang or "", source or "", terms_of(text or "")
        docs[lang].update(set(found))
        counts[lang, source].update(found)
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = sorted((t for t, n in docs[lang].items() if n >= least), key=str.encode)
        whole = sum((counts[lang, s] for s in sources), Counter())

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            words = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", words, 50)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.add((lang, s, part, item, value, rank))
    return out


def some_rows(seed, n=300):
    rng = random.Random(seed)
    words = ["Rot", "rot", "Été", "été", "ÉTÉ", "x", "xy", "xyz", "señal", "größe", "a1b", "don't", "日本", "\U0001f600", "z" * 40, "foo_bar", "É"]
    words += [f"w{'abcdefgh'[i % 8]}{'ij'[i % 2]}{'klmno'[i % 5]}" for i in range(60)]
    rows = []
    for _ in range(n):
        text = rng.choice([None, "", "12 34", *[" ".join(rng.choices(words, k=rng.randrange(1, 60))) for _ in range(12)]])
        rows.append((rng.choice(["de", "de", "fr", "", None]), rng.choice(["s1", "s2", "s3", "ß", None, ""]), text))
    return rows + [("en", "alone", "one text"), ("it", "a", None), ("it", "b", "42")]


def frame(spark, rows):
    # Columns of the operator's own names besides, which it does not read.
    return spark.createDataFrame([(i % 7, t, l, s, 1, "x") for i, (l, s, t) in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_brute_force(spark, seed):
    rows = some_rows(seed)
    found = divergence.audit(frame(spark, rows).repartition(5))
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == sorted(plain_audit(rows, 30))


def test_small_blocks_rounds_and_tiles(spark, monkeypatch):
    rows = some_rows(3, 200)
    monkeypatch.setattr(divergence, "HELD", 20)
    found = divergence.audit(frame(spark, rows), least=3, reported=50, block_terms=4, round_bytes=600)
    assert sorted(map(tuple, found.collect())) == sorted(plain_audit(rows, 3))


def test_tiles_cover_every_pair_once(spark):
    rng = random.Random(4)
    sizes = {f"s{i}": rng.randrange(1, 9) for i in range(23)}
    groups = spark.createDataFrame([("de", s, 50, len(sizes), 7) for s in sizes], "lang string, source string, terms long, sources long, none long")
    p = {s: {t: rng.randrange(100) for t in rng.sample(range(50), n)} for s, n in sizes.items()}
    counts = spark.createDataFrame([("de", s, t, v) for s in p for t, v in p[s].items()], "lang string, source string, ordinal long, p long")
    got = sorted(map(tuple, divergence.pairs(counts, groups, tile_terms=8, tile_sources=4).collect()))
    want = sorted(("de", a, b, sum(abs(p[a].get(t, 7) - p[b].get(t, 7)) for t in range(50))) for a in p for b in p if a != b)
    assert got == want


def test_empty_table(spark):
    assert divergence.audit(frame(spark, some_rows(5, 3)).limit(0)).collect() == []


def test_transducer_is_minimal_and_ranks_terms():
    rng = random.Random(6)
    terms = sorted({bytes(rng.choices(b"abc\xc3", k=rng.randrange(1, 9))) for _ in range(3000)})
    made = Transducer.unpack(Transducer.build(terms).pack())
    assert len(made) == len(terms) and [made.term(i) for i in range(len(terms))] == terms
    tries = terms + [bytes(rng.choices(b"abc\xc3", k=rng.randrange(0, 12))) for _ in range(3000)]
    text = np.frombuffer(b"".join(tries), np.uint8)
    lengths = np.array([len(t) for t in tries])
    rank = {t: i for i, t in enumerate(terms)}
    assert made.ordinals(text, np.cumsum(lengths) - lengths, lengths).tolist() == [rank.get(t, -1) for t in tries]
    # As many states as there are different sets of endings.
    endings = defaultdict(set)
    for t in terms:
        for i in range(len(t) + 1):
            endings[t[:i]].add(t[i:])
    assert len(made.final) == len({frozenset(e) for e in endings.values()})
    assert Transducer.build([]).ordinals(text, np.array([0]), np.array([3])).tolist() == [-1]
