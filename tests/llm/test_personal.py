"""Personal data: the fixed patterns against plain regular expressions, further spans against planted ones."""

from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from mediameta.llm import personal, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def plain_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    tests = [
        (EMAIL, lambda m: True),
        (IP, lambda m: all(int(p) <= 255 for p in m.group().split("."))),
        (CARD, lambda m: 14 <= len(digits(m)) <= 19 and plain_luhn(digits(m))),
        (PHONE, lambda m: 10 <= len(digits(m)) <= 15),
    ]
    return sorted((m.start(), kind, m.end()) for kind, (pattern, good) in enumerate(tests) for m in pattern.finditer(text) if good(m))


def card(rng):
    body = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
    return next(body + str(d) for d in range(10) if plain_luhn(body + str(d)))


def phone(rng):
    return f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"


@pytest.mark.parametrize("seed", range(4))
def test_fixed_spans_equal_patterns(seed):
    rng = random.Random(seed)
    parts = ["a", "Z9", "@", ".", "..", "-", "+", " ", "(", ")", "1", "23", "255", "256", "0007", "4111 1111 1111 1111", "x@y.co", "1.2.3.4", "+1 (555) 010-9999", "é", "\n", "%"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        assert personal.fixed_spans(text) == plain_spans(text), text


def test_long_texts_take_linear_time():
    began = time.perf_counter()
    for piece in ("a", "1", "1.", "a@", "+1(", "1 ", "1-", "(", " at ", "a.", "a:", "[dot]", "+"):
        text = piece * (400_000 // len(piece))
        personal.fixed_spans(text)
        personal.candidates(text)
    assert time.perf_counter() - began < 60


def corpus(rng, n=400):
    """Texts with planted data that the fixed patterns miss, and with numbers that are nothing of the kind."""
    words = lambda: " ".join(rng.choice(["the", "of", "and", "river", "stone", "märz", "light"]) for _ in range(rng.randrange(3, 12)))
    rows, planted, clean = [], {}, set()
    for i in range(n):
        kind = i % 8
        before = f"{words()} "
        if kind == 0:
            a, b = phone(rng), card(rng)
            text = f"{before}{a} {b} {words()}"
            planted[i] = {("phone", len(before), len(before) + len(a)), ("card", len(before) + len(a) + 1, len(before) + len(a) + 1 + len(b))}
        elif kind == 1:
            a = f"jo{i} [at] host{i}.example [dot] com"
            text = f"{before}mail {a}, {words()}"
            planted[i] = {("email", len(before) + 5, len(before) + 5 + len(a))}
        elif kind == 2:
            text = f"{before}isbn 978-3-16-14841{rng.randrange(10)}-0 {words()} page 12-345 67 {words()}"
            clean.add(i)
        elif kind == 3:
            text = f"{before}version 3.11.{rng.randrange(99)}, order no. {rng.randrange(10**9, 10**10)}/{i} {words()} 12:30:59 at the dot of noon"
            clean.add(i)
        else:
            text = f"{before}{[phone(rng), card(rng), f'a.{i}@mail.example.com', f'10.0.{rng.randrange(255)}.{rng.randrange(255)}'][kind - 4]} {words()}"
        rows.append((i, text))
    return rows, planted, clean


def test_planted_spans_are_found_and_clean_texts_left_alone(spark):
    rows, planted, clean = corpus(random.Random(5))
    found = personal.find_personal(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = {r.doc_id: r.spans for r in found.collect()}
    texts = dict(rows)
    for i, spans in got.items():
        assert {(s.start, personal.KINDS.index(s.kind), s.end) for s in spans if s.fixed} == set(plain_spans(texts[i]))
    hits = sum(want <= {(s.kind, s.start, s.end) for s in got[i]} for i, want in planted.items())
    assert hits >= 0.95 * len(planted)
    assert sum(not got[i] for i in clean) >= 0.98 * len(clean)
    some = next(i for i in planted if i % 8 == 0)
    hidden = personal.redact(texts[some], [(s.start, s.kind, s.end) for s in got[some]])
    assert "<phone> <card>" in hidden and not re.search("[0-9]", hidden)


def test_odd_rows(spark):
    rows = [(None, None, 1), (None, "", 2), (7, "a@b.cd", 3), (7, "a@b.cd", 4), (7, "none", 5), (9, "x" * 300_000 + " a@b.cd", 6)]
    given = spark.createDataFrame(rows, "doc_id long, text string, spans long")
    got = sorted((r.doc_id or -1, r.n_email, r.spans) for r in personal.digest(personal.find_personal(given)).collect())
    assert got == [(-1, 0, ""), (-1, 0, ""), (7, 0, ""), (7, 1, "email:0:6"), (7, 1, "email:0:6"), (9, 1, "email:300001:300007")]
    assert personal.find_personal(given.limit(0)).collect() == []


def test_reliabilities_find_the_good_labelers():
    rng = random.Random(1)
    right = [0.95, 0.9, 0.8, 0.7, 0.6, 0.55]
    counts: dict[int, int] = {}
    for _ in range(20000):
        true = rng.random() < 0.3
        votes = [2 if (rng.random() < r) == true else 0 for r in right]
        key = sum(v * 3**i for i, v in enumerate(votes))
        counts[key] = counts.get(key, 0) + 1
    prior, rates = personal.reliabilities(counts)
    assert abs(prior - 0.3) < 0.05
    assert all(abs(rates[i, 1, 2] - r) < 0.06 and abs(rates[i, 0, 0] - r) < 0.06 for i, r in enumerate(right))


def test_query(spark, sf_dir):
    texts = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = []
    for i, t in texts:
        spans = plain_spans(t)
        shown = ",".join(f"{personal.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        want.append((i, *(sum(s[1] == k for s in spans) for k in range(4)), hashlib.sha256(shown.encode()).hexdigest()))
    rows = queries.QUERIES["op11_personal_data"](spark, sf_dir).collect()
    assert sorted(tuple(r)[:6] for r in rows) == sorted(want)
    for r in rows:
        listed = r.spans.split(",") if r.spans else []
        assert len(listed) == r.n_email + r.n_ip + r.n_card + r.n_phone + r.n_added
