"""Exact and near copies, and repeated passages, against brute force."""

import random
import re
from collections import defaultdict
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from mediameta.llm import chunks, exact_dedup, ngram_join
from mediameta.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACE, WORD = re.compile(r"[\x20\x09-\x0D]+"), re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


def prose(rng, n, words=4000):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Copies, chains of near copies, a shared passage, odd texts."""
    rng = random.Random(3)
    rows, passage = [], prose(rng, 60)
    for _ in range(30):
        base = prose(rng, rng.randrange(3, 120))
        rows += [base] * rng.randrange(1, 4)
        for _ in range(rng.randrange(0, 4)):
            words = base.split()
            for _ in range(max(1, len(words) // 40)):
                words[rng.randrange(len(words))] = "changed"
            rows.append(" ".join(words))
        rows.append(prose(rng, 80) + " " + passage + " " + prose(rng, 20))
    # A chain whose ends are not similar, and a group that is hot.
    words = prose(rng, 200).split()
    for k in range(12):
        words[k * 16 : k * 16 + 4] = [f"x{k}{j}" for j in range(4)]
        rows.append(" ".join(words))
    rows += ["Hot text here\n\nagain and again"] * 200
    rows += [None, "", " ", "\t\n", "one", "One", "ONE two", "one  two", "É é", "a b c d e", "a b c d e\n", "x" * 50_000, "q w e r t " * 3000]
    return list(enumerate(rows))


def exact_truth(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[SPACE.sub(" ", t or "")].append(i)
    return {i: (min(g), len(g)) for g in groups.values() for i in g}


def near_truth(rows, n=5):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(low))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sets, 2):
        k = len(sets[a] & sets[b])
        if k and 100 * k >= 75 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_exact_groups(spark, corpus):
    import hashlib

    got = exact_dedup.exact_groups(frame(spark, corpus)).collect()
    texts = dict(corpus)
    assert {r.doc_id: (r.keep_id, r.group_size) for r in got} == exact_truth(corpus) and len(got) == len(corpus)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    assert all(r.text_sha256 == hashlib.sha256(SPACE.sub(" ", texts[r.doc_id] or "").encode()).hexdigest() for r in got)


def test_directory_doubles(spark, corpus):
    index, slots = exact_dedup.build_index(frame(spark, corpus), capacity=4)
    sizes = index.groupBy("bucket").count()
    assert sizes.agg(F.max("count")).first()[0] <= 4 and sizes.count() > 8
    assert index.count() == len({SPACE.sub(" ", t or "") for _, t in corpus})


def test_exact_dedup_rows(spark, corpus):
    docs = frame(spark, [*corpus, *corpus[:5], (None, "only null"), (None, "only null"), (None, corpus[0][1])])
    docs = docs.withColumn("hash", F.lit(1)).withColumn("keep_id", F.lit("x")).withColumn("body", F.lit(None).cast("string"))
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    want = {k for k, _ in exact_truth(corpus).values()} | {None}
    assert sorted(kept.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0)) and [r.doc_id for r in kept.collect()].count(None) == 1
    assert {r.doc_id for r in kept.collect()} == want and kept.count() == len(want)


@pytest.mark.parametrize("block", [3, 1024])
def test_ngram_components(spark, corpus, block):
    got = ngram_join.ngram_components(frame(spark, corpus), block=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_truth(corpus) and len(got) == len(corpus)


def test_ngram_without_known_counts(spark, corpus):
    got = ngram_join.ngram_components(frame(spark, corpus), frequent=1, block=8).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_truth(corpus)


def test_repeated_ngrams_are_counted(spark, corpus):
    """Every n-gram of two classes is there; nothing that is needed passes the sieve unseen, however full it is."""
    texts = ngram_join.texts_of(frame(spark, corpus), "doc_id", "text")
    counts = {r.prefix: r.times for r in ngram_join.repeated(texts, 5, 6).collect()}
    grams_of, truth = ngram_join.shingler(5), defaultdict(set)
    for _, t in corpus:
        grams = grams_of(t)
        for g in (grams.view(np.uint64) >> np.uint64(26)).tolist():
            truth[g].add(grams.tobytes())
    assert {g for g, sets in truth.items() if len(sets) > 1} <= set(counts)
    values = spark.createDataFrame([(-5,), (3,), (None,)], "x long")
    bits = ngram_join.sieve(values, [F.col("x")], 128)
    assert ngram_join.passes(bits, np.array([-5, 3, 0])).all() and not ngram_join.passes(bits, np.array([4])).any()


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(-400, 400), rng.randrange(-400, 400)) for _ in range(350)] + [(i, i + 1) for i in range(1000, 1300)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: find(i) for a, b in links if a != b for i in (a, b)}


def test_empty_tables(spark, corpus):
    none = frame(spark, corpus[:1]).limit(0)
    assert exact_dedup.exact_groups(none).count() == 0
    assert exact_dedup.exact_dedup(none).count() == 0
    assert ngram_join.ngram_components(none).count() == 0
    assert chunks.repeated_spans(none).count() == 0


def chunk_truth(text):
    """Cuts by the definition, byte by byte."""
    data, table = text.encode(), chunks.gear().tolist()
    out, last = [], 0
    for i in range(len(data)):
        h = 0
        for b in data[max(0, i - chunks.WINDOW + 1) : i + 1]:
            h = ((h << 1) + table[b]) & 0xFFFFFFFF
        size = i + 1 - last
        if (h >> (32 - chunks.CUT_BITS) == 0 and size >= chunks.LEAST) or size == chunks.MOST or i + 1 == len(data):
            out.append((last, size))
            last = i + 1
    return out


def test_chunks(spark, corpus, monkeypatch):
    rows = [(i, t) for i, t in corpus if t and len(t) < 4000][:60] + [(9000, "aaaa" * 700), (9001, "é" * 300), (9002, None)]
    got = defaultdict(list)
    for r in chunks.chunk(frame(spark, rows)).collect():
        got[r.doc_id].append((r.start, r.length))
    for i, t in rows:
        assert sorted(got[i]) == (chunk_truth(t) if t else [])


def test_repeated_passages_are_found(spark):
    rng = random.Random(8)
    passage = prose(rng, 55)
    rows = [(i, prose(rng, 100, 10**6)) for i in range(40)]
    for i in (4, 9, 17):
        rows[i] = (i, rows[i][1] + "\n" + passage + " " + prose(rng, 30, 10**6))
    docs = frame(spark, rows)
    spans = chunks.repeated_spans(docs)
    found = spans.collect()
    assert {(r.doc_id, r.first_doc_id) for r in found} == {(9, 4), (17, 4)}
    texts = dict(rows)
    for r in found:
        assert texts[r.doc_id].encode()[r.start : r.start + r.length].decode() in passage + " " and r.length >= len(passage) * 0.5
    left = {r.doc_id: r.text for r in chunks.cut_spans(docs, spans).collect()}
    assert len(left) == len(rows) and all(left[i] == texts[i] for i in left if i not in (9, 17))
    assert passage not in left[9] and passage in left[4]


def span_truth(rows, least=chunks.LEAST_SPAN):
    """(doc_id, start, length, first_doc_id) by the definition: all windows, in order, that a dictionary has from before."""
    space, first, out = b" \t\n\x0b\x0c\r", {}, []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data, spans = (t or "").encode(), []
        for p in range(len(data) - least + 1):
            doc, at = first.setdefault(data[p : p + least], (i, p))
            if doc != i or p >= at + least:
                if spans and p <= spans[-1][1]:
                    spans[-1][1] = p + least
                else:
                    spans.append([p, p + least, {}])
                spans[-1][2][p] = doc
        for a, b, docs in spans:
            begins = [q for q in range(a, a + chunks.WORD_REACH + 1) if q == 0 or data[q - 1] in space and data[q] not in space]
            ends = [q for q in range(b - chunks.WORD_REACH, b + 1) if q == len(data) or data[q] in space and data[q - 1] not in space]
            a, b = min(begins, default=a), max(ends, default=b)
            out.append((i, a, b - a, docs[max(p for p in docs if p <= a)]))
    return out


def test_spans_are_all_repeated_windows(spark, corpus):
    rng = random.Random(21)
    rows = [(i, t if len(t or "") < 20_000 else t[:1500]) for i, t in corpus]
    passages = ["".join(rng.choice("é abcß") for _ in range(n)) for n in (100, 127, 128, 129, 140, 300)]
    for k in range(80):
        own = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(200))) for _ in range(3)]
        rows.append((10_000 + k, own[0] + rng.choice(passages) + own[1] + rng.choice(passages)[rng.randrange(60) :] + own[2]))
    rows += [(20_000, "abcdefghi " * 60), (20_001, "b" * 700), (20_002, "b" * 129), (None, rows[-1][1] + " behind")]
    got = [(r.doc_id, r.start, r.length, r.first_doc_id) for r in chunks.repeated_spans(frame(spark, rows).repartition(7)).collect()]
    assert sorted(got, key=repr) == sorted(span_truth(rows), key=repr)
    few = rows[:60] + rows[-60:]
    got = [(r.doc_id, r.start, r.length, r.first_doc_id) for r in chunks.repeated_spans(frame(spark, few), least_span=77).collect()]
    assert sorted(got, key=repr) == sorted(span_truth(few, 77), key=repr)


def near_copies(rng, docs, originals):
    """Documents that are a copy of one of a few, with a word changed here and there."""
    texts = [prose(rng, 300, 10**6).split() for _ in range(originals)]
    return [(i, " ".join(str(rng.random()) if rng.random() < 0.02 else w for w in texts[i % originals])) for i in range(docs)]


def test_windows_of_many_different_runs(spark, monkeypatch):
    """Seeds with more different runs than a task compares have their windows compared by digest, with the same result."""
    rows = near_copies(random.Random(5), 60, 4)
    for many in (20_000, 3, 0):
        monkeypatch.setattr(chunks, "MANY", many)
        got = [(r.doc_id, r.start, r.length, r.first_doc_id) for r in chunks.repeated_spans(frame(spark, rows)).collect()]
        assert sorted(got) == sorted(span_truth(rows))


def test_near_copies_write_less_than_their_texts(spark):
    """Windows are compared where the bytes of their runs meet, and not listed one by one in the shared folder."""
    rows = near_copies(random.Random(6), 200, 8)
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    size = lambda: sum(f.stat().st_size for f in folder.rglob("*") if f.is_file())
    begun = size()
    assert chunks.repeated_spans(frame(spark, rows)).count() > 500
    assert size() - begun < sum(len(t) for _, t in rows)


def test_no_planted_passage_is_missed(spark):
    """Passages of 51 to 100 words in two to ten documents each: every later copy is found, whole."""
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows, planted = [text(60) for _ in range(1500)], []
    for n in [51] * 150 + [60] * 60 + [80] * 60 + [100] * 60:
        passage = text(n)
        for i in sorted(rng.sample(range(len(rows)), rng.randrange(2, 11))):
            planted.append((i, passage))
            rows[i] += " " + passage + " " + text(20)
    spans = defaultdict(list)
    for r in chunks.repeated_spans(frame(spark, list(enumerate(rows)))).collect():
        spans[r.doc_id].append((r.start, r.start + r.length))
    seen, later = set(), []
    for i, passage in planted:
        if passage in seen:
            later.append((i, rows[i].index(passage), len(passage)))
        seen.add(passage)
    assert len(later) > 1000 and all(any(a <= at and at + n <= b for a, b in spans[i]) for i, at, n in later)


def test_long_texts_come_in_parts(monkeypatch):
    """Each window of a text is in one run, also where parts meet."""
    monkeypatch.setattr(chunks, "PART", 1000)
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"abc ") for _ in range(n)) for n in (5000, 0, 127, 128, 999, 1127, 1128)]
    seen = defaultdict(list)
    for data, listed in chunks.parts(list(range(len(texts))), texts, 128):
        for k, first, last, seed in chunks.runs(listed, np.frombuffer(data, np.uint8), chunks.gear(), 128):
            name, at, _, offset, _ = listed[k]
            for a, b, s in zip(first.tolist(), last.tolist(), seed.tolist(), strict=True):
                assert a <= b <= s <= a + 128 - chunks.WINDOW
                seen[name] += range(a - at + offset, b - at + offset + 1)
    assert all(seen[i] == list(range(max(0, len(t) - 127))) for i, t in enumerate(texts))


def test_cuts_go_by_row(spark):
    """Rows that share an id, or have none, are cut by their own spans; a clean one loses nothing."""
    rng = random.Random(21)
    passage, clean = prose(rng, 60), [prose(rng, 150, 10**9) for _ in range(4)]
    rows = [(1, passage + " " + clean[0]), (2, clean[1] + " " + passage), (2, clean[2]), (None, passage + " " + clean[3]), (None, prose(rng, 80, 10**9)), (None, None), (7, "")]
    docs = frame(spark, rows)
    spans = chunks.repeated_spans(docs)
    assert sorted((str(r.doc_id), r.first_doc_id) for r in spans.collect()) == [("2", 1), ("None", 1)]
    left = sorted((str(r.doc_id), r.text or "") for r in chunks.cut_spans(docs, spans).collect())
    want = [("1", rows[0][1]), ("2", clean[1] + " "), ("2", clean[2]), ("None", " " + clean[3]), ("None", rows[4][1]), ("None", ""), ("7", "")]
    assert left == sorted(want)


def test_tasks_remember_few_words():
    hashes = ngram_join.WordHashes()
    for i in range(300_000):
        assert hashes[str(i).encode()] == hashes[str(i).encode()]
    assert len(hashes) <= 250_000


def test_workers_drop_what_other_operators_keep():
    """A worker goes through all stages: what packing keeps between its tasks is gone when those of another operator begin."""
    import weakref

    from mediameta.llm import quality, tokens

    for begin in (lambda: ngram_join.shingler(5), quality.text_features, lambda: tokens.worker_words("byte_bpe_50k.json")):
        words = tokens.worker_words("word_bpe_49k.json")
        assert words is tokens.worker_words("word_bpe_49k.json") and len(words.encode("some words")) > 0
        gone = weakref.ref(words), weakref.ref(words.units)
        del words
        begin()
        assert [r() for r in gone] == [None, None]


def test_columns_occur_twice(spark, corpus, monkeypatch):
    """Texts without a repeated n-gram have no columns, were all bits of all sieves set."""
    tables = {}

    def written(df, label, write=ngram_join.written):
        tables[label] = write(df, label)
        return tables[label]

    monkeypatch.setattr(ngram_join, "written", written)
    monkeypatch.setattr(ngram_join, "sieve", lambda values, columns, size=128: np.full(size // 64, -1))
    rng = random.Random(8)
    rows = [*enumerate([prose(rng, 100, 10**9) for _ in range(60)], 10**6), *corpus]
    got = ngram_join.ngram_components(frame(spark, rows).coalesce(1)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_truth(rows)
    columns = tables["ngram-columns"].filter("gram IS NOT NULL")
    assert columns.count() > 0 and columns.filter("doc_id >= 1000000").count() == 0


def test_small_bundles(spark, corpus, monkeypatch):
    """Bundles of few n-grams, which tell of each one once or twice, give what one large bundle gives."""
    monkeypatch.setattr(ngram_join, "COUNTED", 300)
    monkeypatch.setattr(ngram_join, "TOLD", 2)
    hot = [(10**6 + i, f"{t} the same hot passage of words in all of them {i}") for i, (_, t) in enumerate(corpus[:60])]
    rows = [*corpus, *hot, (None, "the same hot passage of words in all of them")]
    got = ngram_join.ngram_components(frame(spark, rows).repartition(3)).collect()
    want = near_truth([(i if i is not None else -1, t) for i, t in rows[:-1]])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want and len(got) == len(rows)


def test_cross_pairs_by_cluster(spark, monkeypatch):
    """Classes that meet in many columns are multiplied once, as a cluster; a long chain of columns goes column by column."""
    from mediameta.llm.ngram_join import THRESHOLD, room

    tables = {}

    def written(df, label, write=ngram_join.written):
        tables[label] = write(df, label)
        return tables[label]

    monkeypatch.setattr(ngram_join, "written", written)
    rng = random.Random(9)
    live = [(g, c, rng.randrange(12)) for k in range(30) for g, c in ((k, k), (k, k + 1))]
    live += [(1000 + g, c, g) for c in range(100, 140) for g in range(20) if rng.random() < 0.8]
    size = {c: rng.randrange(36, 44) for _, c, _ in live}
    root = {c: rng.randrange(6) + 10**6 for c in size if rng.random() < 0.7}
    frame_ = spark.createDataFrame([(g, c, size[c], p, c) for g, c, p in live], "gram long, cls long, n long, pos long, pivot long")
    roots = spark.createDataFrame(list(root.items()), "node long, root long")
    columns = {c: {g: p for g, d, p in live if d == c} for c in size}
    want = set()
    for a, b in combinations(sorted(size), 2):
        both = columns[a].keys() & columns[b].keys()
        if both and root.get(a, a) != root.get(b, b) and room(len(both), max(columns[a][g] for g in both), max(columns[b][g] for g in both), size[a], size[b], min, max, THRESHOLD):
            want.add((a, b))
    for block in (7, 1024):
        assert {(r.a, r.b) for r in ngram_join.cross_pairs(frame_, roots, THRESHOLD, block).collect()} == want
        assert {r.at_once for r in tables["clusters"].collect()} == {True, False}
