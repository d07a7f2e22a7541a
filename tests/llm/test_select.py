"""URL rules, quality classifier, top-k search, the pipeline and the registered queries."""

import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mediameta.llm import quality, topk, url_rules
from mediameta.llm.queries import ORACLE, QUERIES
from mediameta.llm.url_rules import Rule

AZ = str.maketrans(url_rules.UPPER, url_rules.LOWER)


def judged(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, tail = rest[:cut].translate(AZ), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.text), r.text), default=None)
    return host, path, best.text if best else None, best.verdict if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "https://EXAMPLE.com", "http://example.com/", "http://example.com/en/x?y#z", "http://www.example.com/en/",
    "http://a.www.example.com/en/1", "http://notexample.com/en/", "http://x.net/es", "http://x.net/es/", "http://net/fr/a/b", "http://x.NET/fr/://",
    "ftp://é.com/en/", "http://example.com?en/", "http://example.com#/en/", "http://a\nb.com/\n", "http://example.com/en", "http://com/", "http://.com/x",
    "x://y.example.com//en/", "http://example.com./en/", "http://" + "a" * 50_000 + ".com/" + "b/" * 20_000,
]


def test_urls(spark):
    rules = tuple(Rule(*r) for r in url_rules.RULES)
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[6]), (3, URLS[3]), (3, URLS[3])]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("token", F.lit(1))
    got = sorted(tuple(r) for r in url_rules.judge(pages).fillna(-1, ["page_id"]).collect())
    assert got == sorted((-1 if i is None else i, *judged(u, rules)) for i, u in rows)
    assert url_rules.judge(pages.limit(0)).count() == 0


def test_many_rules(spark):
    rng = random.Random(6)
    parts = ["ads", "img", "shop", "b-c", "x_y", "q.z", "en", "a"]
    rules = {}
    for _ in range(150):
        host = ".".join(rng.choice(parts) for _ in range(rng.randrange(1, 3)))
        path = rng.choice(["", "/", "/" + rng.choice(parts), f"/{rng.choice(parts)}/{rng.choice(parts)}"])
        rules[host + path] = Rule(rng.choice(["allow", "block"]), host, path)
    rules = tuple(rules.values())
    urls = [(i, "h://" + ".".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) + "".join("/" + rng.choice(parts) + rng.choice(["", "x"]) for _ in range(rng.randrange(3)))) for i in range(600)]
    got = {r.page_id: tuple(r)[1:] for r in url_rules.judge(spark.createDataFrame(urls, "page_id long, url string"), rules).collect()}

    assert got == {i: judged(u, rules) for i, u in urls}
    with pytest.raises(ValueError):
        url_rules.judge(spark.createDataFrame(urls, "page_id long, url string"), (*rules, rules[0]))


def test_rarest_token(spark):
    rules = (Rule("block", "example.com", "/en/"), Rule("block", "com", "/"))
    urls = spark.createDataFrame([(["", "example", "com", "en"],), (["", "com", "en"],), (["", "com", "en"],)], "tokens array<string>")
    index = url_rules.index_rules(urls, url_rules.rule_frame(spark, rules))
    assert {r.rule: r.token for r in index.collect()} == {"example.com/en/": "example", "com/": "com"}


def nearest(rows, k=10, every=100):
    sound = [(i, np.floor(np.array(v, float) * 1024).astype(int)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in sound:
        if q % every == 0:
            best = sorted((-int(a @ b), i) for i, b in sound if i != q and len(b) == len(a))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("dims", [1, 5, 64])
def test_top_k(spark, dims):
    rng = np.random.default_rng(dims)
    rows = [(i, rng.normal(size=dims).tolist()) for i in range(700)]
    rows += [(i, [0.25] * dims) for i in range(800, 830)] + [(1000, None), (1100, [None] * dims), (1200, [float("nan")] * dims), (1300, [float("inf")] * dims)]
    rows += [(None, [1.0] * dims), (-100, [0.5] * dims), (1400, [1.0] * (dims + 1)), (1500, []), (1501, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(0)).withColumn("score", F.lit("x"))
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    for block in (3, 4096):
        got = sorted(tuple(r) for r in topk.top_k(frame, query_block=block).collect())
        assert got == nearest(rows)
    assert topk.top_k(frame.limit(0)).count() == 0


def test_top_k_of_repeated_ids(spark):
    """Only the query's own row is left out, not another row with its id."""
    rows = [(0, [1.0, 0.0]), (0, [2.0, 0.0]), (5, [0.5, 0.0])]
    got = sorted(tuple(r) for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect())
    assert got == sorted([(0, 1, 0, 2048 * 1024), (0, 2, 5, 512 * 1024), (0, 1, 0, 2048 * 1024), (0, 2, 5, 512 * 2048)])


def test_rule_without_a_path_ends_with_the_host(spark):
    urls = [(1, "http://example.com"), (2, "http://example.com\n"), (3, "http://example.com/a")]
    got = {r.page_id: r.rule for r in url_rules.judge(spark.createDataFrame(urls, "page_id long, url string"), (Rule("block", "example.com", ""),)).collect()}
    assert got == {1: "example.com", 2: None, 3: "example.com"}


def test_bounds_hold():
    rng = np.random.default_rng(1)
    q, x = rng.integers(-900, 900, (30, 37)), rng.integers(-900, 900, (50, 37))
    previous = None
    for level in topk.LEVELS:
        bound = topk.upper_bounds([topk.statistics(q.astype(float), level)], [topk.statistics(x.astype(float), level)], 0)
        assert (bound >= q @ x.T).all()
        assert previous is None or (bound <= previous + 1e-6 * abs(previous)).all()
        previous = bound


def labelled(n=1500, seed=2):
    """Good prose and two kinds of junk; sources that tell a little."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        words = ["".join(rng.choice(["th", "er", "on", "an", "re"]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(5, 80))]
        text = " ".join(words) if good else rng.choice([" ".join(w.upper() + "!!" for w in words), " | ".join(words)])
        docs.append((i, text, rng.choice(["en", None]), rng.choice(["a", "b", None] if good else ["b", "c", None]), len(text)))
        labels.append((i, int(good), 0))
    return docs, labels


DOCS, LABELS = "doc_id long, text string, lang string, source string, n_chars long", "doc_id long, quality int, toxic int"


def test_classifier_on_held_out_rows(spark):
    docs, labels = labelled()
    frame = spark.createDataFrame(docs, DOCS).withColumn("score", F.lit("clash")).withColumn("id", F.lit(1)).withColumn("y", F.lit(1))
    known = spark.createDataFrame(labels[:700] + [(None, 1, 0), (3, None, 0), (10**9, 0, 0)], LABELS)
    got = {r.doc_id: r for r in quality.classify(frame, known).collect()}
    held = [(got[i].kept, bool(q)) for i, q, _ in labels[700:]]
    assert len(got) == len(docs)
    assert sum(k for k, q in held if q) / sum(q for _, q in held) > 0.97
    assert sum(not k for k, q in held if not q) / sum(not q for _, q in held) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = quality.classify(frame, known, keep_columns=True)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_classifier_without_labels_and_odd_rows(spark):
    docs, labels = labelled(60)
    odd = [(None, None, None, None, None), (1, "", "", "", -5), (2, "x " * 50_000, "en", "s", 10**18)]
    frame, known = spark.createDataFrame([*docs, *odd, *odd], DOCS), spark.createDataFrame(labels, LABELS)
    free = quality.classify(frame, known.limit(0)).collect()
    assert len(free) == 66 and all(r.kept and r.score is None for r in free)
    assert quality.classify(frame, known).count() == 66
    assert quality.classify(frame.limit(0), known).count() == 0


def test_shapes():
    assert [quality.shape(w) for w in ("THE!!", "word", "Word.", "x9y", "$$$$$", "|", "Ünter")] == ["A!!", "a", "Aa.", "a9a", "$$$", "|", "Aa"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = QUERIES[name](spark, sf_dir)
    cursor = con.execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(names)
    at = [got.columns.index(c) for c in names]
    assert sorted((tuple(r[i] for i in at) for r in got.collect()), key=repr) == sorted(cursor.fetchall(), key=repr)


def test_native_plans(spark, sf_dir):
    for name in ("op3_url_filters", "op6_mixing", "op10_exact_dedup"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns
        after = docs.collect()
        assert all(before[r.doc_id] == r.text for r in after)
        if stage is corpus_pipeline.exact:
            texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in after]
            assert len(set(texts)) == len(texts) and set(texts) == {re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in before.values()}
        if stage is corpus_pipeline.near:
            assert len({r.doc_id for r in after}) == len(after) > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    bins = defaultdict(int)
    for r in packed.collect():
        bins[r.sequence_id] += r.length
    assert max(bins.values()) <= 2048 and packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, sf_dir).count() == packed.count()


def test_stages_take_odd_rows(spark, sf_dir):
    odd = [(None, None, None, None, None), (None, "a b c d e f", None, None, 3), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "q w e r t y u", "en", None, -1)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, DOCS).withColumn("root", F.lit("clash")).withColumn("__n", F.lit(5))
        got = {name: stage(spark, docs, sf_dir).collect() for name, stage in corpus_pipeline.STAGES}
        if not rows:
            assert not any(got.values())
            continue
        # What the classifier rejects is its own choice; it keeps rows as they are.
        assert {r.text for r in got["quality classifier"]} <= {r[1] for r in odd}
        assert sorted((r.doc_id or 0, r.text or "") for r in got["exact dedup"]) == [(0, "a b c d e f"), (1, ""), (2, "q w e r t y u")]
        assert sorted((r.doc_id or 0, r.text or "") for r in got["n-gram Jaccard join"]) == sorted((r[0] or 0, r[1] or "") for r in odd)
        assert {(r.doc_id, r.text) for r in got["mixing"]} == {(None, "a b c d e f"), (2, "q w e r t y u")}
        assert len(got["best-fit packing"]) == len(odd) and {r.offset for r in got["best-fit packing"] if r.length == 1} != set()


def test_near_stage_decides_by_row(spark, sf_dir):
    """Null and repeated ids: one row of each component of near copies stays, and every row without a copy."""
    rng = random.Random(12)
    text = lambda n=60: " ".join(f"w{rng.randrange(4000)}" for _ in range(n))
    a, b, c, d = (text() for _ in range(4))
    rows = [(3, a), (7, a + " x"), (7, text()), (None, a + " y"), (None, text()), (None, text())]
    rows += [(None, b), (None, b + " x"), (None, b + " y"), (9, c), (9, c + " x"), (9, text()), (11, d), (11, d), (12, text())]
    rows += [(None, None), (None, ""), (13, " "), (13, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS).repartition(5)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near(spark, docs, sf_dir).collect()]
    grams = lambda t: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)}
    alike = lambda x, y: bool(grams(x)) and 4 * len(grams(x) & grams(y)) >= 3 * len(grams(x) | grams(y))
    left = [k for k, (i, t) in enumerate(rows) if not any(alike(t or "", u or "") for n, (_, u) in enumerate(rows) if n != k)]
    assert sorted((rows[k] for k in left), key=repr) == sorted((r for r in kept if not any(r[1] and r[1].startswith(x) for x in (a, b, c, d))), key=repr)
    assert all(sum(bool(t) and t.startswith(x) for _, t in kept) == 1 for x in (a, b, c, d))
    assert (3, a) in kept and not set(kept) - set(rows)
