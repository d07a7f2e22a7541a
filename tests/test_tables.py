import json
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from mediameta.operators import clean, profile, quality, split
from mediameta.operators.examples import prepare, prepare_run
from mediameta.operators.ordering import balanced_ranges, exact_quantiles
from mediameta.plans.derive import derived
from mediameta.schema import Params, canonical

CLEAN = "row_id bigint, name string, show_name string, season bigint, episode bigint, reasoning string, confidence double, crc_hash string"


@pytest.fixture(scope="module")
def three(spark):
    return spark.createDataFrame(
        [
            (0, "x" * 201, "s", 1, 1, "", 0.5, "ZZZZZZZZ"),
            (1, "dup", "s2", 1, None, "", 0.5, None),
            (2, "dup", "s3", 1, 2, "", 0.5, "ABCDEF12"),
        ],
        CLEAN,
    )


def issues(df, **options):
    found = {}
    for r in quality.issue_rows(df, **options).collect():
        found.setdefault(r.issue, set()).add(r.row_id)
    return found


def test_issues(three):
    want = {"long_filenames": {0}, "duplicates": {1, 2}, "bad_crc_format": {0}, "missing_episode": {1}}
    assert issues(three) == want
    counts = {r.issue: r.n for r in quality.issue_counts(three).collect()}
    assert counts == {k: len(v) for k, v in want.items()}


def test_clean_table_has_all_zero_counts(spark):
    one = spark.createDataFrame([(0, "a", "s", 1, 1, "", 0.5, None)], CLEAN)
    assert {r.issue: r.n for r in quality.issue_counts(one).collect()} == dict.fromkeys(
        ["long_filenames", "duplicates", "bad_crc_format", "missing_episode"], 0
    )
    assert {r.n for r in quality.issue_counts(one.limit(0)).collect()} == {0}


def test_null_names(spark):
    df = spark.createDataFrame([(i, None, "s", 1, 1, "", 0.5, None) for i in range(2)], CLEAN)
    assert issues(df) == {"duplicates": {0, 1}}


@pytest.mark.parametrize("hot", [2, 50, 10_000])
@pytest.mark.parametrize("parts", [1, 17])
def test_hot_names_give_the_same_counts(spark, hot, parts):
    """A third of the rows share one name, another part is null."""
    names = ["hot" if i % 3 == 0 else None if i % 7 == 0 else f"n{i % 150}" if i % 2 else f"u{i}" for i in range(900)]
    df = spark.createDataFrame(list(enumerate(names)), "row_id bigint, name string").repartition(parts)
    got = {r.row_id: r.name_count for r in quality.with_name_count(df, hot_names=hot).collect()}
    assert got == {i: names.count(n) for i, n in enumerate(names)}


def test_profile(spark):
    df = spark.createDataFrame(
        [(0, "a", "s", 1, 1, "ok", 0.5, "ABCDEF12"), (1, "b", "s2", None, None, "ok2", 0.2, None)], CLEAN
    )
    parts = profile.profile(df)
    nulls = parts["nulls"].first()
    assert (nulls.row_count, nulls.season_nulls, nulls.episode_nulls, nulls.crc_hash_nulls, nulls.name_nulls) == (2, 1, 1, 1, 0)
    assert parts["season_coverage"].first().percent == 50.0
    assert parts["episode"].first()["count"] == 1
    assert [tuple(r) for r in parts["episode_values"].collect()] == [(1, 1)]
    assert parts["sample"].count() == 2


def test_describe(spark):
    df = spark.range(1, 5).withColumnRenamed("id", "episode")
    r = profile.describe_column(df, "episode").first()
    assert (r["count"], r["mean"], r["min"], r.q25, r.q50, r.q75, r["max"]) == (4, 2.5, 1, 1.75, 2.5, 3.25, 4)
    assert r["std"] == pytest.approx(statistics.stdev([1, 2, 3, 4]))
    empty = profile.describe_column(df.limit(0), "episode").first()
    assert empty["count"] == 0 and empty.q50 is None


@pytest.mark.parametrize("kind", ["hot", "outlier", "uniform", "decades", "signs", "one"])
def test_exact_quantiles(spark, kind):
    data = {
        "hot": [5.0 if i % 3 == 0 else (i * 7919 % 1000) / 10 for i in range(3001)],
        "outlier": [float(i % 40) for i in range(2000)] + [9e18],
        "uniform": [i / 7 for i in range(1501)],
        "decades": [10 ** (i * 18 / 4001) for i in range(4001)],
        "signs": [(-1) ** i * 1.5 ** (i % 90) for i in range(1000)] + [0.0, -0.0, 5e-324, -5e-324],
        "one": [2.5],
    }[kind]
    df = spark.createDataFrame([(v,) for v in data] + [(None,)], "v double").repartition(5)
    got = exact_quantiles(df, "v", [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]).first().q
    assert got == pytest.approx(list(np.percentile(data, [0, 10, 25, 50, 75, 99, 100])))


def test_value_counts_ties_and_top(spark):
    df = spark.createDataFrame([(v,) for v in [3, 3, 1, 1, 2, None]], "episode bigint")
    assert [tuple(r) for r in profile.value_counts(df, "episode", 2).collect()] == [(1, 2), (3, 2)]


@pytest.mark.parametrize("n", [0, 1, 9, 10, 1003])
def test_split_sizes(spark, n):
    df = spark.range(n).withColumnRenamed("id", "row_id")
    both = split.assign_split(df).collect()
    want = int(np.ceil(n * 0.1))
    assert sum(r.split == "eval" for r in both) == want and len(both) == n
    train, held = split.train_eval(df)
    a, b = ({r.row_id for r in side.collect()} for side in (train, held))
    assert not a & b and a | b == set(range(n)) and len(b) == want


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(500).withColumnRenamed("id", "row_id")
    chosen = [
        {r.row_id for r in split.train_eval(df.repartition(p), 0.2, seed=3)[1].collect()} for p in (1, 17)
    ]
    assert chosen[0] == chosen[1]
    assert chosen[0] != {r.row_id for r in split.train_eval(df, 0.2, seed=4)[1].collect()}


def test_cap_takes_the_first_of_the_split_order(spark):
    df = spark.range(300).withColumnRenamed("id", "row_id")
    held = {r.row_id for r in split.train_eval(df)[1].collect()}
    capped = {r.row_id for r in split.capped_eval(df, 7).collect()}
    first = {r.row_id for r in split.sample_rows(df, 7).collect()}
    assert capped == first and capped < held
    assert split.capped_eval(df, 1000).count() == 30 and split.capped_eval(df, 0).count() == 0


def test_packing(spark):
    lengths = [(i, 700 + 13 * (i % 50)) for i in range(1000)]
    df = spark.createDataFrame(lengths, "row_id bigint, n int")
    rows = split.pack_sequences(df, F.col("n"), 2048, rows_per_bucket=64).orderBy("row_id").collect()
    at, bucket = 0, None
    for r, (row_id, n) in zip(rows, lengths, strict=True):
        if r.bucket != bucket:
            at, bucket = 0, r.bucket
        assert (r.row_id, r.bucket, r.sequence, r.start, r.n_tokens) == (row_id, row_id // 64 * 64, at // 2048, at % 2048, n)
        at += n


def test_filter_and_guard(three, spark):
    assert [r.row_id for r in clean.require_episode(three).orderBy("row_id").collect()] == [0, 2]
    assert tuple(clean.filter_counts(three).first()) == (3, 2)
    assert clean.require_rows(three) is three
    with pytest.raises(RuntimeError):
        clean.require_rows(clean.require_episode(three.withColumn("episode", F.lit(None).cast("bigint"))))


def test_canonical(spark):
    messy = spark.createDataFrame([("x",) * 8], [" Name ", "SHOW_NAME", "season", "episode", "reasoning", "confidence", "crc_hash", "more"])
    with pytest.warns(UserWarning, match="more"):
        assert canonical(messy).columns == ["name", "show_name", "season", "episode", "reasoning", "confidence", "crc_hash"]
    with pytest.raises(ValueError, match="season"):
        canonical(messy.select(" Name ", "SHOW_NAME"))


def test_prepare(spark, sf_dir):
    done = prepare(derived(spark, sf_dir, "raw_metadata"), "SYS", params=Params(eval_max_samples=5))
    kept = done.kept.count()
    assert done.kept.filter("episode IS NULL").isEmpty() and kept < done.clean.count()
    assert done.evaluation.count() == 5
    assert done.train.count() == kept - int(np.ceil(kept * 0.1))
    text = done.train.first().text
    json.loads(text.split("<|assistant|>\n")[1].removesuffix("<|endoftext|>"))


def test_stateless_operators_stream(spark, sf_dir, tmp_path):
    """The row-wise operators run unchanged on a stream."""
    path = str(tmp_path / "raw")
    raw = derived(spark, sf_dir, "raw_metadata")
    raw.write.parquet(path)
    stream = spark.readStream.schema(raw.schema).parquet(path)
    cleaned = clean.require_episode(clean.clean_metadata(stream))
    done = cleaned.writeStream.format("memory").queryName("cleaned").trigger(availableNow=True).start()
    done.awaitTermination(120)
    want = clean.require_episode(clean.clean_metadata(raw))
    got = spark.table("cleaned")
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


@pytest.mark.parametrize("kind", ["outlier", "clusters", "ends", "powers"])
def test_balanced_ranges(spark, kind):
    ids = {
        "outlier": [*range(19_999), 10**15],
        "clusters": [c * 10**14 + i for c in range(20) for i in range(1000)],
        "ends": [-(2**63), 2**63 - 1, *range(-5000, 5000)],
        "powers": sorted({int(1.002**i) for i in range(20_000)}),
    }[kind]
    df = spark.createDataFrame([(i,) for i in ids], "row_id bigint").repartition(3)
    got = {r.row_id: r.bucket for r in balanced_ranges(df, "row_id", 256).collect()}
    assert set(got) == set(ids)
    sizes = {}
    for b in got.values():
        sizes[b] = sizes.get(b, 0) + 1
    assert max(sizes.values()) <= 256
    # Ranges do not overlap and begin at their names.
    in_order = [got[i] for i in sorted(ids)]
    assert in_order == sorted(in_order) and all(b <= i for i, b in got.items())


def test_balanced_ranges_of_one_id(spark):
    df = spark.createDataFrame([(7,)] * 40, "row_id bigint")
    with pytest.raises(Exception, match="too many rows of one row_id"):
        balanced_ranges(df, "row_id", 16).collect()
    assert {r.bucket for r in balanced_ranges(df, "row_id", 64).collect()} == {7}


def test_prepare_run_counts_while_it_writes(spark, sf_dir, tmp_path):
    out = str(tmp_path / "run")
    raw = derived(spark, sf_dir, "raw_metadata")
    manifest = prepare_run(raw, out, "SYS", params=Params(eval_max_samples=5)).first()
    clean = spark.read.parquet(f"{out}/clean")
    assert manifest.row_count == clean.filter("episode IS NOT NULL").count()
    assert len(manifest.timestamp) == 20
    issues = {r.issue: r.n for r in spark.read.json(f"{out}/issues").collect()}
    assert issues == {r.issue: r.n for r in quality.issue_counts(clean).collect()}
    assert spark.read.json(f"{out}/profile").first().row_count == clean.count()
    assert spark.read.parquet(f"{out}/evaluation").count() == 5
    with pytest.raises(RuntimeError, match="no rows with an episode"):
        prepare_run(raw.filter("episode = 'x'"), str(tmp_path / "none"), "SYS")
