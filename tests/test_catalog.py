"""All registered queries against their SQL twins, and the shape of their plans."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from mediameta.plans.catalog import QUERIES
from mediameta.plans.oracle import ORACLE

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
# These run Python by design.
PYTHON = {"batch_generate", "infer_chain", "score_token_ids", "decode_tokens", "extract_json_python", "csv_multiline_split", "csv_roundtrip", "truncate_token_stop", "generate_resumed"}
SQL_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SQL_DIR}/{t}.parquet'")
    return con


def canonical_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SQL_DIR)
    cursor = duck.execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    want = canonical_rows(names, cursor.fetchall())
    got = canonical_rows(df.columns, [tuple(r) for r in df.collect()])
    assert got == want


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON:
        assert "EvalPython" not in plan and "InPandas" not in plan


def test_entry(spark, sf_dir):
    df = entry_points.entry(spark)
    assert df.columns == ["row_id", "text"] and not df.isEmpty()
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


def test_multiline_files_hold_bounded_rows(spark, tmp_path, monkeypatch):
    """No task writes the whole table, and rows are numbered through the files by key."""
    from pyspark.sql import functions as F

    from mediameta.plans import catalog

    rows = spark.range(400).select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("O").alias("o_orderstatus"), (F.col("id") * 1.5).alias("o_totalprice"),
        F.timestamp_seconds(F.col("id") * 86400).cast("timestamp_ntz").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
    )
    rows.write.parquet(f"{tmp_path}/orders.parquet")
    one = sorted(QUERIES["csv_multiline_split"](spark, str(tmp_path)).collect())
    monkeypatch.setattr(catalog, "FILE_ROWS", 100, raising=False)
    many = QUERIES["csv_multiline_split"](spark, str(tmp_path))
    assert len(many.inputFiles()) > 1
    assert sorted(many.collect()) == one and len(one) == 400
