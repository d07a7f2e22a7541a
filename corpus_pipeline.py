"""A training corpus from raw documents: quality, exact and near copies, mix, packing."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

import mediameta
from mediameta.llm.common import row_keys, shared_dir, written
from mediameta.llm.exact_dedup import exact_dedup
from mediameta.llm.mixing import mix
from mediameta.llm.ngram_join import ngram_components
from mediameta.llm.packing import pack_documents
from mediameta.llm.quality import classify

cloudpickle.register_pickle_by_value(mediameta)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on ``labels``, does not reject."""
    return classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), keep_columns=True)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the least id."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies, the one with the least key of ``row_keys``; so the least id where ids are unique.

    Each row is decided for itself, also where ids are null or repeated. Rows without words have no near copies and stay.
    All is decided on keys; whole texts meet the decision once.
    """
    named = docs.toDF(*[f"c{n}" for n in range(len(docs.columns))])
    i, t = (f"c{docs.columns.index(c)}" for c in ("doc_id", "text"))
    keyed = row_keys(named, i, t, "pipeline-repeated-ids")
    found = written(ngram_components(keyed.select("__key", t), "__key", t), "pipeline-near")
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("__key")).distinct()
    stay = keyed.join(gone, "__key", "left_anti")
    # Rows equal in id and text share a key; ``exact`` leaves none, but it need not come before.
    twins = written(found.filter("n_shingles > 0 AND doc_id = component_id").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("__key")), "pipeline-twins")
    if not twins.isEmpty():
        order = [F.col(c) for c in named.columns if not isinstance(named.schema[c].dataType, MapType | VariantType)]
        one = stay.join(twins, "__key", "left_semi").withColumn("__n", F.row_number().over(Window.partitionBy("__key").orderBy(*order))).filter("__n = 1")
        stay = stay.join(twins, "__key", "left_anti").select(*named.columns).unionByName(one.select(*named.columns))
    return stay.select(*named.columns).toDF(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents in the mix's order; a document may come up to three times."""
    return mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as packed pieces of sequences."""
    return pack_documents(docs)


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("mixing", mixed), ("best-fit packing", packed)]

#: A classifier's training is no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = shared_dir(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
