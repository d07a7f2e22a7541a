"""The registered queries of the corpus operators, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediameta.llm import chunks, conversations, divergence, exact_dedup, mixing, ngram_join, packing, personal, quality, sharding, tokenids, topk, url_rules


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(read(spark, sf_dir, "documents").select("doc_id"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(read(spark, sf_dir, "pages"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeated_spans(read(spark, sf_dir, "documents"))


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenids.round_trip(read(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.schedule(read(spark, sf_dir, "documents"))
    taken = mixing.copies(planned).groupBy("sid", "cell", "place").agg(F.sum("words").alias("taken"))
    full = planned.join(taken, ["sid", "cell", "place"], "left")
    return full.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(read(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.digest(personal.find_personal(read(spark, sf_dir, "documents")))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damage_and_repair(read(spark, sf_dir, "conversations"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_sharding, op2_best_fit_packing, op3_url_filters, op4_substring_dedup, op5_token_ids,
        op6_mixing, op7_quality_classifier, op8_exact_top_k, op9_ngram_jaccard, op10_exact_dedup,
        op11_personal_data, op12_conversation_repair, op13_source_divergence,
    )
}

_AZ = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"


def _op1() -> str:
    table = ",".join(map(str, sharding.fill()))
    return f"""
    WITH s AS (SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::UBIGINT % {sharding.SLOTS})::BIGINT AS slot FROM documents)
    SELECT doc_id, slot, 'shard-' || lpad(string_split('{table}', ',')[slot + 1], 4, '0') AS shard FROM s
    """


_OP3 = rf"""
WITH u AS (
  SELECT page_id, coalesce({_AZ.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                     ('block', 'net', '/es/'), ('block', 'net', '/fr/'))
SELECT page_id, host, path,
  (SELECT arg_max(h || p, length(h || p)) FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule,
  coalesce((SELECT arg_max(verdict, length(h || p)) FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)), 'allow') AS verdict
FROM u
"""

_OP6 = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size,
         md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM d GROUP BY source),
w AS (
  SELECT *, (1 + (sid - 1) % 3)::BIGINT AS weight, 3 * source_size AS cap, source_size * 6 // (1 + (sid - 1) % 3) AS dry FROM s),
o AS (
  SELECT *, (SELECT sum(source_size) FROM w)::BIGINT - coalesce(sum(cap) OVER (ORDER BY dry, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rest,
         (sum(weight) OVER (ORDER BY dry, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS open
  FROM w),
a AS (SELECT dry, sid, rest, open FROM o WHERE rest * weight <= cap * open ORDER BY dry, sid LIMIT 1),
t AS (
  SELECT o.source, o.source_size,
    CASE WHEN (o.dry, o.sid) >= (a.dry, a.sid) THEN least(weight * (a.rest::DOUBLE / a.open::DOUBLE), cap::DOUBLE) ELSE cap::DOUBLE END AS target,
    CASE WHEN (o.dry, o.sid) >= (a.dry, a.sid) THEN least(weight * a.rest // a.open, cap) ELSE cap END AS quota
  FROM o, a),
p AS (
  SELECT d.*, t.source_size, t.target, t.quota,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (greatest(least(size, quota - start), 0) + greatest(least(size, quota - start - source_size), 0)
   + greatest(least(size, quota - start - 2 * source_size), 0))::BIGINT AS taken
FROM p
"""

_OP8 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_inner_product(q.v, x.v)::BIGINT AS score
  FROM v q JOIN v x ON q.vec_id <> x.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""

_OP9 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_AZ.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS gram
  FROM w),
g AS MATERIALIZED (SELECT doc_id, dense_rank() OVER (ORDER BY gram) AS gram FROM s),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
k AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
h AS (SELECT a, b FROM k JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
l AS MATERIALIZED (SELECT a, b FROM h UNION ALL SELECT b, a FROM h),
c AS (SELECT doc_id, doc_id AS r FROM w UNION SELECT c.doc_id, l.b FROM c JOIN l ON l.a = c.r)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(c.r) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN c ON c.doc_id = w.doc_id GROUP BY w.doc_id
"""

_OP10 = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM t GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t.t) AS text_sha256 FROM t JOIN g ON t.t = g.t
"""

_OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS MATERIALIZED (SELECT i, lang, source, unnest(w) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT i) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY ALL),
f AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0)::HUGEINT AS c
  FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS MATERIALIZED (
  SELECT lang, source, term, c, sum(c) OVER (PARTITION BY lang, term) AS lc,
    (1 + 1000000000::HUGEINT * (c + 5) // (sum(c) OVER (PARTITION BY lang, source) + 5 * v))::BIGINT AS p,
    sum(c) OVER (PARTITION BY lang) AS ln, v
  FROM f JOIN v USING (lang)),
q AS (SELECT *, (1 + 1000000000::HUGEINT * (lc + 5) // (ln + 5 * v))::BIGINT AS q FROM p),
x AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM q WHERE c > 0 AND p > q
  UNION ALL
  SELECT a.lang, a.source, 'pair', b.source, coalesce((
    SELECT sum(abs(l.p - r.p)) FROM p l JOIN p r ON l.lang = r.lang AND l.term = r.term
    WHERE l.lang = a.lang AND l.source = a.source AND r.source = b.source), 0)::BIGINT
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source)
SELECT lang, source, part, item, value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM x)
WHERE part = 'pair' OR rank <= 50
"""

ORACLE = {
    "op1_sharding": _op1(),
    "op3_url_filters": _OP3,
    "op6_mixing": _OP6,
    "op8_exact_top_k": _OP8,
    "op9_ngram_jaccard": _OP9,
    "op10_exact_dedup": _OP10,
    "op13_source_divergence": _OP13,
}
