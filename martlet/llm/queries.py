"""The registered queries of this subpackage: one per operator, over its whole
table with production parameters, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm import (
    centroids, exact_dedup, jaccard_join, language, lexical, nn_descent, packing, pieces, pii, quality, simhash, toxicity,
    url_filter)
from martlet.llm.common import fold, table

# The rules the URL query judges by (fixed values of its contract).
URL_RULES = [
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's file, on the driver as on the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"),
                        tokenizer_file("word_bpe_49k.json")).drop("ids")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents
), k AS (
  SELECT doc_id, norm, min(doc_id) OVER (PARTITION BY norm) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
"""


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(language.training_rows(docs))
    found = language.predict(docs, model)
    return found.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"),
                        "lang_pred", "score", "languages", "proportions")


def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    index = nn_descent.build(vectors)
    return nn_descent.search(index, vectors.where(F.col("vec_id") % 20 == 0))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"),
                         with_ids=False)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(toxicity.training_rows(docs),
                           toxicity.training_rows(table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    model = url_filter.train(url_filter.labelled_from_rules(pages, URL_RULES))
    return url_filter.url_filter(pages, URL_RULES, model)


def op9_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(quality.training_rows(docs),
                          quality.training_rows(table(spark, sf_dir, "labels")))
    return quality.score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


# A real run passes its own secret.
PII_KEY = b"a key for test data only"


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_pii(table(spark, sf_dir, "documents"), PII_KEY)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
), q AS (
  SELECT item_id, term, count(*) AS qtf FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term
), c AS (
  SELECT count(*)::BIGINT AS docs, sum(len(t))::BIGINT AS total FROM d WHERE len(t) > 0
), f AS (
  SELECT doc_id, term, count(*)::BIGINT AS tf FROM (
    SELECT doc_id, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term
), w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
  FROM (SELECT term, count(*)::BIGINT AS df FROM f GROUP BY term), c
), m AS (
  SELECT doc_id, 75 + (25 * len(t)::BIGINT * docs) // total AS m FROM d, c WHERE len(t) > 0
), s AS (
  SELECT item_id, doc_id,
         sum(qtf * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN f USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id
), r AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
         doc_id, score FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""


def op12_laesa_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(centroids.cluster(table(spark, sf_dir, "embeddings")))


def _op12_sql() -> str:
    """The rounds written out, over one row a vector and component."""
    steps = ["""
v AS MATERIALIZED (
  SELECT vec_id, unnest(generate_series(1, 64)) AS pos,
         unnest(list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
)""", """
c0 AS MATERIALIZED (
  SELECT cluster, pos, x FROM v JOIN (
    SELECT vec_id, (row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1)::INTEGER AS cluster
    FROM (SELECT DISTINCT vec_id FROM v)) USING (vec_id) WHERE cluster < 40
)"""]
    for i in range(6):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT vec_id, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM (
    SELECT vec_id, cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance
    FROM v JOIN c{i} c USING (pos) GROUP BY vec_id, cluster)
  GROUP BY vec_id
)""")
        if i < 5:
            steps.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT cluster, pos, coalesce(n.x, c.x) AS x FROM c{i} c LEFT JOIN (
    SELECT cluster, pos, floor(sum(x)::DOUBLE / count(*))::BIGINT AS x
    FROM v JOIN a{i} USING (vec_id) GROUP BY cluster, pos) n USING (cluster, pos)
)""")
    return "WITH " + ",".join(steps) + """
SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256
FROM a5 JOIN (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY pos)) AS centroid_sha256
              FROM c5 GROUP BY cluster) USING (cluster)
"""


OP12_SQL = _op12_sql()


def op13_simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_curve_packing": op1_curve_packing,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_language_id": op4_language_id,
    "op5_nn_descent": op5_nn_descent,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_toxicity": op7_toxicity,
    "op8_url_filter": op8_url_filter,
    "op9_quality_cotraining": op9_quality_cotraining,
    "op10_pii_surrogates": op10_pii_surrogates,
    "op11_lexical_search": op11_lexical_search,
    "op12_laesa_clusters": op12_laesa_clusters,
    "op13_simhash_pigeonhole": op13_simhash_pigeonhole,
}

QUERIES_SQL: dict[str, str] = {
    "op3_exact_dedup": OP3_SQL,
    "op11_lexical_search": OP11_SQL,
    "op12_laesa_clusters": OP12_SQL,
}
