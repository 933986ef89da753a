"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import codes, embeddings, encoding, fingerprint, jaccard, lmscore, packing, passages, quality, tokencount, topk, urlgraph, whitening

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score_texts(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE)


def op3_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlgraph.judge(table(spark, sf_dir, "pages"))


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), spans=True)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.link_vectors(table(spark, sf_dir, "embeddings"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encode_decode(table(spark, sf_dir, "documents"), BYTE_BPE)


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), BYTE_BPE)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_ppm, op2_packing, op3_url_trust, op4_passages, op5_quality, op6_fingerprint, op7_embedding_dedup, op8_bpe, op9_jaccard, op10_token_counts, op11_whitening, op12_vector_codes, op13_topk)}

VECTORS = """r AS MATERIALIZED (SELECT row_number() OVER () AS k, *, list_transform(embedding, lambda c: floor({scale} * CAST(c AS DOUBLE))) AS x
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)"""

LLOYD_ROUND = """a{i} AS MATERIALIZED (SELECT k, part, min({{'d': list_dot_product(v, v) - 2 * list_dot_product(v, w) + list_dot_product(w, w), 'e': e}}) AS best FROM p JOIN c{before} USING (part) GROUP BY ALL),
m{i} AS (SELECT part, best.e AS e, pos, floor(sum(v[pos]) / count(*)) AS mean FROM a{i} JOIN p USING (k, part), (SELECT unnest(range(1, 5)) AS pos) GROUP BY ALL),
c{i} AS MATERIALIZED (SELECT c.part, c.e, coalesce(m.w, c.w) AS w FROM c{before} c LEFT JOIN (SELECT part, e, list(mean ORDER BY pos) AS w FROM m{i} GROUP BY ALL) m USING (part, e))"""

#: Of vectors with 64 components, as the given tables have.
ORACLE_SQL: dict[str, str] = {
    "op12_vector_codes": f"""WITH {VECTORS.format(scale=256)},
p AS MATERIALIZED (SELECT k, part, x[4 * part + 1 : 4 * part + 4] AS v FROM r, (SELECT unnest(range(16)) AS part)),
c0 AS MATERIALIZED (SELECT part, e, v AS w FROM p JOIN (SELECT k, row_number() OVER (ORDER BY vec_id NULLS LAST, x) - 1 AS e FROM r) USING (k) WHERE e < 64),
{LLOYD_ROUND.format(i=1, before=0)},
{LLOYD_ROUND.format(i=2, before=1)},
{LLOYD_ROUND.partition(",\nm")[0].format(i=3, before=2)},
coded AS (SELECT k, string_agg(format('{{:02x}}', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a3 GROUP BY k),
books AS (SELECT sha256(string_agg(CAST(CAST(w[pos] AS BIGINT) AS VARCHAR), ',' ORDER BY part, e, pos)) AS digest FROM c2, (SELECT unnest(range(1, 5)) AS pos))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256 FROM r JOIN coded USING (k), books""",
    "op13_topk": f"""WITH {VECTORS.format(scale=64)},
pairs AS (SELECT q.k, q.vec_id AS query_id, r.vec_id, r.k AS other, CAST(list_dot_product(q.x, r.x) AS BIGINT) AS score FROM r q JOIN r ON q.k <> r.k WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id NULLS LAST, other) AS place FROM pairs)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20""",
}
