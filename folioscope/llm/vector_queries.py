"""Queries of the vector operators over the whole embeddings table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioscope.llm.registry import query
from folioscope.llm.stages import table
from folioscope.llm.top_products import top_products
from folioscope.llm.vector_dedup import near_vectors


@query("op1_top_k", """
WITH sound AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM sound q JOIN sound c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored) WHERE rank <= 10""")
def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best products of every hundredth vector with all others."""
    return top_products(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


@query("op8_near_vectors", """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.98),
reach AS (
  SELECT DISTINCT u AS node, u AS other FROM links
  UNION
  SELECT r.node, l.v FROM reach r JOIN links l ON r.other = l.u)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE u = e.vec_id) AS n_links,
       coalesce((SELECT min(other) FROM reach WHERE node = e.vec_id), e.vec_id) AS component_id,
       coalesce((SELECT min(other) FROM reach WHERE node = e.vec_id), e.vec_id) = e.vec_id AS kept
FROM embeddings e""")
def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and classes of near-equal vectors within a label."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
