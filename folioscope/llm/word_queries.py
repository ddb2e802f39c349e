"""Query of the spelling variants over the whole documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioscope.llm.registry import query
from folioscope.llm.spelling import ERROR_EVERY, FORM_RATIO, LOWER, MIN_COUNT, MIN_LENGTH, UPPER, variants, word_counts
from folioscope.llm.sql_text import crc32_sql
from folioscope.llm.stages import table


@query("op12_spelling_variants", f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS run
  FROM documents),
hashed AS (SELECT id, run, count(*) AS k, {crc32_sql("(id || run)")} AS h FROM runs WHERE len(run) >= {MIN_LENGTH} GROUP BY id, run),
words AS MATERIALIZED (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % {ERROR_EVERY} = 0 THEN run[:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word FROM hashed)
  WHERE len(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(k) >= {MIN_COUNT}),
places AS MATERIALIZED (
  SELECT word, unnest(range(1, len(word) + 1)) AS i, word[:i - 1] AS head, word[i + 1:] AS tail FROM words),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other FROM places a JOIN places b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word AND len(a.word) = len(b.word)
  UNION SELECT p.word, w.word FROM places p JOIN words w ON w.word = p.head || p.tail
  UNION SELECT w.word, p.word FROM places p JOIN words w ON w.word = p.head || p.tail),
best AS (
  SELECT x.word, count(*) AS n_near, arg_min(x.other, (-o.n, x.other)) AS other, max(o.n) AS other_n
  FROM near x JOIN words o ON o.word = x.other GROUP BY x.word),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= {FORM_RATIO} * w.n THEN b.other END AS form,
         CASE WHEN b.other_n >= {FORM_RATIO} * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
walk AS (
  SELECT word, word AS at, 0 AS steps FROM formed
  UNION ALL SELECT k.word, f.form, k.steps + 1 FROM walk k JOIN formed f ON f.word = k.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, arg_max(k.at, k.steps) AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN walk k ON k.word = f.word GROUP BY f.word, f.form, f.n, f.n_near, f.form_n""")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its more frequent spelling."""
    return variants(word_counts(table(spark, sf_dir, "documents")))
