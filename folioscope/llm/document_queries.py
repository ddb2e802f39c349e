"""Queries of the document operators over the whole documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm.jaccard_join import jaccard_join
from folioscope.llm.language import identify
from folioscope.llm.line_dedup import LOW_PAGES, LOW_RATIO, MIN_PAGES, RATIO, drop_boilerplate
from folioscope.llm.lm_scores import ALPHA, MIN_COUNT, backoff_scores
from folioscope.llm.mixing import BLOCK_WORDS, MAX_REPEATS, SEED, SHARD_WORDS, mix_sources
from folioscope.llm.packing import pack
from folioscope.llm.quality import classify
from folioscope.llm.registry import query
from folioscope.llm.secret_scan import scan
from folioscope.llm.stages import table


@query("op3_line_dedup", f"""
WITH pages AS (SELECT *, row_number() OVER () AS page, string_split(text, chr(10)) AS lines FROM documents),
totals AS (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source HAVING count(*) >= {MIN_PAGES}),
keyed AS (SELECT DISTINCT page, source, rtrim(unnest(lines), ' ' || chr(9) || chr(13)) AS line FROM pages),
frequent AS (
  SELECT k.source, list(line) AS drops FROM (
    SELECT source, line, count(*) AS k FROM keyed WHERE line <> '' GROUP BY source, line) k
  JOIN totals t ON t.source = k.source AND k.k > CASE WHEN k.k >= {LOW_PAGES} THEN {LOW_RATIO} ELSE {RATIO} END * t.n GROUP BY k.source),
kept AS (
  SELECT p.*, CASE WHEN f.drops IS NULL THEN lines
              ELSE list_filter(lines, lambda x: NOT list_contains(f.drops, rtrim(x, ' ' || chr(9) || chr(13)))) END AS rest
  FROM pages p LEFT JOIN frequent f ON p.source = f.source)
SELECT doc_id, source, coalesce(len(lines), 0) AS n_lines, coalesce(len(lines) - len(rest), 0) AS n_dropped,
       CASE WHEN len(lines) = len(rest) OR text IS NULL THEN text ELSE array_to_string(rest, chr(10)) END AS text
FROM kept""")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the pages of their source, without lines above a tenth of them, or above a hundredth and on five pages."""
    return drop_boilerplate(table(spark, sf_dir, "documents"), low_ratio=LOW_RATIO).select("doc_id", "source", "n_lines", "n_dropped", "text")


@query("op4_mixing", f"""
WITH sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))) AS ord
  FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, {MAX_REPEATS} * source_size AS bound,
         (sum(source_size) OVER () - coalesce(sum({MAX_REPEATS} * source_size) OVER before, 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM totals
  WINDOW before AS (ORDER BY {MAX_REPEATS} * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, CASE WHEN bound < found * weight THEN bound::DOUBLE ELSE found * weight END AS target,
         ceil(greatest(source_size, 1) / {SHARD_WORDS})::BIGINT AS shards
  FROM (SELECT *, max(CASE WHEN bound >= level * weight THEN level END) OVER () AS found FROM levels)),
seats AS (SELECT round(sum(target) / {BLOCK_WORDS})::BIGINT AS n FROM targets),
quotas AS (
  SELECT source, count(*) AS quota FROM (
    SELECT source, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source NULLS LAST) AS place
    FROM targets, (SELECT unnest(range((SELECT n FROM seats))) AS k) WHERE target > 0)
  WHERE place <= (SELECT n FROM seats) GROUP BY source),
placed AS (
  SELECT s.*, t.source_size, t.target, coalesce(q.quota, 0) AS quota, ('0x' || substr(ord, 1, 8))::BIGINT % t.shards AS shard
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
  LEFT JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source),
shards AS (SELECT source, shard, quota, target, sum(size)::BIGINT AS shard_size FROM placed GROUP BY ALL),
shard_quotas AS (
  SELECT source, shard, count(*) AS shard_quota FROM (
    SELECT source, shard, quota,
           row_number() OVER (PARTITION BY source ORDER BY shard_size / (2 * k + 1) DESC, shard) AS place
    FROM (SELECT *, unnest(range(quota)) AS k FROM shards WHERE shard_size > 0))
  WHERE place <= quota GROUP BY source, shard),
blocked AS (
  SELECT s.*, least(coalesce(shard_quota, 0) * {BLOCK_WORDS}, shard_size * {MAX_REPEATS}) AS base
  FROM shards s LEFT JOIN shard_quotas q ON s.source IS NOT DISTINCT FROM q.source AND s.shard = q.shard),
gaps AS (
  SELECT *, shard_size * {MAX_REPEATS} - base AS room, round(target)::BIGINT - sum(base) OVER (PARTITION BY source) AS missing FROM blocked),
runs AS (
  SELECT s.*, base + CASE WHEN missing >= 0 THEN greatest(least(missing - (sum(room) OVER before - room), room), 0)
                          ELSE -greatest(least(-missing - (sum(base) OVER before - base), base), 0) END AS words,
         CASE WHEN shard_size > 0 THEN
           ('0x' || substr(md5('{SEED + 1}:' || coalesce(s.source, '') || '/' || s.shard), 1, 8))::BIGINT % shard_size ELSE 0 END AS start
  FROM gaps s WINDOW before AS (PARTITION BY source ORDER BY shard)),
spans AS (
  SELECT p.*, r.shard_size, r.start, CASE WHEN r.shard_size > 0 THEN r.words // r.shard_size ELSE 0 END AS whole,
         CASE WHEN r.shard_size > 0 THEN r.words % r.shard_size ELSE 0 END AS rest,
         sum(size) OVER (PARTITION BY p.source, p.shard ORDER BY ord, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS low
  FROM placed p JOIN runs r ON p.source IS NOT DISTINCT FROM r.source AND p.shard = r.shard)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (whole * size + greatest(least(start + rest - low, size), least(greatest(start - low, 0), size))
        - least(greatest(start - low, 0), size)
        + least(greatest(greatest(start + rest - shard_size, 0) - low, 0), size))::BIGINT AS taken
FROM spans""")
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document and whether it is kept."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_packing")
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in batches of its length bucket."""
    return pack(table(spark, sf_dir, "documents"))


@query("op10_jaccard_join", """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] ELSE list_distinct(list_transform(
    range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM items a JOIN items b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT DISTINCT u AS node, u AS other FROM links
  UNION
  SELECT r.node, l.v FROM reach r JOIN links l ON r.other = l.u)
SELECT doc_id, len(s) AS n_shingles, coalesce(c.component, doc_id) AS component_id
FROM sets LEFT JOIN (SELECT node, min(other) AS component FROM reach GROUP BY node) c ON c.node = sets.doc_id""")
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return jaccard_join(table(spark, sf_dir, "documents"))


@query("op2_lm_scores", f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
tokens AS (SELECT doc_id, unnest(w) AS w2, unnest([NULL] || w[:len(w) - 1]) AS w1 FROM words WHERE len(w) > 0),
unigrams AS (SELECT w2 AS word, count(*) AS c FROM tokens GROUP BY w2),
bigrams AS (SELECT w1, w2, count(*) AS c FROM tokens WHERE w1 IS NOT NULL GROUP BY w1, w2 HAVING count(*) >= {MIN_COUNT}),
scored AS (
  SELECT doc_id, CASE WHEN t.w1 IS NULL THEN ln(u2.c / (SELECT count(*) FROM tokens))
                      WHEN b.c IS NOT NULL THEN ln(b.c / u1.c)
                      ELSE ln({ALPHA} * u2.c / (SELECT count(*) FROM tokens)) END AS s
  FROM tokens t JOIN unigrams u2 ON u2.word = t.w2 LEFT JOIN unigrams u1 ON u1.word = t.w1
  LEFT JOIN bigrams b ON b.w1 = t.w1 AND b.w2 = t.w2)
SELECT d.doc_id, count(s)::BIGINT AS n_words, round(sum(s), 6) AS log_score, round(sum(s) / nullif(count(s), 0), 6) AS mean_log_score
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN scored s ON d.doc_id = s.doc_id GROUP BY d.doc_id""")
def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document under the counts of all documents."""
    return backoff_scores(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.round("log_score", 6).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


@query("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return identify(table(spark, sf_dir, "documents"))


@query("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate secrets of every document with the forest's verdict."""
    return scan(table(spark, sf_dir, "documents"))
