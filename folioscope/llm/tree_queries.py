"""Query of the dataset manifest over the whole documents table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm.merkle import FAN, merkle_manifest
from folioscope.llm.registry import query
from folioscope.llm.sql_text import crc32_sql
from folioscope.llm.stages import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TAMPER_EVERY = 5
ORACLE_LEVELS = 6  # the SQL holds for sources, and numbers of sources, up to 16**6


def tampered_text() -> Column:
    """The text in lower case (A-Z only) where 5 divides the CRC of the id."""
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))


def _leaf_sql(text: str) -> str:
    fields = [f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR END"
              for c in ("doc_id", "source", "lang", "n_chars")]
    fields.append(f"CASE WHEN {text} IS NULL THEN '-' ELSE octet_length(encode({text})) || ':' || {text} END")
    return f"sha256({' || '.join(fields)})"


def _climb(name: str, start: str) -> tuple[str, str]:
    """CTEs that raise ``start`` (tree, pos, digest) level by level, and one of (tree, pos, level, at, others before, others after)."""
    ctes, steps, last = [], [], start
    for level in range(ORACLE_LEVELS):
        ctes.append(f"""{name}_{level} AS MATERIALIZED (
  SELECT *, pos // {FAN} AS up, count(*) OVER (PARTITION BY tree) AS n FROM {last}),
{name}_up_{level} AS MATERIALIZED (
  SELECT tree, CASE WHEN n > 1 THEN up ELSE pos END AS pos,
         CASE WHEN max(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE min(digest) END AS digest
  FROM {name}_{level} GROUP BY tree, n, CASE WHEN n > 1 THEN up ELSE pos END)""")
        steps.append(f"""SELECT a.tree, a.pos, {level} AS level, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS low,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS high
  FROM {name}_{level} a JOIN {name}_{level} b ON a.tree = b.tree AND a.up = b.up WHERE a.n > 1 GROUP BY ALL""")
        last = f"{name}_up_{level}"
    ctes.append(f"{name}_steps AS MATERIALIZED ({' UNION ALL '.join(steps)})")
    return ",\n".join(ctes), last


def _fold(name: str, start: str, extra: str) -> tuple[str, str]:
    """CTEs that carry (tree, pos, proof, folded) of ``start`` to the top of its tree."""
    ctes, last = [], start
    for level in range(ORACLE_LEVELS):
        ctes.append(f"""{name}_fold_{level} AS MATERIALIZED (
  SELECT v.* EXCLUDE (pos, proof, folded), v.pos // {FAN} AS pos, v.proof || coalesce(s.low || s.high, '') AS proof,
         CASE WHEN s.tree IS NULL THEN v.folded ELSE sha256(s.low || v.folded || s.high) END AS folded
  FROM {last} v LEFT JOIN {name}_steps s ON s.tree = v.tree AND s.pos = v.pos AND s.level = {level})""")
        last = f"{name}_fold_{level}"
    return ",\n".join(ctes), last


def _manifest_sql() -> str:
    inner, inner_top = _climb("own", "leaves")
    outer, outer_top = _climb("over", "roots")
    fold, folded = _fold("own", "versions", "")
    fold_over, folded_over = _fold("over", "carried", "")
    return f"""
WITH hashed AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS tree, {_leaf_sql("text")} AS leaf,
         CASE WHEN {crc32_sql("doc_id::VARCHAR")} % {TAMPER_EVERY} = 0
              THEN {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf_sql("text")} END AS changed
  FROM documents),
numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS pos FROM hashed),
leaves AS (SELECT tree, pos, leaf AS digest FROM numbered),
{inner},
roots AS MATERIALIZED (
  SELECT 'all' AS tree, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, t.digest, t.tree AS child
  FROM {inner_top} t JOIN (SELECT DISTINCT tree, source FROM numbered) s ON s.tree = t.tree),
{outer},
versions AS (SELECT doc_id, leaf, tree, pos, '' AS proof, changed AS folded FROM numbered),
{fold},
carried AS (
  SELECT f.doc_id, f.leaf, r.digest AS subroot, r.tree, r.pos, f.proof, f.folded FROM {folded} f JOIN roots r ON r.child = f.tree),
{fold_over}
SELECT f.doc_id, f.leaf, f.subroot, t.digest AS root, sha256(f.proof) AS proof_sha256, f.folded AS folded_root, f.folded = t.digest AS verified
FROM {folded_over} f, {outer_top} t"""


@query("op13_merkle_manifest", _manifest_sql())
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and version of every document."""
    return merkle_manifest(table(spark, sf_dir, "documents"), {"text": tampered_text()}).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
