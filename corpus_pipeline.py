"""Training-data pipeline over documents: quality, boilerplate lines, near copies, source mix, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and is written as Parquet before
the next one reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm.jaccard_join import jaccard_join
from folioscope.llm.line_dedup import LOW_RATIO, drop_boilerplate
from folioscope.llm.mixing import mix_sources
from folioscope.llm.packing import pack
from folioscope.llm.quality import keep_good
from folioscope.llm.stages import stage, table, unused
from folioscope.scale import first_rows


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps. Null and empty texts, rows without id and repeated rows go its way (see there)."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are boilerplate of their source; n_chars follows the text.

    Null and empty texts, and documents without source, stay as they are; repeated rows stay repeated.
    """
    inner = docs.select("doc_id", "text", "lang", "source", "n_chars", F.struct(*docs.columns).alias("row"))
    out = drop_boilerplate(inner, low_ratio=LOW_RATIO)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.select("text", n_chars.alias("n_chars"), "row").select(
        *[F.col(c) if c in ("text", "n_chars") else F.col("row")[c].alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class the document with the smallest doc_id; texts without words are classes of one.

    Of rows that share a doc_id and a text the first by the other columns stays; rows that share a doc_id only all
    stay if their document does. Rows without doc_id all stay, and so do null and empty texts.
    """
    (key,) = unused(docs, "first_id")
    found = jaccard_join(docs).filter("component_id = doc_id").select(F.col("doc_id").alias(key)).distinct()
    kept = docs.join(found, F.col("doc_id") == F.col(key), "left_semi")
    (digest,) = unused(docs, "text_digest")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    once = first_rows(kept.withColumn(digest, F.md5(F.col("text").cast("binary"))), ["doc_id", digest], others or ["doc_id"]).drop(digest)
    return once.unionByName(docs.filter("doc_id IS NULL"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words the mix takes: a document once per full pass, and the rest of its run as one more row.

    A run keeps the blanks and line breaks between its words. Rows that share a doc_id, or have none, share one take;
    texts without words are not taken.
    """
    takes = mix_sources(docs).filter("taken > 0").select(
        F.col("doc_id").alias("id"), "size", "full", "first", "last", "wrapped").dropDuplicates(["id"])
    joined = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row")).join(takes, F.col("doc_id").eqNullSafe(F.col("id")))
    words = F.split(F.regexp_replace("text", "^[ \\t-\\r]+", ""), "(?<=[ \\t-\\r])(?=[^ \\t-\\r])")  # each with the blanks after it

    def run(start, end):
        taken = F.array_join(F.slice(words, start.cast("int") + 1, (end - start).cast("int")), "")
        return F.when(end > start, F.regexp_replace(taken, "[ \\t-\\r]+$", ""))

    rest = F.nullif(F.concat_ws("\n", run(F.col("first"), F.col("last")), run(F.lit(0), F.col("wrapped"))), F.lit(""))
    whole = F.col("last") - F.col("first") + F.col("wrapped") == F.col("size")
    copies = F.filter(F.concat(F.array_repeat(F.col("text"), F.col("full").cast("int")),
                               F.array(F.when(whole, F.col("text")).otherwise(rest))), lambda t: t.isNotNull())
    rows = joined.select("row", F.explode(copies).alias("copy"))
    n_chars = F.when(F.col("copy") == F.col("row.text"), F.col("row.n_chars")).otherwise(F.length("copy").cast("long"))
    changed = {"text": F.col("copy"), "n_chars": n_chars}
    return rows.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences in batches of their length bucket; null and empty texts have length 0, repeated rows stay repeated."""
    return pack(docs)


STAGES = [
    ("quality", good_documents),
    ("line_dedup", without_boilerplate),
    ("near_duplicates", one_of_each_group),
    ("mixing", mixed_sources),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
