"""Query of the tokenizer over the whole documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm.bpe import decode, encode
from folioscope.llm.registry import query
from folioscope.llm.stages import table


@query("op11_bpe")
def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document and what they decode to, as digests."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    tokens = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path).select("doc_id", "ids"), path)
    return tokens.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                         F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
