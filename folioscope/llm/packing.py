"""Packing into length buckets that waste the least padding.

Lengths are words. A document longer than ``max_words`` is cut into pieces of ``max_words`` and a rest, so
no length is above it and the histogram of all lengths has at most ``max_words`` rows, however many
documents there are. Dynamic programming over that histogram finds the ``buckets`` upper bounds with the
least padding in total; a sequence is padded to the bound of its bucket. Batches of
``token_budget // bound`` sequences are formed inside each bucket.

A bucket may hold any share of all sequences, so its sequences are dealt by hash over shards of about
``shard_rows`` and numbered inside a shard; only the last batch of a shard can be short.

Defined results: a null or blank text has no sequence; it keeps one row of 0 words without bucket and batch. Rows
that share a doc_id are packed one by one. Ties in length are ordered by hash; an empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.mixing import word_count
from folioscope.llm.stages import stage

MAX_WORDS = 2048
BUCKETS = 16
TOKEN_BUDGET = 32768
SHARD_ROWS = 1 << 16


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` runs of ``lengths`` (ascending) with the least total padding."""
    n = len(lengths)
    if not n:
        return []
    lengths = lengths.astype(np.float64)
    rows = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    words = np.concatenate([[0], np.cumsum(counts * lengths)])
    best = np.full(n + 1, np.inf)
    best[0] = 0
    came = []
    for _ in range(min(buckets, n)):
        following, origin = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):  # the run (i, j] is padded to lengths[j - 1]
            cost = best[:j] + (rows[j] - rows[:j]) * lengths[j - 1] - (words[j] - words[:j])
            origin[j] = int(np.argmin(cost))
            following[j] = cost[origin[j]]
        came.append(origin)
        best = following
    bounds, at = [], n
    for origin in reversed(came):
        if at == 0:
            break
        bounds.append(int(lengths[at - 1]))
        at = int(origin[at])
    return sorted(set(bounds))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, max_words: int = MAX_WORDS,
         buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per sequence: doc_id, piece, first_word, n_words, bucket, shard, batch, place (in the batch)."""
    total = F.col("total")
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(total / max_words) - 1, F.lit(0).cast("long"))))
    sized = docs.select(F.col(id_col).alias("doc_id"), word_count(F.col(text_col)).alias("total")).select("doc_id", "total", pieces.alias("piece"))
    sequences = stage(sized.select(
        "doc_id", "piece", (F.col("piece") * max_words).alias("first_word"),
        F.least(total - F.col("piece") * max_words, F.lit(max_words)).cast("long").alias("n_words")), "sequences")
    histogram = sequences.filter("n_words > 0").groupBy("n_words").count().orderBy("n_words").collect()  # max_words rows at most
    lengths = np.array([r["n_words"] for r in histogram], np.int64)
    counts = np.array([r["count"] for r in histogram], np.int64)
    bounds = best_bounds(lengths, counts, buckets)
    ends = np.searchsorted(bounds, lengths) if bounds else lengths
    shards = [max(1, -(-int(counts[ends == k].sum()) // shard_rows)) for k in range(len(bounds))]
    if not bounds:
        return sequences.withColumns({c: F.lit(None).cast("long") for c in ("bucket", "shard", "batch", "place")})

    def per_bucket(values: list[int]):
        out = F.lit(None).cast("long")
        for k in range(len(bounds) - 1, -1, -1):
            out = F.when((F.col("n_words") > 0) & (F.col("n_words") <= bounds[k]), F.lit(values[k]).cast("long")).otherwise(out)
        return out

    key = F.xxhash64("doc_id", "piece")
    placed = sequences.withColumns({"bucket": per_bucket(bounds), "__shards": per_bucket(shards)}).withColumn(
        "shard", F.pmod(key, F.coalesce("__shards", F.lit(1).cast("long"))))
    order = Window.partitionBy("bucket", "shard").orderBy(F.xxhash64("piece", "doc_id"), "doc_id", "piece")
    used = placed.filter("bucket IS NOT NULL").withColumn("__at", F.row_number().over(order) - 1)
    size = F.greatest(F.floor(F.lit(token_budget) / F.col("bucket")), F.lit(1))
    used = used.select("doc_id", "piece", "first_word", "n_words", "bucket", "shard", F.floor(F.col("__at") / size).alias("batch"),
                       (F.col("__at") % size).cast("long").alias("place"))
    none = F.lit(None).cast("long")
    empty = placed.filter("bucket IS NULL").select(
        "doc_id", "piece", "first_word", "n_words", none.alias("bucket"), none.alias("shard"), none.alias("batch"), none.alias("place"))
    return used.unionByName(empty)
