"""Exact top-k search by inner product, with norm-bucketed pruning.

Vectors are grouped by length: a bucket holds vectors whose norms differ by at most five per cent, dealt by hash
into parts of ``bucket_rows``. Each query has a lower bound of its k-th best score, taken from the ``seed_rows``
longest vectors. Against a bucket of greatest norm l the bound becomes a local cosine threshold,
bound / (|query| l): above 1 the bucket is skipped. Queries are put in order of the norm they need and cut into
blocks, and a candidate is sent only to the blocks with a query that needs no more than its norm. Within a bucket,
following LEMP (Teflioudi et al., 2015), a high threshold prunes by coordinates (the entries of a candidate at the
query's largest coordinates must lie in the region that the threshold leaves), a low one by length alone. What is left is verified as an integer product, and the best k of each part are merged.

The bounds only save work: every vector that can be among the best k of a query is verified, whatever the
distribution of norms. Queries and candidates meet in blocks of bounded size.

Defined results: components become floor(1024 x) of the double. Vectors that are null or hold a null, NaN or infinite
component take no part, nor do rows without id. Missing components of a shorter vector count as 0. Equal rows count
once; an id with several vectors is a candidate with each and a query with the least. A query never meets a row
of its own id. Ties go to the smaller id. Scores beyond a long are held at its ends. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.stages import stage

BUCKET_RATIO = 1.05
BUCKET_ROWS = 8192
BLOCK_QUERIES = 1024
SEED_ROWS = 4096
COORDINATES = 3  # of the query, the largest
COORDINATE_FROM = 0.3  # local cosine threshold from which coordinates prune better than length
SCORE_ROWS = 64  # queries scored at once
SLACK = 1e-9  # of norms and bounds, which are doubles


def quantized(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, ints, norm) of the distinct rows that take part."""
    vec = F.col(vector_col)
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ints = F.transform(vec, lambda x: F.floor(F.lit(1024.0) * x.cast("double")))
    norm = F.sqrt(F.aggregate("ints", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return vectors.filter(F.col(id_col).isNotNull() & vec.isNotNull() & sound).select(
        F.col(id_col).cast("long").alias("id"), ints.alias("ints")).distinct().withColumn("norm", norm)


def _matrix(rows, width: int = 0) -> np.ndarray:
    """Integer rows as doubles where every product is exact in doubles, else as Python integers."""
    rows = list(rows)
    width = max([width, *(len(r) for r in rows)])
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _scorer(a: np.ndarray, b: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Exact products of chosen rows of a and b, as int64; the kind of numbers is settled once for all of them."""
    high = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if high < 2.0**53:
        left, right = a.astype(np.float64), b.astype(np.float64)
        return lambda i, j: (left[i] @ right[j].T).astype(np.int64)
    if high < 2.0**62:
        return lambda i, j: a[i] @ b[j].T
    return lambda i, j: np.clip(a[i].astype(object) @ b[j].astype(object).T, -(2**63), 2**63 - 1).astype(np.int64)


def _alike(a, b) -> tuple[np.ndarray, np.ndarray]:
    width = max(max(map(len, a), default=0), max(map(len, b), default=0))
    return _matrix(a, width), _matrix(b, width)


def _bounds(seed_ids: np.ndarray, seed: list, k: int):
    """Adds ``bound``: the k-th best score of a query among the seed rows, null if there are fewer."""

    def run(frames):
        for frame in frames:
            out, ids = [], frame["id"].to_numpy()
            score, every = _scorer(*_alike(frame["ints"], seed)), np.arange(len(seed))
            for first in range(0, len(frame), SCORE_ROWS):
                mine = np.arange(first, min(first + SCORE_ROWS, len(frame)))
                scores = score(mine, every).astype(np.float64)
                scores[ids[mine][:, None] == seed_ids[None, :]] = -np.inf
                best = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(mine), -np.inf)
                out.append(best)
            yield frame.assign(bound=np.concatenate(out) if out else [])

    return run


def _survivors(query, norm, bound, unit, norms, focus_limit):
    """Candidates (sorted by falling norm) that a query must be verified against."""
    if not np.isfinite(bound) or bound <= 0 or norm == 0:
        return np.arange(len(norms))
    slack = SLACK
    local = bound / (norm * norms[0]) - slack if norms[0] > 0 else np.inf
    if local > 1:
        return np.zeros(0, np.int64)
    n = int(np.searchsorted(-norms, -(bound / norm) * (1 - slack), "right"))  # length: |p| >= bound / |q|
    if local < focus_limit:
        return np.arange(n)
    direction = query / norm
    keep = np.ones(n, bool)
    for f in np.argsort(-np.abs(direction))[:COORDINATES]:
        x = min(max(direction[f], -1.0), 1.0)
        wide = np.sqrt(max(0.0, (1 - local * local) * (1 - x * x)))
        low = x * local - wide if -x < local else -1.0  # the region is cut off by -1 or 1 where it holds a pole
        high = x * local + wide if x < local else 1.0
        keep &= (unit[:n, f] >= low - slack) & (unit[:n, f] <= high + slack)
    return np.flatnonzero(keep)


def _best_of_part(k: int, focus_limit: float):
    def run(key, queries: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(part):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        part = part.sort_values("norm", ascending=False, kind="stable")
        q, p = _alike(queries["ints"], part["ints"])
        ids, norms = part["id"].to_numpy(), part["norm"].to_numpy()
        unit = p / np.where(norms > 0, norms, 1.0)[:, None]
        score, wants = _scorer(q, p), list(zip(queries["id"], queries["norm"], queries["bound"]))
        found = []
        for first in range(0, len(wants), SCORE_ROWS):
            kept = [_survivors(q[i], wants[i][1], wants[i][2], unit, norms, focus_limit) for i in range(first, min(first + SCORE_ROWS, len(wants)))]
            rows = np.unique(np.concatenate(kept))
            if not len(rows):
                continue
            block = score(np.arange(first, first + len(kept)), rows)  # one product for all queries of the chunk
            for n, (at, (own, _, bound)) in enumerate(zip(kept, wants[first:])):
                scores = block[n, np.searchsorted(rows, at)]
                enough = (ids[at] != own) & (scores >= bound)
                at, scores = at[enough], scores[enough]
                if not len(at):
                    continue
                best = np.lexsort((ids[at], -scores.astype(np.float64) if np.abs(scores).max() < 2**53 else [-int(s) for s in scores]))[:k]
                found.append(np.stack([np.full(len(best), own), ids[at][best], scores[best]], axis=1))
        rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
        return pd.DataFrame({"query_id": rows[:, 0], "vec_id": rows[:, 1], "score": rows[:, 2]})

    return run


def wanted_copies(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """A candidate once for each block of queries that can use a vector of its class and norm.

    ``wanted``: (block, length, least), the least norm that a query of the block needs. Blocks hold queries of like
    needs, so short vectors go to few of them.
    """
    dealt = wanted.select(F.col("block").alias("block"), "length", "least")  # a column of its own, beside that of the queries
    return rows.join(dealt, "length").filter(F.col("norm") * (1 + SLACK) >= F.col("least")).select(
        "id", "ints", "norm", F.col("length").alias("length"), "part", "block")


def _blocked(asked: DataFrame, block_queries: int) -> DataFrame:
    """Adds ``block``: consecutive ranges of queries put together, so that blocks do not depend on how many partitions held them."""
    before = F.sum("n").over(Window.orderBy("range")) - F.col("n")  # one row per range
    ranges = asked.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("range").alias("at"), F.floor(before / block_queries).cast("int").alias("block"))
    return asked.join(ranges, F.col("range") == F.col("at")).drop("range", "at")


def top_products(vectors: DataFrame, is_query: Callable[[Column], Column], id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = 10,
                 bucket_rows: int = BUCKET_ROWS, block_queries: int = BLOCK_QUERIES, seed_rows: int = SEED_ROWS,
                 coordinate_from: float = COORDINATE_FROM) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best products of each query row with all other rows."""
    rows = quantized(vectors, id_col, vector_col)
    length = F.when(F.col("norm") > 0, F.floor(F.log("norm") / F.log(F.lit(BUCKET_RATIO)))).otherwise(-1).cast("int")
    rows = stage(rows.withColumn("length", length), "quantized")
    # a class of norms is five per cent wide, so there are a few hundred of them, whatever the number of rows
    classes = rows.groupBy("length").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("norm")).collect()
    parts = {-1: 1} | {c["length"]: -(-c["n"] // bucket_rows) for c in classes}

    seed = rows.orderBy(F.desc("norm"), "id", "ints").limit(seed_rows).select("id", "ints").collect()  # bounded by seed_rows
    bounds = _bounds(np.array([r["id"] for r in seed], np.int64), [r["ints"] for r in seed], k)
    asked = rows.filter(is_query(F.col("id"))).groupBy("id").agg(F.min(F.struct("ints", "norm")).alias("v")).select("id", "v.*")
    asked = asked.mapInPandas(bounds, "id long, ints array<long>, norm double, bound double")
    asked = stage(asked, "queries-with-bounds")
    need = F.when((F.col("bound") > 0) & (F.col("norm") > 0), F.col("bound") / F.col("norm")).otherwise(0.0)
    blocks = max(1, -(-asked.count() // block_queries))
    asked = asked.withColumn("need", need).repartitionByRange(blocks, "need", "id").withColumn("range", F.spark_partition_id())
    asked = _blocked(stage(asked, "query-ranges"), block_queries)

    known = F.array(*[F.struct(F.lit(c["length"]).cast("int").alias("length"), F.lit(parts[c["length"]]).cast("int").alias("parts"),
                               F.lit(c["norm"]).cast("double").alias("top")) for c in classes or [{"length": -1, "norm": 0.0}]])
    reached = F.explode(F.filter(known, lambda b: b["top"] * (1 + SLACK) >= F.col("need"))).alias("class")
    sent = asked.select("id", "ints", "norm", "bound", "block", reached).select(
        "id", "ints", "norm", "bound", "block", "class.length",
        F.explode(F.sequence(F.lit(0), F.col("class.parts") - 1)).alias("part"))
    wanted = asked.groupBy("block").agg(F.min("need").alias("need")).select("block", "need", reached).select(
        "block", F.col("need").alias("least"), F.col("class.length").alias("length"))
    held = wanted_copies(rows.withColumn("part", F.pmod(F.xxhash64("id"), _per_class(parts)).cast("int")), wanted)
    keys = ["length", "part", "block"]
    best = sent.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(
        _best_of_part(k, coordinate_from), "query_id long, vec_id long, score long")
    order = [F.desc("score"), F.asc("vec_id")]
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return best.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _per_class(parts: dict[int, int]) -> Column:
    out = F.lit(1)
    for length, n in parts.items():
        out = F.when(F.col("length") == length, F.lit(n)).otherwise(out)
    return out
