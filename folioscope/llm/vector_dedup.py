"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Vectors of one label are scaled to length one and turned into the principal axes of all vectors, largest
variance first. Tiles of at most about ``tile_rows`` vectors are compared with each other: the products of the
leading axes are accumulated first, what the remaining axes can still add is bounded by the product of the
suffix norms, and pairs that cannot reach the threshold any more are left. Pairs that stay to the end are verified
as the cosine of the original vectors in double precision.

Two vectors with cosine t are at most sqrt(2 - 2t) apart on every axis, so tiles are cut into slabs of that width
along the first axis, and only tiles of the same or neighbouring slabs meet. A label may hold any share of all
rows: its slabs are dealt by hash over as many tiles as they need. A tile pair returns, per vector, the
number of its links, and a spanning forest of them; pairs are never rows. Equal vectors are one vector with
a number of copies from the start.

Defined results: vectors that are null, of length zero or hold null or non-finite components, and vectors with a
null label or id, link with nothing. Vectors of different numbers of components are not compared. Equal rows count
once; an id with several vectors has one row with the links of all. A row without id keeps a row of its own.
Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm.graph import components
from folioscope.llm.stages import stage

THRESHOLD = 0.98
TILE_ROWS = 2048
BLOCK_ROWS = 512
SLACK = 1e-9  # of bounds in floating point; verified pairs need the threshold itself


def _second_moments(batches):
    """Sums of products of components of unit vectors, one row (size, place, total) each."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        by_size: dict[int, list] = {}
        for v in batch.column(0).to_pylist():
            by_size.setdefault(len(v), []).append(v)
        for size, rows in by_size.items():
            x = np.array(rows, np.float64)
            x /= np.sqrt((x * x).sum(axis=1))[:, None]
            sums[size] = sums.get(size, 0) + x.T @ x
    for size, total in sums.items():
        flat = total.reshape(-1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(flat), size, np.int32)), pa.array(np.arange(len(flat))), pa.array(flat)], ["size", "place", "total"])


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """By number of components: the axes as columns, by falling variance. A square matrix each, whatever the rows."""
    rows = vectors.select("vec").mapInArrow(_second_moments, "size int, place long, total double").groupBy("size", "place").agg(
        F.sum("total").alias("total")).toPandas()
    axes = {}
    for size, part in rows.groupby("size"):
        moments = part.sort_values("place")["total"].to_numpy().reshape(size, size)
        values, columns = np.linalg.eigh(moments)
        axes[int(size)] = columns[:, np.argsort(-values, kind="stable")]
    return axes


def _slabs(axes: dict[int, np.ndarray], width: float):
    def run(batches):
        for batch in batches:
            slabs = []
            for v in batch.column(batch.schema.get_field_index("vec")).to_pylist():
                x = np.array(v, np.float64)
                slabs.append(int(np.floor(x @ axes[len(v)][:, 0] / np.sqrt(x @ x) / width)))
            yield batch.append_column("slab", pa.array(slabs, pa.int32()))

    return run


def _linked(left: np.ndarray, right: np.ndarray, same: bool, axes: np.ndarray, threshold: float):
    """Index pairs with cosine >= threshold, block by block; ``same``: right is left, pairs once."""
    n = left.shape[1]
    steps = sorted({min(n, s) for s in (max(1, n // 8), max(1, n // 4), max(1, n // 2), n)})

    def prepared(x):
        lengths = np.sqrt((x * x).sum(axis=1))
        turned = (x / lengths[:, None]) @ axes
        rest = np.sqrt(np.maximum(np.cumsum((turned * turned)[:, ::-1], axis=1)[:, ::-1], 0))
        return lengths, turned, np.concatenate([rest, np.zeros((len(x), 1))], axis=1)

    (la, a, ra), (lb, b, rb) = prepared(left), prepared(right)
    for i in range(0, len(a), BLOCK_ROWS):
        for j in range(i if same else 0, len(b), BLOCK_ROWS):
            x, y = a[i : i + BLOCK_ROWS], b[j : j + BLOCK_ROWS]
            first = steps[0]
            part = x[:, :first] @ y[:, :first].T
            open_ = part + np.outer(ra[i : i + BLOCK_ROWS, first], rb[j : j + BLOCK_ROWS, first]) >= threshold - SLACK
            if same and i == j:
                open_ &= np.tri(*open_.shape, -1, dtype=bool).T
            p, q = np.nonzero(open_)
            sums = part[p, q]
            for low, high in zip(steps, steps[1:]):
                if not len(p):
                    break
                sums = sums + np.einsum("ij,ij->i", x[p, low:high], y[q, low:high])
                keep = sums + ra[i + p, high] * rb[j + q, high] >= threshold - SLACK
                p, q, sums = p[keep], q[keep], sums[keep]
            if len(p):
                cosine = np.einsum("ij,ij->i", left[i + p], right[j + q]) / (la[i + p] * lb[j + q])
                sure = cosine >= threshold
                yield i + p[sure], j + q[sure]


def _compare(axes: dict[int, np.ndarray], threshold: float):
    """Of one tile pair: (u, u, links) per vector and (u, v, 0) per edge of the spanning forest."""

    def run(key, tile: pd.DataFrame) -> pd.DataFrame:
        sides = tile["side"].to_numpy()
        same = bool((sides == 2).all())
        ids, copies = tile["first_id"].to_numpy(), tile["copies"].to_numpy()
        left = np.flatnonzero(sides != 1)
        right = left if same else np.flatnonzero(sides == 1)
        links, parent, forest = np.zeros(len(tile), np.int64), list(range(len(tile))), []

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        if len(left) and len(right):
            matrix = np.array(tile["vec"].tolist(), np.float64)
            for p, q in _linked(matrix[left], matrix[right], same, axes[matrix.shape[1]], threshold):
                p, q = left[p], right[q]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                for x, y in zip(p.tolist(), q.tolist()):
                    x, y = root(x), root(y)
                    if x != y:
                        parent[y] = x
                        forest.append((ids[x], ids[y], 0))
        at = np.flatnonzero(links)
        rows = np.concatenate([np.stack([ids[at], ids[at], links[at]], axis=1), np.array(forest, np.int64).reshape(-1, 3)])
        return pd.DataFrame(rows, columns=["u", "v", "links"])

    return run


def _tile_pairs(classes: DataFrame, tile_rows: int) -> DataFrame:
    """Every vector once per tile pair in which it takes part."""
    slabs = classes.groupBy("label", "size", "slab").agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("parts"))
    slabs = stage(slabs, "slabs")
    follows = slabs.select("label", "size", (F.col("slab") - 1).alias("slab"), F.col("parts").alias("parts_after"))
    precedes = slabs.select("label", "size", (F.col("slab") + 1).alias("slab"), F.col("parts").alias("parts_before"))
    keys = ["label", "size", "slab"]
    known = slabs.join(follows, keys, "left").join(precedes, keys, "left")
    placed = classes.join(known, keys).withColumn("tile", F.pmod(F.xxhash64("first_id"), F.col("parts")).cast("int"))

    def others(n, make):
        return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), make)

    def unit(slab, i, other, j, side):
        return F.struct(slab.alias("a"), i.alias("i"), other.alias("b"), j.alias("j"), F.lit(side).cast("int").alias("side") if isinstance(side, int) else side.alias("side"))

    slab, tile = F.col("slab"), F.col("tile")
    inside = others(F.col("parts"), lambda j: unit(slab, F.least(tile, j), slab, F.greatest(tile, j),
                                                   F.when(tile == j, 2).when(tile < j, 0).otherwise(1)))
    after = others(F.coalesce("parts_after", F.lit(0)), lambda j: unit(slab, tile, slab + 1, j, 0))
    before = others(F.coalesce("parts_before", F.lit(0)), lambda j: unit(slab - 1, j, slab, tile, 1))
    return placed.select("label", "size", "first_id", "copies", "vec", F.explode(F.concat(inside, after, before)).alias("unit")).select(
        "label", "size", "first_id", "copies", "vec", "unit.*")


def near_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *,
                 threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per distinct id of ``embeddings``, and one row per row without id."""
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vec"), F.col(label_col).alias("label"))
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    valid = rows.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & F.col("label").isNotNull() & sound & F.exists("vec", lambda x: x != 0))
    valid = valid.withColumn("class", F.md5(F.concat_ws(",", F.col("vec").cast("array<string>")))).distinct()
    classes = stage(valid.groupBy("label", "class", "vec").agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies")).withColumn("size", F.size("vec")), "distinct-vectors")
    axes = principal_axes(classes)
    width = float(np.sqrt(max(2 - 2 * threshold, 0.0))) + 1e-6
    schema = T.StructType([*classes.schema, T.StructField("slab", T.IntegerType())])
    slabbed = stage(classes.mapInArrow(_slabs(axes, width), schema), "slabbed-vectors")
    compared = stage(_tile_pairs(slabbed, tile_rows).groupBy("label", "size", "a", "i", "b", "j").applyInPandas(
        _compare(axes, threshold), "u long, v long, links long"), "vector-links")
    # several vectors of one id, and the copies of a vector, are tied to the first id of their class
    members = stage(valid.select("vec_id", "label", "class").join(classes.select("label", "class", "first_id", "copies"), ["label", "class"]).select(
        "vec_id", "first_id", "copies"), "class-members")
    linked = compared.filter("links > 0").groupBy("u").agg(F.sum("links").alias("links"))
    counts = members.join(linked, members["first_id"] == linked["u"], "left").groupBy("vec_id").agg(
        F.sum(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    edges = compared.filter("links = 0").select("u", "v").unionByName(members.select(F.col("vec_id").alias("u"), F.col("first_id").alias("v")))
    found = components(edges)
    ids = rows.filter("vec_id IS NOT NULL").select("vec_id").distinct()
    out = ids.join(counts, "vec_id", "left").join(found, F.col("vec_id") == F.col("node"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    nameless = rows.filter("vec_id IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(nameless).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
