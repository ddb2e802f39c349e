"""Merkle manifest of a table: a tree of 16 children a node for every source, and one over the sources' roots.

Rows become digests in the map task; only digests move. Positions within a source come from a range sort, with one
summary row per source and partition. Leaves are then grouped in aligned blocks of 16**3, and the blocks' tops in
blocks again, until one node is left: no group holds more than 4,096 nodes, whatever the size of a source. From the
top down every block learns its upper path (the runs above it), so that a block can answer for all of its leaves.

A changed leaf makes a version of the persistent tree: its ancestors are copied, first inside its block, then
along the upper path; every other node is shared with the original.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.stages import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN_BITS = 4
FAN = 1 << FAN_BITS
BLOCK_LEVELS = 3
PATH = "array<struct<at:int,run:array<string>>>"
PROOFS = ("doc_id long, source string, position long, leaf string, subroot string, root string, proof_sha256 string, "
          "folded_root string, verified boolean")


def printed(value: Column) -> Column:
    """``-`` for null, else the length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(fields: Iterable[Column]) -> Column:
    """Lower-case hex SHA-256 of the printed fields."""
    return F.sha2(F.concat(*[printed(f) for f in fields]).cast("binary"), 256)


def merkle_manifest(docs: DataFrame, put: dict[str, Column] | None = None, fields: Sequence[str] = FIELDS,
                    block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per row of ``docs``: leaf, subroot and root of the table, and what a change of the row does.

    ``put`` gives columns of ``docs`` their value in the row's own version; without it no row changes. ``proof_sha256``
    is the digest of all siblings on the way up, ``folded_root`` the root of the row's version and ``verified`` tells
    whether that is the root.

    Rows of a source stand by doc_id, null first; rows with one doc_id by their digest, so repeated rows each have
    a place and a proof. A null source is a source of its own, before all others. Null and empty texts have different
    digests. Texts of any length are hashed whole. A table of one row has its leaf as root and a proof over nothing;
    an empty table gives no rows. Columns outside ``fields`` play no part, whatever their names.
    """
    before = [F.col(c) for c in fields]
    after = [(put or {}).get(c, F.col(c)) for c in fields]
    changed = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(v) for c, v in (put or {}).items()], F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source"), digest(before).alias("leaf"),
                       F.when(changed, digest(after)).alias("changed"))
    order = [F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"), F.asc("leaf"), F.asc("changed")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    rows = stage(rows.withColumn("tree", printed(F.col("source"))).withColumn("part", F.shiftright("at", 33)), "merkle-leaves")

    bits = FAN_BITS * block_levels
    runs, sources = _places(rows)
    leaves = rows.join(runs, ["tree", "part"]).select(
        "tree", "doc_id", "source", "leaf", "changed", "n", (F.col("at") - F.col("first") + F.col("offset")).alias("pos"))
    leaves = stage(leaves.withColumn("block", F.shiftright("pos", bits)), "merkle-placed")
    tops = stage(leaves.groupBy("tree", "block").applyInArrow(
        _tops("leaf", block_levels), "tree string, block long, n long, digest string"), "merkle-tops")
    nodes = tops.select("tree", F.col("block").alias("pos"), "n", "digest")

    inside, subroots = _paths(nodes, block_levels)
    over, _ = _paths(subroots.join(sources, "tree").select(
        F.lit("").alias("tree"), F.col("place").alias("pos"), F.col("n_sources").alias("n"), "digest"), block_levels)
    over = over.select(F.col("pos").alias("place"), F.col("path").alias("over"), F.col("top").alias("root"))
    upper = (inside.join(sources.select("tree", "place"), "tree").join(over, "place")
             .select("tree", F.col("pos").alias("block"), F.concat("path", "over").alias("path"), F.col("top").alias("subroot"), "root"))
    return leaves.groupBy("tree", "block").cogroup(upper.groupBy("tree", "block")).applyInArrow(_proofs(block_levels), PROOFS)


def _places(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For every source and partition of the sorted rows its first row and the rows of the source before it; the order of the sources.

    Windows see one row per source and partition, or one per partition.
    """
    runs = rows.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    runs = stage(runs, "merkle-runs")
    own = Window.partitionBy("tree")
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select("tree", "part", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"),
                          F.sum("rows").over(own).alias("n"))
    starts = runs.groupBy("tree").agg(F.min("first").alias("first")).withColumn("part", F.shiftright("first", 33))
    within = F.row_number().over(Window.partitionBy("part").orderBy("first")) - 1
    by_part = starts.groupBy("part").agg(F.count(F.lit(1)).alias("sources"))
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = by_part.select("part", F.coalesce(F.sum("sources").over(every), F.lit(0)).alias("earlier"),
                             F.sum("sources").over(Window.partitionBy()).alias("n_sources"))
    sources = starts.withColumn("within", within).join(by_part, "part").select(
        "tree", (F.col("earlier") + F.col("within")).alias("place"), "n_sources")
    return offsets, sources


def _paths(nodes: DataFrame, block_levels: int) -> tuple[DataFrame, DataFrame]:
    """Of every node (tree, pos, n nodes in its tree, digest) the runs up to the top of its tree; the trees' tops.

    Each round folds aligned blocks into one node each; the paths are put together from the top down, where a
    node's block is the only parent of at most 4,096 children.
    """
    bits, rounds = FAN_BITS * block_levels, []
    while True:
        work = nodes.withColumn("block", F.shiftright("pos", bits))
        made = stage(work.groupBy("tree", "block").applyInArrow(
            _steps(block_levels), f"tree string, pos long, n long, block long, path {PATH}, top string"), "merkle-paths")
        rounds.append(made)
        above = F.ceil(F.col("n") / F.lit(1 << bits)).cast("long")
        nodes = made.filter(F.col("pos") == F.shiftleft("block", bits)).select("tree", F.col("block").alias("pos"), above.alias("n"), F.col("top").alias("digest"))
        if (nodes.agg(F.max("n")).first()[0] or 1) == 1:
            break
    paths = rounds[-1].select("tree", "pos", "path", "top")
    for made in reversed(rounds[:-1]):
        parents = paths.select("tree", F.col("pos").alias("block"), F.col("path").alias("above"), F.col("top").alias("root"))
        paths = made.join(parents, ["tree", "block"]).select("tree", "pos", F.concat("path", "above").alias("path"), F.col("root").alias("top"))
    return paths, nodes.select("tree", "digest")


def _hash(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _levels(nodes: list[str], n: int, block_levels: int) -> list[list[str]]:
    """The levels above a block's ``nodes``: all of them if its tree has more nodes than a block, else up to one node."""
    full = n > 1 << FAN_BITS * block_levels
    levels = [nodes]
    while len(levels) <= block_levels if full else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([_hash(below[i : i + FAN]) for i in range(0, len(below), FAN)])
    return levels


def _path(levels: list[list[str]], i: int) -> list[tuple[int, list[str]]]:
    """The runs that hold node ``i`` and its ancestors below the top, each with the place in it."""
    out = []
    for level in levels[:-1]:
        first = i >> FAN_BITS << FAN_BITS
        out.append((i - first, level[first : first + FAN]))
        i >>= FAN_BITS
    return out


def _version(changed: str, path: list[tuple[int, list[str]]]) -> str:
    """The top of a version in which one node is ``changed``: its ancestors are copies, all other nodes the original's."""
    for at, run in path:
        changed = _hash([*run[:at], changed, *run[at + 1 :]])
    return changed


def _sorted(table: pa.Table) -> pa.Table:
    return table.sort_by("pos")


def _tops(column: str, block_levels: int):
    def tops(table: pa.Table) -> pa.Table:
        table = _sorted(table)
        n = table["n"][0].as_py()
        top = _levels(table[column].to_pylist(), n, block_levels)[-1][0]
        blocks = -(-n >> FAN_BITS * block_levels)
        return pa.table({"tree": table["tree"][:1], "block": table["block"][:1], "n": pa.array([blocks], pa.int64()), "digest": pa.array([top])})

    return tops


def _steps(block_levels: int):
    path_type = pa.list_(pa.struct([("at", pa.int32()), ("run", pa.list_(pa.string()))]))

    def steps(table: pa.Table) -> pa.Table:
        table = _sorted(table)
        levels = _levels(table["digest"].to_pylist(), table["n"][0].as_py(), block_levels)
        paths = [[{"at": at, "run": run} for at, run in _path(levels, i)] for i in range(table.num_rows)]
        return pa.table({"tree": table["tree"], "pos": table["pos"], "n": table["n"], "block": table["block"],
                         "path": pa.array(paths, path_type), "top": pa.array([levels[-1][0]] * table.num_rows)})

    return steps


def _proofs(block_levels: int):
    def proofs(leaves: pa.Table, upper: pa.Table) -> pa.Table:
        leaves = _sorted(leaves)
        own = leaves["leaf"].to_pylist()
        levels = _levels(own, leaves["n"][0].as_py(), block_levels)
        above = [(step["at"], step["run"]) for step in upper["path"][0].as_py()]
        siblings_above = "".join(d for at, run in above for k, d in enumerate(run) if k != at)
        subroot, root = upper["subroot"][0].as_py(), upper["root"][0].as_py()
        proof, folded = [], []
        for i, (leaf, changed) in enumerate(zip(own, leaves["changed"].to_pylist(), strict=True)):
            path = _path(levels, i)
            proof.append(_hash([d for at, run in path for k, d in enumerate(run) if k != at] + [siblings_above]))
            folded.append(_version(changed or leaf, path + above))
        n = leaves.num_rows
        return pa.table({
            "doc_id": leaves["doc_id"], "source": leaves["source"], "position": leaves["pos"], "leaf": leaves["leaf"],
            "subroot": pa.array([subroot] * n, pa.string()), "root": pa.array([root] * n, pa.string()),
            "proof_sha256": pa.array(proof, pa.string()), "folded_root": pa.array(folded, pa.string()),
            "verified": pa.array([f == root for f in folded], pa.bool_())})

    return proofs
