import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from folioscope.llm.merkle import merkle_manifest
from folioscope.llm.tree_queries import op13_merkle_manifest, tampered_text

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def tree(nodes):
    """Levels from the leaves to the one top."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def walk(levels, i):
    for level in levels[:-1]:
        yield i % 16, level[i // 16 * 16 : i // 16 * 16 + 16]
        i //= 16


def brute(rows):
    """Every row's proof and fold, one by one."""
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append((leaf_of(row), row))
    trees, order = {}, sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        sources[s].sort(key=lambda p: (p[1][0] is not None, p[1][0] or 0, p[0]))
        trees[s] = tree([leaf for leaf, _ in sources[s]])
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for i, (leaf, row) in enumerate(sources[s]):
            steps = [*walk(trees[s], i), *walk(top, place)]
            folded = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                folded = leaf_of([*row[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4])])
            for at, run in steps:
                folded = sha([*run[:at], folded, *run[at + 1 :]])
            proof = sha([d for at, run in steps for k, d in enumerate(run) if k != at])
            out.append((row[0], leaf, trees[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def manifest(spark, rows, **options):
    return got(merkle_manifest(documents(spark, rows), {"text": tampered_text()}, **options))


@pytest.mark.parametrize("block_levels", [1, 2, 3])
def test_every_proof_and_version_equals_the_walk(spark, block_levels):
    """Sources of 1, 16, 17, 256, 257 and 700 rows; with blocks of 16 the tree has several distributed levels."""
    rows, i = [], 0
    for source, n in (("a", 1), ("b", 16), ("c", 17), ("é", 256), ("Z", 257), ("hot", 700), (None, 3)):
        for _ in range(n):
            rows.append((i * 7 % 5000, source, None if i % 3 else "en", i if i % 4 else None, f"Text {i} Äß" if i % 5 else "lower"))
            i += 1
    assert manifest(spark, rows, block_levels=block_levels) == brute(rows)


def test_many_sources(spark):
    rows = [(i, f"host{i % 300}", "en", 4, "Page") for i in range(600)]
    assert manifest(spark, rows, block_levels=1) == brute(rows)


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [(None, None, None, None, None), (1, None, "en", 0, ""), (1, "s", "en", 1, "B"), (1, "s", "en", 1, "A"),
            (2, "s", "en", 1, "A"), (2, "s", "en", 1, "A"), (None, "s", None, None, "X"), (3, "", "", 0, "Long " * 200_000)]
    assert manifest(spark, rows) == brute(rows)


def test_one_row_and_none(spark):
    alone = [(4, "s", "en", 1, "a")]
    (row,) = manifest(spark, alone)
    assert row[1] == row[2] == row[3] and row[4] == hashlib.sha256(b"").hexdigest()
    assert manifest(spark, []) == []


def test_extra_columns_and_no_change(spark):
    rows = [(i, "s", "en", 1, f"T{i}") for i in range(40)]
    plain = documents(spark, rows)
    more = plain.withColumns({c: F.lit("x") for c in ("leaf", "changed", "tree", "part", "pos", "block", "n", "root")})
    assert got(merkle_manifest(more, {"text": tampered_text()})) == brute(rows)
    assert all(r[-1] for r in got(merkle_manifest(more)))


def test_query_over_the_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    assert got(op13_merkle_manifest(spark, sf_dir)) == brute([tuple(r) for r in docs.collect()])
