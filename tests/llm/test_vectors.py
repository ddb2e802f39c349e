import math
import random

import numpy as np
import pytest

from brute import components_of
from folioscope.llm.top_products import top_products, wanted_copies
from folioscope.llm.vector_dedup import near_vectors

SCHEMA = "vec_id long, embedding array<double>, label int, ints string, norm int, size int, side int, n long"
NAN, INF = float("nan"), float("inf")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 1, 1, 1) for r in rows], SCHEMA).repartition(3)


def sound(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def best_products(rows, every, k):
    ints = {(i, tuple(math.floor(1024 * x) for x in v)) for i, v, _ in rows if i is not None and sound(v)}
    out = []
    for q in sorted({i for i, _ in ints if i % every == 0}):
        mine = min(v for i, v in ints if i == q)
        scored = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i, v in ints if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def vectors(seed, n, size=8, spread=1.0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        scale = math.exp(rng.gauss(0, spread))
        v = [rng.gauss(0, scale) for _ in range(size)]
        if i % 5 == 1:  # a near or exact copy of an earlier one
            v = [x * rng.choice([1, 1, 1.001, 1.05]) + rng.choice([0, 0.01]) for x in rows[rng.randrange(i)][1]]
        rows.append((i, v, rng.randrange(3)))
    return rows


@pytest.mark.parametrize("options", [{}, {"bucket_rows": 7, "block_queries": 3, "seed_rows": 20}, {"seed_rows": 12, "coordinate_from": 0.0}])
@pytest.mark.parametrize("spread", [0.0, 2.0])
def test_top_products_equal_all_products(spark, options, spread):
    rows = vectors(3, 150, spread=spread)
    rows += [(500 + i, [0.5] * 8, 0) for i in range(40)]  # ties
    got = top_products(frame(spark, rows), lambda i: i % 10 == 0, **options).collect()
    assert sorted(map(tuple, got)) == best_products(rows, 10, 10)


def test_candidates_go_only_where_they_are_needed(spark):
    """Nine of ten vectors are short; blocks whose queries all need longer ones do not get them."""
    rows = [(i, [float(i % 7 + 1), 1.0] if i % 10 == 0 else [0.01 * (i % 3), 0.02], 0) for i in range(400)]
    sent = []

    def counting(held, wanted):
        out = wanted_copies(held, wanted)
        sent.append((held.count(), wanted.select("block").distinct().count(), out.count(), out.groupBy("id", "block").count().filter("count > 1").count()))
        return out

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("folioscope.llm.top_products.wanted_copies", counting)
        got = top_products(frame(spark, rows), lambda i: i % 10 == 0, block_queries=8).collect()
    assert sorted(map(tuple, got)) == best_products(rows, 10, 10)
    held, blocks, copies, twice = sent[0]
    assert blocks > 1 and twice == 0 and copies < held * blocks / 4


def test_top_products_edges(spark):
    rows = [(0, [1.0, 2.0], 0), (0, [1.0, 2.0], 0), (10, None, 0), (20, [1.0, None], 0), (30, [NAN, 1.0], 0), (40, [INF, 1.0], 0),
            (50, [], 0), (3, [], 1), (4, [0.0, 0.0], 1), (5, [-1.0, -1.0], None), (6, [1.0], 1), (7, [1.0, 2.0, 3.0], 1), (None, [9.0, 9.0], 1),
            (8, [1e6, -1e6], 1), (8, [2.0, 2.0], 1)]
    got = sorted(map(tuple, top_products(frame(spark, rows), lambda i: i % 10 == 0, k=20).collect()))
    assert got == best_products(rows, 10, 20)
    types = dict(top_products(frame(spark, rows), lambda i: i % 10 == 0).dtypes)
    assert types == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    assert top_products(frame(spark, []), lambda i: i % 10 == 0).collect() == []


def linked(rows, threshold=0.98):
    ok = [(i, np.array(v, float), lab) for i, v, lab in rows if i is not None and lab is not None and sound(v) and any(v)]
    links = []
    for a, (i, v, p) in enumerate(ok):
        for j, w, q in ok[:a]:
            if p == q and len(v) == len(w) and v @ w / (np.sqrt(v @ v) * np.sqrt(w @ w)) >= threshold:
                links.append((i, j))
    return links


@pytest.mark.parametrize("options", [{}, {"tile_rows": 5}])
def test_near_vectors_equal_all_pairs(spark, options):
    rows = vectors(4, 160, 6, 0.0)
    rows += [(300 + i, [1.0, 0.0, 0.0, 0.02 * (i % 4), 0.0, 0.0], 1) for i in range(70)]  # a hot label with many copies
    links = linked(rows)
    degree = dict.fromkeys([r[0] for r in rows], 0)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    component = components_of(degree, links)
    got = sorted(map(tuple, near_vectors(frame(spark, rows), **options).collect()))
    assert got == sorted((i, degree[i], component[i], component[i] == i) for i in degree)


def test_near_vectors_edges(spark):
    rows = [(1, None, 0), (2, [0.0, 0.0], 0), (3, [1.0, None], 0), (4, [NAN, 1.0], 0), (5, [1.0, 1.0], None), (6, [1.0, 1.0], 0), (7, [2.0, 2.0], 0),
            (8, [1.0, 1.0, 0.0], 0), (9, [INF, 1.0], 0), (10, [], 0), (None, [1.0, 1.0], 0), (6, [1.0, 1.0], 0)]
    got = sorted(map(tuple, near_vectors(frame(spark, rows)).collect()), key=repr)
    want = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 8, 9, 10)] + [(6, 1, 6, True), (7, 1, 6, False), (None, 0, None, True)]
    assert got == sorted(want, key=repr)
    assert near_vectors(frame(spark, [])).collect() == []
