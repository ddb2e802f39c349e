import random

import pytest

from folioscope.llm.jaccard_join import jaccard_join
from brute import words_of


def shingle_set(text):
    w = words_of(text)
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute_force(rows):
    """Every pair compared."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if i is not None and j is not None and s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), root(i) if i is not None else None) for i, s in sets), key=repr)


def near_copies(prose, seed, families=25):
    rng = random.Random(seed)
    rows, shared = [], prose(999, 40)
    for f in range(families):
        base = prose(f, rng.choice([6, 9, 14, 25, 60, 150])) + (shared if f % 3 == 0 else [])
        for _ in range(rng.choice([1, 2, 6, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    return rows


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"boundary": 40.0}, {"boundary": 1e9}, {"tile_shingles": 300}, {"frequent_shingles": 3}])
def test_equals_all_pairs(documents, prose, options):
    rows = near_copies(prose, 5)
    assert result(jaccard_join(documents(rows), **options)) == brute_force(rows)


def test_edges(documents):
    long = " ".join(f"x{i}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (6, "one two three"), (7, long), (8, long + " y"),
            (9, "a b c d e f g h"), (9, "a b c d e f g h"), (None, "a b c d e f g h"), (10, "Ä b c d e f g h"), (11, "ä b c d e f g h"),
            (12, "a b c d e f"), (13, "a b c d e f")]
    got = result(jaccard_join(documents(rows)))
    assert got == brute_force(rows)
    assert (5, 1, 4) in got and (8, 29997, 7) in got and (None, 4, None) in got


def test_empty_table(documents):
    assert jaccard_join(documents([])).collect() == []


def test_hot_group(documents, prose):
    """A third of the rows in one group of near copies and a third in exact copies, over many tiles."""
    base = prose(1, 80, 10**6)
    rows = [(i, " ".join(base[:i % 70] + [f"q{i}"] + base[i % 70 + 1:])) for i in range(120)]
    rows += [(1000 + i, "the same words stand in all of these documents") for i in range(120)]
    rows += [(2000 + i, " ".join(prose(50 + i, 30, 10**6))) for i in range(120)]
    assert result(jaccard_join(documents(rows), tile_shingles=800)) == brute_force(rows)
