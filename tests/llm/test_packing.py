import random
from itertools import combinations

import numpy as np
import pytest

from folioscope.llm.packing import best_bounds, pack
from brute import words_of


def padding(bounds, lengths, counts):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in zip(lengths, counts))


@pytest.mark.parametrize("seed", range(6))
def test_bounds_are_the_best(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(1, 60), 9))
    counts = [rng.randrange(1, 50) for _ in lengths]
    for buckets in (1, 2, 3, 4, 12):
        got = best_bounds(np.array(lengths), np.array(counts), buckets)
        k = min(buckets, len(lengths)) - 1
        best = min(padding([*c, lengths[-1]], lengths, counts) for c in combinations(lengths[:-1], k))
        assert len(got) <= buckets and padding(got, lengths, counts) == best


def test_batches(documents, prose):
    rng = random.Random(3)
    rows = [(i, " ".join(prose(i, rng.choice([3, 3, 3, 17, 40, 41, 90])))) for i in range(300)]
    rows += [(900, " ".join(prose(1, 1234))), (901, None), (902, "  "), (None, "a b"), (5, "x y z"), (5, "x y z")]
    got = pack(documents(rows), max_words=100, buckets=4, token_budget=200, shard_rows=50).toPandas()
    used = got[got["n_words"] > 0]
    assert (used["n_words"] <= used["bucket"]).all() and used["bucket"].nunique() <= 4
    sizes = used.groupby(["bucket", "shard", "batch"]).size().reset_index(name="n")
    assert (sizes["n"] <= np.maximum(200 // sizes["bucket"], 1)).all()
    short = sizes[sizes["n"] < 200 // sizes["bucket"]]
    assert short.groupby(["bucket", "shard"]).size().max() == 1  # the last batch of a shard
    total = {}
    for r in got.itertuples():
        if r.doc_id == r.doc_id:
            total[int(r.doc_id)] = total.get(int(r.doc_id), 0) + r.n_words
    want = {}
    for i, t in rows:
        if i is not None:
            want[i] = want.get(i, 0) + len(words_of(t))
    assert total == want
    long = got[got["doc_id"] == 900].sort_values("piece")
    assert long["first_word"].tolist() == list(range(0, 1234, 100)) and long["n_words"].sum() == 1234
    assert got[got["doc_id"].isin([901, 902])]["bucket"].isna().all()


def test_empty_table(documents):
    assert pack(documents([])).collect() == []
