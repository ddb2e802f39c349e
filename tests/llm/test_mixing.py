import pytest

from folioscope.llm.mixing import mix_sources, sainte_lague, source_targets, word_count
from brute import words_of


def seats_one_by_one(claims, seats):
    """The rule as it is stated: each seat goes to the highest quotient, ties to the lower key."""
    held = dict.fromkeys(claims, 0)
    for _ in range(seats):
        best = max(sorted(claims), key=lambda k: claims[k] / (2 * held[k] + 1))
        held[best] += 1
    return held


@pytest.mark.parametrize("claims,seats", [
    ({"a": 53.0, "b": 24.0, "c": 23.0}, 7), ({"a": 1000.0, **{f"s{i}": 0.4 for i in range(10)}}, 1004),
    ({f"s{i}": 1.0 for i in range(9)}, 13), ({"a": 5.5, "b": 2.5, "c": 2.5, "d": 0.0}, 5), ({"a": 1.0}, 0),
    ({f"s{i:02}": 0.49 + i for i in range(30)}, 437)])
def test_quotas_equal_the_stated_rule(spark, claims, seats):
    rows = spark.createDataFrame([(k, v, seats) for k, v in claims.items()], "source string, claim double, seats long")
    got = {r.source: r.quota for r in sainte_lague(rows, "claim", "seats", "quota", ["source"], []).collect()}
    assert got == seats_one_by_one(claims, seats)


def reshared(sizes, weights, limit):
    """Targets step by step: the excess over the limit goes to the others by weight."""
    target = {s: sum(sizes.values()) * weights[s] / sum(weights.values()) for s in sizes}
    full = set()
    while over := [s for s in sizes if s not in full and target[s] > limit * sizes[s] + 1e-9]:
        full |= set(over)
        rest = sum(sizes.values()) - sum(limit * sizes[s] for s in full)
        free = sum(weights[s] for s in sizes if s not in full)
        target = {s: limit * sizes[s] if s in full else rest * weights[s] / free for s in sizes}
    return target


def test_targets(spark):
    sizes = {"a": 10, "b": 5000, "c": 1, "d": 200, "e": 0, "f": 900, None: 50}
    weights = dict(zip(["a", "b", "c", "d", "e", "f", None], [1, 2, 3, 1, 2, 3, 1]))
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    want = reshared(sizes, weights, 3)
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)


def test_word_count(spark):
    texts = [None, "", " ", "a", " a", "a ", " a \t b\n", "a b", "\x0b\x0c", "x\ny", "  z", "\x1c q"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.text: r.n for r in frame.select("text", word_count(frame["text"]).alias("n")).collect()}
    assert got == {t: len(words_of(t)) for t in texts}


def test_takes(documents, prose):
    rows = []
    for s, n in (("hot", 200), ("b", 30), ("c", 3), (None, 20)):
        rows += [(len(rows) + i, " ".join(prose(i, 20 + i % 50)), "en", s) for i in range(n)]
    rows += [(5000, None, "en", "b"), (5001, "", "en", "c"), (5002, " ".join(prose(1, 4000)), "en", "hot"), (5003, None, None, "nothing"),
             (None, "a b c", "en", "b"), (None, "a b c", "en", "b")]
    frame = documents(rows)
    runs = [mix_sources(frame.repartition(n), block_words=16, shard_words=2000).toPandas() for n in (2, 5)]
    key = ["doc_id", "size", "taken", "source"]
    assert runs[0].sort_values(key)[key].reset_index(drop=True).equals(runs[1].sort_values(key)[key].reset_index(drop=True))
    got = runs[0]
    assert len(got) == len(rows) and (got["taken"] <= 3 * got["size"]).all() and (got["taken"] >= 0).all()
    by = got.groupby("source", dropna=False).agg(target=("target", "first"), taken=("taken", "sum"), shards=("shard", "nunique"))
    assert ((by["taken"] - by["target"]).abs() <= 1).all() and by["shards"].max() > 1
    assert by["target"].sum() == pytest.approx(got["size"].sum())


def test_small_sources_reach_their_targets(documents, prose):
    """Sources far below one block, and capped ones, give their target to the word."""
    sizes = {"a": 1, "b": 10, "c": 42, "d": 60, "e": 300, "f": 5000}
    got = mix_sources(documents([(i, " ".join(prose(i, n)), "en", s) for i, (s, n) in enumerate(sizes.items())])).toPandas()
    assert ((got["taken"] - got["target"]).abs() <= 1).all() and (got.set_index("source")["taken"][["a", "b", "c"]] == [3, 30, 126]).all()


def test_rows_without_id_are_dealt_to_all_shards(documents):
    got = mix_sources(documents([(None, f"w{i} " * 30, "en", "s") for i in range(400)]), shard_words=1000).toPandas()
    assert got["shard"].nunique() > 8 and got["taken"].sum() == got["size"].sum()


def test_empty_table(documents):
    assert mix_sources(documents([])).collect() == []
