import math
import random
import zlib

import numpy as np

from folioscope.llm.language import families_of, identify, train_svm
from folioscope.llm.lm_scores import ALPHA, backoff_scores
from brute import words_of

SYLLABLES = {"aa": "stra ung hei ver zu", "ab": "stra ung ing the er", "xx": "cion ado que la os", "xy": "tion eau que le oi"}


def speech(lang, seed, n):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(SYLLABLES[lang].split()) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_languages_of_held_out_rows(documents):
    rng = random.Random(1)
    rows = [(i, speech(lang, i, rng.choice([8, 20, 60])), lang) for i, lang in enumerate(rng.choices(sorted(SYLLABLES), k=400))]
    marks = [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 !? 34", "aa"), (1003, speech("xx", 5, 30), None), (None, speech("ab", 6, 30), "ab"),
             (1004, speech("aa", 7, 40000), None), (1005, speech("aa", 8, 9), "aa"), (1005, speech("aa", 8, 9), "aa")]
    got = identify(documents(rows + marks)).toPandas()
    assert len(got) == len(rows) + len(marks) and got["score"].between(0, 1).all()
    true = {i: lang for i, _, lang in rows}
    held = got[got["held_out"] & got["doc_id"].isin(true)]
    assert (held["lang_pred"] == held["doc_id"].map(true)).mean() >= 0.97
    by = got.dropna(subset="doc_id").drop_duplicates("doc_id").set_index("doc_id")
    assert by.loc[[1000, 1001, 1002], "lang_pred"].tolist() == ["und"] * 3 and (by.loc[[1000, 1001, 1002], "score"] == 0).all()
    assert by.loc[1003, "lang_pred"] == "xx" and by.loc[1004, "lang_pred"] == "aa"
    assert all(bool(h) == (zlib.crc32(str(int(i)).encode()) % 3 == 1) for i, h in by["held_out"].items())


def test_held_out_languages_teach_nothing(documents):
    ids = [i for i in range(300) if zlib.crc32(str(i).encode()) % 3 == 1][:60]
    rows = [(i, speech("aa", i, 20), "aa") for i in ids] + [(i, speech("xx", i, 20), "xx") for i in range(1000, 1100)]
    got = identify(documents(rows)).toPandas()
    assert set(got["lang_pred"]) == {"xx"}


def test_nothing_to_learn_from(documents):
    got = identify(documents([(1, "some text", None), (2, None, "en")])).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2
    assert identify(documents([])).collect() == []


def test_families_join_similar_languages():
    rng = np.random.default_rng(0)
    north, south = rng.random(50), rng.random(50)
    got = families_of({"a": north, "b": south, "c": north + 0.05 * rng.random(50), "d": south + 0.05 * rng.random(50)})
    assert got["a"] == got["c"] != got["b"] == got["d"]


def test_svm_separates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 5))
    y = np.where(x @ np.array([1, -2, 0.5, 0, 0]) > 0.3, 1.0, -1.0)
    w = train_svm(x, y, rounds=50, penalty=10.0)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.97


def backoff(rows, min_count):
    words = {}
    for i, t in rows:
        words.setdefault(i, []).append(words_of(t))
    one, two = {}, {}
    for docs in words.values():
        for w in docs:
            for a, b in zip([None, *w], w):
                one[b] = one.get(b, 0) + 1
                two[a, b] = two.get((a, b), 0) + 1
    total = sum(one.values())
    out = {}
    for i, docs in words.items():
        logs = [math.log(one[b] / total) if a is None else math.log(two[a, b] / one[a]) if two[a, b] >= min_count else math.log(ALPHA * one[b] / total)
                for w in docs for a, b in zip([None, *w], w)]
        out[i] = (len(logs), sum(logs) if logs else None)
    return out


def test_scores_equal_the_stated_formula(documents, prose):
    rows = [(i, " ".join(prose(i, 5 + i % 90, 60))) for i in range(150)]
    rows += [(200 + i, "hot pair " * 30 + " ".join(prose(i, 3, 10**6))) for i in range(100)]  # a very common word pair
    rows += [(400, None), (401, " \n"), (402, "ÄÖ äö ÄÖ äö"), (403, "Word WORD word"), (1, "again in two rows"), (None, "no id"), (500, "very long text " * 20000)]
    for options in ({}, {"heavy_share": 0.01, "shard_words": 3000}, {"heavy_share": 0.5, "shard_words": 500}, {"min_count": 2, "shard_words": 900}):
        want = backoff(rows, options.get("min_count", 1))
        got = {r.doc_id: (r.n_words, r.log_score) for r in backoff_scores(documents(rows), **options).collect()}
        assert got.keys() == want.keys()
        for i, (n, score) in want.items():
            assert got[i][0] == n and (got[i][1] is None) == (score is None)
            assert score is None or abs(got[i][1] - score) < 1e-6 * max(1, abs(score))


def test_scores_of_an_empty_table(documents):
    assert backoff_scores(documents([])).collect() == []


def test_the_sample_of_a_hot_language_is_cut_in_the_map_tasks(spark):
    from pyspark.sql import functions as F

    from folioscope.llm.language import PART_ROWS, SAMPLE_ROWS, lowest_ids

    docs = spark.range(30000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 100 == 7, "rare").otherwise("hot").alias("lang"))
    docs = docs.unionByName(docs.filter("doc_id % 3 = 0"))  # repeated rows
    assert SAMPLE_ROWS > PART_ROWS  # else one cut would do
    got = lowest_ids(docs, SAMPLE_ROWS)
    rows = [(r.lang, r.h, r.doc_id) for r in docs.distinct().select("*", F.xxhash64("doc_id").alias("h")).collect()]
    for lang in ("hot", "rare"):
        wanted = [i for _, _, i in sorted(r for r in rows if r[0] == lang)][:SAMPLE_ROWS]
        assert sorted(r.doc_id for r in got.filter(F.col("lang") == lang).collect()) == sorted(wanted)
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()
