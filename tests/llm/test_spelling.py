import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm.spelling import neighbours, variants, word_counts
from folioscope.llm.word_queries import op12_spelling_variants

ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def counted(rows):
    counts = {}
    for doc_id, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(word):
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in ALPHABET}
        if i < len(word):
            out.add(word[:i] + word[i + 1 :])
            out |= {word[:i] + c + word[i + 1 :] for c in ALPHABET}
    return out - {word}


def brute(words):
    form, out = {}, {}
    for w, n in words.items():
        near = sorted((x for x in one_edit(w) if x in words), key=lambda x: (-words[x], x))
        form[w] = near[0] if near and words[near[0]] >= 10 * n else None
        out[w] = len(near)
    rows = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, out[w], words[form[w]] if form[w] else None))
    return rows


def got(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def table(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


def test_random_words(spark):
    """Short alphabets make runs of equal characters, whose deletions and insertions coincide."""
    rng = random.Random(5)
    words = {}
    for _ in range(900):
        w = "".join(rng.choice("aabé") for _ in range(rng.randrange(1, 8)))
        words[w] = rng.choice([2, 3, 20, 30, 200, 2_000, 25_000, 300_000])
    assert got(variants(table(spark, words))) == brute(words)


@settings(max_examples=5, deadline=None)
@given(st.dictionaries(st.text("ab", min_size=1, max_size=5), st.integers(2, 400), min_size=1, max_size=25))
def test_any_words(spark, words):
    assert got(variants(table(spark, words))) == brute(words)


def test_long_chain_of_forms(spark):
    """Counts rise tenfold a step: 18 steps to the root."""
    words = {"a" * 7 + "b" * i: 10**i for i in range(19)}
    rows = got(variants(table(spark, words)))
    assert rows == brute(words) and {r[2] for r in rows} == {"a" * 7 + "b" * 18}


def test_ranges_are_bounded_by_the_alphabet(spark):
    words = {"aaaa" + c + "aaa": 2 for c in ALPHABET} | {"aaaaaaa": 30}
    rows = got(variants(table(spark, words)))
    assert rows == brute(words)
    assert neighbours(table(spark, words)).filter("word = 'aaaaaaa'").first()["n_near"] == len(ALPHABET)


def test_counts_over_whole_texts(spark, documents, prose):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcà×") for _ in range(rng.randrange(5, 10))) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(150)).upper() + "9Straßeİstanbul") for i in range(120)]
    rows += [(None, "Letters letters LETTERS"), (7, None), (8, ""), (9, "123 $$ !!"), (10, "longword " * 30_000), (10, "longword " * 30_000)]
    words = counted(rows)
    found = word_counts(documents(rows))
    assert {tuple(r) for r in found.collect()} == set(words.items())
    assert got(variants(found)) == brute(words)


def test_no_words(spark, documents):
    assert got(variants(word_counts(documents([])))) == set()
    assert got(variants(word_counts(documents([(1, "a b c"), (2, None)])))) == set()


def test_query_over_the_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert got(op12_spelling_variants(spark, sf_dir)) == brute(counted([tuple(r) for r in docs.collect()]))
