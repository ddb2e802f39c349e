import hashlib
import json

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from folioscope.llm import bpe
from folioscope.llm.bpe import Encoder, Vocabulary, decode, encode, merge_pieces
from folioscope.llm.token_queries import op11_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as f:
        return Encoder(f.read())


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


def check(texts, encoder, library):
    for text, packed in zip(texts, encoder.encode(texts), strict=True):
        assert ids_of(packed) == library.encode(text, add_special_tokens=False).ids, text[:80]


HARD = ["aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "abababab" * 9, "it's we'll I'd 'Tis 'S x'REx", "1234567 ½ ² Ⅷ ٣", "Straße ΑΣ ΣΣ İstanbul ǅ ﬁ",
        "é é́ 각 가", "emoji 👩‍👩‍👧 🇩🇪 ❤️", "zero​width  nbsp line\u0085next", "\x00\x1c\x1d\x1e\x1f\x7f tabs\t\t\r\n",
        "<|endoftext|>", "a<|startoftext|><|endoftext|>b", "<|endoftext", "<|ENDOFTEXT|>", "\0<|endoftext|>\0<|endoftext|>", "\0", "日本語 ไทย हिन्दी العربية",
        "Ᲊ\U00010d50Ɤ\U0001e5d0 newer letters", "_!?-—„“", " ", "x" * 5000]


def test_hard_texts(encoder, library):
    check(HARD, encoder, library)
    check([a + " " + b for a in HARD for b in HARD], encoder, library)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(encoder, library, text):
    check([text], encoder, library)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abcdeinorst'é1 ", max_size=40), max_size=20))
def test_slices_of_texts(encoder, library, texts):
    check(texts, encoder, library)


def test_every_character(encoder, library):
    """Each code point beside letters, digits and signs: 1.1 million characters in texts of 500."""
    chars = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}1{c}!{c} " for c in chars[i : i + 500]) for i in range(0, len(chars), 500)]
    check(texts, encoder, library)


def test_index_equals_one_piece_at_a_time(encoder, library):
    vocabulary = encoder.vocabulary
    pieces = [b"the", b"abababab", b"aaaaaaa", b"x", "été".encode(), b"internationalization"]
    assert merge_pieces(pieces, vocabulary) == [merge_pieces([p], vocabulary)[0] for p in pieces]


def test_small_cache(library, encoder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    for text in HARD:
        check([text], encoder, library)


def test_ranks_must_rise(encoder):
    spec = json.loads(encoder.vocabulary.source)
    spec["model"]["merges"].reverse()
    with pytest.raises(ValueError, match="ranks before"):
        Vocabulary(json.dumps(spec))


def expected(library, rows):
    out = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        out.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_tables(spark, documents, library, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE_BYTES", 400)
    rows = [*enumerate(HARD), (None, "no id"), (3, None), (3, None), (4, ""), (5, "Long text, " * 40_000)]
    docs = documents(rows)
    tokens = decode(encode(docs, PATH), PATH)
    assert tokens.columns == [*docs.columns, "ids", "decoded"]
    found = [(r["doc_id"], r["text"], ids_of(r["ids"]), r["decoded"]) for r in tokens.collect()]
    want = [(i, t, (e := library.encode(t or "", add_special_tokens=False).ids), library.decode(e, skip_special_tokens=False)) for i, t in rows]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_clashing_and_empty_tables(spark, documents):
    docs = documents([(1, "a b")]).selectExpr("*", "'x' AS IDS", "1 AS decoded")
    tokens = decode(encode(docs, PATH), PATH)
    assert [c for c in tokens.columns if c.lower() == "ids"] == ["ids"] and tokens.first()["decoded"] == "a</w> b</w>"
    assert decode(encode(documents([]), PATH), PATH).collect() == []


def test_unknown_ids_are_left_out(spark):
    df = spark.createDataFrame([(np.array([320, 99_999], "<u4").tobytes(),), (None,)], "ids binary")
    assert [r["decoded"] for r in decode(df, PATH).collect()] == ["a</w>", ""]


def test_query_over_the_whole_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert sorted((tuple(r) for r in op11_bpe(spark, sf_dir).collect()), key=repr) == expected(library, [tuple(r) for r in docs])
