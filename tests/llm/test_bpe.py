import hashlib
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from deidflow.llm import bpe

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def model():
    return bpe.Model.load(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def encoder(model):
    return bpe.Encoder(model, bpe.Transducer(bpe.compile_lexicon(model.whole_words())))


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(bpe.default_vocabulary())


TEXTS = ["", "it's DON'T", "İI ΣΑΣ ǅ ² ٣ é \x1c x\x1dy \x85z", "<|endoftext|> a<|startoftext|>b <|", "日本語 テスト 한국어", "a\x00b \x0b\x0c", "½ Ⅷ ➀ 𝟘 😀👍🏽", "’s ''s 's'tx", "q ​ k﻿ w"]


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.sampled_from(TEXTS), st.text(max_size=60), st.text(alphabet="abcdefgh'é .,!1", max_size=80)))
def test_equals_the_library(encoder, library, text):
    if any(unicodedata.category(c) in ("Cs", "Cn") for c in text):  # surrogates, and what this Unicode version does not know
        return
    want = library.encode(text, add_special_tokens=False).ids
    assert encoder.ids(text) == want and encoder.decode(want) == library.decode(want, skip_special_tokens=False)


def test_the_automaton_is_minimal_and_exact(model):
    entries = dict(model.whole_words())
    lexicon = bpe.Transducer(bpe.compile_lexicon(entries.items()))
    assert all(lexicon.get(w) == ids for w, ids in entries.items())
    assert lexicon.get(b"") is None and lexicon.get(b"zzqj") is None and lexicon.n_arcs < 0.3 * sum(map(len, entries))
    small = bpe.Transducer(bpe.compile_lexicon([(b"tap", [1]), (b"taps", [2]), (b"top", [3, 4]), (b"tops", [])]))
    assert small.n_arcs == 5 and [small.rank(w) for w in (b"tap", b"taps", b"top", b"tops", b"ta")] == [0, 1, 2, 3, -1]  # t, then a and o, then p and s shared


def test_table(spark, library):
    texts = [None, "", "plain words here", "plain words here", "long " * 20000, *TEXTS]
    df = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    out = bpe.encode(df)
    decoded = {r.doc_id: r.text for r in bpe.decode(out).collect()}
    for r in out.collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (r.token_ids, r.n_tokens, decoded[r.doc_id]) == (ids, len(ids), text)
        assert (r.ids_sha256, r.decoded_sha256) == (hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert bpe.encode(df.limit(0)).count() == 0


@pytest.mark.parametrize("word", ["abcdefghijklmnopqrstuvwxyz" * 200, "the" * 3000, "a" * 5000, "日本語の文字" * 700, "0123456789" * 30, "é" * 99, "Zq" * 25, "!?" * 400])
def test_long_words_equal_the_library(encoder, library, word):
    assert encoder.ids(word) == library.encode(word, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abeinrst", min_size=40, max_size=300))
def test_the_heap_merges_as_the_plain_loop(model, text):
    short, bpe.SHORT = bpe.SHORT, 10_000
    plain = model.merge(text.encode())
    bpe.SHORT = short
    assert model.merge(text.encode()) == plain


def test_a_word_of_200_000_letters_is_quick(encoder):
    import time

    start = time.time()
    assert len(encoder.ids("qwertyuiopasdfgh" * 12_500)) > 10_000 and time.time() - start < 15


def test_frequent_words_are_counted_and_change_nothing(spark):
    texts = ["alphaomega Zq7 alphaomega", "ALPHAOMEGA betaomega it's", "betaomega x\ny alphaomega", None, "", "É É É"]
    df = spark.createDataFrame([(k, t, "w", 1) for k, t in enumerate(texts)], "doc_id long, text string, word string, n int")
    assert bpe.frequent_words(df) == ["alphaomega", "betaomega"] and bpe.frequent_words(df, 1) == ["alphaomega"] and bpe.frequent_words(df, 0) == [] and bpe.frequent_words(df.limit(0)) == []
    with_, without = (sorted(tuple(r) for r in bpe.encode(df, frequent=f, ids=False).collect()) for f in (None, ()))
    assert with_ == without
