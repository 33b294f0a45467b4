import hashlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import bpe, tokens
from siltstone.llm.words import words

WORD = P.path("word_bpe_49k.json")
RANKS = P.path("byte_bpe_multi_50k.tiktoken")
ODD = ["", None, " ", "Hello, it's the <|endoftext|> end<|startoftext|>", "Ünḯcode x y ﬁ Σς İ", "a" * 3000, "x\x1cy \x85z", "'s't 're \t\n\r\x0b\x0c", "日本語 テキスト", "1234 ½ ²³", "é ́", "😀😀 ok"]


def direct(text):
    return len(tokens._library(WORD).encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=40), max_size=6))
def test_counts_by_words_equal_the_library(texts):
    got = tokens._batch_counts(pa.array(texts, pa.string()), WORD, tokens._EMPTY)
    assert got.tolist() == [direct(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab é1.'s \n\t  !\x1c"), max_size=60), st.integers(1, 9))
def test_safe_boundaries(text, size):
    assert "".join(bpe.pieces(text, size)) == text
    assert bpe.encode(text, RANKS, P.PATTERN, size) == bpe.encoding(RANKS, P.PATTERN).encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab é1.'s \n\t\r\x1c\x1f\x85\xa0\u2003\u3000"), max_size=60), st.integers(1, 9), st.integers(1, 6))
def test_white_runs_are_single_matches(text, size, blank):
    assert "".join(part for part, _ in bpe.stretches(text, blank)) == text
    assert bpe.encode(text, RANKS, P.PATTERN, size, blank) == bpe.encoding(RANKS, P.PATTERN).encode_ordinary(text)


def test_very_long_runs(spark):
    runs = [" " * 1_000_000, "\n" * 3_000_000, "\r\n \t" * 500_000, "a" + " " * 10_000_000 + "b", "x\n\n" + "\u3000" * 400_000 + " y" + "\n" * 1_200_000, "!" * 3_000_000, "é" * 3_000_000]
    docs = spark.createDataFrame(list(enumerate(runs)), "doc_id long, text string")
    got = {r.doc_id: r for r in bpe.encode_digests(docs, RANKS, P.PATTERN).collect()}
    for i, t in enumerate(runs):
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    code = bpe.encoding(RANKS, P.PATTERN)
    short = [t[: len(t) // 2] + t[len(t) // 2 :].replace(" " * 100_000, "") for t in ("a" + " " * 300_000 + "b", "\n" * 300_000 + "c", " " * 300_000)]
    assert all(bpe.encode(t, RANKS, P.PATTERN) == code.encode_ordinary(t) for t in short)


def test_word_hashes_agree_across_slices(monkeypatch):
    import siltstone.llm.words as w

    text = "Alpha beta  gamma " * 40 + "x" * 90
    whole = [b for b in words(pa.array([text, None, "beta"]), lower=True)]
    monkeypatch.setattr(w, "SLICE", 50)
    cut = [b for b in words(pa.array([text, None, "beta"]), lower=True)]
    assert np.array_equal(np.concatenate([b.hash for b in whole]), np.concatenate([b.hash for b in cut]))
    assert len(np.unique(np.concatenate([b.hash for b in whole]))) == 4


def test_count_tokens_rows(spark):
    rows = [(i, t, 1) for i, t in enumerate(ODD * 2)] + [(None, "the end", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = {(r.doc_id): r for r in tokens.count_tokens(docs, WORD).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        assert (got[i].n_bytes, got[i].n_tokens) == (len((t or "").encode()), direct(t))
    assert tokens.count_tokens(docs.limit(0), WORD).count() == 0


def test_bpe_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate([*ODD, "word " * 40000, "é" * 70000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe.encode_digests(docs, RANKS, P.PATTERN).collect()}
    full = {r.doc_id: r for r in bpe.encode_documents(docs, RANKS, P.PATTERN).collect()}
    for i, t, _ in rows:
        ids = bpe.encoding(RANKS, P.PATTERN).encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids) and full[i].ids == ids and bytes(full[i].decoded) == (t or "").encode()
        assert got[i].ids_sha256 == hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encode_digests(docs.limit(0), RANKS, P.PATTERN).count() == 0
