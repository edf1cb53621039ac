from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from feedquality.llm import bpe
from tests.llm.common import docs, empty

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(PATH)


@pytest.fixture(scope="module")
def encoder(ranks):
    return bpe.Encoder(ranks, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text_is_encoded_as_the_library_does(encoder, library, text):
    assert ids(encoder, text) == library.encode_ordinary(text)
    assert encoder.decode(encoder.encode(text)) == text.encode()


def test_strings_of_tokens_and_of_few_letters(encoder, library):
    draw = random.Random(5)
    tokens = list(encoder.token.values())
    for _ in range(1500):
        text = b"".join(draw.choices(tokens, k=12)).decode("utf-8", "ignore")
        assert ids(encoder, text) == library.encode_ordinary(text)
        text = "".join(draw.choices("aab= -é\n", k=60))
        assert ids(encoder, text) == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 50_000, "the" * 20_000, "=-" * 20_000, "é" * 20_000])
def test_long_pieces(encoder, library, text):
    assert ids(encoder, text) == library.encode_ordinary(text)


def test_every_token_merges_to_itself(encoder):
    assert all(encoder.edge(rank) is not None for rank in encoder.token)


def test_a_token_that_does_not_merge_is_only_taken_whole():
    ranks = {b"a": 0, b"b": 1, b"c": 2, b"ab": 3, b"abc": 4, b"cab": 5}  # cab: c + ab, abc: ab + c
    broken = ranks | {b"bca": 6}  # no two tokens make it
    encoder = bpe.Encoder(broken, r"[a-z]+")
    assert encoder.edge(6) is None
    library = tiktoken.Encoding("t", pat_str=r"[a-z]+", mergeable_ranks=broken | {bytes([i]): 100 + i for i in range(256) if bytes([i]) not in broken}, special_tokens={})
    for text in ("bca", "bcab", "abca", "abcab", "cabcab", "bcabca", "abab", "ccab"):
        assert ids(encoder, text) == library.encode_ordinary(text)


def test_what_is_forgotten_changes_nothing(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    text = "several words, of which few are remembered: several unrememberable words"
    assert ids(encoder, text) == library.encode_ordinary(text)


def test_rows(spark, library):
    frame = docs(spark)
    got = bpe.encode_digests(frame).collect()
    expected = []
    for row in frame.select("doc_id", "text").collect():
        tokens = library.encode_ordinary(row["text"] or "")
        expected.append((row["doc_id"], len(tokens), hashlib.sha256(np.array(tokens, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256((row["text"] or "").encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    assert bpe.encode_digests(empty(spark)).count() == 0


def test_ids_are_decoded(spark):
    frame = docs(spark)
    struct = bpe.encoded(frame, PATH, public_tokenizers.PATTERN)
    coded = frame.select("text", struct.alias("e"))
    back = coded.select("text", bpe.decoded(coded, PATH, coded["e.ids"]).alias("raw")).collect()
    assert all(bytes(r["raw"]) == (r["text"] or "").encode() for r in back)
