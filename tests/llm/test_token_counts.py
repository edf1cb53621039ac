from __future__ import annotations

import random

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from feedquality.llm import token_counts
from tests.llm.common import docs, empty

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def known():
    return token_counts.load(PATH)


@pytest.fixture(scope="module")
def count(known):
    return token_counts.counter(known)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_strings_proved_to_be_one_token_are(known, library):
    assert len(known["whole"]) > 40_000
    assert all(library(text) == 1 for text in known["whole"])


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(count, library, text):
    assert count(text) == library(text)


def test_added_tokens_inside_a_text(count, library):
    for text in ("<|endoftext|>", "a<|endoftext|>b", " <|endoftext|> ", "<|endoftext|><|endoftext|>", "<|endoftext|"):
        assert count(text) == library(text)


def test_long_pieces(count, library):
    for text in ("a" * 30_000, "-=~" * 10_000, "ab" * 5_000, "日" * 5_000):
        assert count(text) == library(text)


def test_the_two_ways_of_merging_agree(known):
    draw = random.Random(1)
    for _ in range(200):
        ids = [known["first"][b] for b in "".join(draw.choices("aeinrst ", k=150)).encode()]
        assert token_counts._merged_long(list(ids), known["merges"]) == token_counts.merged_length(ids, known["merges"])


def test_stable_characters_are_of_one_class(count, library):
    import re
    stable = re.compile(f"[{token_counts.STABLE}]")
    for code in range(0x10000):
        if not 0xD800 <= code < 0xE000 and stable.match(c := chr(code)):
            text = f"a{c}a1{c}1!{c}! {c} "
            assert count(text) == library(text), hex(code)


def test_rows(spark, library):
    frame = docs(spark)
    got = frame.select("doc_id", "text", token_counts.n_tokens(frame, PATH).alias("n")).collect()
    assert len(got) == frame.count() and all(r["n"] == library(r["text"] or "") for r in got)
    assert empty(spark).select(token_counts.n_tokens(empty(spark), PATH)).count() == 0
