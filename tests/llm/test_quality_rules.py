from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from feedquality.llm import quality_rules as q
from tests.llm.common import docs, empty, sentence, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(i, i + 3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit))


def test_base_counts():
    draw = random.Random(2)
    for _ in range(500):
        text = "".join(draw.choices("ab  \n\t\x0b#|é  \x1c", k=draw.randint(0, 60)))
        assert q.signals(text)[:5] == brute(text)
    for text in ("a " * 5000, "日本 " * 60, sentence(3000), "x\n" * 100):
        assert q.signals(text)[:5] == brute(text)



def test_many_distinct_words_keep_exact_windows():
    n = (1 << 20) + 5
    ids = np.concatenate([np.arange(n), [4, 5, 6], [9, 8]])
    assert q.repeated_words(ids) == 6


def test_accuracies_are_recovered():
    rng = np.random.default_rng(0)
    n, right = 40_000, np.linspace(0.6, 0.95, len(q.RULES))
    good = rng.random(n) < 0.7
    agrees = rng.random((n, len(q.RULES))) < right
    votes = np.where(agrees == good[:, None], 1, 2) * (rng.random((n, len(q.RULES))) < 0.8)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = q.estimate(patterns, counts.astype(float))
    assert abs(model.prior - 0.7) < 0.03
    assert np.abs(np.array(model.accuracies) - right).max() < 0.04


def test_without_votes_the_start_is_kept():
    model = q.estimate(np.zeros((0, len(q.RULES)), int), np.zeros(0))
    assert model.prior == q.PRIOR and np.allclose(model.accuracies, (q.RIGHT_ON_GOOD + q.RIGHT_ON_BAD) / 2)


def corpus():
    clean = [sentence(120, s).replace("x", "") + "." for s in range(300)]
    clean = [" ".join(w if i % 4 else "of" + w[:0] for i, w in enumerate(t.split())) + f" it was {k}" for k, t in enumerate(clean)]
    junk = ["### " + " ".join(w + "$$$" for w in sentence(80, 400 + s).split()) for s in range(60)]
    return clean, junk


def test_junk_goes_and_clean_text_stays(spark):
    clean, junk = corpus()
    frame = texts(spark, *clean, *junk, "too short", None)
    kept = {r["doc_id"] for r in q.filter_quality(frame).collect()}
    assert not kept & set(range(len(clean), len(clean) + len(junk) + 2))
    assert kept >= set(range(len(clean)))


def test_rows(spark):
    frame = docs(spark)
    facts = q.with_signals(frame, ["doc_id"])
    got = q.judged(facts, q.fit_rules(facts)).collect()
    expected = Counter((r["doc_id"], *brute(r["text"])) for r in frame.select("doc_id", "text").collect())
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
                   for r in got) == expected
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert q.filter_quality(frame).columns == frame.columns
    assert q.filter_quality(empty(spark)).count() == 0


def test_junk_goes_from_a_small_corpus_too(spark):
    clean, junk = corpus()
    clean, junk = clean[:60], ["### " + " ".join(w + "$$$" for w in sentence(80, 100 + s).split()) for s in range(12)]
    kept = {r["doc_id"] for r in q.filter_quality(texts(spark, *clean, *junk, "too short", None)).collect()}
    assert kept == set(range(len(clean)))
