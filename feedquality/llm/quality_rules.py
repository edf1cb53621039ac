"""Weak supervision: rules vote or abstain, and a posterior replaces all-must-pass filtering.

Each rule looks at one statistic of a whole text and votes that the text is good, votes
that it is bad, or abstains. No rule is trusted beforehand: expectation-maximisation over
the vote patterns of all documents estimates how often each rule is right, and a text's
posterior probability of being good combines its votes by those accuracies. What leaves
Spark for the estimate is one count per pattern, of which there are at most
``3 ** len(RULES)`` however many documents there are.

Null and empty texts have no words and fail the base. Rows are judged one by one, so
repeated rows and clashing extra columns do not matter; an empty table gives an empty
result, judged by the starting accuracies.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedquality.llm.text import per_text, read
from feedquality.session import stage

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Fewer words than this, or more than this share of repeated words (in per cent), fail outright.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


@dataclass(frozen=True)
class VotingRule:
    """Votes bad where the statistic reaches ``bad``, good where it stays at ``good`` or below."""

    name: str
    statistic: str
    good: float
    bad: float
    higher_is_worse: bool = True

    def vote(self) -> Column:
        """1 good, 2 bad, 0 abstain (also where the statistic is null)."""
        value = F.col(self.statistic)
        is_bad, is_good = ((value >= self.bad, value <= self.good) if self.higher_is_worse
                           else (value <= self.bad, value >= self.good))
        return F.when(is_bad, 2).when(is_good, 1).otherwise(0)


#: Shares are of words, letters or lines as their names say.
RULES = (
    VotingRule("symbols", "symbols_per_word", 0.02, 0.10),
    VotingRule("repeated_windows", "repeat_share", 0.10, 0.30),
    VotingRule("repeated_lines", "dup_line_share", 0.05, 0.30),
    VotingRule("capitals", "upper_share", 0.12, 0.40),
    VotingRule("letters", "alpha_share", 0.80, 0.60, higher_is_worse=False),
    VotingRule("commonest_word", "top_word_share", 0.12, 0.25),
    VotingRule("word_length", "length_off", 0.0, 4.0),
    VotingRule("shouting", "bang_share", 0.02, 0.20),
    VotingRule("plain_words", "plain_share", 0.80, 0.60, higher_is_worse=False),
    VotingRule("short_words", "short_share", 0.15, 0.06, higher_is_worse=False),
)

SIGNALS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()), T.StructField("symbols_per_word", T.DoubleType()),
    T.StructField("repeat_share", T.DoubleType()), T.StructField("dup_line_share", T.DoubleType()),
    T.StructField("upper_share", T.DoubleType()), T.StructField("alpha_share", T.DoubleType()),
    T.StructField("top_word_share", T.DoubleType()), T.StructField("length_off", T.DoubleType()),
    T.StructField("bang_share", T.DoubleType()), T.StructField("plain_share", T.DoubleType()),
    T.StructField("short_share", T.DoubleType()),
])

LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(0x80, 0x100))


def repeated_words(ids: np.ndarray) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(ids)
    if n < 4:
        return 0
    # exact keys: pairs are numbered anew before the third word is added
    width = int(ids.max()) + 1
    pairs = ids[:-1] * width + ids[1:]
    if width >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs[:-1] * width + ids[2:]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(n, bool)
    for shift in range(3):
        hit[shift:n - 2 + shift] |= twice
    return int(hit.sum())


def signals(text: str) -> tuple:
    """The base counts of a text and the statistics that the rules look at."""
    raw = text.encode()
    words = raw.split()  # bytes split at the six ASCII blanks, and at nothing else
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    dup_lines = len(lines) - len(set(lines))
    if not n:
        return (0, 0, symbols, dup_lines, 0) + (None,) * 10
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    repeat = repeated_words(ids)
    codes = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = int(codes[65:91].sum()), int(codes[97:123].sum())
    wide = int(codes[0xC0:].sum())  # lead bytes: characters outside ASCII, taken as letters
    length = chars / n
    times = np.bincount(ids)
    plain = np.fromiter((not w.rstrip(b".,;:?").translate(None, LETTERS) for w in numbers), bool, len(numbers))
    short = plain & np.fromiter((len(w) <= 3 for w in numbers), bool, len(numbers))
    return (n, chars, symbols, dup_lines, repeat, symbols / n, repeat / n, dup_lines / len(lines),
            upper / (upper + lower) if upper + lower else None, (upper + lower + wide) / chars,
            int(times.max()) / n if n >= 20 else None,
            max(0.0, 2.5 - length, length - 12.0), int(codes[33]) / n,
            int(times[plain].sum()) / n, int(times[short].sum()) / n)


def with_signals(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` of the documents, the base counts and the rules' statistics."""
    return docs.select(*keep, per_text(docs, F.col("text"), lambda: signals, SIGNALS).alias("__s")).select(
        *keep, "__s.*")


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def votes() -> Column:
    """All votes as one number, base 3, the first rule in the last place."""
    code = F.lit(0)
    for i, rule in enumerate(RULES):
        code = code + rule.vote() * 3 ** i
    return code


@dataclass(frozen=True)
class RuleModel:
    """``prior`` of good and ``odds[rule][vote]``, the log odds that a vote adds."""

    prior: float
    odds: tuple[tuple[float, float, float], ...]
    accuracies: tuple[float, ...]

    def posterior(self) -> Column:
        """The probability that a text is good, given its votes."""
        total = F.lit(float(np.log(self.prior / (1 - self.prior))))
        for rule, (none, good, bad) in zip(RULES, self.odds, strict=True):
            vote = rule.vote()
            total = total + F.when(vote == 1, good).when(vote == 2, bad).otherwise(none)
        return 1 / (1 + F.exp(-total))


#: Where the estimate starts, and what added counts hold it to where there are few votes: a
#: rule seldom votes against a good text, and it finds its own kind of bad text only.
RIGHT_ON_GOOD, RIGHT_ON_BAD, PRIOR, ADDED = 0.98, 0.3, 0.8, 10


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> RuleModel:
    """Expectation-maximisation over vote patterns (``patterns[p, rule]`` in 0, 1, 2).

    An abstention tells nothing by itself, so only votes are modelled: how often a rule is
    right on good texts, and how often on bad ones. A rule may turn out useless, but its
    votes don't come to mean the opposite.
    """
    n_rules = len(RULES)
    right = np.repeat([[RIGHT_ON_GOOD], [RIGHT_ON_BAD]], n_rules, axis=1)
    start, prior = right.copy(), PRIOR
    good_vote, bad_vote = (patterns == 1).astype(float), (patterns == 2).astype(float)
    for _ in range(rounds):
        odds = (np.log(prior / (1 - prior)) + good_vote @ np.log(right[0] / (1 - right[1]))
                - bad_vote @ np.log(right[1] / (1 - right[0])))
        good = counts / (1 + np.exp(-odds))
        bad = counts - good
        cast = good_vote + bad_vote
        new_right = np.vstack([(good @ good_vote + ADDED * start[0]) / (good @ cast + ADDED),
                               (bad @ bad_vote + ADDED * start[1]) / (bad @ cast + ADDED)]).clip(0.001, 0.999)
        new_right[1] = np.maximum(new_right[1], 1 - new_right[0])
        new_prior = float(np.clip((good.sum() + ADDED * PRIOR) / (counts.sum() + ADDED), 0.01, 0.99))
        moved = max(abs(new_right - right).max(), abs(new_prior - prior))
        right, prior = new_right, new_prior
        if moved < 1e-9:
            break
    odds = tuple((0.0, float(np.log(right[0, j] / (1 - right[1, j]))), float(-np.log(right[1, j] / (1 - right[0, j]))))
                 for j in range(n_rules))
    return RuleModel(prior, odds, tuple(map(float, right.mean(axis=0))))


def fit_rules(with_statistics: DataFrame) -> RuleModel:
    """Estimate the rules' accuracies from the votes on all documents that pass the base."""
    rows = (with_statistics.filter(~base_failed()).groupBy(votes().alias("code"))
            .agg(F.count(F.lit(1)).alias("n")).collect())  # at most 3 ** len(RULES) rows
    rows = sorted((r["code"], r["n"]) for r in rows)
    codes = np.array([c for c, _ in rows], np.int64)
    patterns = (codes[:, None] // 3 ** np.arange(len(RULES))) % 3
    return estimate(patterns, np.array([n for _, n in rows], float))


def judged(with_statistics: DataFrame, model: RuleModel, threshold: float = 0.5) -> DataFrame:
    """Adds ``base_failed``, ``p_good`` (the posterior) and ``kept``."""
    return (with_statistics.withColumn("base_failed", base_failed())
            .withColumn("p_good", model.posterior())
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold)))


def filter_quality(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that are kept, with their own columns.

    The statistics are computed once for the estimate and once for the filter, which
    costs less than moving the texts to stored statistics.
    """
    model = fit_rules(with_signals(docs, []))
    struct = per_text(docs, F.col("text"), lambda: signals, SIGNALS)
    columns = [docs[c] for c in docs.columns]
    return (docs.select(F.struct(*columns).alias("__doc"), struct.alias("__s")).select("__doc", "__s.*")
            .transform(lambda df: judged(df, model, threshold)).filter("kept").select("__doc.*"))


def op9_quality_rules(spark, sf):
    facts = stage(with_signals(read(spark, sf, "documents"), ["doc_id"]), "signals")
    return judged(facts, fit_rules(facts)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")
