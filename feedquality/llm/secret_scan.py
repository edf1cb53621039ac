"""Secret scan: patterns, and the guess cost of values that stand where credentials stand.

Three patterns give the base spans. Beyond them, each value that follows a credential word
is judged by what it would cost to guess it: the cheapest way to put it together from
common words, dates, repeats, keyboard walks and brute force, found by dynamic programming
over its characters, in which spans of every kind end at every place. A value of ``MIN_COST``
or more (the decimal logarithm of the number of guesses) is a secret; ``password=changeme`` or
``token=qwerty2020`` is not. A value in the form of an address (URL, e-mail, path) or of words
joined by dashes is worth as much as the dearest of its parts.

Common words are a short fixed list and then those of the corpus, by their counts outside
of such values: one aggregation, of which the ``CORPUS_WORDS`` most frequent travel as a broadcast.

Positions are code points, ends exclusive. Texts are scanned whole, one at a time; null
counts as empty and has no spans. Apart from the words' counts rows are independent, so repeated
rows, clashing extra columns and empty tables need no care. The time is linear in the text,
and in each value.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedquality.llm.text import per_text, read
from feedquality.session import stage

# The base patterns.
KINDS = ("assign", "access", "hex", "guess")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LENGTH, ACCESS, HEX = 6, r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"

#: Where credentials stand: a wider set of words, and any value up to a blank, quote or bracket.
CONTEXT = (r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private)[_-]?key|auth(?:orization)?"""
           r"""|credentials?|login)["']?(?:\x20*(?:=>|[:=])\x20*|\x20is\x20)["']?([^\s"'<>(){}\[\],;]{4,})""")
#: A text without any of these, in either case, holds no match of ASSIGN or CONTEXT.
MARKS = ("pass", "pwd", "secret", "token", "key", "auth", "credential", "login")

#: Decimal logarithm of the guesses from which a value is a secret.
MIN_COST = 11.0

#: Common words of passwords, the commonest first: a word's rank is its number of guesses.
WORDS = (
    "password", "admin", "welcome", "login", "letmein", "monkey", "dragon", "master", "sunshine", "princess",
    "football", "baseball", "shadow", "superman", "batman", "trustno", "iloveyou", "hello", "freedom", "whatever",
    "secret", "token", "changeme", "default", "example", "sample", "test", "testing", "demo", "guest", "user",
    "username", "root", "server", "service", "system", "public", "private", "access", "api", "key", "auth", "client",
    "none", "null", "true", "false", "your", "my", "the", "this", "here", "value", "string", "placeholder", "redacted",
    "hidden", "summer", "winter", "spring", "autumn", "monday", "friday", "sunday", "january", "march", "april",
    "june", "july", "august", "october", "december", "love", "god", "money", "angel", "flower", "hunter", "ranger",
    "soccer", "hockey", "ginger", "pepper", "cookie", "banana", "orange", "apple", "purple", "silver", "golden",
    "michael", "jordan", "charlie", "thomas", "robert", "daniel", "jessica", "ashley", "george", "andrew", "computer",
    "internet", "google", "mobile", "phone", "office", "company", "database", "temp", "pass", "word", "pwd",
    "and", "you", "that", "was", "for", "are", "with", "his", "they", "one", "have", "from", "had", "not", "but", "what",
    "all", "were", "when", "can", "said", "there", "use", "each", "which", "she", "how", "their", "will", "other",
    "about", "out", "many", "then", "them", "these", "some", "would", "make", "like", "into", "time", "more", "number",
    "people", "first", "now", "find", "long", "get", "made", "part", "should", "never", "share", "something")
#: Words of the corpus that are taken, of so many letters, and how often one has to occur.
CORPUS_WORDS, WORD_LETTERS, WORD_COUNT = 20_000, (3, 20), 10
#: Steps of counts to each doubling: words of a step are taken together or not at all.
LEVELS = 8
KEYBOARD = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")

#: Cost of choosing what kind of part comes next.
PART = math.log10(5)
SEPARATORS = "-_. "
#: Longest unit of a repeat, and the cost of the number of its copies, or of keys in a walk, whatever it is.
UNIT, COUNT = 12, 1.0
#: A year, and the orders of year, month and day, each with its cost.
YEAR, MONTH, DAY = r"(?:19|20)\d\d", r"(?:0[1-9]|1[0-2])", r"(?:0[1-9]|[12]\d|3[01])"
DATES = [(re.compile(YEAR), 2.1)] + [
    (re.compile(f"{a}([-/_.]?){b}\\1{c}"), 4.9) for a, b, c in ((YEAR, MONTH, DAY), (DAY, MONTH, YEAR), (MONTH, DAY, YEAR))]

#: Forms of values that are put together from parts: an address, a path, words with dashes. And what parts them.
ADDRESS = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://\S+|[^\s@/]+@[^\s@/]+\.[A-Za-z]{2,}|[.~]{0,2}(?:/[^\s/]+){2,}/?"
                     r"|[A-Za-z]:\\\S+|[A-Za-z]+(?:[-_][A-Za-z]+){2,}")
PARTED = re.compile(r"[^A-Za-z0-9$!*%^+~]+")


def key_steps() -> dict[tuple[str, str], int]:
    """The direction from each key to each key beside it; a row stands half a key right of the row above it."""
    ways = ((0, -1), (0, 1), (-1, 0), (-1, 1), (1, -1), (1, 0))
    at = {(r, k): key for r, row in enumerate(KEYBOARD) for k, key in enumerate(row)}
    return {(key, at[r + i, k + j]): way for (r, k), key in at.items() for way, (i, j) in enumerate(ways) if (r + i, k + j) in at}


def brute_cost(c: str) -> float:
    return 1.0 if c.isdigit() else math.log10(26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 100)


def word_cost(word: str, rank: float) -> float:
    """Of a word as it is written, with its capitals; ``rank`` is the logarithm of its rank."""
    capitals = sum(c.isupper() for c in word)
    return rank if not capitals else rank + math.log10(2 if capitals in (1, len(word)) else 2 ** min(len(word), 20))


def guess_cost(words: Sequence[str] = WORDS) -> Callable[[str], float]:
    """A function that gives the decimal logarithm of the guesses that a value takes.

    ``words`` are common ones, the commonest first. For each place the cheapest way to get there is
    kept, and the cheapest one whose last span may go on: a run of brute force by a character, a
    repeat by a copy of its unit, a walk by a key. So spans of all lengths are compared.
    """
    ranks: dict[str, float] = {}
    for i, w in enumerate(words):
        ranks.setdefault(w, math.log10(i + 1))
    longest = max(map(len, ranks), default=0)
    steps = key_steps()
    walk_start, walk_turn = math.log10(sum(map(len, KEYBOARD))), math.log10(6)

    def cost(value: str) -> float:
        n = len(value)
        low = value.lower()
        if len(low) != n:  # a letter whose small form is longer
            low = value
        dates: dict[int, list[tuple[int, float]]] = {}
        for i in range(n):
            if low[i].isdigit():
                for pattern, price in DATES:
                    if m := pattern.match(low, i):
                        dates.setdefault(m.end(), []).append((i, price))
        best, run, walk = [0.0] + [math.inf] * n, [math.inf] * (n + 1), [math.inf] * (n + 1)
        copies = [[math.inf] * (n + 1) for _ in range(min(UNIT, n // 2) + 1)]
        way = -1
        for j in range(1, n + 1):
            i = j - 1
            price = brute_cost(value[i])
            # a separator between spans is no span of its own
            run[j] = min(run[i] + price, best[i] + (0.5 if value[i] in SEPARATORS else PART + price))
            least = run[j]
            for k in range(max(0, j - longest), j):
                rank = ranks.get(low[k:j])
                if rank is not None:
                    least = min(least, best[k] + PART + word_cost(value[k:j], rank))
            for k, price in dates.get(j, ()):
                least = min(least, best[k] + PART + price)
            for unit in range(1, min(UNIT, j // 2) + 1):
                piece = value[j - unit:j]
                if piece == value[j - 2 * unit:j - unit]:
                    more = copies[unit][j - unit]
                    copies[unit][j] = min(more, best[j - 2 * unit] + PART + COUNT + known(piece))
                    least = min(least, more if unit == 1 else copies[unit][j])  # two equal characters are no repeat
            before, way = way, steps.get((low[i - 1], low[i]), -1) if i else -1
            if way >= 0:
                more = walk[i] + (0.0 if way == before else walk_turn)  # from three keys on
                walk[j] = min(more, best[j - 2] + PART + COUNT + walk_start + walk_turn)
                least = min(least, more)
            best[j] = least
        return best[n]

    known = lru_cache(maxsize=10_000)(cost)
    return cost


def value_cost(words: Sequence[str] = WORDS) -> Callable[[str], float]:
    """The same for a whole value: an address, a path or words with dashes cost what their dearest part does."""
    cost = guess_cost(words)
    return lambda value: (max(map(cost, PARTED.split(value))) if ADDRESS.fullmatch(value) else cost(value))


def scanner(min_cost: float = MIN_COST, words: Sequence[str] = WORDS) -> Callable[[str], list[tuple[int, int, int]]]:
    """A function that gives a text's spans as (start, kind's number, end), sorted."""
    flags = re.ASCII | re.IGNORECASE  # ASCII: only A-Z and a-z are alike
    assign, context = re.compile(ASSIGN, flags), re.compile(CONTEXT, flags)
    access, hexes = re.compile(ACCESS), re.compile(HEX)
    cost = value_cost(words)

    def marked(text: str) -> Iterator[tuple[int, int, int]]:
        for m in assign.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LENGTH:
                yield m.start(), 0, m.end()
        for m in context.finditer(text):
            value = m.group(1).rstrip(".,:!?")
            if value and cost(value) >= min_cost:
                yield m.start(1), 3, m.start(1) + len(value)

    def scan(text: str) -> list[tuple[int, int, int]]:
        low = text.lower()
        spans = list(marked(text)) if any(mark in low for mark in MARKS) else []
        if "AKIA" in text:
            spans += [(m.start(), 1, m.end()) for m in access.finditer(text)]
        spans += [(m.start(), 2, m.end()) for m in hexes.finditer(text)]
        return sorted(spans)

    return scan


FOUND = T.StructType([T.StructField("spans", T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
DIGEST = T.StructType([
    T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()),
    T.StructField("n_hex", T.LongType()), T.StructField("base_sha256", T.StringType()),
    T.StructField("spans", T.StringType()),
])


def common_words(docs: DataFrame, text: Column | None = None, limit: int = CORPUS_WORDS) -> Broadcast:
    """The fixed words and then the most frequent ones of the corpus, from all texts without the values that follow
    credential words. Counted in each task before the shuffle; ``limit`` words at most come to the driver."""
    least, most = WORD_LETTERS
    plain = F.regexp_replace(F.lower(F.col("text") if text is None else text), CONTEXT, " ")
    words = docs.select(F.explode(F.regexp_extract_all(plain, F.lit(f"(?<![a-z])[a-z]{{{least},{most}}}(?![a-z])"), 0)).alias("word"))
    counts = stage(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= WORD_COUNT)
                   .withColumn("level", F.floor(F.log2("n") * LEVELS)), "word-counts")
    # a few hundred levels, whatever the input; those from the top that come to no more than the limit
    taken, least = 0, None
    for row in sorted(counts.groupBy("level").count().collect(), reverse=True):
        taken += row["count"]
        if taken > limit:
            break
        least = row["level"]
    top = [] if least is None else counts.filter(F.col("level") >= least).select("word", "n").collect()
    top.sort(key=lambda row: (-row["n"], row["word"]))
    return docs.sparkSession.sparkContext.broadcast({"words": (*WORDS, *(row["word"] for row in top))})


def _per_text(docs: DataFrame, words: Broadcast | None, row: Callable[[Callable, str], tuple], schema: T.StructType,
              text: Column | None = None) -> Column:
    def make() -> Callable[[str], tuple]:
        if words is None:
            scan = scanner()
        else:
            held = words.value  # stays with the worker
            scan = held["scan"] = held.get("scan") or scanner(words=held["words"])
        return lambda value: row(scan, value)
    return per_text(docs, F.col("text") if text is None else text, make, schema)


def secrets(docs: DataFrame, text: Column | None = None, words: Broadcast | None = None) -> Column:
    """The spans of each text, as an array of (kind, start, end); ``words`` are those of :func:`common_words`."""
    def row(scan: Callable, value: str) -> tuple:
        return ([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scan(value)],)
    return _per_text(docs, words, row, FOUND, text)["spans"]


def redacted(docs: DataFrame, mark: str = "[secret]", words: Broadcast | None = None) -> Column:
    """The text with each span, or run of overlapping spans, put out by ``mark``; null stays null."""
    def row(scan: Callable, text: str) -> tuple:
        parts, at = [], 0
        for start, _, end in scan(text):
            if start >= at:
                parts += [text[at:start], mark]
            at = max(at, end)
        return ("".join([*parts, text[at:]]),)
    cleaned = _per_text(docs, words, row, T.StructType([T.StructField("text", T.StringType())]))["text"]
    return F.when(F.col("text").isNotNull(), cleaned)


def _digests(scan: Callable, text: str) -> tuple:
    spans = scan(text)
    shown = [f"{KINDS[k]}:{s}:{e}" for s, k, e in spans]
    base = ",".join(x for x, (_, k, _) in zip(shown, spans, strict=True) if k < 3)
    kinds = [k for _, k, _ in spans]
    return kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(base.encode()).hexdigest(), ",".join(shown)


def digests(docs: DataFrame, words: Broadcast | None = None) -> Column:
    """Counts and digest of the base spans, and all spans, as one struct."""
    return _per_text(docs, words, _digests, DIGEST)


def op1_secret_scan(spark, sf):
    docs = read(spark, sf, "documents")
    return docs.select("doc_id", digests(docs, common_words(docs)).alias("__s")).select("doc_id", "__s.*")
