"""Token counts by the whole-token shortcut.

A pre-token that is in the vocabulary needs no merging if merging it is known to give that
one token. That is proved beforehand for each string of the vocabulary, by splitting it
(it must be one pre-token) and merging it. Counting then looks each pre-token of a text up:
proved ones count one, and only the rest are merged.

Counts are those of the vocabulary's own library. Added tokens inside a text count one and
split it, as is the library's default. Its classes of letters and digits are of an older
Unicode version, so a text with characters outside ``STABLE`` is split by the library.

Texts are handled whole, one at a time; null counts as empty. The vocabulary is of fixed
size and travels as a broadcast. Rows are independent, so repeated rows, clashing extra
columns and empty tables need no care.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedquality.llm.text import per_text, read

LIMIT = 1024
#: Merged pre-tokens that a worker remembers, and the longest of them.
REMEMBERED, LONGEST_REMEMBERED = 400_000, 64
#: Longer pieces, in bytes, are merged through a heap.
LONG = 200

#: Fixed value: how byte-level vocabularies of this family split a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose class is the same in all Unicode versions concerned.
STABLE = (r"\u0000-\u0557\u2000-\u206F\u20A0-\u20BF\u3041-\u3096\u30A1-\u30FA"
          r"\u4E00-\u9FA5\uAC00-\uD7A3\uFF00-\uFF60")

Merges = dict[tuple[int, int], tuple[int, int]]


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself if it can be seen, else one from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


def merged_length(ids: list[int], merges: Merges) -> int:
    """How many tokens are left when the neighbours of lowest rank, the leftmost first, have been joined throughout."""
    if len(ids) > LONG:
        return _merged_long(ids, merges)
    none = (1 << 60, -1)
    get = merges.get
    pairs = [get(p, none) for p in zip(ids, ids[1:], strict=False)]
    while pairs:
        best = min(pairs)
        if best is none or best[1] < 0:
            break
        at = pairs.index(best)
        ids[at:at + 2] = [best[1]]
        del pairs[at]
        if at:
            pairs[at - 1] = get((ids[at - 1], best[1]), none)
        if at < len(pairs):
            pairs[at] = get((best[1], ids[at + 1]), none)
    return len(ids)


def _merged_long(ids: list[int], merges: Merges) -> int:
    """The same by a heap of pairs and links between neighbours."""
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(m[0], i, a, b, m[1]) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False))
            if (m := merges.get((a, b)))]
    heapq.heapify(heap)
    left = n
    while heap:
        _, i, a, b, new = heapq.heappop(heap)
        j = after[i] if ids[i] == a else n
        if j >= n or ids[j] != b:
            continue
        ids[i], ids[j] = new, -1
        left -= 1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            if m := merges.get((new, ids[after[i]])):
                heapq.heappush(heap, (m[0], i, new, ids[after[i]], m[1]))
        if before[i] >= 0 and (m := merges.get((ids[before[i]], new))):
            heapq.heappush(heap, (m[0], before[i], ids[before[i]], new, m[1]))
    return left


def load(path: str) -> dict[str, Any]:
    """What counting needs of a vocabulary file, with the strings proved to be one token."""
    import regex

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters, vocab = byte_letters(), spec["model"]["vocab"]
    merges: Merges = {}
    for rank, (a, b) in enumerate(spec["model"]["merges"]):
        merges[vocab[a], vocab[b]] = (rank, vocab[a + b])
    first = [0] * 256
    for letter, byte in letters.items():
        first[byte] = vocab[letter]
    split = regex.compile(PATTERN).findall
    whole = []
    for token in vocab:
        raw = bytes(letters[c] for c in token)
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            continue
        if split(text) == [text] and merged_length([first[b] for b in raw], merges) == 1:
            whole.append(text)
    for token in spec["added_tokens"]:
        if any(token[flag] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added token with unsupported options: {token['content']}")
    return {"merges": merges, "first": first, "whole": whole, "added": [t["content"] for t in spec["added_tokens"]]}


class _Counts(dict):
    """Tokens by pre-token: the proved ones for good, merged ones as long as there is room."""

    def __init__(self, known: dict[str, Any]) -> None:
        super().__init__(dict.fromkeys(known["whole"], 1))
        self.whole, self.merges, self.first = known["whole"], known["merges"], known["first"]

    def __missing__(self, piece: str) -> int:
        n = merged_length([self.first[b] for b in piece.encode()], self.merges)
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED + len(self.whole):
                self.clear()
                self.update(dict.fromkeys(self.whole, 1))
            self[piece] = n
        return n


def counter(known: dict[str, Any]) -> Callable[[str], int]:
    """A function that counts the tokens of a text."""
    import regex
    from tokenizers import pre_tokenizers

    counts = _Counts(known).__getitem__
    split, stable = regex.compile(PATTERN).findall, re.compile(f"[^{STABLE}]")
    library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    added = re.compile("|".join(map(re.escape, sorted(known["added"], key=len, reverse=True))) or r"(?!)")

    def plain(text: str) -> int:
        if stable.search(text):
            return sum(counts(text[a:b]) for _, (a, b) in library.pre_tokenize_str(text))
        return sum(map(counts, split(text)))

    def count(text: str) -> int:
        if not added.search(text):
            return plain(text)
        return len(added.findall(text)) + sum(map(plain, added.split(text)))

    return count


def n_tokens(docs: DataFrame, path: str, text: Column | None = None) -> Column:
    """How many tokens each text has."""
    shared = docs.sparkSession.sparkContext.broadcast({"vocabulary": load(path)})

    def make() -> Callable[[str], tuple]:
        held = shared.value  # stays with the worker, and with it what earlier tasks remembered
        if "count" not in held:
            held["count"] = counter(held["vocabulary"])
        count = held["count"]
        return lambda value: (count(value),)

    schema = T.StructType([T.StructField("n", T.LongType())])
    return per_text(docs, F.col("text") if text is None else text, make, schema)["n"]


def op8_token_counts(spark, sf):
    import public_tokenizers

    docs = read(spark, sf, "documents")
    counted = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                          n_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
