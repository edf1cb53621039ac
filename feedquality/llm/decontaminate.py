"""Benchmark decontamination by a generalised suffix automaton of the test items.

Words are runs of digits, small letters and characters outside ASCII, A-Z made small. A
window is ``WINDOW`` consecutive words of an item, or a shorter item as a whole. The
automaton holds every run of words of every item in a number of states that is at most
twice the items' words. A document's words are streamed through it; after each word the
state stands for the longest run of words, ending there, that some item holds. Where that
run reaches a window's length its words are hit, and the state that stands for just the
last window names the items that hold it.

The automaton of ``ITEM_WORDS`` words at most is broadcast. A larger benchmark is dealt by
item into several, each streamed over the documents in turn, with the same result. Driver and
workers hold ``PLANNED`` of them at a time: what these found is written before the next are fetched.

Null and empty texts have no words and no hits; an empty benchmark hits nothing. Items
without an id count for hits and are not named. Rows are judged one by one, so repeated
rows and clashing extra columns need no care.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedquality.llm.text import per_text, read
from feedquality.session import stage

WINDOW = 10
#: Words of items in one automaton; it then takes some 100 MB in each worker at most.
ITEM_WORDS = 200_000
#: A document goes if more than this share of its words is hit; otherwise the hit spans go.
MAX_COVERAGE = 0.5
#: Automata that one plan holds; what that many found is written before the next are collected.
PLANNED = 2

#: Capitals become small; what is no word character becomes a blank.
NORMAL = bytes(b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32
               for b in range(256))

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("s", T.LongType()), T.StructField("e", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])
CLEANED = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("clean", T.StringType()),
])


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(NORMAL).split()


class Automaton:
    """A generalised suffix automaton over word numbers."""

    def __init__(self, items: Iterable[tuple[str | None, str | None]], window: int = WINDOW) -> None:
        self.window = window
        self.number: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]
        texts = []
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number)) for w in words_of(text or "")]
            if ids:
                texts.append((item, ids))
                last = 0
                for c in ids:
                    last = self._add(last, c)
        self.shortest = min((min(len(ids), window) for _, ids in texts), default=window)
        #: The items of a window, by the state that stands for it; apart for each length.
        self.items: dict[tuple[int, int], set[str]] = {}
        for item, ids in texts:
            size = min(len(ids), window)
            state = matched = 0
            for c in ids:
                state, matched = self.step(state, matched, c)
                if matched >= size:
                    self.items.setdefault((self.suffix(state, size), size), set()).update([] if item is None else [item])
        self.short_sizes = sorted({size for _, size in self.items if size < window}, reverse=True)

    def _add(self, last: int, c: int) -> int:
        known = self.next[last].get(c)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, c, known)
        state = self._state(self.length[last] + 1, {})
        while last != -1 and c not in self.next[last]:
            self.next[last][c] = state
            last = self.link[last]
        if last == -1:
            self.link[state] = 0
        else:
            known = self.next[last][c]
            self.link[state] = (known if self.length[known] == self.length[last] + 1
                                else self._clone(last, c, known))
        return state

    def _state(self, length: int, transitions: dict[int, int]) -> int:
        self.next.append(transitions)
        self.length.append(length)
        self.link.append(-1)
        return len(self.next) - 1

    def _clone(self, at: int, c: int, known: int) -> int:
        clone = self._state(self.length[at] + 1, dict(self.next[known]))
        self.link[clone] = self.link[known]
        self.link[known] = clone
        while at != -1 and self.next[at].get(c) == known:
            self.next[at][c] = clone
            at = self.link[at]
        return clone

    def step(self, state: int, matched: int, c: int) -> tuple[int, int]:
        """The state after one more word, and how many of the last words it matches."""
        to = self.next[state].get(c)
        if to is not None:
            return to, matched + 1
        while state and c not in self.next[state]:
            state = self.link[state]
        to = self.next[state].get(c)
        return (0, 0) if to is None else (to, self.length[state] + 1)

    def suffix(self, state: int, size: int) -> int:
        """The state that stands for the last ``size`` words of what ``state`` matches."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """The hit spans, merged, and the items whose windows occur."""
        n = len(words)
        if n < self.shortest:
            return [], set()
        get = self.number.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, n)
        unknown = np.flatnonzero(ids < 0)
        edges = np.concatenate(([-1], unknown, [n]))
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        sizes = [self.window, *self.short_sizes]
        for run in np.flatnonzero(np.diff(edges) > self.shortest):
            begin, end = int(edges[run]) + 1, int(edges[run + 1])
            state = matched = 0
            for at, c in enumerate(ids[begin:end].tolist(), begin + 1):
                state, matched = self.step(state, matched, c)
                if matched < self.shortest:
                    continue
                for size in sizes:
                    if matched >= size and (key := (self.suffix(state, size), size)) in self.items:
                        found |= self.items[key]
                        if spans and spans[-1][1] >= at - size:
                            start = min(spans.pop()[0], at - size)
                            while spans and spans[-1][1] >= start:
                                start = min(spans.pop()[0], start)
                            spans.append((start, at))
                        else:
                            spans.append((at - size, at))
        return spans, found


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without these spans of words; what stands between words of a span goes with it."""
    raw = text.encode()
    places = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(NORMAL))]
    kept, at = [], 0
    for s, e in spans:
        kept.append(raw[at:places[s][0]])
        at = places[e - 1][1]
    return b"".join([*kept, raw[at:]]).decode()


def _scan(automaton: Automaton, text: str) -> tuple:
    words = words_of(text)
    spans, items = automaton.scan(words)
    return len(words), [{"s": s, "e": e} for s, e in spans], sorted(items)


def _clean(automaton: Automaton, text: str) -> tuple:
    words = words_of(text)
    hit = 0
    spans, _ = automaton.scan(words)
    while spans:  # what a cut brings together may match again
        hit += sum(e - s for s, e in spans)
        text = without(text, spans)
        spans, _ = automaton.scan(words_of(text))
    return len(words), hit, text


class Dealt:
    """The items, dealt into groups; each is collected and broadcast when its turn comes."""

    def __init__(self, items: DataFrame, window: int, groups: int) -> None:
        self.items = items.withColumn("g", F.pmod(F.xxhash64("item", "text"), F.lit(groups)))
        self.window, self.groups = window, groups

    def __len__(self) -> int:
        return self.groups

    def __iter__(self) -> Iterator[Broadcast]:
        for g in range(self.groups):
            rows = sorted(((r["item"], r["text"]) for r in self.items.filter(F.col("g") == g).collect()), key=repr)
            yield self.items.sparkSession.sparkContext.broadcast({"rows": rows, "window": self.window})


def automata(benchmark: DataFrame, window: int = WINDOW, item_words: int = ITEM_WORDS) -> Dealt:
    """The items, dealt into automata of bounded size; built one after the other."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    # a word takes two bytes at least, with the blank after it
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return Dealt(items, window, max(1, math.ceil(total / 2 / item_words)))


def _in_turn(rows: DataFrame, groups: Dealt, apply: Callable[[DataFrame, Broadcast], DataFrame], name: str) -> DataFrame:
    """``rows`` after each group; written, and the broadcasts given up, after ``PLANNED`` of them."""
    held: list[Broadcast] = []
    for i, shared in enumerate(groups, 1):
        rows = apply(rows, shared)
        held.append(shared)
        if len(held) == PLANNED and i < len(groups):
            rows = stage(rows, name)
            while held:
                held.pop().destroy()
    return rows


def _worker(shared: Broadcast, row: Callable[[Automaton, str], tuple]) -> Callable[[], Callable[[str], tuple]]:
    def make() -> Callable[[str], tuple]:
        held: dict[str, Any] = shared.value  # stays with the worker, and the automaton with it
        if "automaton" not in held:
            held["automaton"] = Automaton(held["rows"], held["window"])
        return lambda text: row(held["automaton"], text)
    return make


def hits(docs: DataFrame, keep: list[str], benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``keep``, ``n_words``, the hit ``spans`` (word positions, end exclusive) and the ``items`` found."""
    def apply(rows: DataFrame, shared: Broadcast) -> DataFrame:
        found = per_text(rows, F.col("__text"), _worker(shared, _scan), FOUND)
        return rows.select(*keep, "__text", "__n", "__s", "__i", found.alias("__f")).select(
            *keep, "__text", F.col("__f.n_words").alias("__n"), F.concat("__s", "__f.spans").alias("__s"),
            F.concat("__i", "__f.items").alias("__i"))

    none = [F.array().cast(FOUND[field].dataType) for field in ("spans", "items")]
    rows = docs.select(*keep, F.col("text").alias("__text"), F.lit(None).cast("long").alias("__n"),
                       none[0].alias("__s"), none[1].alias("__i"))
    found = _in_turn(rows, automata(benchmark, window), apply, "hits")
    return found.select(*keep, F.col("__n").alias("n_words"), F.array_sort(F.array_distinct("__s")).alias("spans"),
                        F.array_sort(F.array_distinct("__i")).alias("items"))


def covered(spans: Column) -> Column:
    """How many words sorted spans cover, overlaps once."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach"))
    return F.aggregate(spans, start, lambda acc, x: F.struct(
        (acc["n"] + F.greatest(F.lit(0).cast("long"), x["e"] - F.greatest(x["s"], acc["reach"]))).alias("n"),
        F.greatest(acc["reach"], x["e"]).alias("reach")))["n"]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """A column ``doc`` with each document that stays, hit spans cut from its text, and ``n_hit``."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.lit(0).cast("long").alias("n_hit"),
                       F.lit(None).cast("long").alias("n_words"))

    def apply(rows: DataFrame, shared: Broadcast) -> DataFrame:
        clean = per_text(rows, F.col("doc.text"), _worker(shared, _clean), CLEANED)
        return rows.select("doc", "n_hit", "n_words", clean.alias("__c")).select(
            F.when(F.col("__c.n_hit") > 0, F.col("doc").withField("text", F.col("__c.clean")))
            .otherwise(F.col("doc")).alias("doc"),
            (F.col("n_hit") + F.col("__c.n_hit")).alias("n_hit"),
            F.coalesce("n_words", "__c.n_words").alias("n_words"))

    rows = _in_turn(rows, automata(benchmark, window), apply, "clean")
    return rows.filter(F.col("n_hit") <= max_coverage * F.col("n_words"))


def op5_decontaminate(spark, sf):
    found = hits(read(spark, sf, "documents"), ["doc_id"], read(spark, sf, "benchmark"))
    n_hit = covered(F.col("spans"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
          r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP5_SQL = f"""
with items as (select item_id, {_WORDS} as w from benchmark),
windows as (
  select distinct item_id, m, array_to_string(list_slice(w, p, p + m - 1), ' ') as key
  from (select item_id, w, least(len(w), {WINDOW}) as m, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) as p
        from items where len(w) > 0)),
docs as (select doc_id, {_WORDS} as w from documents),
places as (
  select doc_id, m, p, array_to_string(list_slice(w, p, p + m - 1), ' ') as key
  from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as p
        from docs, (select distinct m from windows) where len(w) >= m)),
found as (select doc_id, p, item_id, m from places join windows using (m, key)),
hit as (select doc_id, count(distinct q) as n_hit
        from (select doc_id, unnest(range(p, p + m)) as q from found) group by doc_id),
named as (select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as list
          from (select distinct doc_id, cast(item_id as varchar) as i from found) group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (doc_id) left join named using (doc_id)
"""
