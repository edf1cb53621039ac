from __future__ import annotations

import re
from collections import Counter

from hypothesis import given, settings, strategies as st

from feedquality.llm import decontaminate as d
from tests.llm.common import docs, empty, sentence, texts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(text, items, window):
    own = words(text)
    hit, found = set(), set()
    for item, body in items:
        parts = words(body)
        size = min(len(parts), window)
        if size:
            wins = {tuple(parts[i:i + size]) for i in range(len(parts) - size + 1)}
            for i in range(len(own) - size + 1):
                if tuple(own[i:i + size]) in wins:
                    hit.update(range(i, i + size))
                    found.add(item)
    return hit, found


letters = st.lists(st.sampled_from("abc"), max_size=30).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(letters, st.lists(letters, max_size=4), st.integers(1, 5))
def test_hits_are_those_of_brute_force(text, bodies, window):
    items = [(str(i), b) for i, b in enumerate(bodies)]
    spans, found = d.Automaton(items, window).scan(d.words_of(text))
    hit, expected = brute(text, items, window)
    assert {i for s, e in spans for i in range(s, e)} == hit and found == expected
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_the_automaton_stays_small():
    items = [(str(i), sentence(60, i % 7)) for i in range(40)]
    automaton = d.Automaton(items)
    assert len(automaton.next) <= 2 * 40 * 60


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_words(text):
    assert [w.decode() for w in d.words_of(text)] == words(text)


def test_cuts_leave_no_window(spark):
    item = sentence(12, 3)
    middle = item.split()
    tricky = " ".join(middle[:6]) + " " + item + " " + " ".join(middle[6:]) + " and so on " + sentence(60, 4)
    bench = spark.createDataFrame([(1, item), (2, None), (None, ""), (3, "Too Short")], "item_id long, text string")
    frame = texts(spark, tricky, "Before. " + item.upper() + "! " + sentence(40, 5), sentence(40, 6), item, None, "", "é" + item)
    got = {r["doc"]["doc_id"]: (r["doc"]["text"], r["n_hit"]) for r in d.decontaminate(frame, bench).collect()}
    assert got[2] == (sentence(40, 6), 0) and got[4] == (None, 0) and got[5] == ("", 0)
    assert got[1] == ("Before. ! " + sentence(40, 5), 12)
    assert 3 not in got
    assert not any(brute(t, [("1", item)], 10)[0] for t, _ in got.values())


def query(frame, bench, window=10):
    return {(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in d.hits(
        frame, ["doc_id"], bench, window).select("doc_id", "n_words", d.covered(d.F.col("spans")).alias("n_hit"), "items").collect()}


def test_rows_and_many_automata(spark, monkeypatch):
    frame = docs(spark)
    items = [(i, sentence(30, i)) for i in range(1, 4)] + [(50, "word"), (None, sentence(12, 2)), (None, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = set()
    for r in frame.select("doc_id", "text").collect():
        hit, found = brute(r["text"], items, 10)
        expected.add((r["doc_id"], len(words(r["text"])), len(hit), tuple(sorted(str(i) for i in found if i is not None))))
    assert query(frame, bench) == expected
    whole = d.automata
    monkeypatch.setattr(d, "automata", lambda b, w=10: whole(b, w, item_words=20))
    assert len(d.automata(bench)) > 3 and query(frame, bench) == expected
    assert d.decontaminate(frame, bench).count() > 0


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {h for *_, h, _ in query(docs(spark), none)} == {0}
    assert query(empty(spark), none) == set()


def test_few_automata_are_held_at_a_time(spark, monkeypatch):
    frame = docs(spark)
    bench = spark.createDataFrame([(i, sentence(30, i)) for i in range(1, 6)], "item_id long, text string")
    expected, cleaned = query(frame, bench), Counter(r["doc"]["text"] for r in d.decontaminate(frame, bench).collect())
    whole, kind = d.automata, type(spark.sparkContext)
    share, drop = kind.broadcast, d.Broadcast.destroy
    held, most = set(), []

    def shares(self, value):
        made = share(self, value)
        held.add(id(made))
        most.append(len(held))
        return made

    def drops(self, *args):
        held.discard(id(self))
        drop(self, *args)

    monkeypatch.setattr(kind, "broadcast", shares)
    monkeypatch.setattr(d.Broadcast, "destroy", drops)
    monkeypatch.setattr(d, "automata", lambda b, w=10: whole(b, w, item_words=20))
    assert query(frame, bench) == expected
    assert len(most) > 3 and max(most) <= d.PLANNED
    held.clear()
    most.clear()
    assert Counter(r["doc"]["text"] for r in d.decontaminate(frame, bench).collect()) == cleaned
    assert len(most) > 3 and max(most) <= d.PLANNED
