from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from feedquality.llm import components as cc, jaccard_join as jj
from tests.llm.common import docs, empty, rows, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*(words[k:] for k in range(5))))


def brute(data):
    """(doc_id, n_shingles, component_id) of every row, by comparing all pairs."""
    sets = [shingle_set(t) for _, t, *_ in data]
    root = list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, *_) in enumerate(data):
        if doc_id is not None:
            least[find(i)].append(doc_id)
    return Counter((d, len(sets[i]), min(least[find(i)], default=None) if sets[i] else d)
                   for i, (d, *_) in enumerate(data))


def run(frame):
    return Counter(tuple(r) for r in jj.jaccard_components(frame).select("doc_id", "n_shingles", "component_id").collect())


def changed(text, draw, share):
    words = text.split()
    for i in range(len(words)):
        if draw.random() < share:
            words[i] = f"new{draw.randrange(10 ** 6)}"
    return " ".join(words)


def corpus():
    """Chains of near copies at all degrees, copies, a passage that all share, and short texts."""
    draw = random.Random(4)
    passage = sentence(60, 900)
    data = []
    for base in range(8):
        text = sentence(draw.choice([12, 40, 150]), base)
        for _ in range(12):
            data.append(text)
            text = changed(text, draw, draw.choice([0.005, 0.02, 0.05]))
    data += [sentence(k, 50 + k) + " " + passage for k in range(0, 30, 2)] + [passage] * 3
    data += ["a b c", "A  b\tc", "a b", "x", "x", "a b c d e", "a b c d e f", "same " * 50, "same " * 7]
    return [(i + 10, t, "en", "a", 0) for i, t in enumerate(data)]


def test_components_are_those_of_all_pairs(spark):
    data = corpus()
    assert run(docs(spark, data)) == brute(data)


def test_awkward_rows(spark):
    assert run(docs(spark)) == brute(rows())
    assert run(empty(spark)) == Counter()


def test_lists_dealt_out_in_parts_and_cut_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(jj, "LIST_PART", 3)
    monkeypatch.setattr(jj, "INDEX_BLOCK", 2)
    monkeypatch.setattr(jj, "GATHERED", 50)
    data = corpus()
    assert run(docs(spark, data)) == brute(data)


def test_a_group_of_copies_forms_few_pairs(spark, monkeypatch):
    draw = random.Random(1)
    text = sentence(120, 1)
    data = [(i, changed(text, draw, 0.004), "en", "a", 0) for i in range(300)]
    tried = []
    search = jj.linked
    monkeypatch.setattr(jj, "linked", lambda pairs, sets: tried.append(pairs.count()) or search(pairs, sets))
    got = run(docs(spark, data))
    assert got == brute(data)
    assert sum(tried) < 4 * 300


lists = st.lists(st.lists(st.integers(0, 40), max_size=25).map(lambda x: sorted(set(x))), max_size=12)


@settings(max_examples=400, deadline=None)
@given(lists, st.integers(1, 12), st.sampled_from([0.001, 0.01, 0.5, 5.0]))
def test_divide_skip_finds_all_that_occur_often_enough(found, need, weight):
    counts = Counter(x for items in found for x in items)
    assert jj.divide_skip(found, need, weight) == {x: c for x, c in counts.items() if c >= need}


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 60), st.lists(st.integers(0, 12), min_size=1, max_size=6))
def test_search_in_a_block(start, cuts):
    query = np.unique(np.arange(start, start + 40, dtype=np.uint64))
    members = [np.arange(start + c, start + 40 + c, dtype=np.uint64) for c in cuts]
    expected = [k for k, m in enumerate(members)
                if 100 * len(np.intersect1d(query, m)) >= 75 * len(np.union1d(query, m))]
    assert sorted(jj.search_block(query, members)) == expected


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1, max_size=20), min_size=1, max_size=8), st.sets(st.integers(0, 30), min_size=1))
def test_an_index_of_a_block(members, query):
    found = jj.BlockIndex([np.array(sorted(m), np.uint64) for m in members]).search(np.array(sorted(query), np.uint64))
    assert sorted(found) == [k for k, m in enumerate(members) if 100 * len(m & query) >= 75 * len(m | query)]


def test_a_cloud_that_falls_apart(spark, monkeypatch):
    """Copies of one text, changed so much that most pairs just miss the threshold."""
    monkeypatch.setattr(jj, "INDEX_BLOCK", 16)
    draw = random.Random(8)
    text = sentence(150, 3)
    data = [(i, changed(text, draw, 0.02 + 0.0006 * i), "en", "a", 0) for i in range(80)]
    expected = brute(data)
    assert 3 < len({c for _, _, c in expected}) < 80
    assert run(docs(spark, data)) == expected


def test_groups_whose_pairs_have_all_been_tried_are_done(spark):
    draw = random.Random(5)
    parts = [(b"%d %d" % (g, k), b"g%d" % g, b"r%d" % draw.randrange(g, 2 * g + 2)) for g in range(12) for k in range(g + 1)]
    of = {v: (g, root) for v, g, root in parts}
    cross = [(a, b) for a in of for b in of if a < b and of[a][0] == of[b][0] and of[a][1] != of[b][1]]
    tried = [draw.choice([(a, b), (b, a)]) for a, b in cross if of[a][0] != b"g3" and draw.random() < 0.9] + [(b"0 0", b"1 0")]
    got = jj.untried(spark.createDataFrame(parts, "v binary, all binary, root binary"),
                     spark.createDataFrame(tried + tried[:9], "a binary, b binary")).collect()
    left = [p for p in cross if p not in tried and p[::-1] not in tried]
    assert {bytes(r["all"]) for r in got} == {of[a][0] for a, _ in left}
    assert all(r["rows"] == sum(g == bytes(r["all"]) for g, _ in of.values()) for r in got)
    asks = {bytes(r["v"]) for r in got if r["asks"]}
    # each pair that is left has an end that is searched for, and no record that is done with all is
    assert all(a in asks or b in asks for a, b in left) and asks <= {v for p in left for v in p}
    assert len(got) == sum(g in {of[a][0] for a, _ in left} for g, _ in of.values())


def test_records_that_link_meet_in_enough_short_lists(spark):
    frame = spark.createDataFrame([(n, m) for n in range(1, 80) for m in range(n, 80)], "n long, m long")
    for row in frame.withColumn("need", jj.needed_in_short(frame["n"], frame["m"])).collect():
        n, m = row["n"], row["m"]
        most_outside = max(jj.least_overlap(x) - 1 for x in (n, m))
        assert row["need"] <= max(1, jj.pair_overlap(n, m) - most_outside)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 100])
def test_bounds(n):
    assert jj.least_overlap(n) == -(-3 * n // 4)
    for m in range(1, 2 * n):
        least = jj.pair_overlap(n, m)
        assert 100 * least >= 75 * (n + m - least) and 100 * (least - 1) < 75 * (n + m - least + 1)


def test_connected_components(spark):
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(200, 300)] + [(0, k) for k in range(1, 60)] + [
        (draw.randrange(1000, 1400), draw.randrange(1000, 1400)) for _ in range(200)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = dict(tuple(r) for r in cc.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {x: find(x) for x in root}
    assert cc.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_group_stays(spark):
    frame = docs(spark)
    kept = jj.keep_one(frame)
    assert kept.columns == frame.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    # 2 and 9 are copies of 1; row 8 is there twice; rows without words all stay
    assert ids == Counter([1, 3, 4, 5, None, None, 7, 8, 10])
    assert jj.keep_one(empty(spark)).count() == 0


def test_one_stays_where_ids_are_null_or_shared(spark):
    def near(seed):
        text = sentence(200, seed)
        return text, text + " one", text + " two"
    a, b, c = near(21), near(22), near(23)
    data = [(None, a[0], "en", "a", 0), (None, a[1], "en", "a", 0), (None, a[1], "en", "a", 0),  # no ids
            (5, b[0], "en", "a", 0), (5, b[1], "en", "a", 0), (6, b[2], "en", "a", 0),  # two texts share the least
            (None, c[0], "en", "a", 0), (8, c[1], "en", "a", 0), (7, c[2], "en", "a", 0), (7, c[2], "en", "a", 0)]
    kept = [(r["doc_id"], r["text"]) for r in jj.keep_one(docs(spark, data)).collect()]
    assert Counter(i for i, _ in kept) == Counter([None, 5, 7])
    assert {t for _, t in kept} & set(a) and {t for _, t in kept} & set(b) and (7, c[2]) in kept


def test_a_full_sketch_does_not_make_every_list_a_long_one(spark, monkeypatch):
    """With counters so few that each holds many shingles, no more postings leave the merge, and the links are the same."""
    data = [(i, sentence(60, i), "en", "a", 0) for i in range(300)] + [(400 + i, sentence(60, 7) + f" x{i}", "en", "a", 0) for i in range(20)]
    frame = docs(spark, data, clashing=False)

    def postings():
        _, sketch = jj.records(frame)
        assert np.median(sketch.value) > jj.LIST_PART or jj.SKETCH_BITS > 10
        return jj.short_lists(frame, sketch).filter("kind in (1, 2)").count()

    plain = postings()
    monkeypatch.setattr(jj, "SKETCH_BITS", 8)
    monkeypatch.setattr(jj, "BLOCK", 64)
    monkeypatch.setattr(jj, "LIST_PART", 40)
    assert 0 < postings() <= 2 * plain
    assert run(frame) == brute(data)


def test_long_lists_alone_make_no_pairs(spark, monkeypatch):
    """Records of many components that share 6 long lists, of the 12 that a link takes, and one pair that shares 12."""
    def name(k):
        return f"record{k:010d}".encode()

    postings = []
    for k in range(90):
        root = name(0) if k < 40 else name(k)
        postings += [(t, name(k), 100, 10, root) for t in range(6)]
        # lists of its own, each with a record of another component
        postings += [(1000 + 20 * (k // 2) + t, name(k), 100, 10, root) for t in range(6 if k in (88, 89) else 0)]
        postings += [(100_000 + 100 * k + t, name(k), 100, 10, root) for t in range(14)]
    mixed = spark.createDataFrame(postings, "token long, v binary, n long, pos long, root binary")
    votes = spark.createDataFrame([], "v binary, n long, w binary, m long, alone long")
    marks = [(3, name(k), 100, None, 5, 5, 5, None, None) for k in range(90)]
    listed = spark.createDataFrame(marks, jj.LISTED)
    staged = {}

    def stage(df, what):
        staged[what] = df
        return df

    monkeypatch.setattr(jj, "stage", stage)
    found = jj.apart(mixed, votes, listed).collect()
    assert [(bytes(r["a"]), bytes(r["b"])) for r in found] == [(name(88), name(89))]
    assert staged["met"].count() == 1
