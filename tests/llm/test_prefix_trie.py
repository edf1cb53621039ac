from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from feedquality.llm import prefix_trie
from tests.llm.common import CLASHING

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuild(rows):
    """From the definition: conversation -> its turns, rebuilt."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        takes = zlib.crc32(str(c).encode()) % 9
        giver = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(giver, [])[:takes] + turns[takes:]
    return out


def brute(rows):
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in rebuild(rows).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = own + sum(saved[k] for k in children[node])
    return Counter(
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()) for node, m in members.items())


def found(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4).withColumns(
        {c: F.lit(7) for c in (*CLASHING, "node", "parent", "digest", "bytes", "row", "block", "rank", "takes", "depth")})


def talk(draw, convs, turns=6, words=3):
    return [(c, t, draw.choice(["user", "assistant", None]), draw.choice([None, "", "é", *["word " * i for i in range(words)]]))
            for c in convs for t in range(draw.randrange(turns))]


def test_query_against_the_definition(spark):
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{SF}/conversations.parquet'").fetchall()
    df = prefix_trie.op11_prefix_trie(spark, SF)
    assert df.columns == COLUMNS and {t for _, t in df.dtypes} == {"bigint", "string"}
    assert found(df) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(spark, seed):
    draw = random.Random(seed)
    rows = talk(draw, range(-20, 60), turns=14)
    draw.shuffle(rows)
    assert found(prefix_trie.prefix_trie(frame(spark, rows))) == brute(rows)


def test_awkward_rows(spark):
    rows = [(1, None, "user", "a"), (1, 0, None, None), (1, 0, "user", "b"), (1, 0, "user", "b"), (None, 0, "user", "x"),
            (None, None, None, None), (7, None, None, None), (7, 5, "", ""), (40, 3, "user", "é" * 5000), (41, 3, "user", "é" * 5000),
            (-3, 1, "user", "a"), (-5, 1, "user", "a"), (9_000_000_000, 1, "user", "a"), *[(12, 1, "user", "same")] * 40]
    assert found(prefix_trie.prefix_trie(frame(spark, rows))) == brute(rows)


def test_no_turns_left(spark):
    """A conversation with fewer turns than it is to take, and no giver."""
    lone = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(lone, t, "user", "a") for t in range(2)]
    assert rebuild(rows) == {lone: []}
    assert found(prefix_trie.prefix_trie(frame(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert prefix_trie.prefix_trie(frame(spark, [])).collect() == []
    assert prefix_trie.prefix_trie(frame(spark, [(None, 1, "user", "a")])).collect() == []


def test_long_and_common_conversations(spark, monkeypatch):
    """A conversation over many blocks and segments, one that many hold, and ends in many parts."""
    monkeypatch.setattr(prefix_trie, "SEGMENT", 3)
    monkeypatch.setattr(prefix_trie, "IDS", 3)
    draw = random.Random(5)
    rows = [(2, t, "user", f"turn {t}") for t in range(150)] + [(2, 70, "user", "again")] * 50
    rows += [(c, t, "user", "common") for c in range(100, 180) for t in range(9)] + talk(draw, range(200, 220))
    assert found(prefix_trie.prefix_trie(frame(spark, rows))) == brute(rows)


def trees():
    draw = random.Random(11)
    yield "chain", [i - 1 for i in range(1, 300)]
    yield "comb", [i - 1 if i % 2 else i - 2 for i in range(1, 300)]
    yield "star", [0] * 200
    yield "random", [draw.randrange(i) for i in range(1, 300)]
    yield "late", [draw.randrange(max(0, i - 3), i) for i in range(1, 300)]
    yield "root", []


@pytest.mark.parametrize(("name", "parents"), list(trees()))
def test_totals_of_any_tree(spark, monkeypatch, name, parents):
    n, kids = len(parents) + 1, Counter(parents)
    leaves, saved = [int(not kids[i]) for i in range(n)], [i * i % 17 for i in range(n)]
    tree = spark.createDataFrame(
        [(f"n{i}", f"n{parents[i - 1]}" if i else None, kids[i], leaves[i], saved[i]) for i in range(n)],
        "node string, parent string, n_children long, n_leaves long, saved_tokens long").repartition(3)
    for i in range(n - 1, 0, -1):
        leaves[parents[i - 1]] += leaves[i]
        saved[parents[i - 1]] += saved[i]
    staged = Counter()
    monkeypatch.setattr(prefix_trie, "stage", lambda df, area, real=prefix_trie.stage: (staged.update([area]), real(df, area))[1])
    got = {r["node"]: tuple(r)[1:] for r in prefix_trie.contracted_totals(tree).collect()}
    assert got == {f"n{i}": (leaves[i], saved[i]) for i in range(n)}
    # a chain of 300 is gone after far fewer rounds than it is long
    assert staged["raked"] <= 24
