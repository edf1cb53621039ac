from __future__ import annotations

from collections import Counter

import duckdb

from feedquality.llm import quote_links as q

MESSAGES = [
    (1, 0, "user", "Hello there, world.\nSecond line of it."),
    (1, 1, "assistant", "> hello THERE world\nA first reply.\n\nIts end."),
    (1, 2, "user", ">> Hello there, world.\n> A first reply.\nA reply to the reply."),
    (1, 3, "user", "> Hello there, world.\n> Second line of it.\nTo the first."),
    (1, 4, "assistant", "> > Second line of it.\nQuotes a level below."),
    (1, 5, "user", "> nobody said this\nA new thread."),
    (1, 6, "user", "> A reply to the reply.\n> A new thread.\nBoth."),
    (1, 7, "user", "> Both.\n>\n> Both.\nDeep."),
    (2, 0, "user", "> Hello there, world.\nNot in this conversation."),
    (2, 1, "user", None), (2, 2, "user", ""), (2, 3, "user", ">"), (2, 4, "user", "!!!"), (2, 5, "user", "> !!!"),
    (2, 6, "user", "Same"), (2, 7, "user", "Same"), (2, 8, "user", "> Same\nearliest counts"), (2, 8, "user", "> Same\nearliest counts"),
    (None, 1, "user", "> Same"), (3, None, "user", "> Same"), (None, None, None, None),
    (4, 5, "user", "> later"), (4, 6, "user", "later"), (4, 7, "user", "> é ü\nx"), (4, 0, "u", "É ü"), (4, 1, "u", "é ü"),
] + [(5, k, "user", f"message {k}" if not k else f"> message {k - 1}\nmessage {k}") for k in range(40)]
SCHEMA = "conv_id long, turn long, role string, text string"


def frame(spark, rows=MESSAGES):
    from pyspark.sql import functions as F
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("parent", "root", "depth", "level", "h1")})


def test_links_and_order(spark):
    got = {(r["conv_id"], r["turn"]): (r["parent"], r["quote_level"], r["root"], r["depth"]) for r in q.conversations(frame(spark)).collect()}
    assert got[1, 1] == (0, 1, 0, 1)
    assert got[1, 2] == (1, 1, 0, 2)
    assert got[1, 3] == (0, 1, 0, 1)
    assert got[1, 4] == (0, 2, 0, 1)
    assert got[1, 5] == (None, None, 5, 0)
    assert got[1, 6] == (2, 1, 0, 3)
    assert got[1, 7] == (6, 1, 0, 4)
    assert got[2, 8] == (6, 1, 6, 1)
    assert got[4, 5] == (None, None, 5, 0) and got[4, 7] == (1, 1, 1, 1)
    assert got[5, 39] == (38, 1, 0, 39)


def test_agrees_with_sql(spark):
    db = duckdb.connect()
    db.execute("create table conversations(conv_id bigint, turn bigint, role varchar, text varchar)")
    db.executemany("insert into conversations values (?, ?, ?, ?)", MESSAGES)
    result = db.execute(q.OP2_SQL)
    columns = [d[0] for d in result.description]
    expected = Counter(map(repr, result.fetchall()))
    df = q.conversations(frame(spark))
    assert sorted(df.columns) == sorted(columns)
    assert Counter(repr(tuple(r)) for r in df.select(*columns).collect()) == expected


def test_quotes_are_gone_and_every_row_stays(spark):
    rows = q.conversations(frame(spark)).collect()
    assert len(rows) == len(MESSAGES)
    assert not any(line.lstrip(" ").startswith(">") for r in rows for line in (r["text"] or "").split("\n"))
    assert q.conversations(frame(spark, []).limit(0)).count() == 0


def test_no_python(spark):
    text = q.conversations(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "NestedLoop" not in text
