from __future__ import annotations

from collections import Counter, defaultdict

from pyspark.sql import functions as F

from feedquality.llm import line_dedup as ld
from tests.llm.common import docs, empty

BLANKS = " \t\r\x0b\x0c"


def brute(rows, min_sites):
    sites, holders = defaultdict(set), defaultdict(list)
    for doc_id, text, _, source, _ in rows:
        for line in (text or "").split("\n"):
            if key := line.strip(BLANKS):
                if source is not None:
                    sites[key].add(source)
                    if doc_id is not None:
                        holders[key].append(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        if text is None:
            out.append((doc_id, None, 0, 0))
            continue
        kept = []
        for line in text.split("\n"):
            key = line.strip(BLANKS)
            spread = key and len(sites[key]) >= min_sites
            if not (spread and (doc_id is None or not holders[key] or doc_id != min(holders[key]))):
                kept.append(line)
        n = len(text.split("\n"))
        out.append((doc_id, "\n".join(kept), n, n - len(kept)))
    return Counter(out)


def run(frame, min_sites):
    return Counter((r["doc"]["doc_id"], r["doc"]["text"], r["n_lines"], r["n_removed"])
                   for r in ld.drop_boilerplate(frame, min_sites=min_sites).collect())


def rows():
    out = []
    for i in range(60):  # lines on 1, 2, ... sites, around the threshold
        lines = [f"line {k}" for k in range(1, 13) if i % 12 < k] + [f"own {i}", "", "  padded \t" if i % 2 else "padded"]
        out.append((i, "\n".join(lines), "en", f"s{i % 12}" if i % 7 else None, 0))
    out += [(100, None, "en", "s1", 0), (101, "", "en", "s2", 0), (102, "line 12", "en", "s3", 0), (102, "line 12", "en", "s3", 0),
            (102, "line 12\nother", "en", None, 0), (None, "line 12\nmine", "en", "s4", 0), (103, "\n\n", None, None, None),
            (104, "line 12\n" * 3000 + "end", "en", "s5", 0), (None, "unowned", "en", "q1", 0), (None, "unowned", "en", "q2", 0)]
    return out


def test_agrees_with_exact_counts(spark):
    frame = docs(spark, rows())
    for min_sites in (2, 5, 9, 12, 13):
        assert run(frame, min_sites) == brute(rows(), min_sites), min_sites


def test_hundreds_of_sites(spark):
    data = [(i, f"all\nhalf {i % 2}\nown {i}", "en", f"s{i}", 0) for i in range(600)]
    for min_sites in (299, 300, 301, 600, 601):
        assert run(docs(spark, data), min_sites) == brute(data, min_sites)


def test_columns_and_empty_tables(spark):
    frame = docs(spark)
    assert ld.drop_boilerplate(frame).select("doc.*").columns == frame.columns
    assert ld.drop_boilerplate(empty(spark)).count() == 0


def test_partial_aggregation_comes_before_the_shuffle(spark):
    lines = ld._lines(docs(spark), "source")
    plan = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_hll_sketch_agg" in plan
