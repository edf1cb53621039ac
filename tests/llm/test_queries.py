"""The registered queries on the small tables, against their SQL or a brute-force version."""

from __future__ import annotations

import hashlib
import importlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from feedquality.llm import bpe
from feedquality.llm.queries import ORACLE, QUERIES
from feedquality.session import shared_dir
from tests.llm import common, test_decontaminate, test_jaccard_join, test_line_dedup, test_quality_rules, test_secret_scan

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_all_are_registered():
    names = contract.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(ORACLE) <= set(contract.oracle_sql())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_agrees_with_its_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    result = db.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected = Counter(map(repr, result.fetchall()))
    assert Counter(repr(tuple(r)) for r in df.select(*columns).collect()) == expected


def texts(db):
    return db.execute("select doc_id, text, lang, source, n_chars from documents").fetchall()


def test_secrets(spark, db):
    got = {r["doc_id"]: r for r in QUERIES["op1_secret_scan"](spark, SF).collect()}
    for doc_id, text, *_ in texts(db):
        base = test_secret_scan.base_by_the_patterns(text)
        joined = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in base)
        row = got[doc_id]
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert set(joined.split(",")) - {""} <= set(row["spans"].split(","))


def test_components(spark, db):
    got = Counter(tuple(r) for r in QUERIES["op3_jaccard_join"](spark, SF).collect())
    assert got == test_jaccard_join.brute(texts(db))


def test_quality_base(spark, db):
    got = {r["doc_id"]: tuple(r)[1:6] for r in QUERIES["op9_quality_rules"](spark, SF).collect()}
    assert got == {i: test_quality_rules.brute(t) for i, t, *_ in texts(db)}


def test_classifier_on_held_out_labels(spark):
    """Both kinds of held-out documents are told apart; always giving one answer would fail for the other kind."""
    sf = "/root/testdata/sf0.01"
    labels = dict(duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet'").fetchall())
    rows = [r for r in QUERIES["op7_byte_cnn"](spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    for quality in (0, 1):
        found = [r["predicted"] == quality for r in rows if labels[r["doc_id"]] == quality]
        assert len(found) >= 5 and sum(found) >= 0.8 * len(found)


def encodings(rows):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return {i: (len(ids := library.encode_ordinary(t or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows}


def test_encoding(spark, db):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op10_byte_bpe"](spark, SF).collect()}
    assert got == encodings((i, t) for i, t, *_ in texts(db))


def test_pipeline_stage_by_stage(spark, db):
    """Each stage against a brute-force version, on what the stage before it left."""
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "jaccard_join", "benchmark_decontamination", "byte_bpe"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {r["doc_id"] for r in QUERIES["op9_quality_rules"](spark, SF).collect() if r["kept"]}
    rows = [r for r in texts(db) if r[0] in kept]
    bench = db.execute("select item_id, text from benchmark").fetchall()
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, SF).cache()
        if name == "line_dedup":
            cleaned = test_line_dedup.brute(rows, 10)
            new = {i: (t, gone) for i, t, _, gone in cleaned}
            rows = [(i, new[i][0], *rest, len(new[i][0])) for i, _, *rest, _ in rows if not new[i][1] or new[i][0].split()]
        elif name == "jaccard_join":
            label = {i: c if n else i for i, n, c in test_jaccard_join.brute(rows)}
            rows = [r for r in rows if label[r[0]] == r[0]]
        elif name == "benchmark_decontamination":
            left = []
            for i, text, *rest, _ in rows:
                hit, _ = test_decontaminate.brute(text, bench, 10)
                if len(hit) <= 0.5 * len(test_decontaminate.words(text)):
                    new_text = next(r["text"] for r in docs.filter(f"doc_id = {i}").collect()) if hit else text
                    assert not test_decontaminate.brute(new_text, bench, 10)[0]
                    assert not hit or len(test_decontaminate.words(new_text)) == len(test_decontaminate.words(text)) - len(hit)
                    left.append((i, new_text, *rest, len(new_text)))
            rows = left
        if name == "byte_bpe":
            assert {r["doc_id"]: tuple(r)[1:4] for r in docs.collect()} == encodings((r[0], r[1]) for r in rows)
            assert {r["doc_id"]: r["text"] for r in docs.collect()} == {r[0]: r[1] for r in rows}
            assert all(hashlib.sha256(r["ids"]).hexdigest() == r["ids_sha256"] and len(r["ids"]) == 4 * r["n_tokens"] for r in docs.collect())
        else:
            assert docs.columns == columns
            assert Counter(map(tuple, docs.collect())) == Counter(rows)
    assert corpus_pipeline.run(spark, SF).count() == len(rows)


def test_pipeline_on_awkward_tables(spark, tmp_path):
    """Null and blank texts, shared and missing ids, copies, further columns; and no rows at all. Nothing stays staged but the last copy."""
    good = spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'en'").limit(30)
    awkward = common.docs(spark).select(*good.columns, "score", "text").toDF(*good.columns, "score", "extra")
    frame = good.withColumns({"score": F.lit(1), "extra": F.lit("x")}).unionByName(awkward)
    first = good.orderBy("doc_id").first()
    same = spark.createDataFrame([(None, first["text"], "en", "b", 0, 1, None), (None, first["text"], "en", "b", 0, 1, None),
                                  (first["doc_id"], first["text"], "en", "b", 0, 1, None)], frame.schema)
    for name, rows in (("full", frame.union(same)), ("empty", frame.limit(0))):
        rows.write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / name / "benchmark.parquet"))
    folder = Path(shared_dir(spark)) / "feedquality"
    before = set(folder.iterdir()) if folder.exists() else set()
    result = corpus_pipeline.run(spark, str(tmp_path / "full"))
    assert len(set(folder.iterdir()) - before) == 1
    found = result.collect()
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "text", "ids"]
    assert found and all((r["text"] or "").split() and hashlib.sha256(r["text"].encode()).hexdigest() == r["decoded_sha256"] for r in found)
    assert len({r["text"] for r in found}) == len(found)
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).collect() == []


def test_an_import_error_of_the_operators_is_not_swallowed(monkeypatch):
    monkeypatch.setitem(__import__("sys").modules, "feedquality.llm.bpe", None)
    monkeypatch.delitem(__import__("sys").modules, "corpus_pipeline", raising=False)
    with pytest.raises(ModuleNotFoundError):
        importlib.import_module("corpus_pipeline")
