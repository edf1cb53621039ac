from __future__ import annotations

import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from feedquality.llm import byte_cnn as b
from tests.llm.common import docs, empty, sentence


def test_chunks_cover_every_byte_and_overlap():
    for n in (0, 1, b.CHUNK - 1, b.CHUNK, b.CHUNK + 1, 5 * b.STRIDE, 12_345):
        raw = bytes(1 + i % 255 for i in range(n))
        chunks = b.chunks_of(raw)
        whole = np.zeros(b.STRIDE * (len(chunks) - 1) + b.CHUNK, np.uint8)
        for i, c in enumerate(chunks):
            whole[i * b.STRIDE:i * b.STRIDE + b.CHUNK] = c
        assert whole[:n].tobytes() == raw and not whole[n:].any()


def test_responses_are_a_convolution():
    rng = np.random.default_rng(0)
    net = b.Network(rng.standard_normal((b.WIDTH, 256, b.FILTERS)).astype(np.float32), rng.standard_normal(b.FILTERS),
                    rng.standard_normal(2 * b.FILTERS), 0.5)
    chunk = rng.integers(0, 256, (1, b.CHUNK)).astype(np.uint8)
    hot = np.eye(256)[chunk[0]]
    plain = np.array([[sum(hot[t + k] @ net.tables[k, :, f] for k in range(b.WIDTH)) for f in range(3)] for t in range(40)])
    assert np.allclose(net.responses(chunk)[0, :40, :3], plain, atol=1e-4)
    assert np.allclose(net.largest(chunk), np.maximum(net.responses(chunk)[0].max(axis=0) + net.bias, 0))


def plain_score(net, raw):
    """The probability by loops over chunks, places and filters."""
    chunks = [raw[at:at + b.CHUNK] for at in range(0, max(1, len(raw) - (b.CHUNK - b.STRIDE)), b.STRIDE)]
    largest = []
    for chunk in chunks:
        chunk = chunk + bytes(b.CHUNK - len(chunk))
        best = [max(sum(float(net.tables[k, chunk[t + k], f]) for k in range(b.WIDTH)) for t in range(b.CHUNK - b.WIDTH + 1))
                for f in range(b.FILTERS)]
        largest.append([max(0.0, x + float(net.bias[f])) for f, x in enumerate(best)])
    total = net.offset
    for f in range(b.FILTERS):
        column = [row[f] for row in largest]
        total += net.weights[f] * sum(column) / len(column) + net.weights[b.FILTERS + f] * max(column)
    return 1 / (1 + math.exp(-max(-30, min(30, total))))


def test_scores_are_those_of_plain_loops(spark):
    rng = np.random.default_rng(5)
    net = b.Network((rng.standard_normal((b.WIDTH, 256, b.FILTERS)) * 0.2).astype(np.float32),
                    (rng.standard_normal(b.FILTERS) * 0.2).astype(np.float32),
                    (rng.standard_normal(2 * b.FILTERS) * 0.2).astype(np.float32), -0.3)
    texts = ["", None, "short", sentence(90, 3), "日本語 " * 200, sentence(400, 4), "x" * (b.CHUNK + 1)]
    frame = docs(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)])
    got = {r["doc_id"]: r["score"] for r in b.classify(frame, net).collect()}
    for i, text in enumerate(texts):
        assert abs(got[i] - plain_score(net, (text or "").encode())) < 1e-4


def test_whole_texts_are_learned_from(spark, monkeypatch):
    monkeypatch.setattr(b, "train", lambda chunks, labels: [c.tobytes() for c in chunks])
    long = sentence(20_000, 9)
    frame = docs(spark, [(i, long if i == 1 else f"text {i}", "en", "a", 0) for i in range(1, 9)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 9)], "doc_id long, quality int, toxic int")
    assert b.chunks_of(long.encode()).tobytes() in b.fit(frame, labels)


def corpus(n=240):
    draw = random.Random(0)
    out = []
    for i in range(n):
        text = sentence(draw.randint(30, 300), i)
        out.append((i, text if i % 3 else " ".join(w + draw.choice(["###", "%%"]) for w in text.split()), "en", "a", 0))
    return out


def test_it_learns_without_the_held_out(spark, monkeypatch):
    monkeypatch.setattr(b, "EPOCHS", 4)
    frame = docs(spark, corpus())
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(240)], "doc_id long, quality int, toxic int")
    model = b.fit(frame, labels)
    rows = b.classify(frame, model).collect()
    assert len(rows) == 240
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    right = [r["predicted"] == int(r["doc_id"] % 3 > 0) for r in rows if r["held_out"]]
    assert sum(right) >= 0.95 * len(right)
    # labels of held-out documents have no influence
    turned = labels.withColumn("quality", F.when(b.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(b.fit(frame, turned).tables, model.tables)
    awkward = docs(spark)
    got = b.classify(awkward, model).collect()
    assert len(got) == awkward.count() and all(0 <= r["score"] <= 1 for r in got)
    assert all(not r["held_out"] for r in got if r["doc_id"] is None)
    assert b.classify(empty(spark), model).count() == 0


def test_without_labels_to_tell_apart(spark):
    frame = docs(spark)
    schema = "doc_id long, quality int, toxic int"
    assert b.fit(frame, spark.createDataFrame([], schema)) == 0.5
    assert b.fit(frame, spark.createDataFrame([(None, 1, 0), (1, None, 0)], schema)) == 0.5
    one = spark.createDataFrame([(i, 1, 0) for i in range(1, 10)], schema)
    assert b.fit(frame, one) == 1.0 and {r["score"] for r in b.classify(frame, 1.0).collect()} == {1.0}
    both = spark.createDataFrame([(1, 1, 0), (1, 0, 0)], schema)
    assert b.fit(frame, both) == 0.5


def test_repeated_rows_and_labels_do_not_fill_the_sample(spark, monkeypatch):
    monkeypatch.setattr(b, "SAMPLE", 20)
    monkeypatch.setattr(b, "train", lambda chunks, labels: (chunks, labels.tolist()))
    schema = "doc_id long, quality int, toxic int"
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(240)], schema)
    frame = docs(spark, corpus())
    chunks, of = b.fit(frame, labels)
    assert (of.count(0), of.count(1)) == (20, 20)
    kind, fetched = type(frame), []
    each = kind.toLocalIterator

    def counted(self, *args, **kwargs):
        for row in each(self, *args, **kwargs):
            fetched.append(row)
            yield row

    monkeypatch.setattr(kind, "toLocalIterator", counted)
    many = F.explode(F.sequence(F.lit(1), F.lit(30)))
    again = b.fit(frame.withColumn("k", many).drop("k"), labels.withColumn("k", many).drop("k"))
    assert again[1] == of and all(map(np.array_equal, again[0], chunks))
    assert len(fetched) == 40
    # labels that differ don't use up the sample either
    unsure = labels.union(labels.filter("doc_id < 60").withColumn("quality", 1 - F.col("quality")))
    assert sorted(b.fit(frame, unsure)[1]) == [0] * 20 + [1] * 20
