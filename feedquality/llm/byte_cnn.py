"""Quality classifier: a convolutional network over bytes, in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. Learned filters
of ``WIDTH`` bytes slide over each chunk; a filter's weight for each byte at each place is
looked up in a table, which is a convolution over one-hot bytes. The largest response of
each filter in a chunk, the mean of these over the chunks and their maximum go into one
logistic unit, which gives the probability that the text is of good quality.

The network learns, by gradient descent with momentum (Adam), from labelled documents that
are not held out. The sample is bounded: ``SAMPLE`` documents of each label, those whose
ids hash lowest. Learning and scoring read texts whole. Neither labels nor any other column is an input of a score.

Held out are documents for which crc32 of the id, as text, leaves no remainder by 5. Null
and empty texts are one chunk of padding and are scored like any other. Rows with a null
doc_id are scored, not held out, and never learned from. A document with labels of both
kinds is not learned from. Without labels of both kinds all scores are the share of good
ones (one half without any). Repeated rows and clashing extra columns need no care.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from feedquality.llm.text import bound_batches, read

CHUNK, STRIDE = 512, 384
WIDTH, FILTERS = 5, 16
#: Documents of each label that are learned from at most.
SAMPLE = 1500
EPOCHS, GROUP, RATE, DECAY = 14, 32, 0.01, 1e-5
THRESHOLD = 0.3
#: Chunks whose responses are computed together; they take 4 MB.
TOGETHER = 128


def chunks_of(raw: bytes) -> np.ndarray:
    """The chunks of a text as rows, the last one filled up with zeros."""
    n = max(1, -(-(len(raw) - (CHUNK - STRIDE)) // STRIDE))
    padded = np.zeros(STRIDE * (n - 1) + CHUNK, np.uint8)
    padded[:len(raw)] = np.frombuffer(raw, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STRIDE]


@dataclass
class Network:
    tables: np.ndarray  # (WIDTH, 256, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    weights: np.ndarray  # (2 * FILTERS,): of the means, then of the maxima
    offset: float

    def responses(self, chunks: np.ndarray) -> np.ndarray:
        """(chunks, positions, FILTERS): each filter's response at each place."""
        places = CHUNK - WIDTH + 1
        total = self.tables[0][chunks[:, :places]]
        for k in range(1, WIDTH):
            total += self.tables[k][chunks[:, k:k + places]]
        return total

    def largest(self, chunks: np.ndarray) -> np.ndarray:
        """(chunks, FILTERS): the largest response in each chunk, none below zero."""
        parts = [self.responses(chunks[at:at + TOGETHER]).max(axis=1) for at in range(0, len(chunks), TOGETHER)]
        return np.maximum(np.concatenate(parts) + self.bias, 0)

    def score(self, mean: np.ndarray, most: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(np.hstack([mean, most]) @ self.weights + self.offset).clip(-30, 30)))


def train(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Network:
    """Learn from the chunks of each text. Both labels weigh the same."""
    rng = np.random.default_rng(seed)
    net = Network((rng.standard_normal((WIDTH, 256, FILTERS)) * 0.1).astype(np.float32),
                  np.zeros(FILTERS, np.float32), (rng.standard_normal(2 * FILTERS) * 0.1).astype(np.float32), 0.0)
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    shapes = [net.tables.shape, net.bias.shape, net.weights.shape, (1,)]
    first, second = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * 0.5 ** (epoch / 5)
        order = rng.permutation(len(texts))
        for at in range(0, len(order), GROUP):
            group = order[at:at + GROUP]
            sizes = np.array([len(texts[i]) for i in group])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            chunks = np.concatenate([texts[i] for i in group])
            best = np.empty((len(chunks), FILTERS), np.int64)
            value = np.empty((len(chunks), FILTERS), np.float32)
            for k in range(0, len(chunks), TOGETHER):
                responses = net.responses(chunks[k:k + TOGETHER])
                best[k:k + TOGETHER] = responses.argmax(axis=1)
                value[k:k + TOGETHER] = responses.max(axis=1)
            value += net.bias
            live = value > 0
            value = np.maximum(value, 0)
            mean = np.add.reduceat(value, starts) / sizes[:, None]
            most = np.maximum.reduceat(value, starts)
            error = (net.score(mean, most) - labels[group]) * weight[group] / len(group)
            # back through the unit, the mean and the maximum, to the places that responded most
            to_mean, to_most = error[:, None] * net.weights[:FILTERS], error[:, None] * net.weights[FILTERS:]
            owner = np.repeat(np.arange(len(group)), sizes)
            back = (to_mean / sizes[:, None])[owner] + to_most[owner] * (value == most[owner])
            back *= live
            tables = np.zeros(net.tables.shape)
            rows, filters = np.arange(len(chunks))[:, None], np.arange(FILTERS)[None, :]
            for k in range(WIDTH):
                np.add.at(tables[k], (chunks[rows, best + k], np.broadcast_to(filters, best.shape)), back)
            grads = [tables, back.sum(axis=0), np.concatenate([error @ mean, error @ most]), np.array([error.sum()])]
            step += 1
            values = [net.tables, net.bias, net.weights, np.array([net.offset])]
            for j, (g, v) in enumerate(zip(grads, values, strict=True)):
                g = g + DECAY * v
                first[j] = 0.9 * first[j] + 0.1 * g
                second[j] = 0.999 * second[j] + 0.001 * g * g
                v -= (rate * (first[j] / (1 - 0.9 ** step))
                      / (np.sqrt(second[j] / (1 - 0.999 ** step)) + 1e-8)).astype(v.dtype)
            net.offset = float(values[3][0])
    return net


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Network | float:
    """Learn from the sample, or give the share of good labels if there is nothing to tell apart."""
    usable = labels.filter("doc_id is not null and quality in (0, 1)").filter(~held_out(F.col("doc_id")))
    # each id once, unless its labels differ
    agreed = (usable.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
              .filter("quality = other"))
    known: dict[int, int] = {}
    for quality in (0, 1):  # the lowest hashes, SAMPLE ids of each
        rows = (agreed.filter(F.col("quality") == quality).select("doc_id")
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).collect())
        known |= {row["doc_id"]: quality for row in rows}
    good = sum(known.values())
    if not 0 < good < len(known):
        return good / len(known) if known else 0.5
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(i,) for i in sorted(known)], "doc_id long")  # 2 * SAMPLE ids at most
    sample = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(wanted), "doc_id", "left_semi")
    once = sample.groupBy("doc_id").agg(F.max(F.coalesce("text", F.lit(""))).alias("text"))
    found = {row["doc_id"]: row["text"] for row in once.toLocalIterator()}  # a row for each id at most
    ids = sorted(found)
    labels_of = np.array([known[i] for i in ids])
    if not ids or labels_of.min() == labels_of.max():
        return float(labels_of.mean()) if ids else 0.5
    return train([chunks_of(found[i].encode()) for i in ids], labels_of)


def scored(docs: DataFrame, model: Network | float) -> Column:
    """The probability that each text is of good quality."""
    if isinstance(model, float):
        return F.lit(model)
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(
        {"tables": model.tables, "bias": model.bias, "weights": model.weights, "offset": model.offset})

    @F.arrow_udf(T.DoubleType())
    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = Network(**shared.value)
        for texts in batches:
            out: list[float] = []
            waiting: list[np.ndarray] = []
            held = 0

            def flush() -> None:
                if waiting:
                    sizes = np.array([len(c) for c in waiting])
                    value = net.largest(np.concatenate(waiting))
                    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
                    mean = np.add.reduceat(value, starts) / sizes[:, None]
                    out.extend(net.score(mean, np.maximum.reduceat(value, starts)).tolist())
                    waiting.clear()

            for text in texts:
                chunks = chunks_of((text.as_py() or "").encode())
                waiting.append(chunks)
                held += len(chunks)
                if held >= 8 * TOGETHER:
                    flush()
                    held = 0
            flush()
            yield pa.array(out, pa.float64())

    return each(F.col("text"))


def classify(docs: DataFrame, model: Any, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted``."""
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored(docs, model).alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)))


def op7_byte_cnn(spark, sf):
    docs = read(spark, sf, "documents")
    return classify(docs, fit(docs, read(spark, sf, "labels")))
