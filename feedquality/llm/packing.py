"""Packing documents into training sequences by best-two-fit.

A document is its token ids and one end token. Only a document longer than a sequence is
cut, into pieces of a sequence's length of which the first may be shorter. A sequence is
filled greedily, the longest piece that fits first. Where room is left, its smallest piece
is replaced by the two unpacked pieces that fill the room, grown by that piece, most tightly.

What fits depends on lengths alone, so the plan is made on the driver from the number of
pieces of each length: at most as many numbers as a sequence has tokens, whatever the input.
A filling that was found is repeated until one of its lengths runs out, which gives the
sequences that filling one after the other would give, and bounds the number of fillings by
the sequence length and not by the corpus. Pieces of a length are interchangeable: each is
numbered, within the task that encoded it and by the counts of the tasks before, and its
number says which place of its length it takes. No task sees more than its own pieces.

The ids are those of the vocabulary's own library. Where it is proved that merging by rank
is merging by the list of merges (see ``proved``), texts of characters whose classes are the
same in all Unicode versions are encoded by rank, which is faster; all others, and those with
added tokens or very long runs of blanks, by the library itself.

Null and empty texts are one end token. Documents may share an id or have none; repeated
rows are packed each for itself. Texts are handled whole, one at a time. An empty table
gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from feedquality.llm.text import map_batches, read
from feedquality.llm.token_counts import PATTERN, STABLE, byte_letters, merged_length
from feedquality.session import stage

SEQUENCE = 2048
#: Ends each document.
END = 0
#: Longer runs of blanks are left to the library, whose splitter doesn't recurse.
BLANKS = 1000

PIECES = T.StructType([
    T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
    T.StructField("block", T.IntegerType()), T.StructField("number", T.LongType()),
])
PLACE = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])


class Plan(NamedTuple):
    """Places in the order of length and number. From ``start`` on, pieces of ``length`` go to
    the sequences from ``first`` on, ``uses`` to each, beginning at ``offset``."""

    base: np.ndarray
    start: np.ndarray
    length: np.ndarray
    first: np.ndarray
    uses: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these numbers among those of their length."""
        at = self.base[length] + number
        slot = np.searchsorted(self.start, at, "right") - 1
        nth = at - self.start[slot]
        return self.first[slot] + nth // self.uses[slot], self.offset[slot] + nth % self.uses[slot] * length


def tighter_pair(left: np.ndarray, used: Counter, room: int, least: int) -> tuple[int, int] | None:
    """The two free lengths whose sum comes closest to ``room`` from below and exceeds ``least``."""
    free = left[:room + 1].copy()
    for length, n in used.items():
        if length <= room:
            free[length] -= n
    lengths = np.flatnonzero(free > 0)
    if not len(lengths):
        return None
    nearest = np.zeros(room + 1, np.int64)
    nearest[lengths] = lengths
    nearest = np.maximum.accumulate(nearest)
    small = lengths[lengths <= room // 2]
    large = nearest[room - small]
    good = (large > small) | ((large == small) & (free[small] > 1))
    small, large = small[good], large[good]
    if not len(small):
        return None
    best = int(np.argmax(small + large))
    pair = int(small[best]), int(large[best])
    return pair if sum(pair) > least else None


def fill(left: np.ndarray, lengths: list[int], size: int) -> Counter:
    """One sequence from what is left: how many pieces of which lengths. ``lengths`` are those left, ascending."""
    used: Counter = Counter()
    gap, i = size, len(lengths)
    while gap and (i := bisect_right(lengths, gap, 0, i)):
        length = lengths[i - 1]
        used[length] = min(int(left[length]), gap // length)
        gap -= used[length] * length
        i -= 1
    least = min(used)
    if gap and used.total() > 1 and (pair := tighter_pair(left, used, gap + least, least)):
        used[least] -= 1
        used.update(pair)
    return +used


def plan(counts: dict[int, int], size: int) -> Plan:
    """Best-two-fit for ``counts`` pieces of each length."""
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    base = np.concatenate([[0], np.cumsum(left)[:-1]])
    taken, places, sequence = base.copy(), [], 0
    lengths = [int(x) for x in np.flatnonzero(left)]
    while lengths:
        used = fill(left, lengths, size)
        times = min(int(left[length]) // n for length, n in used.items())
        offset = 0
        for length, n in sorted(used.items(), reverse=True):
            places.append((int(taken[length]), length, sequence, n, offset))
            taken[length] += n * times
            left[length] -= n * times
            offset += n * length
            if not left[length]:
                lengths.remove(length)
        sequence += times
    columns = np.array(sorted(places), np.int64).reshape(-1, 5).T
    return Plan(base, *columns, sequence)


def proved(spec: dict[str, Any]) -> dict[bytes, int] | None:
    """The tokens as ranks, if joining neighbours by rank is the same as by the list of merges.

    It is if ids rise with the merges and each token, merged alone, comes out whole: neighbours
    that make up a token have been merged up to there as the token alone would be, since nothing
    was merged across its ends, so they are the pair that its merge names. None otherwise.
    """
    letters, vocab = byte_letters(), spec["model"]["vocab"]
    added = {t["content"] for t in spec["added_tokens"]}
    made = [vocab[a + b] for a, b in spec["model"]["merges"]]
    plain = {token: i for token, i in vocab.items() if token not in added}
    if made != sorted(set(made)) or len(made) + 256 != len(plain):
        return None
    merges = {(vocab[a], vocab[b]): (i, i) for i, (a, b) in zip(made, spec["model"]["merges"], strict=True)}
    ranks = {}
    for token, i in plain.items():
        if merged_length([vocab[c] for c in token], merges) != 1:
            return None
        ranks[bytes(letters[c] for c in token)] = i
    return ranks


def encoder(vocabulary: str, ranks: dict[bytes, int] | None) -> Callable[[str], np.ndarray]:
    """A function from a text to its ids, by the library's file and what was proved of it."""
    import tiktoken
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(vocabulary)
    library.no_truncation()
    library.no_padding()
    added = [re.escape(t["content"]) for t in json.loads(vocabulary)["added_tokens"]]
    odd = re.compile("|".join([rf"\s{{{BLANKS}}}", *added])).search
    unstable = re.compile(f"[^{STABLE}]").search
    by_rank = ranks and tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(text: str) -> np.ndarray:
        if not by_rank or odd(text) or not text.isascii() and unstable(text):
            return np.array(library.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(by_rank.encode_ordinary(text), "<u4")

    return ids


def pieces(docs: DataFrame, path: str, size: int = SEQUENCE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document as pieces of at most ``size`` ids, staged: the key, ``piece``, ``start``, ``length``,
    ``ids`` (little-endian unsigned 32-bit numbers), and ``number`` among the pieces of a length in ``block``.

    Blocks are tasks. Staging keeps the rows of one attempt of each, so the numbers have no gaps.
    """
    with open(path, encoding="utf-8") as file:
        vocabulary = file.read()
    shared = docs.sparkSession.sparkContext.broadcast({"file": vocabulary, "ranks": proved(json.loads(vocabulary))})
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = shared.value  # stays with the worker
        if "ids" not in held:
            held["ids"] = encoder(held["file"], held["ranks"])
        ids, block, numbers = held["ids"], TaskContext.get().partitionId(), Counter()
        for batch in batches:
            row, columns = [], [[] for _ in PIECES]
            for i, value in enumerate(batch.column(1)):
                whole = np.append(ids(value.as_py() or ""), np.uint32(END)).astype("<u4")
                ends = range(len(whole) % size or size, len(whole) + 1, size)
                for nth, end in enumerate(ends):
                    start = ends[nth - 1] if nth else 0
                    row.append(i)
                    for column, v in zip(columns, (nth, start, end - start, whole[start:end].tobytes(), block,
                                                   numbers[end - start]), strict=True):
                        column.append(v)
                    numbers[end - start] += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, (
                    pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()), strict=True))],
                names=["key", *PIECES.names])

    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), *PIECES])
    return stage(map_batches(rows, cut, schema), "pieces").withColumnRenamed("key", key)


def placed(docs: DataFrame, spark: SparkSession, found: Plan) -> Column:
    """Sequence and offset from the columns ``length`` and ``number``."""
    shared = spark.sparkContext.broadcast(found)

    @F.arrow_udf(PLACE)
    def each(length: pa.Array, number: pa.Array) -> pa.Array:
        sequence, offset = shared.value.place(length.to_numpy(zero_copy_only=False), number.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                                          names=["sequence_id", "offset"])

    return each("length", "number")


def pack(docs: DataFrame, path: str, size: int = SEQUENCE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every piece with its ``ids``, its ``sequence_id`` (from 0, no gaps) and its ``offset`` there."""
    spark = docs.sparkSession
    cut = pieces(docs, path, size, key, text)
    counts = stage(cut.groupBy("block", "length").agg(F.count("*").alias("n")), "piece-counts")
    found = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, size)
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("block", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = cut.join(before, ["block", "length"]).withColumn("number", F.col("number") + F.col("before"))
    return numbered.withColumn("place", placed(numbered, spark, found)).select(
        key, "piece", "start", "length", "ids", "place.sequence_id", "place.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``n_tokens``, ``n_pieces`` and the joined ``ids``. A group
    holds one sequence's pieces, never more than a sequence has tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.count("*").alias("n_pieces"), parts.alias("parts")).select(
        "sequence_id", "n_tokens", "n_pieces",
        F.aggregate("parts", F.lit(b"").cast("binary"), lambda whole, part: F.concat(whole, part["ids"])).alias("ids"))


def op13_packing(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    packed = pack(read(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
