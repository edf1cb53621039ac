"""N-gram Jaccard join by T-occurrence search.

A document is the set of its distinct 5-word shingles, as 64-bit hashes. Documents with
equal sets are one record ``v`` (a 128-bit hash of the set). Two records link when the
intersection is three quarters of the union or more, so a record of ``n`` shingles shares
at least ``T = ceil(3n / 4)`` with any partner. Its shingles name ``n`` inverted lists. They
are divided as in DivideSkip: the ``T - 1`` longest lists can't make a partner by
themselves, so each partner is in one of the other, short ones.

1. ``records``: sets, and how often shingles occur by a counting sketch of fixed size over
   all texts. It ranks lists from short to long; any ranking gives the same links.
2. ``short_lists``: the short lists of all records, dealt out by shingle. A list of a
   common shingle is dealt out in parts by record, so that no task holds it whole. Lists
   are merged by sorting; each record votes for the first record in each list
   that it can link with, and the one with most votes becomes its leader.
3. ``linked``: a leader's block of records forms an index of inverted lists, in which the
   leader's shingles are the query: the short lists are merged by a heap that skips
   records which can't reach the overlap, the long ones are probed by binary search.
4. Links make components. Before any link is verified, records whose votes make a link
   likely are taken as groups, and pairs between groups are formed only if they meet in as
   many short lists as a link needs (``needed_in_short``, and by where in the ranking the
   short lists of either end, ``can_link``). Where verified links leave a group in several components
   and not all pairs between these have been tried (``untried``), single records of them are searched
   for first; then all records outside the group's largest component, in every block of the group.

So no pairs are formed within a group of copies: a group of ``m`` near copies takes some
``m`` comparisons, and yet every two records that link are in one component.

Null texts, empty ones and those of blanks have no shingles, link with nothing, and are
their own component. Rows with a null doc_id take part, but name no component; a component
without any doc_id has a null one. Repeated rows are equal records. An empty table gives an
empty result.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from feedquality.llm.components import components, merged
from feedquality.llm.text import map_batches, read
from feedquality.session import stage, stage_buckets

SHINGLE = 5
#: The counting sketch: 2 ** SKETCH_BITS counters, moved in blocks.
SKETCH_BITS, BLOCK = 19, 1 << 15
#: A list that the sketch puts above this many records is dealt out in parts of about this size.
LIST_PART = 50_000
#: Records in one block of a leader.
INDEX_BLOCK = 256
#: Parts of a broken group are searched for by single records as long as one pair in so many links.
WORTH = 2
#: Postings that a worker gathers before it passes them on.
GATHERED = 1_000_000

#: Odd multipliers for the places of a shingle, and for the last mixing.
PLACES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
MIX = 0xFF51AFD7ED558CCD


def least_overlap(n: int) -> int:
    """What a record of ``n`` shingles shares with any partner at least."""
    return (3 * n + 3) // 4


def pair_overlap(n: int, m: int) -> int:
    """What records of ``n`` and ``m`` shingles share if they link, at least."""
    return (3 * (n + m) + 6) // 7


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted; sorts in place."""
    values.sort()
    first = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=first[1:])
    return values[first]


def shingles_of(text: str | None) -> np.ndarray:
    """The distinct shingles of a text, sorted."""
    import xxhash

    # bytes are split at the six ASCII blanks, and only A-Z becomes small
    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    if n < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=n)], np.uint64)
    ids = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    mixed = ids[:n - SHINGLE + 1] * np.uint64(PLACES[0])
    for k, odd in enumerate(PLACES[1:], 1):
        mixed += ids[k:n - SHINGLE + 1 + k] * np.uint64(odd)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(MIX)
    mixed ^= mixed >> np.uint64(29)
    return distinct(mixed)


def record_id(shingles: np.ndarray) -> bytes:
    import xxhash
    return xxhash.xxh3_128_digest(shingles.tobytes())


# --- 1. records and the ranking of lists -------------------------------------------

RECORDS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("t1", T.LongType()), T.StructField("t2", T.LongType()),
    T.StructField("v", T.BinaryType()), T.StructField("n", T.LongType()),
    T.StructField("block", T.IntegerType()), T.StructField("counts", T.BinaryType()),
])


def _batch(schema: T.StructType, columns: list[list]) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)


def _record_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << SKETCH_BITS, np.uint32)
    waiting: list[np.ndarray] = []
    held = 0
    seen: set[bytes] = set()
    shift = np.uint64(64 - SKETCH_BITS)
    for batch in batches:
        ids, first, second, texts = (c.to_pylist() for c in batch.columns)
        vs, ns = [], []
        for text in texts:
            s = shingles_of(text)
            v = record_id(s) if len(s) else None
            vs.append(v)
            ns.append(len(s))
            if v is not None and v not in seen:
                seen.add(v)
                waiting.append((s >> shift).astype(np.int64))
                held += len(s)
        if held > 1 << SKETCH_BITS:
            counts += np.bincount(np.concatenate(waiting), minlength=len(counts)).astype(np.uint32)
            waiting, held = [], 0
        none = [None] * len(ids)
        yield _batch(RECORDS, [ids, first, second, vs, ns, none, none])
    if waiting:
        counts += np.bincount(np.concatenate(waiting), minlength=len(counts)).astype(np.uint32)
    for block in range(len(counts) // BLOCK):
        part = counts[block * BLOCK:(block + 1) * BLOCK]
        if part.any():
            yield _batch(RECORDS, [[None], [None], [None], [None], [None], [block], [part.tobytes()]])


SUMS = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("counts", T.BinaryType())])


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if block not in total:
                total[block] = np.zeros(BLOCK, np.uint64)
            total[block] += np.frombuffer(counts, np.uint32)
    for block, counts in total.items():
        yield _batch(SUMS, [[block], [counts.tobytes()]])


def records(docs: DataFrame) -> tuple[DataFrame, Broadcast]:
    """The record of each row, and the sketch: how often the shingles of each counter occur."""
    key = [F.xxhash64(F.lit(i), "text").alias(f"t{i}") for i in (1, 2)]
    both = stage(map_batches(docs.select(F.col("doc_id").cast("long"), *key, "text"), _record_batches, RECORDS), "records")
    blocks = both.filter("block is not null").select("block", "counts")
    sums = map_batches(blocks.repartition((1 << SKETCH_BITS) // BLOCK, "block"), _sum_blocks, SUMS)
    counts = np.zeros(1 << SKETCH_BITS, np.uint64)
    for row in sums.collect():  # 2 ** SKETCH_BITS numbers, whatever the input
        counts[row["block"] * BLOCK:(row["block"] + 1) * BLOCK] = np.frombuffer(row["counts"], np.uint64)
    return (both.filter("block is null").select("doc_id", "t1", "t2", "v", "n"),
            docs.sparkSession.sparkContext.broadcast(counts))


def above_chance(counts: np.ndarray) -> np.ndarray:
    """What each counter holds beyond the median one. All counters fill up as the corpus grows, so
    a list is known to be long only by how far its counter stands out."""
    return np.maximum(counts.astype(np.int64) - int(np.median(counts)), 0)


# --- 2. short lists ----------------------------------------------------------------

#: The places in a record's short lists whose ranks are known to all, in quarters of them.
QUARTERS = (2, 3, 4)

#: One row holds the postings of many records for one bucket: the shingles of the first
#: ``counts[0]`` of them are those of the first record, and so on; ``pos`` is a shingle's
#: place in its record's ranking. Or, without ``counts``, the ranks at ``QUARTERS`` of records.
POSTINGS = T.StructType([
    T.StructField("bucket", T.IntegerType()), T.StructField("vs", T.BinaryType()), T.StructField("ns", T.BinaryType()),
    T.StructField("counts", T.BinaryType()), T.StructField("tokens", T.BinaryType()), T.StructField("pos", T.BinaryType()),
])


def _narrow(values: np.ndarray) -> bytes:
    """Numbers in two bytes each if they fit, else in four."""
    return values.astype(np.uint16 if values.max() < 1 << 16 else np.uint32).tobytes()


def _wide(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, np.uint16 if len(packed) == 2 * n else np.uint32).astype(np.int64)


def _posting_batches(sketch: Broadcast, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def packed(vs: list, ns: list, marks: list, tokens: list, idx: list, pos: list) -> Iterator[pa.RecordBatch]:
        above = above_chance(sketch.value).astype(np.uint64)
        yield _batch(POSTINGS, [[int.from_bytes(vs[0][:4], "little") % buckets], [b"".join(vs)],
                                [np.array(ns, np.uint32).tobytes()], [None], [np.concatenate(marks).tobytes()], [None]])
        toks, owner, place = np.concatenate(tokens), np.concatenate(idx), np.concatenate(pos)
        ids = np.frombuffer(b"".join(vs), np.uint64).reshape(-1, 2)
        sizes = np.array(ns, np.uint32)
        parts = above[(toks >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] // np.uint64(LIST_PART) + np.uint64(1)
        mixed = toks * np.uint64(PLACES[0]) + (ids[owner, 0] % parts) * np.uint64(PLACES[1])
        bucket = ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")  # within a bucket still by record
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
        for begin, end in zip(edges[:-1], edges[1:], strict=True):
            rows = order[begin:end]
            own, times = np.unique(owner[rows], return_counts=True)
            yield _batch(POSTINGS, [
                [int(bucket[rows[0]])], [ids[own].tobytes()], [sizes[own].tobytes()], [_narrow(times)],
                [toks[rows].tobytes()], [_narrow(place[rows])]])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        # four steps to each doubling: near counts are ranked by the hash alone
        rank = np.rint(4 * np.log2(counts.astype(float) + 1)).astype(np.uint64)
        seen: set[bytes] = set()
        vs, ns, marks, tokens, idx, pos = [], [], [], [], [], []
        held = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                s = shingles_of(text)
                n = len(s)
                if not n or (v := record_id(s)) in seen:
                    continue
                seen.add(v)
                level = rank[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                place = level << np.uint64(56) | s >> np.uint64(8)
                order = np.argsort(place, kind="stable")
                short = n - least_overlap(n) + 1
                marks.append(place[order[[max(short * k // 4 - 1, 0) for k in QUARTERS]]] >> np.uint64(1))
                tokens.append(s[order[:short]])
                idx.append(np.full(short, len(vs), np.int64))
                pos.append(np.arange(short))
                vs.append(v)
                ns.append(n)
                held += short
                if held >= GATHERED:
                    yield from packed(vs, ns, marks, tokens, idx, pos)
                    vs, ns, marks, tokens, idx, pos = [], [], [], [], [], []
                    held = 0
        if vs:
            yield from packed(vs, ns, marks, tokens, idx, pos)

    return each


#: ``kind`` 0: record ``v`` of ``n`` shingles votes for ``w`` of ``m``, ``votes`` times, ``alone`` of
#: them in lists of these two only. 1: a posting in a longer list. 2: the same, first in its part of a list.
#: 3: the ranks of a record's shingles at ``QUARTERS`` of its short lists, in ``m``, ``votes`` and ``alone``.
LISTED = T.StructType([
    T.StructField("kind", T.IntegerType()), T.StructField("v", T.BinaryType()), T.StructField("n", T.LongType()),
    T.StructField("w", T.BinaryType()), T.StructField("m", T.LongType()), T.StructField("votes", T.LongType()),
    T.StructField("alone", T.LongType()), T.StructField("token", T.LongType()), T.StructField("pos", T.LongType()),
])


def _list_batches(sketch: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vs, ns, tokens, owner, pos, known = [], [], [], [], [], 0
        for batch in batches:
            for _, v, n, c, t, p in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if c is None:
                    sizes = np.frombuffer(n, np.uint32).tolist()
                    ranks = np.frombuffer(t, np.int64).reshape(-1, len(QUARTERS)).T.tolist()
                    none = [None] * len(sizes)
                    yield _batch(LISTED, [[3] * len(sizes), [v[16 * k:16 * k + 16] for k in range(len(sizes))], sizes, none,
                                          *ranks, none, none])
                    continue
                vs.append(np.frombuffer(v, np.uint64).reshape(-1, 2))
                ns.append(np.frombuffer(n, np.uint32))
                tokens.append(np.frombuffer(t, np.uint64))
                owner.append(np.repeat(np.arange(known, known + len(ns[-1])), _wide(c, len(ns[-1]))))
                pos.append(_wide(p, len(tokens[-1])))
                known += len(ns[-1])
        if not known:
            return
        # the same record may come from several tasks: number records afresh
        raw = np.concatenate(vs)
        order = np.lexsort((raw[:, 1], raw[:, 0]))
        fresh = np.ones(known, bool)
        fresh[1:] = (raw[order[1:]] != raw[order[:-1]]).any(axis=1)
        number = np.empty(known, np.int64)
        number[order] = np.cumsum(fresh) - 1
        ids, sizes = raw[order[fresh]], np.concatenate(ns)[order[fresh]].astype(np.int64)
        tok, own, place = np.concatenate(tokens), number[np.concatenate(owner)], np.concatenate(pos)
        del vs, ns, tokens, owner, pos
        # the lists merged: each by size and record, a record once
        order = np.lexsort((own, sizes[own], tok))
        tok, own, place = tok[order], own[order], place[order]
        first = np.ones(len(tok), bool)
        first[1:] = (tok[1:] != tok[:-1]) | (own[1:] != own[:-1])
        tok, own, place = tok[first], own[first], place[first]
        starts = np.flatnonzero(np.concatenate(([True], tok[1:] != tok[:-1])))
        lengths = np.diff(np.concatenate((starts, [len(tok)])))
        listed, length = np.repeat(np.arange(len(starts)), lengths), np.repeat(lengths, lengths)
        dealt = above_chance(sketch.value)[(tok >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] >= LIST_PART
        # the first record of the list that is not too small to link
        size = sizes[own]
        scale = np.int64(1 << 32)
        leader = np.searchsorted(listed * scale + size, listed * scale + (3 * size + 3) // 4)
        voting = np.flatnonzero(leader < np.arange(len(tok)))
        pairs, which = np.unique(own[voting] * np.int64(len(ids)) + own[leader[voting]], return_inverse=True)
        votes = np.bincount(which, minlength=len(pairs))
        alone = np.bincount(which, weights=(length == 2)[voting] & ~dealt[voting], minlength=len(pairs)).astype(np.int64)

        def name(numbers: np.ndarray) -> list[bytes]:
            return [ids[k].tobytes() for k in numbers]

        for at in range(0, len(pairs), 10_000):
            part = slice(at, at + 10_000)
            v, w = pairs[part] // len(ids), pairs[part] % len(ids)
            none = [None] * len(v)
            yield _batch(LISTED, [[0] * len(v), name(v), sizes[v].tolist(), name(w), sizes[w].tolist(),
                                  votes[part].tolist(), alone[part].tolist(), none, none])
        kind = np.where(dealt & np.isin(np.arange(len(tok)), starts), 2, 1)
        # of no use is a posting without another one in its list that is near it in size
        near = np.zeros(len(tok), bool)
        beside = (tok[1:] == tok[:-1]) & (4 * size[:-1] >= 3 * size[1:])
        near[1:] |= beside
        near[:-1] |= beside
        rows = np.flatnonzero((length > 2) & near | dealt)
        for at in range(0, len(rows), 10_000):
            some = rows[at:at + 10_000]
            none = [None] * len(some)
            yield _batch(LISTED, [kind[some].tolist(), name(own[some]), size[some].tolist(), none, none, none, none,
                                  tok[some].view(np.int64).tolist(), place[some].tolist()])

    return each


def short_lists(docs: DataFrame, sketch: Broadcast) -> DataFrame:
    """Votes, and the postings of lists that hold more than two records, of sizes that may link."""
    spark = docs.sparkSession
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    postings = map_batches(docs.select("text"), _posting_batches(sketch, partitions), POSTINGS)
    return stage(map_batches(postings.repartitionById(partitions, "bucket"), _list_batches(sketch), LISTED), "lists")


# --- 3. search in a leader's block ----------------------------------------------------

SETS = T.StructType([T.StructField("v", T.BinaryType()), T.StructField("shingles", T.BinaryType())])
#: Bits that tell most records that aren't wanted from those that are, before the shuffle.
BITMAP, BITMAP_ROW = 1 << 23, 1 << 15


def _set_batches(bits: Broadcast, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        bitmap = bits.value
        seen: set[int] = set()
        for batch in batches:
            vs, sets = [], []
            for text in batch.column(0).to_pylist():
                t1 = xxhash.xxh64_intdigest((text or "").encode(), seed=seed)
                place = t1 % BITMAP
                if t1 not in seen and bitmap[place >> 3] >> (place & 7) & 1:
                    seen.add(t1)
                    s = shingles_of(text)
                    if len(s):
                        vs.append(record_id(s))
                        sets.append(s.tobytes())
            yield _batch(SETS, [vs, sets])
    return each


def sets_of(docs: DataFrame, rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The shingles of the records ``wanted(v)``, and of few others, each record once. They are by far the
    widest rows of the join, so they lie in buckets of ``v`` and only what is joined to them moves."""
    spark = docs.sparkSession
    # one text for each record, known by its hash
    chosen = rows.filter("v is not null").groupBy("v").agg(F.min("t1").alias("t1")).join(wanted.distinct(), "v", "left_semi")
    place = F.pmod("t1", F.lit(BITMAP)) + 1
    parts = (chosen.groupBy(F.bitmap_bucket_number(place).alias("part"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect())
    bitmap = np.zeros(BITMAP >> 3, np.uint8)  # BITMAP bits, whatever the input
    for row in parts:
        at = (row["part"] - 1) * (BITMAP_ROW >> 3)
        bitmap[at:at + (BITMAP_ROW >> 3)] = np.frombuffer(row["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(bitmap.tobytes())
    # t1 is xxhash64 of 1 and the text: the hash of the text seeded by that of 1
    seed = spark.range(1).select(F.xxhash64(F.lit(1))).first()[0] % (1 << 64)
    found = map_batches(docs.select("text"), _set_batches(shared, seed), SETS)
    return stage_buckets(found.groupBy("v").agg(F.first("shingles").alias("shingles")), "sets", "v")


def divide_skip(lists: list[list[int]], need: int, weight: float = 0.01) -> dict[int, int]:
    """The numbers that occur in ``need`` of the sorted ``lists`` or more, and how often.

    The longest lists are set aside, by the rule that DivideSkip gives for how many. The
    others are merged through a heap: a number that can't occur in enough of them is
    skipped in all lists at the top together. What is left is looked up in the long lists.
    """
    lists = sorted((x for x in lists if x), key=len, reverse=True)
    if need < 1 or len(lists) < need:
        return {}
    n_long = min(need - 1, int(need / (weight * math.log2(max(2, len(lists[0]))) + 1)))
    long, short = lists[:n_long], lists[n_long:]
    enough = need - n_long
    heap = [(x[0], i, 0) for i, x in enumerate(short)]
    heapq.heapify(heap)
    found: dict[int, int] = {}
    while len(heap) >= enough:
        number = heap[0][0]
        top = []
        while heap and heap[0][0] == number:
            top.append(heapq.heappop(heap))
        if len(top) >= enough:
            count = len(top)
            for k, x in enumerate(long):
                if count + n_long - k < need:
                    break
                at = bisect_left(x, number)
                count += at < len(x) and x[at] == number
            if count >= need:
                found[number] = count
            for _, i, at in top:
                if at + 1 < len(short[i]):
                    heapq.heappush(heap, (short[i][at + 1], i, at + 1))
        else:
            while heap and len(top) < enough - 1:
                top.append(heapq.heappop(heap))
            if not heap:
                break
            bound = heap[0][0]
            for _, i, at in top:
                at = bisect_left(short[i], bound, at)
                if at < len(short[i]):
                    heapq.heappush(heap, (short[i][at], i, at))
    return found


LINKS = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])


def search_block(query: np.ndarray, members: list[np.ndarray]) -> list[int]:
    """Which members link with the query, by their inverted lists."""
    n = len(query)
    places = [np.searchsorted(query, m) for m in members]
    in_query = [np.flatnonzero(query[np.minimum(p, n - 1)] == m) for p, m in zip(places, members, strict=True)]
    shingle = np.concatenate([p[hit] for p, hit in zip(places, in_query, strict=True)])
    member = np.repeat(np.arange(len(members)), [len(hit) for hit in in_query])
    order = np.lexsort((member, shingle))
    cuts = np.flatnonzero(np.diff(shingle[order])) + 1
    lists = [x.tolist() for x in np.split(member[order], cuts)] if len(order) else []
    found = divide_skip(lists, max(least_overlap(n), min(pair_overlap(n, len(m)) for m in members)))
    return [k for k, count in found.items() if count >= pair_overlap(n, len(members[k]))]


def _search_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by block, the leader's first. One leader and one block of records are held."""
    block, leader, query = None, None, None
    names: list[bytes] = []
    members: list[np.ndarray] = []

    def searched() -> Iterator[pa.RecordBatch]:
        if members:
            linked = search_block(query, members)
            if linked:
                yield _batch(LINKS, [[leader] * len(linked), [names[k] for k in linked]])
        names.clear()
        members.clear()

    for batch in batches:
        for a, salt, b, shingles in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (a, salt) != block:
                yield from searched()
                block, leader, query = (a, salt), a, None
            if b is None:
                query = np.frombuffer(shingles, np.uint64)
            elif query is not None:
                names.append(b)
                members.append(np.frombuffer(shingles, np.uint64))
                if len(members) >= INDEX_BLOCK:
                    yield from searched()
    yield from searched()


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` that link. ``a`` leads; the block of a leader of many is cut in several."""
    spark = pairs.sparkSession
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / INDEX_BLOCK).alias("parts"))
    dealt = (pairs.join(parts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("parts")))
             .select("a", "salt", "b"))
    members = dealt.join(sets.withColumnRenamed("v", "b"), "b").select("a", "salt", "b", "shingles")
    leaders = (parts.join(sets.withColumnRenamed("v", "a"), "a")
               .select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("salt"),
                       F.lit(None).cast("binary").alias("b"), "shingles"))
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    blocks = (members.unionByName(leaders).repartition(partitions, "a", "salt")
              .sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first()))
    return stage(map_batches(blocks, _search_batches, LINKS), "links")


class BlockIndex:
    """The inverted lists of a block of records."""

    def __init__(self, members: list[np.ndarray]) -> None:
        self.sizes = [len(m) for m in members]
        shingle = np.concatenate(members)
        member = np.repeat(np.arange(len(members)), self.sizes)
        order = np.lexsort((member, shingle))
        self.member = member[order]
        self.shingles, self.starts = np.unique(shingle[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(order))

    def search(self, query: np.ndarray) -> list[int]:
        """Which members link with ``query``."""
        n = len(query)
        at = np.minimum(np.searchsorted(self.shingles, query), len(self.shingles) - 1)
        at = at[self.shingles[at] == query]
        lists = [self.member[s:e].tolist() for s, e in zip(self.starts[at].tolist(), self.ends[at].tolist(), strict=True)]
        found = divide_skip(lists, max(least_overlap(n), min(pair_overlap(n, m) for m in self.sizes)))
        return [k for k, count in found.items() if count >= pair_overlap(n, self.sizes[k])]


def _group_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by block, its members first and then the records to search for. A block is held."""
    block, index = None, None
    names: list[bytes] = []
    roots: list[bytes] = []
    members: list[np.ndarray] = []
    for batch in batches:
        out_a, out_b = [], []
        for group, number, asks, v, root, shingles in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (group, number) != block:
                block, index = (group, number), None
                names, roots, members = [], [], []
            values = np.frombuffer(shingles, np.uint64)
            if not asks:
                names.append(v)
                roots.append(root)
                members.append(values)
            elif members:
                if index is None:
                    index = BlockIndex(members)
                # one link to each component is enough
                met = {roots[k]: names[k] for k in index.search(values) if roots[k] != root}
                out_a += [v] * len(met)
                out_b += met.values()
        if out_a:
            yield _batch(LINKS, [out_a, out_b])


def untried(parts: DataFrame, tried: DataFrame) -> DataFrame:
    """Of ``parts(v, all, root)``, the groups in which two records of different components are no pair
    of ``tried(a, b)`` yet, with how many records the group has (``rows``).

    ``asks`` marks the records that are to be searched for: those outside the group's largest
    component that have not been tried with every record of the other components.
    """
    sizes = parts.groupBy("all", "root").agg(F.count(F.lit(1)).alias("same"))
    groups = sizes.groupBy("all").agg(F.sum("same").alias("rows"), F.max(F.struct("same", "root")).alias("largest"))

    def end(name: str) -> DataFrame:
        return parts.select(F.col("v").alias(name), F.struct("all", "root").alias(f"{name}_in"))

    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    done = (tried.select(*ends).distinct().join(end("a"), "a").join(end("b"), "b")
            .filter("a_in.all = b_in.all and a_in.root <> b_in.root")
            .select(F.explode(F.array("a", "b")).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("done")))
    marked = stage(
        parts.join(sizes, ["all", "root"]).join(groups, "all").join(done, "v", "left")
        .select("all", "v", "root", "rows", (
            (F.col("root") != F.col("largest.root"))
            & (F.coalesce("done", F.lit(0)) < F.col("rows") - F.col("same"))).alias("asks")), "marked")
    return marked.join(marked.filter("asks").select("all").distinct(), "all", "left_semi")


def linked_in_groups(parts: DataFrame, tried: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the components (``root``) of each group (``all``) of records ``v``.

    A group's records are dealt into blocks. All but those of its largest component, and
    those that have been tried with all others, are searched for in every block of the group.
    """
    spark = parts.sparkSession
    dealt = untried(parts, tried).withColumn("blocks", F.ceil(F.col("rows") / INDEX_BLOCK))
    held = dealt.select("all", F.pmod(F.xxhash64("v"), F.col("blocks")).alias("block"), F.lit(False).alias("asks"), "v", "root")
    asked = dealt.filter("asks").select(
        "all", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("asks"), "v", "root")
    rows = held.unionByName(asked).join(sets, "v").select("all", "block", "asks", "v", "root", "shingles")
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ordered = rows.repartition(partitions, "all", "block").sortWithinPartitions("all", "block", "asks", "v")
    return stage(map_batches(ordered, _group_batches, LINKS), "links")


# --- 4. components -------------------------------------------------------------------


def needed_in_short(n: Column, m: Column) -> Column:
    """In how many short lists records of ``n`` and ``m`` shingles meet if they link, at least.

    ``T - L``: of the ``T`` shingles that they share, no more than the ``L`` long lists of
    the larger one can be outside its short lists.
    """
    overlap, larger = F.floor((3 * (n + m) + 6) / 7), F.greatest(n, m)
    return F.greatest(overlap - F.floor((3 * larger + 3) / 4) + 1, F.lit(1))


def _with_root(df: DataFrame, column: str, roots: DataFrame, name: str) -> DataFrame:
    named = roots.select(F.col("v").alias(column), F.col("root").alias(name))
    return df.join(named, column, "left").withColumn(name, F.coalesce(name, column))


def _known_before(own: str, other: str, n: str) -> Column:
    """Of a record's shingles, how many at least rank before the last of the other's short lists."""
    short = F.col(n) - F.floor((3 * F.col(n) + 3) / 4) + 1
    known = F.lit(0).cast("long")
    for k, field in zip(QUARTERS, ("q2", "q3", "q4"), strict=True):
        known = F.when(F.col(f"{own}.{field}") <= F.col(f"{other}.q4"), F.floor(short * k / 4)).otherwise(known)
    return known


def can_link(pairs: DataFrame, listed: DataFrame) -> DataFrame:
    """Those of ``pairs(a, n, b, m, times)`` that may link by where their short lists end.

    Where one record's short lists end first, every shingle that both hold up to there is
    counted in ``times``. What they share beyond is no more than what either has left.
    """
    marks = listed.filter("kind = 3").groupBy("v").agg(
        F.struct(F.first("m").alias("q2"), F.first("votes").alias("q3"), F.first("alone").alias("q4")).alias("marks"))
    placed = (pairs.join(marks.select(F.col("v").alias("a"), F.col("marks").alias("x")), "a")
              .join(marks.select(F.col("v").alias("b"), F.col("marks").alias("y")), "b"))
    overlap = F.floor((3 * (F.col("n") + F.col("m")) + 6) / 7)
    left = F.least(F.col("n") - _known_before("x", "y", "n"), F.col("m") - _known_before("y", "x", "m"))
    return placed.filter(F.col("times") + left >= overlap).select("a", "b")


def apart(mixed: DataFrame, votes: DataFrame, listed: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of records of different components that meet in enough short lists.

    ``mixed`` has the postings of lists that may hold several components, ``votes`` those
    between components from lists of two.
    """
    # a record's lists from the short ones to the long ones, alike for all: two that meet in enough lists
    # meet first where both have as many left, so that long lists alone don't make a pair
    lengths = mixed.groupBy("token").agg(F.count(F.lit(1)).alias("length"))
    left = F.row_number().over(Window.partitionBy("v").orderBy(F.desc("length"), F.desc("token")))
    rows = stage(mixed.join(lengths, "token").select("token", "v", "n", "pos", "root", left.alias("left")), "counted")
    x, y = rows.alias("x"), rows.alias("y")
    n, m, i, j = F.col("x.n"), F.col("y.n"), F.col("x.pos"), F.col("y.pos")
    # a shared shingle at these places leaves room for an overlap of at most the sum of the
    # lesser numbers before it and from it on
    room = F.least(i, j) + F.least(n - i, m - j)
    met = (x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.root") != F.col("y.root"))
                  & (F.col("x.v") < F.col("y.v")) & (4 * F.least(n, m) >= 3 * F.greatest(n, m)) & (7 * room >= 3 * (n + m))
                  & (F.least("x.left", "y.left") >= needed_in_short(n, m)))
           .select(F.col("x.v").alias("a"), n.alias("n"), F.col("y.v").alias("b"), m.alias("m"), F.lit(0).cast("long").alias("times")))
    ordered = F.col("v") < F.col("w")
    alone = votes.select(F.least("v", "w").alias("a"), F.when(ordered, F.col("n")).otherwise(F.col("m")).alias("n"),
                         F.greatest("v", "w").alias("b"), F.when(ordered, F.col("m")).otherwise(F.col("n")).alias("m"),
                         F.col("alone").alias("times"))
    pairs = stage(met.unionByName(alone).groupBy("a", "b", "n", "m").agg(F.sum("times").alias("alone")), "met")
    # the lists that both are in, counted for these pairs alone
    lists = rows.groupBy("v").agg(F.collect_list("token").alias("tokens"))
    shared = (pairs.join(lists.select(F.col("v").alias("a"), F.col("tokens").alias("x")), "a", "left")
              .join(lists.select(F.col("v").alias("b"), F.col("tokens").alias("y")), "b", "left"))
    none = F.array().cast("array<bigint>")
    both = F.size(F.array_intersect(F.coalesce("x", none), F.coalesce("y", none)))
    enough = (shared.select("a", "b", "n", "m", (F.col("alone") + both).alias("times"))
              .filter(F.col("times") >= needed_in_short(F.col("n"), F.col("m"))))
    return can_link(enough, listed)


def _mixed(rooted: DataFrame) -> DataFrame:
    """The postings of lists that hold records of several components."""
    tokens = (rooted.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
              .filter("lo <> hi").select("token"))
    return rooted.join(tokens, "token", "left_semi")


def _star(postings: DataFrame, key: list[str], turn: int = 0) -> DataFrame:
    """For each list, one record of each component in it, with one of the list: ``(a, b)`` and in how
    many lists (``votes``), if their sizes let them link. Each ``turn`` picks other records."""
    pick = F.min(F.struct(F.xxhash64(F.lit(turn), "v").alias("h"), "n", "v"))
    heads = postings.groupBy(*key, "root").agg(pick.alias("head"))
    first = heads.groupBy(*key).agg(F.min("head").alias("first"))
    n, m = F.col("first.n"), F.col("head.n")
    near = (F.col("head") != F.col("first")) & (4 * F.least(n, m) >= 3 * F.greatest(n, m))
    return (heads.join(first, key).filter(near)
            .groupBy(F.col("first.v").alias("a"), F.col("head.v").alias("b"), n.alias("n"), m.alias("m"))
            .agg(F.count(F.lit(1)).alias("votes")))


def _likely() -> Column:
    """Whether votes are so many that a link is likely, for what is only tried first. Votes are counted
    in some of the lists that two records share; near copies share most of their short ones."""
    return 2 * F.col("votes") >= F.greatest(needed_in_short(F.col("n"), F.col("m")), F.least("n", "m") / 16)


def link_records(docs: DataFrame, rows: DataFrame, sketch: Broadcast) -> DataFrame:
    """``v`` and ``root`` of every record that links with another."""
    listed = short_lists(docs, sketch)
    best = (listed.filter("kind = 0").groupBy("v", "n", "w", "m").agg(F.sum("votes").alias("votes")).filter(_likely())
            .groupBy("v").agg(F.max(F.struct("votes", "w")).alias("best"))
            .select(F.col("best.w").alias("a"), F.col("v").alias("b")))
    # parts of one list, by their first records
    heads = listed.filter("kind = 2").select("token", F.struct("n", "v").alias("head"))
    first = heads.groupBy("token").agg(F.min("head").alias("first"))
    parts = (heads.join(first, "token").filter("head <> first and 4 * first.n >= 3 * head.n")
             .select(F.col("first.v").alias("a"), F.col("head.v").alias("b")))
    led = stage(best.union(parts).distinct(), "led")
    # as if all of these linked, and what such groups share likewise: the groups in which
    # almost all links lie. What else is to be compared is between them
    groups = stage(components(led), "groups")
    postings = listed.filter("kind in (1, 2)").select("token", "v", "n", "pos")
    mixed = stage(_mixed(_with_root(postings, "v", groups, "root")), "mixed")
    star = stage(_star(mixed, ["token"]).filter(_likely()).select("a", "b"), "star")
    if not star.isEmpty():
        led = led.union(star)
        groups = stage(merged(groups, star), "groups")
        mixed = _with_root(mixed.drop("root"), "v", groups, "root")
    votes = listed.filter("kind = 0 and alone > 0").select("v", "n", "w", "m", "alone")
    votes = _with_root(_with_root(votes, "v", groups, "root"), "w", groups, "other").filter("root <> other")
    tried = led.union(stage(apart(mixed, stage(votes.drop("root", "other"), "votes"), listed), "across"))
    sets = sets_of(docs, rows, tried.select(F.col("a").alias("v")).union(tried.select(F.col("b").alias("v"))))
    found = stage(components(linked(tried, sets)), "roots")

    # the groups that fell apart, unless all pairs of their parts have been tried, and the lists of their records
    whole = _with_root(groups.withColumnRenamed("root", "all"), "v", found, "root")
    broken = (whole.groupBy("all").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
              .filter("lo <> hi").select("all"))
    parts = stage(whole.join(broken, "all", "left_semi").select("v", "all", "root"), "broken")
    inside = stage(untried(parts, tried).select("v", "all"), "inside")
    if inside.isEmpty():
        return found
    inner = stage(postings.join(inside, "v"), "inner")

    def new(pairs: DataFrame) -> DataFrame:
        turned = tried.select(F.col("b").alias("a"), F.col("a").alias("b"))
        return stage(pairs.distinct().join(tried.union(turned), ["a", "b"], "left_anti"), "pairs")

    # one record for each part of such a group in a list, other ones each time, as long as
    # that is worth it; then a search for all that is left
    turn = 0
    while True:
        placed = _with_root(inner.select("token", "all", "v", "n"), "v", found, "root")
        turn += 1
        star = new(_star(placed, ["token", "all"], turn).filter(_likely()).select("a", "b"))
        more = linked(star, sets)
        tried = tried.union(star)
        found = stage(merged(found, more), "roots")
        if more.count() * WORTH <= star.count():
            break
    parts = _with_root(inside, "v", found, "root")
    return stage(merged(found, linked_in_groups(parts, tried, sets)), "roots")


def _labelled(docs: DataFrame) -> DataFrame:
    """A row for each document: its key, ``n_shingles``, ``component_id`` and the component's ``root``."""
    rows, sketch = records(docs)
    roots = link_records(docs, rows, sketch)
    known = rows.filter("v is not null").groupBy("v").agg(F.min("doc_id").alias("least"))
    rooted = known.join(roots, "v", "left").withColumn("root", F.coalesce("root", "v"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    label = rooted.join(named, "root").select("v", "component_id", "root")
    return (rows.join(label, "v", "left")
            .select("doc_id", "t1", "t2", F.col("n").alias("n_shingles"),
                    F.when(F.col("v").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "root"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """A row for each document: its key, ``n_shingles`` and the smallest doc_id it links to.

    The key is the doc_id and a hash of the text (``t1``, ``t2``).
    """
    return _labelled(docs).drop("root")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, once: that with the least key, one without doc_id only if
    none has one. Documents without words stay."""
    found = stage(_labelled(docs), "components")
    key = ["doc_id", "t1", "t2"]
    ranked = (found.filter("n_shingles > 0").groupBy("root", *key).agg(F.count(F.lit(1)).alias("rows"))
              .select("root", F.struct(F.col("doc_id").isNull().alias("unnamed"), *key, "rows").alias("row")))
    first = ranked.groupBy("root").agg(F.min("row").alias("row")).select(*[f"row.{c}" for c in key], "row.rows")
    wordless = found.filter("n_shingles = 0").select(*key).distinct().withColumn("rows", F.lit(1).cast("long"))
    keys = stage(first.unionByName(wordless), "stay")
    columns = [docs[c] for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("doc"), "doc_id",
                       *[F.xxhash64(F.lit(i), "text").alias(f"t{i}") for i in (1, 2)])
    same = (rows["doc_id"].eqNullSafe(keys["doc_id"]) & (rows["t1"] == keys["t1"]) & (rows["t2"] == keys["t2"]))
    repeated = F.col("rows") > 1
    kept = rows.join(keys.filter(~repeated), same, "left_semi").select("doc.*")
    several = keys.filter(repeated)
    if several.isEmpty():
        return kept
    once = rows.join(several, same, "left_semi").groupBy("doc_id", "t1", "t2").agg(F.first("doc").alias("doc"))
    return kept.unionByName(once.select("doc.*"))


def op3_jaccard_join(spark, sf):
    return jaccard_components(read(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")
