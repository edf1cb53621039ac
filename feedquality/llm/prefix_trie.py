"""The trie of conversation prefixes, with totals of every subtree by parallel tree contraction.

A node is a distinct sequence of first turns. Its identity is a sum over its turns, each
hashed with its position, so that the prefixes of a conversation are running sums, and a
conversation of any length is worked on in segments: turns are ranked in blocks of a sorted
range, summed in segments of ``SEGMENT`` positions, and the blocks' and segments' totals carried on.

Subtree totals come from contracting the tree. In each round all leaves are raked: their
totals are final, and summed onto their parents. Then nodes left with one child are
compressed, those whose hash in this round is below that of parent and child, so that no two
neighbours go at once: the child moves up and its edge keeps what was passed over. Both
take a share of the nodes away, in bushes as in chains, and rounds grow with the logarithm
of the number of nodes. Going back through the rounds, a compressed node's total is what was kept
plus the total of the child it had; what is joined shrinks like the tree did.

Turns are ordered by ``turn``, nulls first, and equal ones by a digest of role and text; repeated rows are
turns each. Null role and text are empty. Rows without ``conv_id`` belong to no conversation
and are left out. Only digests of the texts are shuffled. An empty table has no nodes, not even a root. Extra
columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from feedquality.llm.text import map_batches, read
from feedquality.session import stage

#: Conversations in a family of this many neighbouring ids share the turns of the first of them.
FAMILY = 5
#: A conversation takes fewer turns than this from there.
HEADS = 9
#: Positions, as a power of two, in a segment of a conversation; and ids in a part of a joined list.
SEGMENT, IDS = 12, 12

#: Parts of a prefix's identity, of 32 bits each.
PARTS = [f"part{i}" for i in range(4)]
MASK = (1 << 32) - 1
ROOT = "0" * 32
#: What is summed over subtrees.
TOTALS = ["n_leaves", "saved_tokens"]
EDGES = [f"edge_{t}" for t in TOTALS]


def turn_digest(role: Column, text: Column) -> Column:
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def ranked(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns with the ``block`` of the sorted order they are in and their ``rank`` there, staged;
    and ``before``, the turns of the conversation in earlier blocks.

    A conversation may fill many blocks, equal rows too, as the staged rows have a number to sort by.
    """
    turns = conversations.filter("conv_id is not null").select(
        "conv_id", F.col("turn"), turn_digest(F.col("role"), F.col("text")).alias("digest"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("row"))
    order = [F.asc_nulls_first("turn"), "digest", "row"]
    blocks = stage(stage(turns, "turns").repartitionByRange("conv_id", *order)
                   .withColumn("block", F.spark_partition_id()), "turns-by-range")
    rank = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy(*order))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = blocks.groupBy("conv_id", "block").agg(F.count("*").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return blocks.select("conv_id", "block", rank.alias("rank"), "digest", "bytes"), stage(counts, "turn-counts")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation rebuilt, as rows of ``conv_id``, ``depth`` (from 1), ``digest``, ``bytes`` and ``last``;
    and the conversations with their new ``length``."""
    turns, counts = ranked(conversations)
    sizes = counts.groupBy("conv_id").agg(F.sum("n").alias("n"))
    known = sizes.withColumns({"takes": F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS,
                               "giver": F.col("conv_id") - F.col("conv_id") % FAMILY})
    givers = sizes.select(F.col("conv_id").alias("giver"), F.col("n").alias("n_giver"))
    taken = F.least("takes", F.coalesce("n_giver", F.lit(0)))
    known = known.join(givers, "giver", "left").withColumn("taken", taken).withColumn(
        "length", F.col("taken") + F.greatest(F.col("n") - F.col("takes"), F.lit(0)))
    known = stage(known.select("conv_id", "giver", "takes", "taken", "length"), "conversations")
    # joined by block too, so that a long conversation is no hot key
    starts = counts.select("conv_id", "block", "before").join(known, "conv_id")
    placed = stage(turns.join(starts, ["conv_id", "block"]).withColumn("position", F.col("before") + F.col("rank")).select(
        "conv_id", "position", "digest", "bytes", "takes", "taken", "length"), "positions")
    heads = placed.filter(F.col("position") < HEADS).select(F.col("conv_id").alias("giver"), "position", "digest", "bytes")
    first = known.join(heads, "giver").filter("position <= takes").withColumn("depth", F.col("position"))
    rest = placed.filter("position > takes").withColumn("depth", F.expr("position - takes + taken"))
    columns = ["conv_id", "depth", "digest", "bytes", (F.col("depth") == F.col("length")).alias("last")]
    return first.select(*columns).unionByName(rest.select(*columns)), known


def hexed(parts: list[Column]) -> Column:
    return F.lower(F.concat(*(F.lpad(F.hex(p.bitwiseAND(MASK)), 8, "0") for p in parts)))


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` with ``node``, the identity of the turns up to here, and that of its ``parent``."""
    hashed = F.md5(F.concat_ws(":", F.col("depth").cast("string"), "digest").cast("binary"))
    turns = turns.withColumn("hashed", hashed).select("*", *(
        F.conv(F.substring("hashed", 8 * i + 1, 8), 16, 10).cast("long").alias(p) for i, p in enumerate(PARTS))).withColumn(
        "segment", F.shiftright("depth", SEGMENT))
    here = Window.partitionBy("conv_id", "segment").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = stage(turns.select("conv_id", "depth", "segment", "bytes", "last", *PARTS, *(
        F.sum(p).over(here).alias(f"to_{p}") for p in PARTS)), "running-sums")
    earlier = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    # a sum of 32 bits for each turn; the totals carried on are cut to 32 bits, so nothing overflows
    totals = running.groupBy("conv_id", "segment").agg(*(F.sum(p).bitwiseAND(MASK).alias(p) for p in PARTS))
    before = totals.select("conv_id", "segment", *(F.sum(p).over(earlier).alias(f"before_{p}") for p in PARTS)).filter(
        "before_part0 is not null")
    whole = running.join(before, ["conv_id", "segment"], "left")
    upto = [F.coalesce(f"before_{p}", F.lit(0)) + F.col(f"to_{p}") for p in PARTS]
    return whole.select("conv_id", "depth", "bytes", "last", hexed(upto).alias("node"),
                        hexed([u - F.col(p) for u, p in zip(upto, PARTS, strict=True)]).alias("parent"))


def digests(ends: DataFrame) -> DataFrame:
    """For each ``node`` the SHA-256 of its ``conv_id`` in ascending order, joined with commas.

    Ids are joined in parts of neighbouring ones, and the parts of a node streamed through its digest:
    that is a chain by its nature, but a part is one row and no task holds a list whole.
    """
    parts = ends.groupBy("node", F.shiftright("conv_id", IDS).alias("part")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if row["node"] != node:
                    if running:
                        done.append((node, running.hexdigest()))
                    node, running = row["node"], hashlib.sha256(row["ids"].encode())
                else:
                    running.update(b"," + row["ids"].encode())
            yield rows(done)
        if running:
            yield rows([(node, running.hexdigest())])

    def rows(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in range(2)],
                                          names=["node", "ends_sha256"])

    ordered = parts.repartition("node").sortWithinPartitions("node", "part")
    return map_batches(ordered, stream, "node string, ends_sha256 string")


def contracted_totals(tree: DataFrame) -> DataFrame:
    """For each ``node`` the totals over its subtree of ``TOTALS``. ``tree`` has ``node``, ``parent`` (null at the
    root), ``n_children`` and the node's own values."""
    def added(*names: str) -> Column:
        return sum((F.col(n) for n in names[1:]), F.col(names[0]))

    alive = stage(tree.select("node", "parent", "n_children", *TOTALS, *(F.lit(0).cast("long").alias(e) for e in EDGES)),
                  "tree")
    rounds: list[tuple[DataFrame, DataFrame | None]] = []
    while not alive.filter("n_children > 0").isEmpty():
        leaf = F.col("n_children") == 0
        below = alive.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(
            F.count(F.when(~leaf, True)).alias("live"), F.min(F.when(~leaf, F.col("node"))).alias("child"),
            *(F.coalesce(F.sum(F.when(leaf, added(t, e))), F.lit(0)).alias(f"raked_{t}") for t, e in zip(TOTALS, EDGES, strict=True)),
            *(F.coalesce(F.sum(F.when(~leaf, F.col(e))), F.lit(0)).alias(f"child_{e}") for e in EDGES))
        order = [F.xxhash64(n, F.lit(len(rounds))) for n in ("node", "parent", "child")]
        unary = (F.col("live") == 1) & F.col("parent").isNotNull() & (order[0] < order[1]) & (order[0] < order[2])
        inner = stage(alive.filter(~leaf).join(below, "node").select(
            "node", "parent", F.col("live").alias("n_children"), "child", unary.alias("compressed"),
            *(added(t, f"raked_{t}").alias(t) for t in TOTALS), *EDGES, *(f"child_{e}" for e in EDGES)), "raked")
        gone = inner.filter("compressed")
        moved = gone.select(F.col("child").alias("node"), F.col("parent").alias("above"),
                            *(added(t, e).alias(f"over_{t}") for t, e in zip(TOTALS, EDGES, strict=True)))
        kept = inner.filter("not compressed").join(moved, "node", "left")
        rounds.append((alive.filter(leaf).select("node", *TOTALS), None if gone.isEmpty() else gone.select(
            "node", "child", *(added(t, f"child_{e}").alias(t) for t, e in zip(TOTALS, EDGES, strict=True)))))
        alive = stage(kept.select(
            "node", F.coalesce("above", "parent").alias("parent"), "n_children", *TOTALS,
            *((F.col(e) + F.coalesce(f"over_{t}", F.lit(0))).alias(e) for t, e in zip(TOTALS, EDGES, strict=True))), "tree")
    totals = alive.select("node", *TOTALS)
    for leaves, gone in reversed(rounds):
        if gone is not None:
            later = totals.select(F.col("node").alias("child"), *(F.col(t).alias(f"below_{t}") for t in TOTALS))
            totals = totals.unionByName(stage(gone.join(later, "child").select(
                "node", *(added(t, f"below_{t}").alias(t) for t in TOTALS)), "expanded"))
        totals = totals.unionByName(leaves)
    return totals


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each node: ``conv_id``, its smallest member, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``, and its identity ``node`` with that of its ``parent``."""
    turns, known = rebuilt(conversations)
    paths = stage(prefixes(turns), "prefixes")
    root = known.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), "conv_id", F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("bytes"), "n_convs")
    nodes = stage(paths.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.min("depth").cast("long").alias("depth"),
        F.max("bytes").alias("bytes"), F.count("*").alias("n_convs")).unionByName(root), "nodes")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = stage(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    totals = contracted_totals(nodes.withColumns({
        "n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")}))
    ended = digests(paths.filter("last").select("node", "conv_id").unionByName(
        known.filter("length = 0").select(F.lit(ROOT).alias("node"), "conv_id")))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # by itself, so that a parent of many children can be split
    named = stage(nodes.drop("bytes").join(above, "parent", "left"), "named")
    return named.join(totals, "node").join(ended, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *TOTALS,
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), "node", "parent")


def op11_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie(read(spark, sf, "conversations")).drop("node", "parent")


#: CRC-32 bit by bit, as the query's SQL has no function for it. 3988292384 is the polynomial, a fixed value.
_CRC = """xor(list_reduce(list_transform(string_split(conv_id::varchar, ''), lambda ch: ascii(ch)::bigint),
    lambda crc, byte: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda x, bit:
        case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, xor(crc, byte)), 4294967295::bigint), 4294967295)"""

OP11_SQL = f"""
with turns as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by
        turn nulls first, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as pos
    from conversations where conv_id is not null),
convs as (
    select conv_id as c, count(*) as n, conv_id - conv_id % {FAMILY} as giver, {_CRC} % {HEADS} as takes
    from turns group by conv_id),
rebuilt as (
    select c, pos as depth, role, text from convs join turns on conv_id = giver and pos <= takes
    union all
    select convs.c, pos - convs.takes + least(convs.takes, coalesce(g.n, 0)), role, text
    from convs join turns on conv_id = convs.c and pos > convs.takes left join convs g on g.c = convs.giver),
paths as (
    select c, depth, strlen(text) as bytes, string_agg(sha256(strlen(role) || ':' || role || text), ',')
        over (partition by c order by depth) as path from rebuilt
    union all select c, 0, 0, '' from convs),
steps as (
    select *, max(depth) over (partition by c) as length, lag(path) over (partition by c order by depth) as above from paths),
nodes as (
    select path, depth, min(c) as conv_id, any_value(above) as above, max(bytes) as bytes, count(*) as n_convs,
        coalesce(string_agg(c::varchar, ',' order by c) filter (depth = length), '') as ends
    from steps group by path, depth),
counted as (
    select n.*, (select count(*) from nodes k where k.depth = n.depth + 1 and k.above = n.path) as n_children from nodes n),
totals as (
    select s.path, s.depth, sum(k.n_children = 0) as n_leaves, sum((k.n_convs - 1) * k.bytes) as saved_tokens
    from counted k join steps s on s.c = k.conv_id and s.depth <= k.depth group by s.path, s.depth)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children,
    n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, sha256(n.ends) as ends_sha256
from counted n join totals t on t.path = n.path and t.depth = n.depth
left join nodes p on p.depth = n.depth - 1 and p.path = n.above
"""
