"""Byte-level BPE by backtracking over longest matches.

A text is split by the pattern of the vocabulary, and each piece is encoded by itself. Of
a piece's encodings into tokens the right one, the one that merging would give, is the
only one in which every token merges to itself and every two neighbours, merged afresh,
come out as the same two tokens. So a piece is encoded from the left: the longest token
that matches and gets on with the token before it is taken, and where none does, the last
token goes back. Each end position has one right prefix at most, so a position that was
given up is never tried again, and the work is linear in the piece. Whether two tokens get
on is found by merging their bytes once, and remembered.

Matches come from an Aho-Corasick automaton; it takes strings, so bytes are read as
Latin-1, one character a byte.

Texts are handled whole, one at a time; null counts as empty. The vocabulary is of fixed
size and travels as a broadcast. Rows are independent, so repeated rows, clashing extra
columns and empty tables need no special care.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from feedquality.llm.text import per_text, read

#: Pieces, and pairs of tokens, that a worker remembers; beyond it the memory starts afresh.
REMEMBERED = 400_000
#: Longer pieces are seldom met twice and not remembered.
LONGEST_REMEMBERED = 64

#: Later than any merge.
NEVER = 1 << 60
#: Stands for the start of a piece where a token on the left is looked up.
START = 1 << 31

ENCODED = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
])
DIGEST = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
])


def load_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file: a token in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int], stop: int = 1) -> list[bytes]:
    """The plain rule: join the neighbours of lowest rank, the leftmost first, until none can be joined.

    Stops early once ``stop`` parts are left. Takes quadratic time, and serves for single tokens only.
    """
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > stop:
        best, at = min((ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if best == NEVER:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Encoder:
    """Encodes and decodes; holds the automaton and what it remembers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import ahocorasick
        import regex

        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.shorter: dict[int, int | None] = {}
        self.edges: dict[int, tuple] = {}
        self.pieces = _Remembered(self)

    def next_shorter(self, rank: int) -> int | None:
        """The longest token that a token properly begins with."""
        if rank in self.shorter:
            return self.shorter[rank]
        token = self.token[rank]
        found = next((self.ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.ranks), None)
        self.shorter[rank] = found
        return found

    def edge(self, rank: int) -> tuple:
        """What stood at a token's left and at its right end while it was merged.

        Each side lists (bytes, time made, time taken up into the next), the token itself
        first; None if the token doesn't merge to itself out of tokens of lower rank.
        """
        known = self.edges.get(rank, False)
        if known is False:
            known = self.edges[rank] = self._edge(rank)
        return known

    def _edge(self, rank: int) -> tuple | None:
        token = self.token[rank]
        if len(token) == 1:
            return ((token, -1, NEVER),), ((token, -1, NEVER),)
        halves = merge(token, self.ranks, stop=2)
        if len(halves) != 2 or self.ranks[halves[0] + halves[1]] != rank:
            return None
        below = [self.edge(self.ranks[h]) for h in halves]
        if None in below or any(len(h) > 1 and self.ranks[h] >= rank for h in halves):
            return None
        return tuple(((token, rank, NEVER), (own[side][0][0], own[side][0][1], rank), *own[side][1:])
                     for side, own in enumerate(below))

    def gets_on(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens, merged afresh, come out as these two."""
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        known = self.pairs[left << 32 | right] = self._gets_on(left, right)
        return known

    def _gets_on(self, left: int, right: int) -> bool:
        if self.edge(right) is None:
            return False
        if left == START:
            return True
        # What meets at the border changes as either side grows. A merge across the border
        # happens where it comes before both sides are taken up; of equal merges the left is first.
        ends, starts = self.edge(left)[1], self.edge(right)[0]
        i = j = 0
        while True:
            a, made_a, taken_a = ends[i]
            b, made_b, taken_b = starts[j]
            across = self.ranks.get(a + b)
            if across is not None and across < taken_a and across <= taken_b:
                return False
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                i += 1
            else:
                j += 1

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        text = piece.decode("latin-1")
        longest, pairs, lengths = self.automaton.iter_long, self.pairs, self.token
        given_up = bytearray(n + 1)
        tokens: list[int] = []
        at, last = 0, START
        matches = longest(text)
        rank: int | None = next(matches, (0, None))[1]
        fresh = True  # whether the matches still follow the tokens taken
        while True:
            while rank is not None:
                end = at + len(lengths[rank])
                if not given_up[end]:
                    known = pairs.get(last << 32 | rank)
                    if known or known is None and self.gets_on(last, rank):
                        break
                rank = self.next_shorter(rank)
                fresh = False
            if rank is None:
                if not tokens:
                    raise ValueError("the vocabulary lacks a byte of this piece")
                given_up[at] = 1
                rank = tokens.pop()
                at -= len(lengths[rank])
                last = tokens[-1] if tokens else START
                rank, fresh = self.next_shorter(rank), False
                continue
            tokens.append(rank)
            last, at = rank, end
            if at == n:
                return tokens
            if not fresh:
                matches, fresh = longest(text, at), True
            rank = next(matches, (0, None))[1]

    def encode(self, text: str) -> bytes:
        """The ids of a text, packed as little-endian unsigned 32-bit numbers."""
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(packed, "<u4").tolist()))


class _Remembered(dict):
    """Pieces and their packed ids."""

    def __init__(self, encoder: Encoder) -> None:
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        ids = self.encoder.encode_piece(piece.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = packed
        return packed


def _worker(shared: Broadcast, pattern: str, row: Callable) -> Callable[[], Callable[[str], tuple]]:
    def make() -> Callable[[str], tuple]:
        # the broadcast stays with the worker, and with it what earlier tasks remembered
        held = shared.value
        if pattern not in held:
            held[pattern] = Encoder(held["ranks"], pattern)
        encoder = held[pattern]
        return lambda text: row(encoder, text)
    return make


def encoded(docs: DataFrame, ranks_path: str, pattern: str, text: Column | None = None) -> Column:
    """A struct of ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit numbers)."""
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": load_ranks(ranks_path)})

    def row(encoder: Encoder, value: str) -> tuple:
        packed = encoder.encode(value)
        return len(packed) // 4, packed

    return per_text(docs, F.col("text") if text is None else text, _worker(shared, pattern, row), ENCODED)


def decoded(docs: DataFrame, ranks_path: str, ids: Column) -> Column:
    """The bytes that packed ``ids`` stand for; null for null."""
    token = {rank: token for token, rank in load_ranks(ranks_path).items()}
    shared = docs.sparkSession.sparkContext.broadcast(token)

    @F.arrow_udf(T.BinaryType())
    def each(batch):
        import pyarrow as pa
        tokens = shared.value
        return pa.array([None if v is None else b"".join(map(tokens.__getitem__, np.frombuffer(v, "<u4").tolist()))
                         for v in batch.to_pylist()], pa.binary())

    return each(ids)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> Column:
    """A struct of ``n_tokens`` and the digests of the ids and of the bytes decoded from them."""
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": load_ranks(ranks_path)})

    def row(encoder: Encoder, value: str) -> tuple:
        packed = encoder.encode(value)
        return (len(packed) // 4, hashlib.sha256(packed).hexdigest(),
                hashlib.sha256(encoder.decode(packed)).hexdigest())

    return per_text(docs, F.col("text"), _worker(shared, pattern, row), DIGEST)


def ids_and_digests(docs: DataFrame, ranks_path: str, pattern: str) -> Column:
    """A struct of ``n_tokens``, the packed ``ids``, and the digests of the ids and of the bytes decoded from them."""
    shared = docs.sparkSession.sparkContext.broadcast({"ranks": load_ranks(ranks_path)})

    def row(encoder: Encoder, value: str) -> tuple:
        packed = encoder.encode(value)
        return (len(packed) // 4, packed, hashlib.sha256(packed).hexdigest(),
                hashlib.sha256(encoder.decode(packed)).hexdigest())

    return per_text(docs, F.col("text"), _worker(shared, pattern, row), T.StructType([*ENCODED, *DIGEST.fields[1:]]))


def encode_digests(docs: DataFrame) -> DataFrame:
    """The digests of every document, by the 50k vocabulary."""
    import public_tokenizers

    digests = round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return docs.select("doc_id", digests.alias("__s")).select("doc_id", "__s.*")


def op10_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return encode_digests(read(spark, sf, "documents"))
