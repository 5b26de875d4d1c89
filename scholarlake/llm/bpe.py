"""Encoding of a corpus with a public byte-level BPE tokenizer (problem 6).

Method: a text is cut into pieces by the tokenizer's pattern.  Within a piece, a
segment tree over the byte positions stores the leftmost minimum rank of the
pairs that start there; a merge sets the pair's right position dead and renews
the pairs of the two live neighbours, each a point update of logarithmic cost.
A piece of n bytes so takes O(n log n), also where a text without blanks is one
piece of a million bytes.  Pieces repeat, so each worker keeps the ids of recent
ones in a cache of bounded size.

The vocabulary's path is a parameter; each worker reads it once.  No special
tokens exist here, so strings that look like them are ordinary text.

Defined results for odd input: an empty and a null text both give an empty list;
blanks are encoded as any text; unpaired surrogates cannot occur in a Spark
string; repeated rows give a row each; an empty table gives an empty result;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

#: Pieces of a text: contractions, letters, digits, signs, blanks (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NEVER = 1 << 30
CACHED_PIECES = 1 << 17
LONGEST_CACHED = 64  # bytes


class LeftmostMinimum:
    """A segment tree over ranks: the root names the leftmost least one."""

    __slots__ = ("best", "size")

    def __init__(self, ranks: list[int]) -> None:
        self.size = 1 << max(0, (len(ranks) - 1).bit_length())
        # rank and position in one number, so that ties go to the left
        leaves = [(r << 32) | i for i, r in enumerate(ranks)]
        leaves += [(NEVER << 32) | i for i in range(len(ranks), self.size)]
        self.best = [0] * self.size + leaves
        for k in range(self.size - 1, 0, -1):
            self.best[k] = min(self.best[2 * k], self.best[2 * k + 1])

    def least(self) -> tuple[int, int]:
        top = self.best[1]
        return top >> 32, top & 0xFFFFFFFF

    def put(self, position: int, rank: int) -> None:
        best, k = self.best, position + self.size
        best[k] = (rank << 32) | position
        k >>= 1
        while k:
            left, right = best[2 * k], best[2 * k + 1]
            least = left if left < right else right
            if best[k] == least:
                break
            best[k] = least
            k >>= 1


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN) -> None:
        self.ranks = ranks
        self.pieces = regex.compile(pattern).findall
        self.piece = lru_cache(maxsize=CACHED_PIECES)(self.merge)

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """The ids of one piece."""
        ranks = self.ranks
        if piece in ranks:
            return (ranks[piece],)
        n = len(piece)
        #: the part that starts at i ends before after[i]; before[i] starts the one to its left
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = LeftmostMinimum([ranks.get(piece[i : i + 2], NEVER) for i in range(n - 1)] or [NEVER])

        def pair(i: int) -> int:
            j = after[i]
            return ranks.get(piece[i : after[j]], NEVER) if j < n else NEVER

        while True:
            rank, i = tree.least()
            if rank == NEVER:
                break
            dead = after[i]
            after[i] = after[dead]
            if after[i] < n:
                before[after[i]] = i
            if dead < n - 1:
                tree.put(dead, NEVER)
            if i < n - 1:
                tree.put(i, pair(i))
            if before[i] >= 0:
                tree.put(before[i], pair(before[i]))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : after[i]]])
            i = after[i]
        return tuple(out)

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        for p in self.pieces(text or ""):
            data = p.encode("utf-8")
            out += self.piece(data) if len(data) <= LONGEST_CACHED else self.merge(data)
        return out


def encoder(path: str) -> Encoder:
    """The encoder of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return _encoder(lines.read())


@lru_cache(maxsize=2)
def _encoder(ranks: bytes) -> Encoder:
    return Encoder({base64.b64decode(token): int(rank) for token, rank in (line.split() for line in ranks.splitlines() if line.strip())})


_IDS = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def _encode(batches: Iterator[pa.RecordBatch], ranks: Broadcast, rows: int = 500) -> Iterator[pa.RecordBatch]:
    made = _encoder(ranks.value)
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            ids = [made.encode(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(ids, pa.list_(pa.int32()))], schema=_IDS)


def encode(df: DataFrame, id_column: str, text_column: str, path: str) -> DataFrame:
    """One row per row of ``df``: the id and ``ids``, the token ids of the whole
    text.  A single pass without a shuffle.  The rank file is read where the query is
    made and goes to the workers with it (about a megabyte); they need no such file."""
    thin = df.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    with open(path, "rb") as lines:
        ranks = df.sparkSession.sparkContext.broadcast(lines.read())
    return thin.mapInArrow(partial(_encode, ranks=ranks), "id bigint, ids array<int>").withColumnRenamed("id", id_column)
