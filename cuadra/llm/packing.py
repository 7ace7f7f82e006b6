"""Best-fit packing of token pieces into sequences.

Texts are encoded once, in place; what is shuffled is a few numbers for each piece. A document that is
longer than a sequence is cut into full sequences, with the remainder as its first piece. Full pieces
are sequences by themselves. The others are packed by best-fit decreasing: longest first, each into the
open sequence with the least room that still suffices, found by a segment tree over the room left.

Pieces are dealt at random into shards of about ``SHARD_PIECES``; each shard is packed by one task and
leaves at most a few sequences that could have been filled further, whatever the size of the input.

Cases: null text counts as empty, and an empty text is its end id alone. Repeated rows and null ids are
packed like others. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadra.llm.common import query, table
from cuadra.llm.tokens import shared_encoder, spaced
from cuadra.session import written_once

SEQUENCE = 2048
SHARD_PIECES = 200_000

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, size: int = SEQUENCE, pieces=spaced) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the pieces of each document, of at most ``size`` ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = shared_encoder(tokenizer, pieces), int(end_id).to_bytes(4, "little")
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc, coded in zip(batch.column(0).to_pylist(), map(encoder.encode, texts)):
                coded += end
                n = len(coded) // 4
                first = n % size or size
                edges = [0, *range(first, n + 1, size)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    for column, value in zip(out, (doc, k, a, b - a, zlib.crc32(coded[4 * a:4 * b]))):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)], [c.split()[0] for c in _PIECES.split(", ")])
        shared_encoder(tokenizer, pieces).known.trim()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(cut, _PIECES)


class Room:
    """Open sequences by the room left in them: a segment tree tells which amounts of room occur."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.tree = [0] * (2 * self.leaves)  # sequences below each node
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, sequence: int, room: int) -> None:
        self.open[room].append(sequence)
        self._count(room, 1)

    def _count(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.tree[node] += by
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (sequence, room) with the least room of at least ``need``."""
        tree, node = self.tree, need + self.leaves
        if not tree[node]:
            # Up to the first right neighbour with anything below it, then down on its left side.
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._count(room, -1)
        return self.open[room].pop(), room


def best_fit(lengths: np.ndarray, size: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room, used = Room(size), 0
    for at in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[at])
        found = room.take(length)
        if found is None:
            found, used = (used, size), used + 1
        sequence[at], offset[at] = found[0], size - found[1]
        if found[1] > length:
            room.add(found[0], found[1] - length)
    return sequence, offset


_PACKED = _PIECES + ", sequence_id long, offset long"
_SHARD_BITS = 34  # sequence numbers of one shard lie below


def pack_pieces(pieces: DataFrame, size: int = SEQUENCE, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    fixed = written_once(pieces.withColumn("_row", F.monotonically_increasing_id()))
    names = pieces.columns
    # Full pieces have the negative numbers.
    full = fixed.filter(F.col("length") >= size).select(*names, (-F.col("_row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = fixed.filter(F.col("length") < size)
    shards = -(-rest.count() // shard_pieces) or 1

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_row", kind="stable", ignore_index=True)
        sequence, offset = best_fit(rows["length"].to_numpy(), size)
        return rows.assign(sequence_id=(int(key[0]) << _SHARD_BITS) + sequence, offset=offset)[[*names, "sequence_id", "offset"]]

    dealt = rest.withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(shards)))
    packed = dealt.groupBy("_shard").applyInPandas(pack, _PACKED)
    return full.unionByName(packed)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, size: int = SEQUENCE) -> DataFrame:
    """The pieces of ``docs`` with their sequence and their place in it."""
    return pack_pieces(cut_pieces(docs, tokenizer, end_id, size), size)


@query("op6_best_fit_packing")
def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
