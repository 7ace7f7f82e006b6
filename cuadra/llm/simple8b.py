"""Token ids as Simple-8b words in block files.

A 64-bit word has a 4-bit selector and a 60-bit payload that holds as many ids as fit: 240 or 120
zeros, 60 ids of 1 bit, ... down to 1 id of 60 bits. Selector 15 is an escape: the value, too wide
for a payload, stands whole in a list beside the words. A block holds whole documents and its header
has their ids and lengths, and for every 128th word the number of ids before it, so that any range of
ids can be decoded without the words before. Coding and decoding work on whole arrays.

The file is a Parquet table of blocks in ascending ``doc_id`` order: part, block, ids before the block
in its part, number of ids, and the block as bytes; and a small table with the ids before each part.
Spark's committer writes both, so lost tasks are simply run again.

Cases: null text counts as empty, and an empty text is its end id alone. Null ids come first and
repeated rows follow each other. An empty table gives an empty file. Extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuadra.llm.common import query, table
from cuadra.llm.tokens import shared_encoder, shared_words, words
from cuadra.session import scratch_path

# Selector -> ids in a word and bits of each; fixed values of the format.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
# Two ids of 30 bits are selector 14; selector 15 holds one of 60 bits, and is an escape if its payload is all ones.
ESCAPE = (1 << 60) - 1

STEP = 128  # words between two entries of the offset table
BLOCK_IDS = 1 << 16  # a block is closed at the first document end behind so many ids
_HEAD = "<4sIQQQ"  # magic, documents, ids, words, escapes


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    out = np.zeros(len(values), np.int8)
    rest = values.copy()
    for shift in (32, 16, 8, 4, 2, 1):
        big = rest >= np.uint64(1) << np.uint64(shift)
        out[big] += shift
        rest[big] >>= np.uint64(shift)
    return out + (rest > 0).astype(np.int8)


_SMALL = _widths(np.arange(1 << 16, dtype=np.uint64))


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and escaped values of unsigned 64-bit ``values``."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    width = _SMALL[values] if values.max() < len(_SMALL) else _widths(values)
    # Largest width in the next 2^k values, then of any count from two overlapping runs of 2^k.
    runs = [width]
    choice = np.full(n, 15, np.int8)
    for s in range(14, -1, -1):
        count, k = int(COUNTS[s]), int(COUNTS[s]).bit_length() - 1
        while len(runs) <= k:
            last, half = runs[-1], 1 << (len(runs) - 1)
            runs.append(np.maximum(last[:-half], last[half:]) if len(last) > half else last[:0])
        top = runs[k][:max(n - count + 1, 0)]
        if not len(top) or top.min() > BITS[s]:
            continue
        if count & (count - 1):
            top = np.maximum(top, runs[k][count - (1 << k):][:n - count + 1])
        np.copyto(choice[:n - count + 1], np.int8(s), where=top <= BITS[s])
    # The walk from word to word is the only part that looks at one position after the other.
    steps = COUNTS.astype(np.uint8)[choice].tobytes()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += steps[at]
    start = np.array(starts)
    chosen = choice[start]
    out = chosen.astype(np.uint64) << np.uint64(60)
    for s in range(2, 16):
        rows = np.flatnonzero(chosen == s)
        if len(rows):
            place = np.arange(COUNTS[s])
            payload = values[start[rows, None] + place]
            if s == 15:
                payload = np.minimum(payload, np.uint64(ESCAPE))
            out[rows] |= np.bitwise_or.reduce(payload << (place * BITS[s]).astype(np.uint64), axis=1)
    single = values[start[chosen == 15]]
    return out, single[single >= ESCAPE]


def unpack(coded: np.ndarray, escaped: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` values of some words."""
    chosen = (coded >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(COUNTS[chosen])
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    for s in range(2, 16):
        rows = np.flatnonzero(chosen == s)
        if len(rows):
            bits, count = np.uint64(BITS[s]), int(COUNTS[s])
            mask = np.uint64((1 << int(BITS[s])) - 1)
            place = np.arange(count)
            got = (coded[rows, None] >> (place.astype(np.uint64) * bits)) & mask
            out[(ends[rows] - count)[:, None] + place] = got
            if s == 15:
                wide = np.flatnonzero(got[:, 0] == np.uint64(ESCAPE))
                out[ends[rows[wide]] - 1] = escaped[:len(wide)]
    return out[:n]


def write_block(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """``ids`` has as many arrays for each document, one after the other."""
    sizes = np.array([len(x) for x in ids], np.uint64)
    lengths = sizes.reshape(len(doc_ids), -1).sum(axis=1, dtype=np.uint64) if doc_ids else sizes
    values = np.concatenate(ids) if ids else np.zeros(0, np.uint64)
    coded, escaped = pack(values)
    before = np.concatenate([[0], np.cumsum(COUNTS[(coded >> np.uint64(60)).astype(np.int64)])])[:-1][::STEP].astype(np.uint64)
    known = np.array([x is not None for x in doc_ids], np.uint8)
    numbers = np.array([x or 0 for x in doc_ids], np.int64)
    head = struct.pack(_HEAD, b"S8B1", len(doc_ids), len(values), len(coded), len(escaped))
    return b"".join([head, known.tobytes(), numbers.tobytes(), lengths.tobytes(), before.tobytes(), coded.tobytes(), escaped.tobytes()])


class Block:
    """A block from its bytes."""

    def __init__(self, data: bytes):
        magic, docs, self.n_ids, n_words, n_escaped = struct.unpack_from(_HEAD, data)
        if magic != b"S8B1":
            raise ValueError("not a block of token ids")
        at = struct.calcsize(_HEAD)

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        known, numbers = take(np.uint8, docs), take(np.int64, docs)
        self.doc_ids = [int(x) if k else None for x, k in zip(numbers, known)]
        self.lengths = take(np.uint64, docs).astype(np.int64)
        self.before = take(np.uint64, -(-n_words // STEP)).astype(np.int64)
        self.words, self.escaped = take(np.uint64, n_words), take(np.uint64, n_escaped)

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the block, from the words that hold them."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint64)
        first = int(np.searchsorted(self.before, start, "right")) - 1
        last = int(np.searchsorted(self.before, stop, "left"))
        wide = np.cumsum(self.words == np.uint64(2**64 - 1))
        skipped = int(wide[first * STEP - 1]) if first else 0
        got = unpack(self.words[first * STEP:last * STEP], self.escaped[skipped:], stop - int(self.before[first]))
        return got[start - int(self.before[first]):]


def gathered(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of at least ``size`` bytes, so that a word that comes often is looked up once."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.nbytes
        if n >= size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if held and (rows := pa.Table.from_batches(held)).num_rows:
        yield rows.combine_chunks().to_batches()[0]


_BLOCKS = "part int, block int, ids_before long, n_ids long, data binary"


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, pieces=words, block_ids: int = BLOCK_IDS) -> None:
    """Encode ``docs`` (doc_id, text) with a closing ``end_id`` each, into a new file at ``path``."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before = TaskContext.get().partitionId(), 0, 0
        names, ids, held = [], [], 0
        end = np.array([end_id], np.uint64)

        def close():
            nonlocal number, before, names, ids, held
            row = [[part], [number], [before], [held], [write_block(names, ids)]]
            number, before, names, ids, held = number + 1, before + held, [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                ["part", "block", "ids_before", "n_ids", "data"])

        for batch in gathered(batches):
            texts = batch.column(1).fill_null("")
            if pieces is words:
                coded = shared_words(tokenizer).encode(texts)
            else:
                encoder = shared_encoder(tokenizer, pieces)
                coded = [np.frombuffer(encoder.encode(t), "<u4") for t in texts.to_pylist()]
            for doc, run in zip(batch.column(0).to_pylist(), coded):
                names.append(doc)
                ids += [run, end]
                held += len(run) + 1
                if held >= block_ids:
                    yield close()
        if names:
            yield close()

    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # Equal ids are ordered by a digest of the text, so that a repeated run writes the same file. The
    # sample for the range bounds then holds numbers only, no texts.
    order = [F.col("doc_id"), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(blocks, _BLOCKS).write.parquet(f"{path}/blocks")
    # One row for each part.
    sizes = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")).write.parquet(f"{path}/parts")


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, and its ``ids`` if wanted, from the file."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, start in zip(batch.column(0), batch.column(1)):
                block = Block(data.as_py())
                ids = block.ids().astype("<u4")
                ends = np.cumsum(block.lengths)
                begins = ends - block.lengths
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(begins, ends)]
                columns = [pa.array(block.doc_ids, pa.int64()), pa.array(begins + start.as_py()), pa.array(block.lengths), pa.array(crcs, pa.int64())]
                if with_ids:
                    offsets = np.append(begins, ends[-1:]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(offsets, ids.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    parts = spark.read.schema("part int, part_start long").parquet(f"{path}/parts")
    placed = blocks.join(F.broadcast(parts), "part")  # as many rows as the file has parts
    return placed.select("data", (F.col("part_start") + F.col("ids_before")).alias("start")).mapInArrow(documents, schema)


@query("op2_simple8b")
def op2_simple8b(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "token-ids")
    write_ids(table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_ids(spark, path)
