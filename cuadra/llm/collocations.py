"""Phrase collocations, counted with broadcast double-array tries.

Texts become blocks of word numbers once. Candidates are found level by level and never lose a frequent
phrase: a phrase of k words is looked at only where both phrases of k - 1 words inside it may be frequent,
which a bitmap of fixed size answers (it may say yes too often, never no), and it stays if the sums of its
occurrences reach the minimum. The candidates, sorted, are cut into shards of a fixed number of phrases.
Each shard is built into a double-array trie by a task and broadcast; every task then moves the states of
all its text positions one word further at a time with a few array lookups, counts accepting states with
``bincount``, and the counts of all tasks are summed. Scores are exact: whole decimals, no floats.

A word is known by a 64-bit hash. The table of all words shows whether two words share one; then everything
is hashed again with another seed.

Cases: null text counts as empty and a null ``lang`` as ``und``; an empty text has no words. Repeated rows
count again. Words are whatever stands between blanks, tabs and the marks that end a piece, of any length.
Phrases never reach over the end of a document or piece. Ties are ordered by phrase. Extra columns are
ignored. Without a candidate there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuadra.llm.common import query, table
from cuadra.operators.position import with_position
from cuadra.session import broadcast_if_small, scratch_path, written_once

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
COVERED = 80  # per cent of its occurrences that a longer candidate must hold to replace a phrase
SCALE = 2_000_000

BLOCK_TOKENS = 1 << 18
BLOCK_ROWS = 2  # blocks that go to Python at once
TASK_TOKENS = 1 << 20  # a task counts so many words at a time before it hands on
SHARD = 1 << 18  # phrases in one trie
BITMAP_BITS = 26  # 8 MB, whatever the number of phrases

# Kinds of bytes: 0 in words, 1 between words, 2 between pieces. All marks are ASCII, so UTF-8 stays whole.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BLOCK = "g long, lang string, codes array<long>, words array<string>, counts array<long>, tokens binary"
_MIX = np.uint64(0x9E3779B97F4A7C15)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside hand so many rows at once to Python: a block is a row of a megabyte."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _sliced(batch: pa.RecordBatch, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """A long result in pieces, so that neither side holds a second copy of it."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Word numbers of all texts, with -1 where a piece begins, and the distinct words they stand for."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    if offsets[-1] == offsets[0]:
        return np.zeros(0, np.int32), pa.array([], pa.string())
    data = np.frombuffer(texts.buffers()[2], np.uint8, int(offsets[-1] - offsets[0]), int(offsets[0]))
    bounds = np.unique(offsets - offsets[0])[:-1]
    kind = _KIND[data]
    inside = kind == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[bounds] = inside[bounds]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.int32), pa.array([], pa.string())
    # A piece begins at the first word behind a mark or the start of a document.
    cut = kind == 2
    cut[bounds] = True
    piece = np.cumsum(cut)[starts]
    opens = np.ones(len(starts), bool)
    opens[1:] = piece[1:] != piece[:-1]
    letters = _LOWER[data[inside]]
    begins = (np.cumsum(inside)[starts] - 1).astype(np.int32)
    ends = np.append(begins, len(letters)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(letters)]).dictionary_encode()
    out = np.full(len(starts) + int(opens.sum()), -1, np.int32)
    out[np.arange(len(starts)) + np.cumsum(opens)] = words.indices.to_numpy()
    return out, words.dictionary.cast(pa.string())


def _hash(data: bytes, seed: int, bits: int) -> int:
    """A signed integer of at most ``bits`` bits."""
    import xxhash

    return xxhash.xxh3_64_intdigest(data, seed) >> (64 - bits) if bits < 64 else xxhash.xxh3_64_intdigest(data, seed) - (1 << 63)


def text_blocks(docs: DataFrame, seed: int = 0, bits: int = 64, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The texts as blocks of one language: distinct words with hash and count, and the word numbers."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[dict[str, int], list[np.ndarray]]] = {}

        def close(lang: str) -> pa.RecordBatch:
            numbers, runs = known.pop(lang)
            tokens = np.concatenate(runs)
            counts = np.bincount(tokens[tokens >= 0], minlength=len(numbers))
            codes = [_hash(w.encode(), seed, bits) for w in numbers]
            row = [[_hash(lang.encode(), seed, bits)], [lang], [codes], [list(numbers)], [counts.tolist()], [tokens.tobytes()]]
            kinds = [pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)], [c.split()[0] for c in _BLOCK.split(", ")])

        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            which = langs.indices.to_numpy()
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                found, words = tokens_of(batch.column(1).take(pa.array(np.flatnonzero(which == i))))
                if not len(found):
                    continue
                numbers, runs = known.setdefault(lang, ({}, []))
                mapped = np.array([numbers.setdefault(w, len(numbers)) for w in words.to_pylist()] + [-1], np.int32)
                runs.append(mapped[found])
                if sum(map(len, runs)) >= block_tokens:
                    yield close(lang)
        for lang in list(known):
            yield close(lang)

    plain = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return written_once(plain.mapInArrow(blocks, _BLOCK))


def word_counts(blocks: DataFrame) -> DataFrame:
    """g, lang, code, word and f, the occurrences of each word of each language.

    Written in as many files as its size asks for (``rebalance``), like all results of counting here.
    """
    each = blocks.select("g", "lang", F.explode(F.arrays_zip("codes", "words", "counts")).alias("_w"))
    return written_once(each.groupBy("g", "lang", F.col("_w.codes").alias("code"), F.col("_w.words").alias("word")).agg(F.sum("_w.counts").alias("f")).hint("rebalance"))


class Bitmap:
    """Which phrases may be frequent: one bit for each hash, in memory of a fixed size."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(g: int | np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
        """The bit of each phrase, from the hashes of its language and words."""
        h = np.full(len(columns[0]), g, np.int64).view(np.uint64) if np.isscalar(g) else g.astype(np.int64).view(np.uint64)
        for c in columns:
            h = (h ^ (h >> np.uint64(29))) * _MIX + np.ascontiguousarray(c, np.int64).view(np.uint64)
        h = (h ^ (h >> np.uint64(32))) * _MIX
        return (h >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)

    @classmethod
    def of(cls, phrases: DataFrame, words: int) -> "Bitmap":
        """The bitmap of the rows of ``phrases`` (g, c1, ...); the driver gets no more than 2^(BITMAP_BITS - 6) numbers."""

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at = np.unique(cls.places(b.column(0).to_numpy(), [b.column(i + 1).to_numpy() for i in range(words)]))
                yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((at & 63).astype(np.int32))], ["slot", "bit"])

        names = [f"c{i + 1}" for i in range(words)]
        slots = phrases.select("g", *names).mapInArrow(places, "slot long, bit int").groupBy("slot").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        got = slots.toArrow()
        bits = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
        bits[got.column("slot").to_numpy()] = got.column("bits").to_numpy()
        return cls(bits)

    def may_hold(self, g: int, columns: list[np.ndarray]) -> np.ndarray:
        at = self.places(g, columns)
        return (self.bits[at >> 6] >> (at & 63)) & 1 == 1


def _seen(g: int, blocks: list[tuple[np.ndarray, np.ndarray]], level: int, maps: list[Bitmap]) -> tuple[list[np.ndarray], np.ndarray]:
    """The word hashes of each phrase of ``level`` words in some blocks of one language, and its occurrences.

    Phrases of which a shorter part cannot be frequent are left out.
    """
    uniq, back = np.unique(np.concatenate([c for c, _ in blocks]), return_inverse=True)
    number = np.where(maps[0].may_hold(g, [uniq]), np.arange(len(uniq)), -1).astype(np.int32)
    runs, at = [], 0
    for codes, tokens in blocks:
        own = np.append(number[back[at:at + len(codes)]], np.int32(-1))
        runs += [own[tokens], own[-1:]]
        at += len(codes)
    ids = np.concatenate(runs)
    columns, phrase = [uniq], ids  # of the words; then of longer and longer phrases
    for k in range(2, level + 1):
        # Both parts, one word apart, may be frequent; a phrase is its first part and one more word.
        place = np.flatnonzero((phrase[:-1] >= 0) & (phrase[1:] >= 0))
        key = phrase[place].astype(np.int64) * len(uniq) + ids[place + k - 1]
        if k == level:  # sorting needs less memory than a hash table
            distinct, n = np.unique(key, return_counts=True)
        else:
            number_of, distinct = pd.factorize(key)
        head, last = distinct // len(uniq), distinct % len(uniq)
        columns = [c[head] for c in columns] + [uniq[last]]
        if k == level:
            return columns, n
        kept = maps[k - 1].may_hold(g, columns)
        phrase = np.full(len(ids), -1, np.int32)
        phrase[place] = np.where(kept[number_of], number_of, -1)
    raise ValueError("level must be at least 2")


def frequent_phrases(blocks: DataFrame, level: int, maps: list[Bitmap], least: int, task_tokens: int = TASK_TOKENS) -> DataFrame:
    """g, c1 .. c``level`` of the phrases whose occurrences reach ``least``."""
    names = [f"c{i + 1}" for i in range(level)]
    shared = blocks.sparkSession.sparkContext.broadcast(maps)  # BITMAP_BITS each

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def close(g: int) -> pa.RecordBatch:
            columns, n = _seen(g, held.pop(g), level, shared.value)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), g, np.int64)), *map(pa.array, columns), pa.array(n)], ["g", *names, "n"])

        for batch in batches:
            for g, codes, tokens in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                held.setdefault(g, []).append((codes.values.to_numpy(), np.frombuffer(tokens.as_buffer(), np.int32)))
                if sum(len(t) for _, t in held[g]) >= task_tokens:
                    yield from _sliced(close(g))
        for g in list(held):
            yield from _sliced(close(g))

    rows = blocks.select("g", "codes", "tokens").mapInArrow(seen, f"g long, {', '.join(f'{c} long' for c in names)}, n long")
    # The tasks have added up their own occurrences; a second hash table beside the scan would only need memory.
    rows = rows.repartition("g", *names)
    with batches_of(blocks.sparkSession, BLOCK_ROWS):
        found = written_once(rows.groupBy("g", *names).agg(F.sum("n").alias("n")).filter(F.col("n") >= least).drop("n").hint("rebalance"))
    shared.destroy()  # the written table never asks for it again
    return found


class Trie:
    """A double-array trie of phrases: the child of state s by symbol c is base[s] + c, if check there is s."""

    def __init__(self, symbols: np.ndarray, base: np.ndarray, check: np.ndarray, accept: np.ndarray):
        self.symbols, self.base, self.check, self.accept = symbols, base, check, accept

    @classmethod
    def build(cls, phrases: np.ndarray, lengths: np.ndarray, accept: np.ndarray) -> "Trie":
        """From rows of word hashes (the first ``lengths`` of each row), distinct; ``accept`` numbers them."""
        used = np.arange(phrases.shape[1]) < lengths[:, None]
        symbols = np.unique(phrases[used])
        coded = np.where(used, np.searchsorted(symbols, phrases) + 1, 0)
        width = len(symbols) + 1
        # Nodes of one length after another; node 0 is the root.
        parent, symbol, accepts = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [np.array([-1])]
        node, total = np.zeros(len(phrases), np.int64), 1
        for k in range(phrases.shape[1]):
            rows = np.flatnonzero(lengths > k)
            if not len(rows):
                break
            keys, back = np.unique(node[rows] * width + coded[rows, k], return_inverse=True)
            node[rows] = total + back
            own = np.full(len(keys), -1)
            ends = rows[lengths[rows] == k + 1]
            own[node[ends] - total] = accept[ends]
            parent.append(keys // width)
            symbol.append(keys % width)
            accepts.append(own)
            total += len(keys)
        parent, symbol, accepts = map(np.concatenate, (parent, symbol, accepts))

        # The root's children stand at their symbols. Then large families, each at the first of some random
        # places that are free, and at last only children, for which any free cell will do.
        size = width + total * 3 // 2 + 64
        free = np.ones(size, bool)
        free[:width] = False
        base = np.zeros(total, np.int64)
        order = np.argsort(parent[1:], kind="stable") + 1
        families, first, many = np.unique(parent[order], return_index=True, return_counts=True)
        dice = np.random.default_rng(0)
        for i in np.argsort(-many, kind="stable"):
            if many[i] < 2:
                break
            if families[i] == 0:
                continue
            kids = symbol[order[first[i]:first[i] + many[i]]]
            for _ in range(16):
                tries = dice.integers(0, len(free) - width, 16)
                fits = free[tries[:, None] + kids].all(axis=1)
                if fits.any():
                    at = int(tries[np.argmax(fits)])
                    break
            else:
                at = len(free)
                free = np.append(free, np.ones(width, bool))
            free[at + kids] = False
            base[families[i]] = at
        alone = np.flatnonzero((many == 1) & (families != 0))
        cells = np.flatnonzero(free)
        if len(cells) < len(alone):
            cells = np.append(cells, len(free) + np.arange(len(alone)))
        base[families[alone]] = cells[:len(alone)] - symbol[order[first[alone]]]

        cell = np.zeros(total, np.int64)
        cell[1:] = base[parent[1:]] + symbol[1:]
        size = int(max(cell.max(initial=0), width)) + 2  # the last cell is never a state
        out = [np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)]
        out[0][cell] = base
        out[1][cell[1:]] = cell[parent[1:]]
        out[2][cell] = accepts
        return cls(symbols, *out)

    def to_bytes(self) -> bytes:
        head = np.array([len(self.symbols), len(self.base)], np.int64)
        return b"".join(x.tobytes() for x in (head, self.symbols, self.base, self.check, self.accept))

    @classmethod
    def from_bytes(cls, data: bytes) -> "Trie":
        n, size = np.frombuffer(data, np.int64, 2)
        at = 16 + int(n) * 8
        arrays = [np.frombuffer(data, np.int32, int(size), at + i * 4 * int(size)) for i in range(3)]
        return cls(np.frombuffer(data, np.int64, int(n), 16), *arrays)

    def count(self, codes: np.ndarray, tokens: np.ndarray, into: np.ndarray) -> None:
        """Add to ``into``, by state, how often each is reached from all positions of a block."""
        at = np.searchsorted(self.symbols, codes).clip(0, len(self.symbols) - 1)
        own = np.append(np.where(self.symbols[at] == codes, at + 1, 0), 0)
        symbol = np.append(own[tokens], np.zeros(MAX_WORDS, np.int64))
        place = np.flatnonzero(symbol)
        place = place[self.check[symbol[place]] == 0]
        state = symbol[place]
        reached = [state]
        for k in range(1, MAX_WORDS):
            after = symbol[place + k]
            to = np.clip(self.base[state] + after, 0, len(self.base) - 1)
            on = (after > 0) & (self.check[to] == state)
            place, state = place[on], to[on]
            if not len(place):
                break
            reached.append(state)
        into += np.bincount(np.concatenate(reached), minlength=len(into))


def trie_counts(blocks: DataFrame, candidates: DataFrame, shard: int = SHARD) -> DataFrame:
    """``candidates`` (g, c1 .. c4, null behind the end) with f, the exact number of their occurrences."""
    spark = blocks.sparkSession
    names = [f"c{i + 1}" for i in range(MAX_WORDS)]
    placed = written_once(with_position(candidates, order=["g", *names]).withColumn("_shard", F.expr(f"pos div {shard}")))

    # At most ``shard`` phrases in a group.
    plain = placed.select("_shard", "g", "pos", F.expr(f"{' + '.join(f'int({c} is not null)' for c in names)}").alias("k"), *[F.coalesce(c, F.lit(0)).alias(c) for c in names])

    def build(key, rows):
        trie = Trie.build(rows[names].to_numpy(np.int64), rows["k"].to_numpy(), rows["pos"].to_numpy(np.int64) - key[0] * shard)
        return pd.DataFrame({"_shard": [key[0]], "g": [key[1]], "trie": [trie.to_bytes()]})

    tries = written_once(plain.groupBy("_shard", "g").applyInPandas(build, "_shard long, g long, trie binary"))
    path = scratch_path(spark, "trie-counts")
    shards = tries.agg(F.max("_shard")).first()[0]
    for number in range(-1 if shards is None else shards + 1):
        # The driver holds the tries of one shard.
        held = spark.sparkContext.broadcast({r.g: r.trie for r in tries.filter(F.col("_shard") == number).collect()})

        def counted(batches: Iterator[pa.RecordBatch], held=held, number=number) -> Iterator[pa.RecordBatch]:
            sums: dict[int, tuple[Trie, np.ndarray]] = {}
            for batch in batches:
                for g, codes, tokens in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                    if g not in held.value:
                        continue
                    if g not in sums:
                        trie = Trie.from_bytes(held.value[g])
                        sums[g] = trie, np.zeros(len(trie.base), np.int64)
                    trie, into = sums[g]
                    trie.count(codes.values.to_numpy(), np.frombuffer(tokens.as_buffer(), np.int32), into)
            for trie, into in sums.values():
                hit = np.flatnonzero((into > 0) & (trie.accept >= 0))
                yield from _sliced(pa.RecordBatch.from_arrays([pa.array(trie.accept[hit] + np.int64(number * shard)), pa.array(into[hit])], ["pos", "n"]))

        with batches_of(spark, BLOCK_ROWS):
            blocks.select("g", "codes", "tokens").mapInArrow(counted, "pos long, n long").groupBy("pos").agg(F.sum("n").alias("f")).hint("rebalance").write.mode("append").parquet(path)
        held.destroy()
    counts = spark.read.schema("pos long, f long").parquet(path) if shards is not None else spark.createDataFrame([], "pos long, f long")
    return written_once(placed.join(counts, "pos").select("g", F.expr(f"filter(array({', '.join(names)}), x -> x is not null)").alias("p"), "f"))


def scored(counted: DataFrame) -> DataFrame:
    """g, p, a, l, r and score of the phrases of two words and more that no longer candidate covers."""
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    phrases = counted.filter("size(p) > 1").withColumnRenamed("f", "a")
    part = lambda name, f: counted.select(F.col("g"), F.col("p").alias(name), F.col("f").alias(f))
    cuts = phrases.select("g", "p", "a", F.explode(F.sequence(F.lit(1), F.size("p") - 1)).alias("k")).select(
        "*", F.expr("slice(p, 1, k)").alias("_l"), F.expr("slice(p, k + 1, size(p) - k)").alias("_r"))
    cuts = cuts.join(part("_l", "l"), ["g", "_l"]).join(part("_r", "r"), ["g", "_r"])
    cuts = cuts.withColumn("score", F.expr(f"(cast(a as decimal(28,0)) * {SCALE}) div (cast(l as decimal(28,0)) + r)"))
    best = cuts.groupBy("g", "p", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_b")).select("g", "p", "a", "_b.l", "_b.r", "_b.score")
    # The largest count of a longer candidate around each part of it.
    inner = phrases.filter("size(p) > 2").select(
        "g", "a", F.explode(F.expr("flatten(transform(sequence(2, size(p) - 1), n -> transform(sequence(1, size(p) - n + 1), i -> slice(p, i, n))))")).alias("p"))
    around = inner.groupBy("g", "p").agg(F.max("a").alias("_longer"))
    joined = best.join(around, ["g", "p"], "left")
    return joined.filter(F.col("_longer").isNull() | (exact("_longer") * 100 < exact("a") * COVERED)).drop("_longer")


def collocations(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP, bits: int = 64, shard: int = SHARD, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the ``top`` phrases of each language."""
    seed = 0
    while True:
        blocks = text_blocks(docs, seed, bits, block_tokens)
        words = word_counts(blocks)
        if words.groupBy("g", "code").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").isEmpty() and \
                words.select("g", "lang").distinct().groupBy("g").count().filter("count > 1").isEmpty():
            break
        seed += 1  # two words or languages share a hash
    frequent = words.filter(F.col("f") >= least)
    found = [frequent.select("g", F.col("code").alias("c1"))]
    maps = [Bitmap.of(found[0], 1)]
    for level in range(2, MAX_WORDS + 1):
        found.append(frequent_phrases(blocks, level, maps, least))
        if level < MAX_WORDS:
            maps.append(Bitmap.of(found[-1], level))
    candidates = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
    results = written_once(scored(trie_counts(blocks, candidates, shard)))

    # Ties at the last place stay until the words are known. Each task keeps only rows that can still be in.
    place = Window.partitionBy("g").orderBy(F.desc("score"), F.desc("a"))
    near = results.withColumn("_rank", F.rank().over(place)).filter(F.col("_rank") <= top).drop("_rank")
    near = written_once(near)
    spelled = near.select("g", "p", F.posexplode("p").alias("_i", "code")).join(words.select("g", "code", "word"), ["g", "code"])
    phrases = spelled.groupBy("g", "p").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    totals = words.groupBy("g", "lang").agg(F.sum("f").alias("n"))
    named = near.join(phrases, ["g", "p"]).join(broadcast_if_small(totals), "g")  # one row for each language
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


OP11_SQL = f"""
with texts as (
  select coalesce(lang, 'und') lang, row_number() over () doc,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
pieces as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) s from texts),
runs as (select lang, regexp_extract_all(s, '[^\\x20\\x09]+') w from pieces),
grams as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') phrase, count(*) f
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) i from runs, (values (1), (2), (3), (4)) v(k) where len(w) >= k)
  group by all),
total as (select lang, sum(f) n from grams where k = 1 group by lang),
frequent as (select lang, k, phrase, f, string_split(phrase, ' ') w from grams where f >= {MIN_COUNT}),
cuts as (
  select c.lang, c.phrase, c.f a, c.place, l.f l, r.f r,
         (c.f::hugeint * {SCALE}) // (l.f::hugeint + r.f) score
  from (select *, unnest(range(1, k)) place from frequent where k > 1) c
  join frequent l on l.lang = c.lang and l.phrase = array_to_string(c.w[1:c.place], ' ')
  join frequent r on r.lang = c.lang and r.phrase = array_to_string(c.w[c.place + 1:], ' ')),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, place) = 1),
inside as (
  select lang, array_to_string(w[i:i + n - 1], ' ') phrase, max(f) longer
  from (select lang, w, k, f, n, unnest(range(1, k - n + 2)) i from (select *, unnest(range(2, k)) n from frequent where k > 2))
  group by 1, 2),
kept as (
  select b.*, row_number() over (partition by b.lang order by b.score desc, b.a desc, b.phrase) rank
  from best b left join inside i on i.lang = b.lang and i.phrase = b.phrase
  where i.longer is null or 100 * i.longer::hugeint < {COVERED} * b.a::hugeint)
select k.lang, k.rank, k.phrase, k.a::bigint a, k.l::bigint l, k.r::bigint r, t.n::bigint n, k.score::bigint score
from kept k join total t on t.lang = k.lang where k.rank <= {TOP}
"""


@query("op11_collocations", OP11_SQL)
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))
