"""Jaccard join of word shingles by blocked sparse matrix products.

Two documents link if their sets of five-word shingles have a Jaccard similarity of at least 75 %, that
is 100 * common >= 75 * all. Rows of the incidence matrix are documents, columns are shingles; the
product of the matrix with its transpose holds the overlaps. It is never formed as a whole:

1. Equal sets are one row. A row can only reach 75 % with another one if enough of its smallest shingle
   hashes occur twice in the corpus: a count on about a third of the shingles discards nearly all rows.
2. Of the rest, columns with one entry add nothing. Rows with fewer than 75 % of their shingles in other
   columns are discarded; the others keep the rarest few columns by which a partner must be found.
3. Each row is compared with the first row of each of its columns. These links join most of each group,
   at a cost in proportion to its size.
4. What shares columns, directly or through others, is a block. Inside a block the product is taken tile
   by tile, between slices whose rows and summed sizes are bounded, and only where the slices hold rows
   that are not joined yet and whose sizes allow 75 %. A tile gives one link for each two parts it joins.

Links, not all pairs, are returned, and no link between parts is lost: within a part, rows are connected.

Cases: null or empty text, or white space only, has an empty set and is linked with nothing. Fewer than
five words are one shingle. Repeated rows and equal texts share a set and are linked. A null ``doc_id``
is linked like others and is never the smallest. Extra columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadra.llm.common import fresh_name, query, table, without
from cuadra.llm.components import components
from cuadra.operators.position import with_running_sums
from cuadra.session import broadcast_if_small, written_once

WORDS = 5
PERCENT = 75
# Hashes beyond the shortest prefix that finds a partner, as a share of the set: with more of them, more
# must be found twice, which discards documents that only share a passage.
EXTRA = 0.1
SLICE = 1 << 17  # shingles in one slice of a tile
ROWS = 1 << 11  # rows in one slice of a tile: the product of two slices has no more than their product of numbers

_LOWER = bytes(32 if b in b" \t\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_R = np.random.default_rng(20240229)
_BYTES = _R.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _R.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits in which every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct shingle hashes of a text, by array operations on its bytes."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = 1 << n.bit_length()
            one = np.ones(1, np.uint64)  # keeps the join of the arrays in whole numbers
            self.up = np.concatenate([one, np.cumprod(np.full(n, _BASE, np.uint64))])
            self.down = np.concatenate([one, np.cumprod(np.full(n, _INVERSE, np.uint64))])

    def hashes(self, text: str | None) -> np.ndarray:
        data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8)
        visible = np.concatenate([[False], data != 32, [False]])
        edge = np.flatnonzero(visible[1:] != visible[:-1])
        start, end = edge[::2], edge[1::2]
        if not len(start):
            return np.zeros(0, np.uint64)
        self._powers(len(data) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * self.up[:len(data)])])
        word = _mixed((sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64))
        n = max(len(word) - WORDS + 1, 1)
        # A text of fewer words is told from a longer one by their number.
        total = np.full(n, max(WORDS - len(word), 0), np.uint64)
        for k in range(min(WORDS, len(word))):
            total += word[k:k + n] * _PLACES[k]
        return np.unique(_mixed(total))


def _least(n):
    """Fewest shingles that a set of ``n`` shares with a partner."""
    return -(-n * PERCENT // 100)


def _prefix(n: int) -> int:
    return min(n, n - _least(n) + 1 + int(n * EXTRA))


def _needed(n: int) -> int:
    """How many of the prefix a partner's prefix holds too, the partner having at least 75 % of the size."""
    return 1 + int(_least(n) * EXTRA)


def shingle_sets(docs: DataFrame, whole: bool = False) -> DataFrame:
    """doc_id, n, key1 and key2 (which tell a set), needed, and the smallest hashes, or all with ``whole``."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            rows = [shingler.hashes(t) for t in batch.column(1).to_pylist()]
            n = [len(r) for r in rows]
            key1 = [int(_mixed(r ^ np.uint64(_BASE)).sum(dtype=np.uint64)) for r in rows]
            key2 = [int(_mixed(r + np.uint64(_INVERSE)).sum(dtype=np.uint64)) for r in rows]
            kept = rows if whole else [r[:_prefix(len(r))] for r in rows]
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in kept])]).astype(np.int32)
            flat = np.concatenate([*kept, np.zeros(0, np.uint64)]).view(np.int64)
            signed = lambda v: pa.array(np.array(v, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), signed(key1), signed(key2),
                 pa.array([_needed(x) for x in n], pa.int64()), pa.ListArray.from_arrays(offsets, flat)],
                ["doc_id", "n", "key1", "key2", "needed", "hashes"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(sets, "doc_id long, n long, key1 long, key2 long, needed long, hashes array<long>")


_KEY = ["key1", "key2", "n"]


def _candidate_rows(docs: DataFrame, sets: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sets that step 1 leaves: (key, first, node), and (node, n, all hashes)."""
    some = sets.select("key1", "key2", "n", F.explode("hashes").alias("h"))
    twice = some.groupBy("h").count().filter("count > 1").select("h")
    found = some.hint("merge").join(twice, "h").groupBy(*_KEY).agg(F.count(F.lit(1)).alias("found"))
    # Equal sets find the same number each.
    near = groups.join(found, _KEY).filter(F.col("found") >= F.col("needed") * F.col("copies"))
    nodes = written_once(near.select(*_KEY, "first", F.monotonically_increasing_id().alias("node")))
    wanted = broadcast_if_small(nodes.select(F.col("first").alias("_id")).distinct())
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    rows = shingle_sets(texts, whole=True).join(broadcast_if_small(nodes.select(*_KEY, "node")), _KEY)
    # Copies with the same id give their row more than once.
    return nodes, written_once(rows.groupBy("node", "n").agg(F.any_value("hashes").alias("hashes")))


def _joinable(rows: DataFrame) -> DataFrame:
    """Step 2: node, n, common (hashes that other rows have too) and keys (the rarest of them)."""
    cells = rows.select("node", "n", F.explode("hashes").alias("h"))
    often = cells.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    shared = cells.hint("merge").join(often, "h").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("c", "h"))).alias("_s"))
    least = F.ceil(F.col("n") * PERCENT / 100)
    left = shared.filter(F.size("_s") >= least)
    return written_once(left.select(
        "node", "n", F.col("_s.h").alias("common"),
        F.slice(F.col("_s.h"), F.lit(1), (F.size("_s") - least + 1).cast("int")).alias("keys"),
    ))


def _similar(common, n1, n2):
    return 100 * common >= PERCENT * (n1 + n2 - common)


def _first_links(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Step 3: all pairs of a row and the first row of one of its columns, and those that are links."""
    places = rows.select("node", F.explode("keys").alias("h"))
    heads = places.groupBy("h").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("c")).filter("c > 1")
    pairs = written_once(
        places.hint("merge").join(heads.select("h", "head"), "h").filter("node != head").select("node", "head").distinct())
    a = rows.select("node", F.col("n").alias("n1"), F.col("common").alias("h1"))
    b = rows.select(F.col("node").alias("head"), F.col("n").alias("n2"), F.col("common").alias("h2"))
    met = pairs.hint("merge").join(a, "node").hint("merge").join(b, "head")
    links = met.filter(_similar(F.size(F.array_intersect("h1", "h2")), F.col("n1"), F.col("n2")))
    return pairs.select(F.col("node").alias("u"), F.col("head").alias("v")), links.select(F.col("node").alias("u"), F.col("head").alias("v"))


def _tile(rows: pd.DataFrame) -> pd.DataFrame:
    """The product of two slices; one link for each two parts that it joins."""
    one, two = rows[rows["side"] == 0], rows[rows["side"] == 1]
    if not len(two):
        two = one
    columns, place = np.unique(np.concatenate([*one["common"], *two["common"]]), return_inverse=True)
    cut = np.cumsum([len(h) for h in [*one["common"], *two["common"]]])[:-1]
    at = np.split(place, cut)
    overlap = np.zeros((len(one), len(two)), np.float32)
    step = min(4096, max(len(columns), 1))
    order = [(np.repeat(np.arange(len(part)), [len(x) for x in part]), np.concatenate(part), len(part)) for part in (at[:len(one)], at[len(one):])]
    for low in range(0, len(columns), step):
        dense = []
        for row, column, n in order:
            inside = (column >= low) & (column < low + step)
            block = np.zeros((n, step), np.float32)
            block[row[inside], column[inside] - low] = 1
            dense.append(block)
        overlap += dense[0] @ dense[1].T
    n1, n2 = one["n"].to_numpy()[:, None], two["n"].to_numpy()[None, :]
    c1, c2 = one["comp"].to_numpy(), two["comp"].to_numpy()
    i, j = np.nonzero(_similar(overlap.astype(np.int64), n1, n2) & (c1[:, None] != c2[None, :]))
    if not len(i):
        return pd.DataFrame({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64)})
    parts = np.unique(np.sort(np.stack([c1[i], c2[j]], 1), 1), axis=0)
    return pd.DataFrame(parts, columns=["u", "v"])


def _tile_links(rows: DataFrame, pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Step 4: links between the parts of each block."""
    blocks = components(pairs)
    named = rows.select("node", "n").join(blocks.withColumnRenamed("comp", "block"), "node").join(parts, "node", "left")
    named = written_once(named.select("node", "n", "block", F.coalesce("comp", "node").alias("comp")))
    open_blocks = named.groupBy("block").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b")).filter("_a != _b").select("block")
    left = named.hint("merge").join(open_blocks, "block")
    # A row weighs its shingles, and enough that short rows fill a slice as well.
    weighed = left.withColumn("_weight", F.greatest("n", F.lit(max(SLICE // ROWS, 1))))
    placed = with_running_sums(weighed, ["comp", "n", "node"], {"_until": "_weight"}, ["block"])
    sliced = written_once(placed.withColumn("slice", F.floor(F.col("_until") / SLICE)).drop("_until", "_weight"))
    slices = sliced.groupBy("block", "slice").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("comp").alias("c_low"), F.max("comp").alias("c_high"))
    slices = written_once(slices)
    other = slices.select("block", *[F.col(c).alias(f"{c}2") for c in slices.columns if c != "block"])
    joined = (F.col("c_low") == F.col("c_high")) & (F.col("c_low2") == F.col("c_high2")) & (F.col("c_low") == F.col("c_low2"))
    fits = 100 * F.least("high", "high2") >= PERCENT * F.greatest("low", "low2")
    tiles = slices.join(other, "block").filter("slice <= slice2").filter(~joined & fits)
    tiles = written_once(tiles.select("block", "slice", "slice2", F.monotonically_increasing_id().alias("tile")))
    sides = tiles.select("block", "slice", "tile", F.lit(0).alias("side")).unionByName(
        tiles.filter("slice != slice2").select("block", F.col("slice2").alias("slice"), "tile", F.lit(1).alias("side")))
    filled = sliced.join(sides, ["block", "slice"]).join(rows.select("node", "common"), "node")
    return filled.select("tile", "side", "n", "comp", "common").groupBy("tile").applyInPandas(_tile, "u long, v long")


def near_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of each row."""
    sets = written_once(shingle_sets(docs))
    filled = sets.filter("n > 0")
    groups = written_once(filled.groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first"), F.first("needed").alias("needed")))
    nodes, rows = _candidate_rows(docs, filled, groups)
    rows = _joinable(rows)
    pairs, links = _first_links(rows)
    parts = written_once(components(links))
    more = written_once(_tile_links(rows, pairs, parts))
    # Nodes joined in step 3 stand for their part; the tiles join parts.
    tops = components(more).select(F.col("node").alias("comp"), F.col("comp").alias("top"))
    lone = more.select(F.col("u").alias("comp")).union(more.select("v")).distinct()
    named = parts.unionByName(lone.select(F.col("comp").alias("node"), "comp")).distinct()
    final = named.join(tops, "comp", "left").select("node", F.coalesce("top", "comp").alias("top"))
    linked = written_once(nodes.join(final, "node").select(*_KEY, "first", "top"))
    least = linked.groupBy("top").agg(F.min("first").alias("component_id"))
    # Written, so that the last join shuffles both sides and a hot set can be split.
    chosen = written_once(groups.join(linked.join(least, "top").select(*_KEY, "component_id"), _KEY, "left").select(
        *_KEY, F.coalesce("component_id", "first").alias("component_id")))
    joined = sets.select("doc_id", *_KEY).hint("merge").join(chosen, _KEY, "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"),
                         F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows whose id is the smallest of their component, with their columns.

    Rows that share an id and a component stay or go together; a component without ids stays.
    """
    found = near_components(docs)
    return without(docs, found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near_copies_rows(docs: DataFrame) -> DataFrame:
    """One row of each component stays, the one with the smallest id, whatever the ids are.

    Rows are told apart by id and text, so that rows without an id or with an id that others have too are
    judged one by one. Of a component without ids one row stays. Rows equal in id and text stay or go together.
    """
    key = fresh_name(docs, "row_key")
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text")))
    found = near_components(keyed.select(F.col(key).alias("doc_id"), "text")).select(F.col("doc_id").alias("k"), F.col("component_id").alias("c"))
    ids = keyed.select(F.col(key).alias("k"), F.col("doc_id").cast("bigint").alias("id"))
    rows = written_once(found.distinct().join(ids.distinct(), "k"))
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("k"))
    first = rows.groupBy("c").agg(F.min(order).alias("_f")).select("c", F.col("_f.k").alias("kept"))
    gone = rows.hint("merge").join(first, "c").filter("k != kept").select(F.col("k").alias(key))
    return without(keyed, gone, (key,)).drop(key)


@query("op5_ngram_join")
def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_components(table(spark, folder, "documents"))
