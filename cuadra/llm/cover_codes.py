"""Vector codes from codebooks that Lloyd's rounds improve, with cover trees over the vectors.

Vectors become whole numbers and are cut into equal parts, each with a codebook of its own. Every task
builds cover trees over chunks of the vectors it reads, one for each part: a node stands for all vectors
within its radius of a centre, its children have centres further apart than the next smaller power of two
and cover it within that distance. Vectors are stored in the order of the tree, so that a subtree is a run
of rows, and with cumulative sums, so that its sum is one difference. In a round the nodes go down level by
level: if the second nearest entry is further from a node's centre than the nearest by more than twice the
radius, the whole subtree belongs to the nearest (triangle inequality). Only ambiguous nodes descend, and
only the vectors at the bottom are compared one by one. All comparisons that decide are exact.

The trees are written once; a round reads them, and gives the driver one sum for each number of the
codebooks, whatever the number of vectors.

Cases: rows whose vector is null or holds a null, infinite or undefined component are left out. Shorter vectors are
filled up with zeros to the longest, and that to whole parts; an empty vector is all zeros. Components beyond
2^30 / sqrt(length) count as that bound, so that every squared distance fits 64 bits. Fewer vectors than
entries make smaller codebooks. Null ids come last and equal ids are ordered by vector. Repeated rows are all
coded. Equal vectors take the same branch of a tree. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadra.llm.common import query, table
from cuadra.session import broadcast_if_small, written_once

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
CHUNK = 2048  # vectors in one tree
LEAF = 8  # so few vectors are compared one by one
BOUND = 1 << 30


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` from all rows of ``b``."""
    top = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    if a.shape[1] * (2 * top) ** 2 < 1 << 52:  # whole numbers that floats hold exactly
        a, b = a.astype(np.float64), b.astype(np.float64)
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)


class CoverTree:
    """A cover tree over the rows of a matrix.

    Nodes stand level by level: ``centre`` (a row), ``radius``, the rows ``begin`` to ``end`` of the subtree,
    and its children ``child`` to ``child + kids``. ``rows`` are the distinct vectors in the order of the tree,
    ``weight`` how often each occurs, ``place`` the row of each given vector.
    """

    FIELDS = ("rows", "weight", "place", "centre", "radius", "begin", "end", "child", "kids")

    def __init__(self, **arrays: np.ndarray):
        self.__dict__.update(arrays)
        running = np.cumsum(self.rows * self.weight[:, None], axis=0)
        self.sums = np.vstack([np.zeros((1, self.rows.shape[1]), np.int64), running])
        self.counts = np.append(0, np.cumsum(self.weight))

    @classmethod
    def build(cls, vectors: np.ndarray) -> "CoverTree":
        rows, back, weight = np.unique(vectors, axis=0, return_inverse=True, return_counts=True)
        apart = np.sqrt(np.maximum(squared(rows, rows), 0).astype(np.float64))
        order = np.zeros(len(rows), np.int64)
        nodes: list[list[float]] = []  # centre, radius, begin, end, child, kids
        queue = [(np.arange(len(rows)), 0, 0)]
        for members, centre, begin in queue:
            reach = apart[centre, members]
            radius = float(reach.max())
            node = [centre, radius, begin, begin + len(members), 0, 0]
            nodes.append(node)
            order[begin:begin + len(members)] = members
            if len(members) <= LEAF or radius == 0:
                continue
            # The centre comes first (it is its own child), then whatever no child covers yet.
            step = 2.0 ** (math.frexp(radius)[1] - 1)
            if step >= radius:
                step /= 2
            node[4], at = len(queue), begin
            left, pick = members, centre
            while len(left):
                near = apart[pick, left] <= step
                own = left[near]
                queue.append((own, pick, at))
                at += len(own)
                left = left[~near]
                pick = int(left[0]) if len(left) else 0
            node[5] = len(queue) - node[4]
        rank = np.empty(len(rows), np.int64)
        rank[order] = np.arange(len(rows))
        columns = list(zip(*nodes))
        whole = lambda i: np.array(columns[i], np.int64)
        return cls(rows=rows[order], weight=weight[order].astype(np.int64), place=rank[back.ravel()], centre=rank[whole(0)],
                   radius=np.array(columns[1]), begin=whole(2), end=whole(3), child=whole(4), kids=whole(5))

    def assign(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of rows (begin, end) and the index of the nearest entry of ``book`` for each; the lower index of equal ones."""
        # Of equal entries only the first can be nearest, and a second one would make every node ambiguous.
        _, first = np.unique(book, axis=0, return_index=True)
        first.sort()
        entries = book[first]
        front, single = np.zeros(1, np.int64), []
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(front):
            far = squared(self.rows[self.centre[front]], entries)
            nearest = far.argmin(axis=1)
            if len(entries) > 1:
                two = np.sqrt(np.maximum(np.partition(far, 1, axis=1)[:, :2], 0).astype(np.float64))
                # Room for rounding of the roots; it can only make a node descend.
                clear = two[:, 1] - two[:, 0] > 2 * self.radius[front] + 1e-6 * (1 + two[:, 1])
            else:
                clear = np.ones(len(front), bool)
            found.append((self.begin[front[clear]], self.end[front[clear]], nearest[clear]))
            rest = front[~clear]
            inner = rest[self.kids[rest] > 0]
            bottom = rest[self.kids[rest] == 0]
            single += [np.arange(a, b) for a, b in zip(self.begin[bottom], self.end[bottom])]
            front = np.concatenate([np.arange(c, c + k) for c, k in zip(self.child[inner], self.kids[inner])]) if len(inner) else inner
        if single:
            rows = np.concatenate(single)
            found.append((rows, rows + 1, squared(self.rows[rows], entries).argmin(axis=1)))
        begin, end, nearest = map(np.concatenate, zip(*found))
        return begin, end, first[nearest]

    def add_sums(self, book: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> None:
        """Add the sum and number of the vectors of each entry."""
        begin, end, nearest = self.assign(book)
        np.add.at(sums, nearest, self.sums[end] - self.sums[begin])
        np.add.at(counts, nearest, self.counts[end] - self.counts[begin])

    def codes(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance of each given vector."""
        begin, end, nearest = self.assign(book)
        label = np.empty(len(self.rows), np.int64)
        for a, b, c in zip(begin, end, nearest):
            label[a:b] = c
        error = ((self.rows - book[label]) ** 2).sum(axis=1)
        return label[self.place], error[self.place]


def whole_vectors(vectors: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, label and ``v``, the vector in whole numbers; rows with unusable vectors are left out."""
    x = F.col(column).cast("array<double>")
    unusable = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(float(BOUND))), F.lit(float(-BOUND)))).cast("long"))
    return vectors.filter(F.col(column).isNotNull() & ~unusable).select(F.col("vec_id").cast("long").alias("vec_id"), "label", whole.alias("v"))


def _padded(columns: pa.ListArray, width: int) -> np.ndarray:
    """The vectors as rows of a matrix, filled up with zeros."""
    offsets = columns.offsets.to_numpy().astype(np.int64)
    lengths = np.diff(offsets)
    values = columns.values.to_numpy()[offsets[0]:offsets[-1]]
    out = np.zeros((len(columns), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    limit = int(BOUND / math.sqrt(max(width, 1)))
    return np.clip(out, -limit, limit)


def cover_trees(whole: DataFrame, width: int, parts: int = PARTS, chunk: int = CHUNK) -> DataFrame:
    """One row for each chunk of vectors: their ids and labels, and the tree of each part."""
    names = CoverTree.FIELDS
    kinds = pa.struct([(f, pa.binary()) for f in names])

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            matrix = _padded(rows.column(2), width)
            trees = [CoverTree.build(p) for p in np.split(matrix, parts, axis=1)]
            cells = [{f: getattr(t, f).tobytes() for f in names} for t in trees]
            return pa.RecordBatch.from_arrays([pa.array([rows.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([rows.column(1).to_pylist()], pa.list_(rows.column(1).type)),
                                               pa.array([cells], pa.list_(kinds))], ["ids", "labels", "trees"])

        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                held.append(batch.slice(at, chunk))
                if sum(b.num_rows for b in held) >= chunk:
                    yield close()
        if sum(b.num_rows for b in held):
            yield close()

    label = whole.schema["label"].dataType.simpleString()
    fields = ", ".join(f"{f}: binary" for f in names)
    return written_once(whole.select("vec_id", "label", "v").mapInArrow(built, f"ids array<long>, labels array<{label}>, trees array<struct<{fields}>>"))


def _trees(cells: list[dict], width: int) -> list[CoverTree]:
    """The trees of one chunk from their bytes; each part is ``width`` numbers."""
    out = []
    for cell in cells:
        arrays = {f: np.frombuffer(b, np.float64 if f == "radius" else np.int64) for f, b in cell.items()}
        arrays["rows"] = arrays["rows"].reshape(len(arrays["weight"]), width)
        out.append(CoverTree(**arrays))
    return out


def improved(trees: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round; the driver gets one sum for each of their numbers."""
    width = books[0].shape[1]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(b.shape, np.int64) for b in books]
        counts = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for row in batch.column(0):
                for tree, book, s, n in zip(_trees(row.as_py(), width), books, sums, counts):
                    tree.add_sums(book, s, n)
        for part, (s, n) in enumerate(zip(sums, counts)):
            hit = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hit), part, np.int32)), pa.array(hit.astype(np.int32)), pa.array(n[hit]),
                                              pa.array(list(s[hit]), pa.list_(pa.int64()))], ["part", "entry", "n", "s"])

    each = trees.select("trees").mapInArrow(summed, "part int, entry int, n long, s array<long>")
    big = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    numbers = each.select("part", "entry", "n", F.posexplode(F.concat(F.array("n"), F.col("s"))).alias("at", "x"))
    total = numbers.groupBy("part", "entry", "at").agg(big("x").alias("x")).groupBy("part", "entry").agg(
        F.sort_array(F.collect_list(F.struct("at", "x"))).alias("x"))  # one number for each place of an entry
    out = [b.copy() for b in books]
    for row in total.collect():
        n, *s = [int(x.x) for x in row.x]
        out[row.part][row.entry] = [v // n for v in s]
    return out


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def vector_codes(vectors: DataFrame, column: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                 scale: int = SCALE, chunk: int = CHUNK) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label, code and error of each usable vector, and the codebooks.

    ``entries`` is at most 256. The codebooks begin with the parts of the vectors with the smallest ids.
    """
    whole = written_once(whole_vectors(vectors, column, scale))
    longest = whole.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return whole.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), []
    width = -(-longest // parts) * parts
    first = whole.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").toArrow().column("v").combine_chunks()
    seeds = _padded(first, width)
    books = list(np.split(seeds, parts, axis=1))
    trees = cover_trees(whole, width, parts, chunk)
    for _ in range(rounds):
        books = improved(trees, books)
    final = books

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, cells in zip(batch.column(0), batch.column(1), batch.column(2)):
                each = [tree.codes(book) for tree, book in zip(_trees(cells.as_py(), width // parts), final)]
                text = ["".join(f"{c:02x}" for c in row) for row in zip(*[code.tolist() for code, _ in each])]
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, pa.array(text, pa.string()), pa.array(sum(e for _, e in each))],
                                                 ["vec_id", "label", "code", "error"])

    kind = whole.schema["label"].dataType.simpleString()
    return written_once(trees.select("ids", "labels", "trees").mapInArrow(coded, f"vec_id long, label {kind}, code string, error long")), final


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with label_error, the error of all vectors of the same label; null is a label."""
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    sums = codes.groupBy(F.col("label").alias("_label")).agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error"))
    return codes.join(broadcast_if_small(sums), F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def _sql() -> str:
    """Every assignment compares all parts with all entries."""

    def nearest(k: int) -> str:
        return f"""
a{k} as materialized (
  select vec_id, part, min(d * {ENTRIES} + entry) m from (
    select p.vec_id, p.part, b.entry, list_sum(list_transform(list_zip(p.x, b.x), lambda t: (t[1] - t[2]) * (t[1] - t[2])))::bigint d
    from p join b{k} b on b.part = p.part) group by all)"""

    def book(k: int) -> str:
        return f"""
b{k + 1} as materialized (
  select b.part, b.entry, coalesce(n.x, b.x) x from b{k} b left join (
    select part, entry, list((s - ((s % n) + n) % n) // n order by place) x from (
      select part, entry, place, sum(v)::bigint s, count(*)::bigint n from (
        select p.part, a.m % {ENTRIES} entry, unnest(p.x) v, unnest(range(1, len(p.x) + 1)) place
        from p join a{k} a on a.vec_id = p.vec_id and a.part = p.part) group by all) group by part, entry) n
  on n.part = b.part and n.entry = b.entry)"""

    steps = ",".join(nearest(k) + "," + book(k) for k in range(ROUNDS)) + "," + nearest(ROUNDS)
    return f"""
with v as (
  select vec_id, label, list_transform(embedding, lambda c: floor({SCALE} * c::double)::bigint) v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
p as materialized (
  select vec_id, part, v[part * len(v) // {PARTS} + 1:(part + 1) * len(v) // {PARTS}] x from v, range(0, {PARTS}) r(part)),
b0 as materialized (
  select part, entry, x from (select vec_id, row_number() over (order by vec_id) - 1 entry from v qualify entry < {ENTRIES}) join p using (vec_id)),
{steps},
c as (
  select vec_id, string_agg(printf('%02x', (m % {ENTRIES})::integer), '' order by part) code, sum(m // {ENTRIES})::bigint error from a{ROUNDS} group by 1),
book as (select sha256(string_agg(array_to_string(x, ','), ',' order by part, entry)) codebooks_sha256 from b{ROUNDS})
select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error, codebooks_sha256 from c join v using (vec_id), book
"""


@query("op12_vector_codes", _sql())
def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    codes, books = vector_codes(table(spark, folder, "embeddings"))
    return with_label_error(codes).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
