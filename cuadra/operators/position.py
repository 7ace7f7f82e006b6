"""Row numbers and running sums over an order, without putting a series into one task.

``Window.orderBy`` without a partition, or with a key that owns a third of the table, sorts
everything in a single task. Here the rows are range-partitioned by (keys, order), so a long
series spreads over as many partitions as its size asks for. What a partition must know of the
earlier ones is a count or a sum per (partition, key): a table of at most
``partitions + distinct keys`` rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuadra.session import broadcast_if_small, written_once

# monotonically_increasing_id() holds the partition above bit 33 and the row below it.
_ROW_BITS = 33


def _ordered(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Rows sorted by (keys, order) across partitions, with ``_part`` and ``_at`` in each."""
    sort = [F.col(k) for k in keys] + [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    # The range bounds come from a sample, so a second run could cut elsewhere. The written copy
    # fixes them for all later uses.
    return written_once(ranged.withColumn("_mid", F.monotonically_increasing_id())).select(
        *df.columns,
        F.shiftright("_mid", _ROW_BITS).alias("_part"),
        F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_at"),
    )


def _join_parts(rows: DataFrame, parts: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Attach the ``_`` columns of a (partition, keys) table; null keys match null keys."""
    right = parts.select(
        F.col("_part").alias("_cpart"),
        *[F.col(k).alias(f"_c_{i}") for i, k in enumerate(keys)],
        *[c for c in parts.columns if c != "_part" and c not in keys],
    )
    cond = F.col("_part") == F.col("_cpart")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_c_{i}"))
    # With few series this is about one row per partition.
    return rows.join(broadcast_if_small(right), cond, how).drop(
        "_cpart", *[f"_c_{i}" for i in range(len(keys))]
    )


def _series(keys: Sequence[str]):
    """The window over the partitions of one series: at most one row for each partition."""
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))


def _before(keys: Sequence[str]):
    return _series(keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)


def _inside(keys: Sequence[str]):
    """A series inside one range partition, never a whole series."""
    return Window.partitionBy("_part", *keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def with_position(
    df: DataFrame,
    order: Sequence[str | Column],
    keys: Sequence[str] = (),
    name: str = "pos",
    length: str | None = None,
) -> DataFrame:
    """Add the 0-based row number inside each series as ``name``, and its length as ``length``.

    ``order`` must end in a column that breaks ties, so that the numbers are the same on every
    run and equal values can be split over partitions.
    """
    rows = _ordered(df, keys, order)
    seen = rows.groupBy("_part", *keys).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    carry = seen.select(
        "_part",
        *keys,
        (F.coalesce(F.sum("_n").over(_before(keys)), F.lit(0)) - F.col("_first")).alias("_carry"),
        F.sum("_n").over(_series(keys)).alias("_length"),
    )
    joined = _join_parts(rows, carry, keys)
    sized = [F.col("_length").alias(length)] if length else []
    return joined.select(*df.columns, (F.col("_at") + F.col("_carry")).alias(name), *sized)


def with_running_sums(
    df: DataFrame,
    order: Sequence[str | Column],
    sums: Mapping[str, str],
    keys: Sequence[str] = (),
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add, for each ``{new: column}`` of ``sums``, the running total in order, this row included.

    ``totals`` names the sums of the whole series in the same way.
    """
    rows = _ordered(df, keys, order)
    outs, wholes = list(sums), dict(totals or {})
    summed = sorted({*sums.values(), *wholes.values()})
    part = rows.groupBy("_part", *keys).agg(*[F.sum(c).alias(f"_s_{c}") for c in summed])
    carry = part.select(
        "_part",
        *keys,
        *[F.sum(f"_s_{sums[o]}").over(_before(keys)).alias(f"_carry{i}") for i, o in enumerate(outs)],
        *[F.sum(f"_s_{c}").over(_series(keys)).alias(f"_total_{o}") for o, c in wholes.items()],
    )
    local = rows.select("*", *[F.sum(sums[o]).over(_inside(keys)).alias(f"_l{i}") for i, o in enumerate(outs)])
    joined = _join_parts(local, carry, keys)
    return joined.select(
        *df.columns,
        *[
            (F.coalesce(F.col(f"_l{i}"), F.lit(0)) + F.coalesce(F.col(f"_carry{i}"), F.lit(0))).alias(o)
            for i, o in enumerate(outs)
        ],
        *[F.col(f"_total_{o}").alias(o) for o in wholes],
    )


def sorted_copy(df: DataFrame, order: Sequence[str | Column], keys: Sequence[str] = ()) -> DataFrame:
    """The rows written once in order, for ``rows_at_ranks`` and any further pass over them."""
    return _ordered(df, keys, order)


def rows_at_ranks(
    rows: DataFrame, weight: str, ranks: Sequence[Callable[[Column], Column]], keys: Sequence[str] = ()
) -> DataFrame:
    """From a ``sorted_copy``, the rows that cover the wanted ranks of each series.

    A row with weight w covers w consecutive ranks, counted from 0. Each entry of ``ranks`` gives
    a rank from the length of the series. Adds ``_n``, the length, and ``_start``, the first rank
    of the row. Only the partitions that hold a wanted rank are looked into.
    """
    part = rows.groupBy("_part", *keys).agg(F.sum(weight).alias("_s"))
    placed = part.select(
        "_part",
        *keys,
        "_s",
        F.coalesce(F.sum("_s").over(_before(keys)), F.lit(0)).alias("_base"),
        F.sum("_s").over(_series(keys)).alias("_n"),
    )

    def covers(first: Column, count: Column) -> Column:
        tests = [(rank(F.col("_n")) >= first) & (rank(F.col("_n")) < first + count) for rank in ranks]
        return reduce(lambda a, b: a | b, tests)

    wanted = placed.filter(covers(F.col("_base"), F.col("_s"))).drop("_s")
    near = _join_parts(rows, wanted, keys, "inner")
    start = F.col("_base") + F.sum(weight).over(_inside(keys)) - F.col(weight)
    return near.withColumn("_start", start).filter(covers(F.col("_start"), F.col(weight))).drop("_part", "_at", "_base")
