"""Cutting a long series into blocks of consecutive positions.

An order-dependent step needs only the rows near each row, or one carried value. So a series is
cut by ``pos`` into blocks of ``size`` positions, and a window runs inside (keys, block). A row
that a neighbour block needs is sent there as well. No group is larger than one block and its
edges, however long the series is.

``size=None`` means one block per series. It is meant for calendar grids, where the number of
days bounds the length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from cuadra.session import broadcast_if_small

BLOCK = 65_536


def block_of(pos: str | Column, size: int | None) -> Column:
    if size is None:
        return F.lit(0).cast("long")
    return F.floor((F.col(pos) if isinstance(pos, str) else pos) / F.lit(size))


def with_block(df: DataFrame, pos: str, size: int | None) -> DataFrame:
    return df.withColumn("_block", block_of(pos, size))


def with_edges(df: DataFrame, pos: str, before: int, after: int, size: int | None) -> DataFrame:
    """Send every row to its own block and to those that need it as an edge row.

    ``before`` and ``after`` count the positions that a row looks back and ahead. ``_own`` marks
    the copy that belongs to the block; drop the others after the window.
    """
    if size is None:
        return df.withColumn("_block", block_of(pos, None)).withColumn("_own", F.lit(True))
    p = F.col(pos)
    blocks = F.sequence(block_of(p - after, size), block_of(p + before, size))
    spread = df.withColumn("_block", F.explode(blocks))
    return spread.withColumn("_own", F.col("_block") == block_of(pos, size))


def inside(keys: Sequence[str], pos: str, rising: bool = True) -> WindowSpec:
    """The window of one block, in position order, or from its end."""
    return Window.partitionBy(*keys, "_block").orderBy(F.asc(pos) if rising else F.desc(pos))


def over_blocks(keys: Sequence[str], rising: bool = True) -> WindowSpec:
    """The window over the block summaries of a series: one row for ``size`` rows."""
    base = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    return base.orderBy(F.asc("_block") if rising else F.desc("_block"))


def with_carried(rows: DataFrame, carried: DataFrame, pos: str, size: int, first: bool = True) -> DataFrame:
    """Add one row to each block with what the rest of the series hands to it.

    ``carried`` has (keys, _block) and columns of ``rows``; the other columns are null. The added
    row comes before all rows of the block, or after them. The window over the block then needs
    no join. ``_own`` is false for it.
    """
    at = F.col("_block") * size - 1 if first else (F.col("_block") + 1) * size
    extra = carried.withColumn(pos, at.cast(rows.schema[pos].dataType)).withColumn("_own", F.lit(False))
    return rows.withColumn("_own", F.lit(True)).unionByName(extra, allowMissingColumns=True)


def join_summary(rows: DataFrame, summary: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left-join a summary on the columns ``on``, null-safe; its other columns are appended."""
    right = summary.select(
        *[F.col(n).alias(f"_j{i}") for i, n in enumerate(on)], *[c for c in summary.columns if c not in on]
    )
    cond = F.lit(True)
    for i, n in enumerate(on):
        cond = cond & F.col(n).eqNullSafe(F.col(f"_j{i}"))
    return rows.join(right, cond, "left").drop(*[f"_j{i}" for i in range(len(on))])


def attach_stats(rows: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Put per-series figures beside every row of the series.

    Without keys ``stats`` has exactly one row and is broadcast. With keys it is broadcast if it
    is counted to be small, so a series that owns much of the table is not gathered by its key.
    """
    if not keys:
        return rows.crossJoin(F.broadcast(stats))
    return join_summary(rows, broadcast_if_small(stats), keys)
