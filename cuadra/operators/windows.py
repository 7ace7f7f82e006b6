"""Steps that depend on row order: fills, running totals, lag windows, moving averages, splits.

All take ``keys`` (the columns that name a series, possibly none) and ``pos``, an integer column
that is unique inside a series and rises in order: from ``with_position`` or from a calendar grid.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cuadra.operators.blocks import BLOCK, attach_stats, inside, over_blocks, with_block, with_carried, with_edges


def ffill(df: DataFrame, cols: Sequence[str], keys: Sequence[str], pos: str, size: int | None = BLOCK) -> DataFrame:
    """Carry the last known value forward; leading nulls stay null."""
    return _fill(df, cols, keys, pos, size, forward=True)


def bfill(df: DataFrame, cols: Sequence[str], keys: Sequence[str], pos: str, size: int | None = BLOCK) -> DataFrame:
    """Carry the next known value back; trailing nulls stay null."""
    return _fill(df, cols, keys, pos, size, forward=False)


def _fill(df, cols, keys, pos, size, forward) -> DataFrame:
    # Back means forward in falling order: a frame that ends at the last row is gone through again for every row.
    rows = with_block(df, pos, size)
    w = inside(keys, pos, forward).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = {c: F.last(c, ignorenulls=True).over(w) for c in cols}
    if size is None:
        return rows.withColumns(filled).select(*df.columns)
    # Each block hands its edge value to its neighbours; blocks without one pass on what they got.
    edge = F.max_by if forward else F.min_by
    edges = rows.groupBy(*keys, "_block").agg(
        *[edge(F.col(c), F.when(F.col(c).isNotNull(), F.col(pos))).alias(c) for c in cols]
    )
    others = over_blocks(keys, forward).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(*keys, "_block", *[F.last(c, ignorenulls=True).over(others).alias(c) for c in cols])
    both = with_carried(rows, carried, pos, size, first=forward)
    return both.withColumns(filled).filter("_own").select(*df.columns)


def cumulative_sum(
    df: DataFrame, col: str, keys: Sequence[str], pos: str, out: str, start: float | None = None, size: int | None = BLOCK
) -> DataFrame:
    """Running total in order, from ``start``; a random walk is the running total of its steps.

    Nulls add nothing; before the first value the total is null.
    """
    rows = with_block(df, pos, size).withColumn("_own", F.lit(True))
    if size is not None:
        totals = rows.groupBy(*keys, "_block").agg(F.sum(col).alias(col))
        before = over_blocks(keys).rowsBetween(Window.unboundedPreceding, -1)
        carried = totals.select(*keys, "_block", F.sum(col).over(before).alias(col))
        rows = with_carried(rows, carried, pos, size)
    total = F.sum(col).over(inside(keys, pos).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = rows.withColumn(out, total if start is None else total + F.lit(start))
    return summed.filter("_own").select(*df.columns, out)


def lag_windows(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    k: int,
    keys: Sequence[str],
    pos: str,
    size: int | None = BLOCK,
    keep: Sequence[str] = (),
) -> DataFrame:
    """For each row, the ``k`` rows before it as an array of structs, and its own target.

    ``pos`` must be dense and start at 0. The first ``k`` rows of a series have no full window
    and give none, so a series of n rows gives n - k. ``keep`` lists further columns of the row.
    """
    rows = with_edges(df, pos, before=k, after=0, size=size)
    w = inside(keys, pos)
    packed = F.struct(*features)
    past = F.array(*[F.lag(packed, j).over(w) for j in range(k, 0, -1)])
    return (
        rows.select(*keys, pos, *keep, "_own", F.col(target).alias("y"), past.alias("x"))
        .filter(F.col("_own") & (F.col(pos) >= k))
        .select(*keys, pos, *keep, "x", "y")
    )


def centered_moving_average(
    df: DataFrame, col: str, period: int, keys: Sequence[str], pos: str, out: str, size: int | None = BLOCK
) -> DataFrame:
    """Mean of the ``period`` rows around each row; null where the window leaves the series.

    An even period takes one more row and gives the two outer ones half weight.
    """
    half = period // 2
    rows = with_edges(df, pos, before=half, after=half, size=size)
    w = inside(keys, pos)
    around = w.rowsBetween(-half, half)
    if period % 2:
        total = F.sum(col).over(around)
    else:
        core = w.rowsBetween(-half + 1, half - 1)
        total = F.sum(col).over(core) + F.lit(0.5) * (F.lag(col, half).over(w) + F.lead(col, half).over(w))
    full = F.count(col).over(around) == 2 * half + 1
    return rows.withColumn(out, F.when(full, total / F.lit(period))).filter("_own").select(*df.columns, out)


def series_length(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def chronological_split(
    df: DataFrame, keys: Sequence[str], pos: str, fraction: float = 0.8, out: str = "part"
) -> DataFrame:
    """Label the first ``int(fraction * n)`` rows of each series ``train`` and the others ``test``."""
    sized = attach_stats(df, series_length(df, keys, "_n"), keys)
    cut = F.floor(F.lit(fraction) * F.col("_n"))
    return sized.withColumn(out, F.when(F.col(pos) < cut, "train").otherwise("test")).drop("_n")


def tail_split(df: DataFrame, keys: Sequence[str], pos: str, n: int = 100, out: str = "part") -> DataFrame:
    """Label the last ``n`` rows of each series ``test`` and the others ``train``."""
    sized = attach_stats(df, series_length(df, keys, "_n"), keys)
    return sized.withColumn(out, F.when(F.col(pos) < F.col("_n") - n, "train").otherwise("test")).drop("_n")
