"""Exact quantiles of many columns at once, in three wide passes and without a job before an action.

The first pass sketches every column: values just below and just above the rank of each quantile are its
neighbourhood. The second looks only at the values strictly between the two, sketches them at evenly spaced
points and counts what lies below, which gives a neighbourhood inside the first. The third takes the values
strictly inside that, about a ten-thousandth of the rows, and picks the ranks. Equal values are
counted, never kept: rows strictly between two values lie between their ranks, so a value that a third of the
rows share costs nothing.

Raw rows stay as they are (no row per cell), each pass is one aggregation with map-side combining, and all of it is
one lazy plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadra.operators.blocks import join_summary
from cuadra.operators.values import present

# The sketches are off by at most 1 / accuracy of the rows. The first neighbourhood reaches twice as far to both
# sides; a group of fewer rows than make two of that is a neighbourhood as a whole. The second has steps wider than its error.
ACCURACY = 1000
SLACK = 2 / ACCURACY
STEPS, FINE_ACCURACY = 200, 2000


def quantile_name(q: float) -> str:
    return f"q{q * 100:g}".replace(".", "_")


def attach(rows: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the columns of a summary by group; lazy, so how they meet is decided when sizes are known."""
    return join_summary(rows, summary, keys) if keys else rows.join(F.broadcast(summary), how="cross")  # one row


def wide_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """One row per group with ``n`` and the quantiles of each column: ``0:n`` and ``0:q25`` for the first, and so on.

    Quantiles are interpolated linearly between ranks. Null and NaN do not count; without a value they are null.
    The many expressions are written as SQL text, which Spark parses in one call each.
    """
    cells = [(i, j) for i in range(len(cols)) for j in range(len(qs))]
    rows = df.select(*keys, *[present(df, c).cast("double").alias(f"_v{i}") for i, c in enumerate(cols)])
    counts = [f"_n{i}" for i in range(len(cols))]
    points = f"array({', '.join(f'{min(max(q + d, 0.0), 1.0)}D' for q in qs for d in (-SLACK, SLACK))})"
    grid = f"array({', '.join(f'{k / STEPS}D' for k in range(STEPS + 1))})"
    infinity = "double('Infinity')"

    def rank(i: int, j: int) -> str:
        return f"({float(qs[j])!r}D * (_n{i} - 1))"

    def between(i: int, j: int) -> str:
        return f"(_v{i} > _low{i}_{j} AND _v{i} < _high{i}_{j})"

    first = rows.groupBy(*keys).agg(*[F.expr(e) for i in range(len(cols)) for e in (
        f"percentile_approx(_v{i}, {points}, {ACCURACY}) AS _s{i}", f"count(_v{i}) AS _n{i}")])
    around = []
    for i, j in cells:
        few = f"_n{i} * {SLACK}D < 2"
        low, high = (f"IF({few} OR {'true' if end else 'false'}, {sign}{infinity}, get(_s{i}, {2 * j + side}))"
                     for side, end, sign in ((0, qs[j] <= SLACK, "-"), (1, qs[j] >= 1 - SLACK, "")))
        around += [f"{low} AS _low{i}_{j}", f"{high} AS _high{i}_{j}"]
    first = first.select(*keys, *counts, *map(F.expr, around))

    # The second pass: smaller neighbourhoods inside the first.
    kept = [c for c in first.columns if c not in keys]
    counted = attach(rows, first, keys).groupBy(*keys).agg(*[F.expr(f"first({c}) AS {c}") for c in kept], *[F.expr(e) for i, j in cells for e in (
        f"count_if(_v{i} <= _low{i}_{j}) AS _upto{i}_{j}", f"count_if({between(i, j)}) AS _in{i}_{j}",
        f"percentile_approx(IF({between(i, j)}, _v{i}, NULL), {grid}, {FINE_ACCURACY}) AS _g{i}_{j}")])
    # Places of the two ranks among the values inside, and the steps of the sketch that they cannot lie beyond, with two steps of room for its error.
    placed = counted.select("*", *[F.expr(e) for i, j in cells for e in (
        f"floor({rank(i, j)}) - _upto{i}_{j} AS _one{i}_{j}", f"ceil({rank(i, j)}) - _upto{i}_{j} AS _two{i}_{j}")])
    placed = placed.select("*", *[F.expr(e) for i, j in cells for e in (
        f"int(floor(try_divide(_one{i}_{j}, _in{i}_{j}) * {STEPS}) - 2) AS _down{i}_{j}", f"int(ceil(try_divide(_two{i}_{j} + 1, _in{i}_{j}) * {STEPS}) + 2) AS _up{i}_{j}")])
    closer = []
    for i, j in cells:
        c = f"{i}_{j}"
        # Ranks at or beyond an end need nothing inside.
        closer.append(f"CASE WHEN _in{c} = 0 OR _one{c} < 0 OR _down{c} < 0 THEN IF(_one{c} >= _in{c}, _high{c}, _low{c}) WHEN _one{c} >= _in{c} THEN _high{c} ELSE get(_g{c}, _down{c}) END AS _low{c}")
        closer.append(f"CASE WHEN _in{c} = 0 OR _two{c} >= _in{c} THEN IF(_two{c} < 0, _low{c}, _high{c}) WHEN _two{c} < 0 THEN _low{c} WHEN _up{c} > {STEPS} THEN _high{c} ELSE get(_g{c}, _up{c}) END AS _high{c}")
    stats = placed.select(*keys, *counts, *map(F.expr, closer))

    last = attach(rows, stats, keys).groupBy(*keys).agg(*[F.expr(f"first({c}) AS {c}") for c in kept], *[F.expr(e) for i, j in cells for e in (
        f"count_if(_v{i} < _low{i}_{j}) AS _below{i}_{j}", f"count_if(_v{i} <= _low{i}_{j}) AS _upto{i}_{j}", f"count_if(_v{i} <= _high{i}_{j}) AS _all{i}_{j}",
        f"sort_array(collect_list(IF({between(i, j)}, _v{i}, NULL))) AS _in{i}_{j}")])
    values = []
    for i, j in cells:
        c = f"{i}_{j}"
        for name, side in (("_a", "floor"), ("_b", "ceil")):
            r = f"{side}({rank(i, j)})"
            values.append(f"CASE WHEN _n{i} = 0 THEN NULL WHEN {r} < _below{c} OR {r} >= _all{c} THEN double(raise_error('a quantile lies outside its neighbourhood')) "
                          f"WHEN {r} < _upto{c} THEN _low{c} WHEN {r} < _upto{c} + size(_in{c}) THEN get(_in{c}, int({r} - _upto{c})) ELSE _high{c} END AS {name}{c}")
    picked = last.select(*keys, *counts, *map(F.expr, values))
    out = []
    for i in range(len(cols)):
        out.append(f"coalesce(_n{i}, 0) AS `{i}:n`")
        out += [f"_a{i}_{j} + (_b{i}_{j} - _a{i}_{j}) * ({rank(i, j)} - floor({rank(i, j)})) AS `{i}:{quantile_name(q)}`" for j, q in enumerate(qs)]
    return picked.select(*keys, *map(F.expr, out))


def long_form(wide: DataFrame, cols: Sequence[str], fields: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """A row per group and column from a row per group: ``column`` and the given fields of it."""
    cells = [F.struct(F.lit(c).alias("column"), *[F.col(f"`{i}:{f}`").alias(f) for f in fields]) for i, c in enumerate(cols)]
    return wide.select(*keys, F.inline(F.array(*cells)))
