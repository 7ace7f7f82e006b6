"""Counts, means, exact quantiles, correlations and the tables behind the usual charts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuadra.functions.normal import normal_quantile
from cuadra.operators.blocks import attach_stats
from cuadra.operators.position import rows_at_ranks, sorted_copy, with_position
from cuadra.operators.quantiles import attach, long_form, quantile_name, wide_quantiles
from cuadra.operators.values import missing, numeric_columns, present
from cuadra.session import written_once


def account_summary(df: DataFrame, key: str, text: str, amount: str, balance: str) -> DataFrame:
    """One row per account: largest text, two means and the number of rows.

    A largest text cannot be kept in a hash aggregation, so the raw rows are first added up per account and
    text; what is sorted afterwards is one row for each of those.
    """
    sums = df.groupBy(key, text).agg(*[
        e for name, c in (("_a", amount), ("_b", balance)) for e in (F.sum(F.col(c).cast("double")).alias(name), F.count(c).alias(f"{name}n"))],
        F.count(F.lit(1)).alias("_n"))
    return sums.groupBy(key).agg(
        F.max(text).alias("operation"),
        F.try_divide(F.sum("_a"), F.sum("_an")).alias("avg_amount"),
        F.try_divide(F.sum("_b"), F.sum("_bn")).alias("avg_balance"),
        F.sum("_n").alias("n_transactions"),
    )


def count_by(df: DataFrame, *cols: str, out: str = "count") -> DataFrame:
    """Rows per group; null is a group of its own."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(out))


def avg_by(df: DataFrame, *by: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Mean of every numeric column per group, named ``avg(column)``."""
    cols = cols or [c for c in numeric_columns(df) if c not in by]
    return df.groupBy(*by).agg(*[F.avg(present(df, c)).alias(f"avg({c})") for c in cols])


def row_count(df: DataFrame) -> DataFrame:
    """The number of rows as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, smallest and largest: one row per column.

    Text columns have count, smallest and largest; these are given as text for every column.
    """
    cols = list(cols or df.columns)
    numeric = set(numeric_columns(df))

    def figures(c: str) -> Column:
        known = present(df, c)
        num = known.cast("double") if c in numeric else F.lit(None).cast("double")
        return F.struct(
            F.lit(c).alias("column"),
            F.count(known).alias("count"),
            F.avg(num).alias("mean"),
            F.stddev_samp(num).alias("stddev"),
            F.min(known).cast("string").alias("min"),
            F.max(known).cast("string").alias("max"),
        )

    return df.agg(F.array(*[figures(c) for c in cols]).alias("r")).select(F.inline("r"))


# The sketch that narrows an exact quantile down is off by at most 1 / SKETCH of the rows.
SKETCH = 1000

# A group with no more rows than this keeps all its values. In a larger one the error of the sketch
# and the two ranks beside a quantile fit into a neighbourhood of twice the error.
SMALL_GROUP = 2 * SKETCH


def _known(df: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    return df.filter(~missing(df, value)).select(*keys, F.col(value).cast("double").alias("_v"))


def _weights(values: DataFrame, keys: Sequence[str], qs: Sequence[float] | None) -> DataFrame:
    """Values with their number of rows, as (keys, _v, _single, weight).

    With ``qs`` only the values near the wanted quantiles stay apart. All rows between two such
    neighbourhoods become one row, which is sorted before the next neighbourhood: ``_single`` is
    0 for it. So what has to be sorted is a small share of the rows, and no rank changes.
    """
    if qs is None:
        slots = values.withColumn("_single", F.lit(1))
    else:
        slack = 2.0 / SKETCH
        points = [min(max(q + d, 0.0), 1.0) for q in qs for d in (-slack, slack)]
        sketch = values.groupBy(*keys).agg(
            F.percentile_approx("_v", points, SKETCH).alias("_s"), (F.count(F.lit(1)) <= SMALL_GROUP).alias("_small")
        )
        ends = []
        for i, q in enumerate(qs):
            low = F.lit(float("-inf")) if q <= slack else F.col("_s")[2 * i]
            high = F.lit(float("inf")) if q >= 1 - slack else F.col("_s")[2 * i + 1]
            ends += [low.alias(f"_low{i}"), high.alias(f"_high{i}")]
        beside = attach_stats(values, sketch.select(*keys, "_small", *ends), keys)
        v, lows = F.col("_v"), [F.col(f"_low{i}") for i in range(len(qs))]
        within = [(v >= low) & (v <= F.col(f"_high{i}")) for i, low in enumerate(lows)]
        near = reduce(lambda a, b: a | b, within, F.col("_small"))
        following = F.array_min(F.array(*[F.when(low > v, low) for low in lows], F.lit(float("inf"))))
        slots = beside.select(*keys, F.when(near, v).otherwise(following).alias("_v"), near.cast("int").alias("_single"))
    return slots.groupBy(*keys, "_v", "_single").agg(F.count(F.lit(1)).alias("weight"))


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, n, q...) with linear interpolation, exact for groups of any size; groups without a value are left out."""
    wide = wide_quantiles(df, [value], qs, keys)
    return long_form(wide, [value], ["n", *map(quantile_name, qs)], keys).drop("column").filter("n > 0")


def sorted_quantiles(df: DataFrame, value: str, qs: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """The same figures without any list of values in a task, for groups beyond about 10^11 rows.

    It runs its passes at once and reads the rows more often than ``exact_quantiles``. A sketch first tells
    where the quantiles must lie. Equal values are counted, and so are the rows in between. What
    is left is sorted across partitions, and the rows that cover the wanted ranks are picked. If
    a rank falls outside its neighbourhood, all values are sorted instead.
    """
    def at(q: float, n: Column) -> Column:
        return F.lit(float(q)) * (n - 1)

    values = _known(df, value, keys)
    ranks = [lambda n, q=q, side=side: side(at(q, n)) for q in qs for side in (F.floor, F.ceil)]

    def pick(points: Sequence[float] | None) -> DataFrame:
        ordered = sorted_copy(_weights(values, keys, points), ["_v", "_single"], keys)
        return written_once(rows_at_ranks(ordered, "weight", ranks, keys))

    near = pick(qs)
    if not near.filter("_single = 0").isEmpty():
        near = pick(None)

    def value_at(rank: Column) -> Column:
        covers = (F.col("_start") <= rank) & (rank < F.col("_start") + F.col("weight"))
        return F.max(F.when(covers, F.col("_v")))

    n = F.col("_n")
    found = near.groupBy(*keys).agg(
        F.max("_n").alias("n"),
        *[value_at(F.floor(at(q, n))).alias(f"_lo{i}") for i, q in enumerate(qs)],
        *[value_at(F.ceil(at(q, n))).alias(f"_hi{i}") for i, q in enumerate(qs)],
    )
    out = []
    for i, q in enumerate(qs):
        rank, low = at(q, F.col("n")), F.col(f"_lo{i}")
        out.append((low + (F.col(f"_hi{i}") - low) * (rank - F.floor(rank))).alias(quantile_name(q)))
    return found.select(*keys, "n", *out)


def summary(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """``describe`` of the numeric columns plus quartiles, exact or from Spark's sketch."""
    cols = list(cols or numeric_columns(df))
    qs = (0.25, 0.5, 0.75)
    if exact:
        quartiles = long_form(wide_quantiles(df, cols, qs), cols, [quantile_name(q) for q in qs])
    else:
        sketch = [
            F.struct(
                F.lit(c).alias("column"),
                *[F.percentile_approx(F.col(c).cast("double"), q).alias(quantile_name(q)) for q in qs],
            )
            for c in cols
        ]
        quartiles = df.agg(F.array(*sketch).alias("r")).select(F.inline("r"))
    # Both sides have one row per column of the table.
    return describe(df, cols).join(F.broadcast(quartiles), "column", "left")


def describe_dates(df: DataFrame, col: str) -> DataFrame:
    """Count, first, last and quartiles of a date column (quartiles as whole days, rounded down)."""
    days = df.select(F.col(col), F.unix_date(F.col(col)).alias("_day"))
    ends = days.agg(F.count(col).alias("count"), F.min(col).alias("min"), F.max(col).alias("max"))
    qs = (0.25, 0.5, 0.75)
    q = exact_quantiles(days, "_day", qs).select(
        *[F.date_from_unix_date(F.floor(quantile_name(x)).cast("int")).alias(quantile_name(x)) for x in qs]
    )
    return ends.crossJoin(F.broadcast(q))


def value_counts(df: DataFrame, col: str, out: str = "count") -> DataFrame:
    """Frequency table, most frequent first; nulls left out."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(out))
    return counts.orderBy(F.desc(out), F.asc(col))


def global_stats(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean, sample deviation, smallest and largest value, per series or of the table."""
    v = present(df, col)
    return df.groupBy(*keys).agg(
        F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"), F.min(v).alias("min"), F.max(v).alias("max")
    )


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson's r for every pair of numeric columns, from the rows where both are present."""
    cols = list(cols or numeric_columns(df))
    pairs = list(combinations(cols, 2))
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r"))
        for a, b in pairs
    ]
    ones = [
        F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.corr(F.col(c).cast("double"), F.col(c).cast("double")).alias("r"))
        for c in cols
    ]
    half = df.agg(F.array(*cells, *ones).alias("r")).select(F.inline("r"))
    both = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b", "r"))).otherwise(
        F.array(F.struct("a", "b", "r"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "r"))
    )
    return half.select(F.inline(both))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Counts in equal bins from smallest to largest; the last bin includes its right end."""
    values = df.filter(~missing(df, col)).select(F.col(col).cast("double").alias("v"))
    ends = values.agg(F.min("v").alias("_lo"), F.max("v").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    slot = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("v") - F.col("_lo")) / width), F.lit(bins - 1))
    )
    binned = values.crossJoin(F.broadcast(ends)).groupBy(slot.cast("int").alias("bin"), "_lo", "_hi").agg(
        F.count(F.lit(1)).alias("count")
    )
    return binned.select(
        "bin", (F.col("_lo") + width * F.col("bin")).alias("left"), (F.col("_lo") + width * (F.col("bin") + 1)).alias("right"), "count"
    )


def box_stats(df: DataFrame, by: str, features: Sequence[str]) -> DataFrame:
    """Per class and feature: quartiles, whiskers and the number of values beyond them.

    A whisker ends at the last value within 1.5 interquartile ranges of the box.
    """
    fields = ["n", "q25", "q50", "q75"]
    quartiles = wide_quantiles(df, features, (0.25, 0.5, 0.75), [by])
    plain = quartiles.select(by, *[F.col(f"`{i}:{f}`").alias(f"_{f}_{i}") for i in range(len(features)) for f in fields])
    rows = attach(df.select(by, *[present(df, c).cast("double").alias(f"_v{i}") for i, c in enumerate(features)]), plain, [by])
    ends = []
    for i in range(len(features)):
        v, low, high = F.col(f"_v{i}"), F.col(f"_q25_{i}"), F.col(f"_q75_{i}")
        reach = F.lit(1.5) * (high - low)
        within = (v >= low - reach) & (v <= high + reach)
        ends += [*[F.first(f"_{f}_{i}").alias(f"{i}:{f}") for f in fields],
                 F.least(F.min(F.when(within, v)), F.first(low)).alias(f"{i}:whisker_low"),
                 F.greatest(F.max(F.when(within, v)), F.first(high)).alias(f"{i}:whisker_high"),
                 F.count_if(~within).alias(f"{i}:n_outliers")]
    wide = rows.groupBy(by).agg(*ends)
    return long_form(wide, features, [*fields, "whisker_low", "whisker_high", "n_outliers"], [by]).filter("n > 0")


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per (true class, predicted class)."""
    return count_by(df, label, prediction)


def qq_table(df: DataFrame, value: str, tie: str, keys: Sequence[str] = ()) -> DataFrame:
    """Sorted values against the normal quantiles of their plotting positions (Filliben's medians)."""
    known = df.select(*keys, value, tie).filter(~missing(df, value))
    sized = with_position(known, [value, tie], keys, "_i", length="_n")
    end = F.pow(F.lit(0.5), F.lit(1.0) / F.col("_n"))
    at = (
        F.when(F.col("_i") == 0, 1 - end)
        .when(F.col("_i") == F.col("_n") - 1, end)
        .otherwise((F.col("_i") + 1 - 0.3175) / (F.col("_n") + 0.365))
    )
    return sized.select(*keys, (F.col("_i") + 1).alias("i"), F.col(value).alias("value"), at.alias("plot_position")).withColumn(
        "quantile", normal_quantile("plot_position")
    )


def qq_line(table: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Slope, intercept and r of the least-squares line through a ``qq_table``."""
    return table.groupBy(*keys).agg(
        F.regr_slope("value", "quantile").alias("slope"),
        F.regr_intercept("value", "quantile").alias("intercept"),
        F.corr("value", "quantile").alias("r"),
    )


def most_frequent(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the mode of each column; of equally frequent values the smallest.

    Columns are counted in one scan and one shuffle (a grouping set for each, up to 60 at a time), so no task
    holds all distinct values of a column.
    """
    if len(cols) > 60:  # Spark has 64 bits to tell grouping sets apart
        return reduce(lambda a, b: a.join(F.broadcast(b), how="cross"), [most_frequent(df, cols[i:i + 60]) for i in range(0, len(cols), 60)])  # one row each
    names = [f"_c{i}" for i in range(len(cols))]
    rows = df.select(*[present(df, c).alias(name) for c, name in zip(cols, names)])
    counts = rows.groupingSets([[F.col(n)] for n in names], *[F.col(n) for n in names]).agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_g"))
    modes = []
    for i, (c, name) in enumerate(zip(cols, names)):
        own = (1 << len(names)) - 1 - (1 << (len(names) - 1 - i))  # every bit but that of this column
        best = F.when((F.col("_g") == own) & F.col(name).isNotNull(), F.struct(-F.col("_n"), F.col(name).alias("v")))
        modes.append(F.min(best)["v"].alias(c))
    return counts.agg(*modes)
