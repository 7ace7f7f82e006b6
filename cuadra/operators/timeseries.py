"""Calendar grids, decomposition, autocorrelation, scaling and forecast tables.

A series is a set of rows with the same ``keys``. A grid has one row per calendar step, so a
series on it is no longer than the calendar, and ``pos`` numbers its rows from 0 without gaps.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuadra.operators.aggregate import global_stats, missing, present
from cuadra.operators.blocks import BLOCK, attach_stats, join_summary, with_edges
from cuadra.operators.windows import centered_moving_average
from cuadra.session import broadcast_if_small

# Rows per cycle by frequency: days, business days, weeks, months, quarters.
PERIODS = {"D": 7, "B": 5, "W": 52, "M": 12, "Q": 4}

_STEPS = {"D": "interval 1 day", "B": "interval 1 day", "W": "interval 7 days", "M": "interval 1 month", "Q": "interval 3 months"}


def date_index(df: DataFrame, col: str, fmt: str = "dd/MM/yyyy", out: str = "ts") -> DataFrame:
    """Text to a date column; text that is no date becomes null."""
    return df.withColumn(out, F.try_to_date(F.col(col), fmt))


def business_days_before(day: Column) -> Column:
    """Weekdays before ``day`` since Monday 1970-01-05; differences of it count business days."""
    since = F.datediff(day, F.lit("1970-01-05").cast("date"))
    weeks = F.floor(since / F.lit(7))
    return weeks * 5 + F.least(since - weeks * 7, F.lit(5))


def _is_weekday(day: Column) -> Column:
    return F.weekday(day) < 5


def regular_grid(df: DataFrame, ts: str, keys: Sequence[str] = (), freq: str = "D", pos: str = "pos") -> DataFrame:
    """One row per calendar step from the first to the last date of each series.

    New rows are null in the other columns. On business days (``B``) weekend rows are dropped.
    Two rows of a series must not share a date.
    """
    ends = df.groupBy(*keys).agg(F.min(ts).alias("_from"), F.max(ts).alias("_to"))
    steps = F.sequence(F.col("_from"), F.col("_to"), F.expr(_STEPS[freq]))
    if freq == "B":
        steps = F.filter(steps, _is_weekday)
    grid = ends.select(*keys, F.posexplode(steps).alias(pos, ts)).withColumn(pos, F.col(pos).cast("long"))
    values = [c for c in df.columns if c not in (*keys, ts)]
    on = [*keys, ts]
    return join_summary(grid, df.select(*on, *values), on)


def decompose(
    df: DataFrame,
    col: str,
    period: int | None = None,
    keys: Sequence[str] = (),
    pos: str = "pos",
    model: str = "additive",
    freq: str = "D",
    size: int | None = BLOCK,
) -> DataFrame:
    """Trend, seasonal part and residual of a series on a regular grid.

    The trend is the centered moving average over one period. The seasonal part is the mean of
    what the trend leaves, per position in the cycle, counted from the first row and centered to
    a mean of 0 (additive) or 1 (multiplicative). Multiplicative needs values above 0.
    """
    if model not in ("additive", "multiplicative"):
        raise ValueError(f"unknown model {model!r}")
    period = period or PERIODS[freq]
    ratio = model == "multiplicative"
    source = df
    if ratio:
        checked = F.when(F.col(col) <= 0, F.raise_error(F.lit("multiplicative decomposition needs values above 0")))
        source = df.withColumn(col, checked.otherwise(F.col(col)))
    trended = centered_moving_average(source, col, period, keys, pos, "trend", size)
    left = F.col(col) / F.col("trend") if ratio else F.col(col) - F.col("trend")
    phased = trended.withColumn("_phase", F.col(pos) % period)
    phases = phased.groupBy(*keys, "_phase").agg(F.avg(left).alias("_mean"))
    # A window of ``period`` rows, one for each place in the cycle.
    level = F.avg("_mean").over(Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0)))
    seasonal = phases.select(
        *keys, "_phase", (F.col("_mean") / level if ratio else F.col("_mean") - level).alias("seasonal")
    )
    joined = join_summary(phased, broadcast_if_small(seasonal), [*keys, "_phase"])
    s = F.col("seasonal")
    resid = F.col(col) / F.col("trend") / s if ratio else F.col(col) - F.col("trend") - s
    return joined.withColumn("resid", resid).select(*df.columns, "trend", "seasonal", "resid")


def reject_nulls(df: DataFrame, col: str) -> DataFrame:
    """Stop the query at a missing value: these tests need a filled series."""
    stop = F.raise_error(F.lit(f"column {col} has missing values; put it on a grid and fill it first"))
    return df.withColumn(col, F.when(missing(df, col), stop).otherwise(F.col(col).cast("double")))


def acf(
    df: DataFrame, col: str, keys: Sequence[str] = (), pos: str = "pos", lags: int = 40, size: int = BLOCK
) -> DataFrame:
    """Autocorrelation at lags 1 to ``lags`` with Bartlett's 95 % band.

    A block gives its ``lags`` + 1 lagged products as one array, and the arrays are added up per
    series. A window with one column per lag reads every row once for each of them.
    """
    if size <= lags:
        raise ValueError("a block must be longer than the number of lags")
    clean = reject_nulls(df.select(*keys, pos, col), col)
    at = F.col(pos)
    gapless = (F.min(at) == 0) & (F.max(at) - F.min(at) + 1 == F.count(F.lit(1)))
    mean = F.when(gapless, F.avg(col)).otherwise(F.raise_error(F.lit(f"{pos} must count from 0 without gaps")).cast("double"))
    stats = clean.groupBy(*keys).agg(mean.alias("_mean"))
    centered = attach_stats(clean, stats, keys).select(*keys, pos, (F.col(col) - F.col("_mean")).alias("_x"))
    rows = with_edges(centered, pos, before=lags, after=0, size=size)
    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField("n", T.LongType()), T.StructField("c", T.ArrayType(T.DoubleType()))])
    names = list(keys)

    def products(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(pos)
        x, own = pdf["_x"].to_numpy(), pdf["_own"].to_numpy()
        y = np.where(own, x, 0.0)
        c = [float(y @ y)] + [float(y[k:] @ x[:-k]) if k < len(x) else 0.0 for k in range(1, lags + 1)]
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in names}, "n": [int(own.sum())], "c": [c]})

    parts = rows.groupBy(*keys, "_block").applyInPandas(products, schema)
    sums = parts.groupBy(*keys).agg(F.sum("n").alias("n"), vector_to_array(Summarizer.sum(array_to_vector("c"))).alias("_c"))
    r = F.transform(F.slice("_c", 2, lags), lambda v: F.try_divide(v, F.col("_c")[0]))
    long = sums.select(*keys, "n", F.posexplode(r).alias("_k", "acf")).filter(F.col("_k") < F.col("n") - 1)
    earlier = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("_k")
    squares = F.coalesce(
        F.sum(F.col("acf") * F.col("acf")).over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    band = F.lit(1.96) * F.sqrt((1 + 2 * squares) / F.col("n"))
    return long.select(*keys, (F.col("_k") + 1).cast("int").alias("lag"), "acf", band.alias("band"))


def noise_column(df: DataFrame, col: str, key: str, out: str, seed: int = 0, keys: Sequence[str] = ()) -> DataFrame:
    """White noise with the mean and sample deviation of ``col``.

    The draw of a row depends only on its series, its ``key`` and the seed (Box-Muller over two
    hashes), so it does not change with the partitioning, and every series has draws of its own.
    """
    def uniform(salt: str) -> Column:
        series = [F.concat(F.coalesce(F.col(k).cast("string"), F.lit("")), F.lit(":")) for k in keys]
        text = F.concat(F.lit(f"{seed}:{salt}:"), *series, F.col(key).cast("string"))
        return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 0.5) / float(16**12)

    z = F.sqrt(-2 * F.log(uniform("a"))) * F.cos(2 * F.pi() * uniform("b"))
    stats = global_stats(df, col, keys).select(*keys, F.col("mean").alias("_m"), F.col("sd").alias("_sd"))
    return attach_stats(df, stats, keys).withColumn(out, F.col("_m") + F.col("_sd") * z).drop("_m", "_sd")


def minmax_fit(train: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Smallest and largest training value of each column."""
    ends = [f(present(train, c)).alias(f"{c}_{n}") for c in cols for f, n in ((F.min, "min"), (F.max, "max"))]
    return train.groupBy(*keys).agg(*ends)


def minmax_apply(df: DataFrame, ends: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Scale by the training ends; other rows may leave [0, 1]. A constant column gives null."""
    both = attach_stats(df, ends, keys)
    scaled = {c: F.try_divide(F.col(c) - F.col(f"{c}_min"), F.col(f"{c}_max") - F.col(f"{c}_min")) for c in cols}
    return both.withColumns(scaled).select(*df.columns)


def minmax_invert(
    df: DataFrame, ends: DataFrame, cols: Sequence[str], target: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Scaled columns back to the units of ``target``, by its own ends."""
    both = attach_stats(df, ends, keys)
    width = F.col(f"{target}_max") - F.col(f"{target}_min")
    return both.withColumns({c: F.col(c) * width + F.col(f"{target}_min") for c in cols}).select(*df.columns)


def forecast_metrics(df: DataFrame, truth: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """MSE, RMSE and MAPE in percent. A true value of 0 has no ratio and is left out of MAPE."""
    err = F.col(truth) - F.col(pred)
    return df.groupBy(*keys).agg(
        F.avg(err * err).alias("mse"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.avg(F.abs(F.try_divide(err, F.col(truth)))) * 100).alias("mape"),
    )


def overlay_frame(
    scored: DataFrame, pos: str, truth: str, pred: str, part: str = "part", keys: Sequence[str] = ()
) -> DataFrame:
    """History, truth and prediction in one long table (keys, step, series, value)."""
    train = F.col(part) == "train"
    cells = F.when(train, F.array(F.struct(F.lit("history").alias("series"), F.col(truth).alias("value")))).otherwise(
        F.array(
            F.struct(F.lit("true").alias("series"), F.col(truth).alias("value")),
            F.struct(F.lit("prediction").alias("series"), F.col(pred).alias("value")),
        )
    )
    return scored.select(*keys, F.col(pos).alias("step"), F.inline(cells))
