"""Augmented Dickey-Fuller test and partial autocorrelation by least squares.

Each block of a series is turned into the cross products of its regressors, a small square that
does not grow with the rows. The squares are added up per series and one small solve per series
gives the result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuadra.functions.regression import adf_critical_values, adf_p_value, least_squares, nested_errors
from cuadra.operators.blocks import BLOCK, attach_stats, with_edges
from cuadra.operators.timeseries import reject_nulls


def _fields(df: DataFrame, keys: Sequence[str]) -> list[T.StructField]:
    return [df.schema[k] for k in keys]


def _regressors(y: np.ndarray, start: int, stop: int, lags: int, differenced: bool) -> np.ndarray:
    """Rows [1, level, lagged values 1..lags, target] for the indices ``start`` to ``stop`` - 1.

    ``differenced``: the target is the step of ``y``, the level its last value, the lags are earlier
    steps. Otherwise there is no level and lags and target are values.
    """
    source = np.diff(y, prepend=np.nan) if differenced else y
    z = np.empty((lags + (3 if differenced else 2), max(stop - start, 0)))
    z[0] = 1.0
    if differenced:
        z[1] = y[start - 1 : stop - 1]
    for j in range(1, lags + 1):
        z[j - lags - 2] = source[start - j : stop - j]
    z[-1] = source[start:stop]
    return z.T


def _cross_products(df: DataFrame, keys: Sequence[str], pos: str, differenced: bool, size: int) -> DataFrame:
    """Per series: (gram, head) from the rows that have all ``use`` lags.

    ``use`` is the series' own lag count, and the square of a series is as wide as that asks for. ``head`` holds
    the first values, from which the solve rebuilds the rows that have fewer lags.
    """
    extra = 1 if differenced else 0
    reach = F.when(F.col("use") + extra < size, F.col("use") + extra).otherwise(
        F.raise_error(F.lit("a block must be longer than the number of lags")).cast("int"))
    rows = with_edges(df.select(*keys, pos, "use", "_x"), pos, before=reach, after=0, size=size)
    key_fields = _fields(df, keys)
    schema = T.StructType(
        [*key_fields, T.StructField("gram", T.ArrayType(T.DoubleType())), T.StructField("head", T.ArrayType(T.DoubleType()))]
    )
    names = list(keys)

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(pos)
        y, p, use = pdf["_x"].to_numpy(), pdf[pos].to_numpy(), int(pdf["use"].iloc[0])
        first = use + extra
        full = pdf["_own"].to_numpy() & (p >= first)
        width = use + 2 + extra
        gram = np.zeros((width, width))
        if full.any():
            # A block may hold edge rows only. Its own rows come after them, up to the end.
            z = _regressors(y, int(np.argmax(full)), len(y), use, differenced)
            gram = z.T @ z
        head = y[:first] if p[0] == 0 else np.empty(0)
        out = {k: [pdf[k].iloc[0]] for k in names}
        return pd.DataFrame({**out, "gram": [gram.ravel()], "head": [head]})

    parts = rows.groupBy(*keys, "_block").applyInPandas(block, schema)
    return parts.groupBy(*keys).agg(
        vector_to_array(Summarizer.sum(array_to_vector("gram"))).alias("gram"),
        F.max_by("head", F.size("head")).alias("head"),
    )


def _spread(grams: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One small row per series: without a stated number they would be merged into one task."""
    return grams.repartition(grams.sparkSession.sparkContext.defaultParallelism, *keys) if keys else grams


def _centered(df: DataFrame, col: str, keys: Sequence[str], pos: str, use) -> tuple[DataFrame, DataFrame]:
    clean = reject_nulls(df.select(*keys, pos, col), col)
    at = F.col(pos)
    gapless = (F.min(at) == 0) & (F.max(at) - F.min(at) + 1 == F.count(F.lit(1)))
    n = F.when(gapless, F.count(F.lit(1))).otherwise(F.raise_error(F.lit(f"{pos} must count from 0 without gaps")).cast("long"))
    stats = clean.groupBy(*keys).agg(n.alias("n"), F.avg(col).alias("mean")).withColumn("use", use)
    return attach_stats(clean, stats, keys).withColumn("_x", F.col(col) - F.col("mean")), stats


def default_adf_lags(n):
    """The usual upper bound of the lag search, as a column expression over the length ``n``."""
    bound = F.least(F.ceil(12 * F.pow(n / 100.0, F.lit(0.25))), F.floor(n / F.lit(2)) - 2)
    return F.greatest(bound, F.lit(0)).cast("int")


def adf_test(
    df: DataFrame,
    col: str,
    keys: Sequence[str] = (),
    pos: str = "pos",
    max_lags: int | None = None,
    search: bool = True,
    size: int = BLOCK,
) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant, one row per series.

    With ``search`` the number of lagged steps is the one with the smallest AIC up to ``max_lags``
    (by default a bound that grows with the fourth root of the length), on the rows that all
    candidates share; the test is then fitted again on every row that the chosen number allows.
    A series with fewer than four rows has null figures: nothing is left over to measure an error.
    """
    bound = default_adf_lags(F.col("n"))
    use = F.least(bound, F.lit(max_lags)) if max_lags is not None else bound
    rows, stats = _centered(df, col, keys, pos, use)
    grams = _cross_products(rows, keys, pos, True, size)
    joined = attach_stats(grams, stats, keys)
    key_fields = _fields(df, keys)
    schema = T.StructType(
        [
            *key_fields,
            T.StructField("statistic", T.DoubleType()),
            T.StructField("p_value", T.DoubleType()),
            T.StructField("lags", T.IntegerType()),
            T.StructField("n_obs", T.LongType()),
            T.StructField("crit_1", T.DoubleType()),
            T.StructField("crit_5", T.DoubleType()),
            T.StructField("crit_10", T.DoubleType()),
        ]
    )
    names = list(keys)

    def one(n: int, use: int, gram: np.ndarray, head: np.ndarray):
        slots = lambda p: np.r_[0 : p + 2]  # noqa: E731  constant, level and p lags
        if n - 1 - use <= use + 2:
            return None, None, 0, max(n - 1, 0), None, None, None
        width = use + 3
        square = np.asarray(gram).reshape(width, width)
        chosen = use
        if search:
            common = n - 1 - use
            # One factorisation has the errors of all nested fits, from two regressors on.
            errors = nested_errors(square, common)[1:]
            chosen = int(np.argmin([common * np.log(e / common) + 2 * (p + 2) for p, e in enumerate(errors)]))
        # Rows between the chosen and the common start come from the first values of the series.
        if chosen < use:
            extra = _regressors(np.asarray(head), chosen + 1, use + 1, chosen, True)
            take = np.r_[0 : chosen + 2, width - 1]
            square = square.copy()
            square[np.ix_(take, take)] += extra.T @ extra
        n_obs = n - 1 - chosen
        fit = least_squares(square, slots(chosen), n_obs)
        stat = fit.coef[1] / fit.error[1]
        return stat, adf_p_value(stat), chosen, n_obs, *adf_critical_values(n_obs)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [one(r.n, r.use, r.gram, r.head) for r in pdf.itertuples(index=False)]
            cols = list(zip(*got)) if got else [[]] * 7
            out = {k: pdf[k] for k in names}
            for f, c in zip(schema.fields[len(names) :], cols):
                out[f.name] = list(c)
            yield pd.DataFrame(out)

    return _spread(joined.select(*keys, "n", "use", "gram", "head"), keys).mapInPandas(solve, schema)


def pacf_ols(
    df: DataFrame, col: str, keys: Sequence[str] = (), pos: str = "pos", lags: int = 40, size: int = BLOCK
) -> DataFrame:
    """Partial autocorrelation at lags 1 to ``lags``: the last coefficient of a regression on them.

    Each lag uses every row that has it. The band is 1.96 over the root of the length.
    """
    rows, stats = _centered(df, col, keys, pos, F.lit(lags).cast("int"))
    grams = _cross_products(rows, keys, pos, False, size)
    joined = attach_stats(grams, stats, keys)
    schema = T.StructType(
        [
            *_fields(df, keys),
            T.StructField("lag", T.IntegerType()),
            T.StructField("pacf", T.DoubleType()),
            T.StructField("band", T.DoubleType()),
        ]
    )
    names, width = list(keys), lags + 2

    def one(n: int, gram: np.ndarray, head: np.ndarray) -> list[float | None]:
        square = np.asarray(gram).reshape(width, width).copy()
        head = np.asarray(head)
        found: list[float | None] = []
        for k in range(lags, 0, -1):
            if n - k <= k + 1:
                found.append(None)
            else:
                found.append(float(least_squares(square, np.r_[0 : k + 1], n - k).coef[-1]))
            # The next shorter lag gains the row k - 1, which has k - 1 values before it.
            if 1 < k <= len(head):
                z = _regressors(head, k - 1, k, k - 1, False)
                take = np.r_[0:k, width - 1]
                square[np.ix_(take, take)] += z.T @ z
        return found[::-1]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                values = one(row.n, row.gram, row.head)
                out = {k: [getattr(row, k)] * lags for k in names}
                yield pd.DataFrame(
                    {
                        **out,
                        "lag": np.arange(1, lags + 1, dtype="int32"),
                        "pacf": pd.array(values, dtype="Float64"),
                        "band": 1.96 / np.sqrt(row.n),
                    }
                )

    return _spread(joined.select(*keys, "n", "gram", "head"), keys).mapInPandas(solve, schema)
