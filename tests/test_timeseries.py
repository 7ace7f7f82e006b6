import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cuadra.functions.regression import adf_critical_values, adf_p_value
from cuadra.operators import stationarity as S
from cuadra.operators import timeseries as T
from cuadra.operators import windows as W


def frame(spark, series: dict):
    rows = [(k, i, float(v)) for k, xs in series.items() for i, v in enumerate(xs)]
    return spark.createDataFrame(rows, "k string, pos long, x double").repartition(6)


def walk(n, seed):
    return 100 + np.cumsum(np.random.default_rng(seed).normal(0, 1, n))


def noise(n, seed):
    return np.random.default_rng(seed).normal(5, 2, n)


# ---- calendar ----


def test_business_grid(spark):
    df = spark.createDataFrame([("1994-01-07", 1.0), ("1994-01-10", 2.0), ("1994-01-12", 3.0)], "d string, x double").select(F.to_date("d").alias("ts"), "x")
    grid = T.regular_grid(df, "ts", freq="B").orderBy("pos")
    assert [(str(r.ts), r.pos, r.x) for r in grid.collect()] == [
        ("1994-01-07", 0, 1.0), ("1994-01-10", 1, 2.0), ("1994-01-11", 2, None), ("1994-01-12", 3, 3.0)]
    filled = W.ffill(grid, ["x"], [], "pos", None).orderBy("pos")
    assert [r.x for r in filled.collect()] == [1, 2, 2, 3]


def test_business_grid_that_starts_on_a_weekend(spark):
    df = spark.createDataFrame([("1994-01-08", 1.0), ("1994-01-10", 2.0)], "d string, x double").select(F.to_date("d").alias("ts"), "x")
    assert [(str(r.ts), r.x) for r in T.regular_grid(df, "ts", freq="B").collect()] == [("1994-01-10", 2.0)]


def test_monthly_grid(spark):
    df = spark.createDataFrame([("1960-01-01", 1.0), ("1960-04-01", 2.0)], "d string, x double").select(F.to_date("d").alias("ts"), "x")
    assert [(str(r.ts), r.x) for r in T.regular_grid(df, "ts", freq="M").orderBy("ts").collect()] == [
        ("1960-01-01", 1.0), ("1960-02-01", None), ("1960-03-01", None), ("1960-04-01", 2.0)]


def test_business_days_before(spark):
    days = pd.bdate_range("1969-12-01", "1970-03-01")
    got = {r.d: r.n for r in spark.createDataFrame([(d.date(),) for d in days], "d date").withColumn("n", T.business_days_before(F.col("d"))).collect()}
    first = got[days[0].date()]
    assert [got[d.date()] - first for d in days] == list(range(len(days)))


def test_date_index(spark):
    df = spark.createDataFrame([("07/01/1994",), ("13/13/1994",), (None,)], "s string")
    assert [r.ts for r in T.date_index(df, "s").collect()] == [dt.date(1994, 1, 7), None, None]


# ---- decomposition ----


def by_hand(x, p, ratio):
    h, n = p // 2, len(x)
    w = np.ones(p) if p % 2 else np.r_[0.5, np.ones(p - 1), 0.5]
    trend = np.full(n, np.nan)
    for i in range(h, n - h):
        trend[i] = w @ x[i - h : i + h + 1] / p
    rest = x / trend if ratio else x - trend
    means = np.array([np.nanmean(rest[i::p]) for i in range(p)])
    means = means / means.mean() if ratio else means - means.mean()
    seasonal = means[np.arange(n) % p]
    return trend, seasonal, (rest / seasonal if ratio else rest - seasonal)


@pytest.mark.parametrize("model", ["additive", "multiplicative"])
@pytest.mark.parametrize("period,size", [(5, 7), (12, 20), (12, None), (5, 65_536)])
def test_decompose(spark, model, period, size):
    t = np.arange(80)
    series = {k: 50 + 0.3 * t + 5 * np.sin(2 * np.pi * t / period) + noise(80, s) for k, s in (("a", 1), ("b", 2))}
    out = T.decompose(frame(spark, series), "x", period, ["k"], model=model, size=size)
    for k, x in series.items():
        rows = out.filter(F.col("k") == k).orderBy("pos").collect()
        for name, want in zip(("trend", "seasonal", "resid"), by_hand(x, period, model == "multiplicative")):
            assert np.array([np.nan if r[name] is None else r[name] for r in rows]) == pytest.approx(want, nan_ok=True)


def test_multiplicative_refuses_zero(spark):
    with pytest.raises(PySparkException):
        T.decompose(frame(spark, {"a": [1, 2, 0, 4, 5, 6, 7]}), "x", 3, ["k"], model="multiplicative").collect()


# ---- autocorrelation ----


@pytest.mark.parametrize("size", [50, 65_536])
def test_acf(spark, size):
    series = {"walk": walk(300, 1), "noise": noise(150, 2)}
    rows = T.acf(frame(spark, series), "x", ["k"], lags=40, size=size).collect()
    assert len(rows) == 80
    got = {(r.k, r.lag): r for r in rows}
    for k, x in series.items():
        c = x - x.mean()
        r = [c[j:] @ c[: len(c) - j] / (c @ c) for j in range(1, 41)]
        band = 1.96 * np.sqrt((1 + 2 * np.r_[0, np.cumsum(np.square(r))[:-1]]) / len(x))
        assert [got[k, j].acf for j in range(1, 41)] == pytest.approx(r)
        assert [got[k, j].band for j in range(1, 41)] == pytest.approx(band)
    assert got["walk", 1].acf > 0.9


def test_acf_of_a_short_series(spark):
    assert T.acf(frame(spark, {"a": [1, 2, 4]}), "x", ["k"], lags=5).count() == 2


def test_acf_without_keys(spark):
    x = noise(200, 3)
    df = frame(spark, {"a": x}).drop("k")
    c = x - x.mean()
    assert T.acf(df, "x", lags=1, size=30).first().acf == pytest.approx(c[1:] @ c[:-1] / (c @ c))


def test_acf_refuses_nulls(spark):
    df = spark.createDataFrame([(0, 1.0), (1, None), (2, 3.0)], "pos long, x double")
    with pytest.raises(PySparkException):
        T.acf(df, "x", lags=1).collect()


@pytest.mark.parametrize("size", [50, 65_536])
def test_pacf(spark, size):
    series = {"walk": walk(300, 4), "noise": noise(120, 5)}
    got = {(r.k, r.lag): r for r in S.pacf_ols(frame(spark, series), "x", ["k"], lags=20, size=size).collect()}
    for name, x in series.items():
        n = len(x)
        for k in range(1, 21):
            z = np.column_stack([np.ones(n - k)] + [x[k - j : n - j] for j in range(1, k + 1)])
            want = np.linalg.lstsq(z, x[k:], rcond=None)[0][-1]
            assert got[name, k].pacf == pytest.approx(want, abs=1e-7), (name, k)
        assert got[name, 1].band == pytest.approx(1.96 / np.sqrt(n))


# ---- unit root ----


def ols(z, y):
    b, *_ = np.linalg.lstsq(z, y, rcond=None)
    e = y - z @ b
    ssr = e @ e
    s = np.sqrt(ssr / (len(y) - z.shape[1]) * np.diag(np.linalg.inv(z.T @ z)))
    return b, s, ssr


def adf_by_hand(x, max_lags=None, search=True):
    n, d = len(x), np.diff(x)
    bound = min(int(np.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2)
    m = bound if max_lags is None else min(max_lags, bound)

    def rows(p, first):
        at = np.arange(first, n - 1)
        return np.column_stack([np.ones(len(at)), x[at]] + [d[at - j] for j in range(1, p + 1)]), d[at]

    best = m
    if search:
        aic = []
        for p in range(m + 1):
            z, y = rows(p, m)
            aic.append(len(y) * np.log(ols(z, y)[2] / len(y)) + 2 * z.shape[1])
        best = int(np.argmin(aic))
    z, y = rows(best, best)
    b, s, _ = ols(z, y)
    return b[1] / s[1], best, len(y)


@pytest.mark.parametrize("size", [60, 65_536])
@pytest.mark.parametrize("max_lags,search", [(None, True), (3, False), (0, True)])
def test_adf(spark, size, max_lags, search):
    series = {"walk": walk(400, 6), "noise": noise(150, 7), "ar": walk(90, 8) * 0.1 + noise(90, 9)}
    got = {r.k: r for r in S.adf_test(frame(spark, series), "x", ["k"], max_lags=max_lags, search=search, size=size).collect()}
    for k, x in series.items():
        stat, lags, n = adf_by_hand(x, max_lags, search)
        assert (got[k].lags, got[k].n_obs) == (lags, n)
        assert got[k].statistic == pytest.approx(stat, rel=1e-6)
    assert got["noise"].p_value < 0.01 < got["walk"].p_value


def test_adf_without_keys(spark):
    x = walk(200, 10)
    row = S.adf_test(frame(spark, {"a": x}).drop("k"), "x", size=50).first()
    assert row.statistic == pytest.approx(adf_by_hand(x)[0], rel=1e-6)


def test_adf_p_values():
    assert adf_p_value(-1.73) == pytest.approx(0.416, abs=0.001)
    assert adf_p_value(-20) == 0 and adf_p_value(3) == 1
    assert adf_critical_values(10**9) == pytest.approx((-3.43035, -2.86154, -2.56677))


# ---- scaling, noise, forecasts ----


def test_minmax_may_leave_the_range(spark):
    train = spark.createDataFrame([(float(i),) for i in range(20)], "x double")
    ends = T.minmax_fit(train, ["x"])
    test = spark.createDataFrame([(39.0,), (0.0,)], "x double")
    scaled = T.minmax_apply(test, ends, ["x"])
    assert [r.x for r in scaled.collect()] == pytest.approx([2.0526, 0], abs=1e-4)
    assert [r.x for r in T.minmax_invert(scaled, ends, ["x"], "x").collect()] == pytest.approx([39, 0])


def test_noise_column(spark):
    df = frame(spark, {"a": noise(2000, 11)})
    one = {r.pos: r.n for r in T.noise_column(df, "x", "pos", "n", seed=3).collect()}
    two = {r.pos: r.n for r in T.noise_column(df.repartition(3), "x", "pos", "n", seed=3).collect()}
    assert one.keys() == two.keys() and all(one[p] == pytest.approx(two[p]) for p in one)
    v = np.array([one[p] for p in sorted(one)])
    assert v.mean() == pytest.approx(5, abs=0.2) and v.std() == pytest.approx(2, abs=0.2)
    assert abs(np.corrcoef(v[1:], v[:-1])[0, 1]) < 0.1


def test_forecast_metrics(spark):
    df = spark.createDataFrame([(10.0, 8.0), (20.0, 25.0), (0.0, 1.0)], "y double, p double")
    row = T.forecast_metrics(df, "y", "p").first()
    assert row.mse == pytest.approx(10) and row.rmse == pytest.approx(10**0.5) and row.mape == pytest.approx(22.5)


def test_overlay(spark):
    df = spark.createDataFrame([(0, 1.0, 1.5, "train"), (1, 2.0, 2.5, "test")], "pos int, y double, p double, part string")
    assert sorted(tuple(r) for r in T.overlay_frame(df, "pos", "y", "p").collect()) == [
        (0, "history", 1.0), (1, "prediction", 2.5), (1, "true", 2.0)]


def test_every_series_has_noise_of_its_own(spark):
    df = spark.createDataFrame([(k, p, float(p % 5)) for k in "ab" for p in range(20)], "k string, pos long, x double")
    got = {(r.k, r.pos): r.n for r in T.noise_column(df, "x", "pos", "n", seed=3, keys=["k"]).collect()}
    assert all(got["a", p] != got["b", p] for p in range(20))


def test_unit_root_test_with_short_series(spark):
    from cuadra.operators.stationarity import adf_test

    rows = [(k, p, float((p * 7919) % 31)) for k, n in (("one", 1), ("two", 2), ("three", 3), ("long", 80)) for p in range(n)]
    df = spark.createDataFrame(rows, "k string, pos long, x double")
    got = {r.k: r.statistic for r in adf_test(df, "x", ["k"]).collect()}
    assert got["one"] is got["two"] is got["three"] is None and got["long"] is not None


def test_gaps_in_the_positions_are_refused(spark):
    from cuadra.operators.stationarity import adf_test

    df = spark.createDataFrame([(p, float(p % 7)) for p in range(60) if p != 30], "pos long, x double")
    for run in (lambda: T.acf(df, "x", lags=5), lambda: adf_test(df, "x")):
        with pytest.raises(Exception, match="without gaps"):
            run().collect()
