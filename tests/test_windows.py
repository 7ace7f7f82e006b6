import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cuadra.operators import windows as W
from cuadra.operators.position import with_position, with_running_sums

SIZES = [None, 3, 4, 1000]


def series(spark, seed=0, n=60, keys=("hot", "hot", "hot", "a", None)):
    """Rows of several series, one of them much longer, with gaps in the values."""
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"k": [keys[i] for i in rng.integers(0, len(keys), n)], "x": np.round(rng.normal(10, 3, n), 2)})
    pdf["pos"] = pdf.groupby("k", dropna=False).cumcount()
    pdf["gap"] = np.where(rng.random(n) < 0.6, np.nan, pdf["x"])
    df = spark.createDataFrame(pdf).withColumn("gap", F.when(~F.isnan("gap"), F.col("gap")))
    return pdf, df.repartition(5)


def got(df, col):
    return {(r.k, r.pos): r[col] for r in df.collect()}


def expected(pdf, values):
    return {(None if pd.isna(k) else k, p): (None if pd.isna(v) else v) for k, p, v in zip(pdf.k, pdf.pos, values)}


def close(a, b):
    assert a.keys() == b.keys()
    for key in a:
        assert (a[key] is None) == (b[key] is None), key
        assert a[key] is None or a[key] == pytest.approx(b[key]), key


@pytest.mark.parametrize("size", SIZES)
def test_fills(spark, size):
    pdf, df = series(spark)
    by = pdf.groupby("k", dropna=False)["gap"]
    close(got(W.ffill(df, ["gap"], ["k"], "pos", size), "gap"), expected(pdf, by.ffill()))
    close(got(W.bfill(df, ["gap"], ["k"], "pos", size), "gap"), expected(pdf, by.bfill()))


@pytest.mark.parametrize("size", [None, 4])
def test_no_fill_goes_through_the_rest_of_a_block_for_every_row(spark, size):
    df = series(spark)[1]
    for fill in (W.ffill, W.bfill):
        frames = fill(df, ["gap"], ["k"], "pos", size)._jdf.queryExecution().analyzed().toString().lower()
        assert "unboundedpreceding" in frames and "unboundedfollowing" not in frames


def test_fill_back_over_long_blocks(spark):
    n = 150_000
    df = spark.range(n).select(F.col("id").alias("pos"), F.when(F.col("id") % 70_000 == 69_999, F.col("id")).alias("x"))
    filled = W.bfill(df, ["x"], [], "pos").groupBy("x").agg(F.count("*"), F.min("pos"), F.max("pos"))
    assert sorted(filled.collect(), key=str) == [(139_999, 70_000, 70_000, 139_999), (69_999, 70_000, 0, 69_999), (None, 10_000, 140_000, 149_999)]


def test_fill_by_hand_without_keys(spark):
    df = spark.createDataFrame(list(enumerate([None, 5.0, None, 7.0, None])), "pos int, x double")
    forward = W.ffill(df, ["x"], [], "pos", 2).orderBy("pos")
    assert [r.x for r in forward.collect()] == [None, 5, 5, 7, 7]
    assert [r.x for r in W.bfill(df, ["x"], [], "pos", 2).orderBy("pos").collect()] == [5, 5, 7, 7, None]
    # Filling twice changes nothing.
    assert W.ffill(forward, ["x"], [], "pos", 2).orderBy("pos").collect() == forward.collect()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-100, 100)), min_size=1, max_size=30), st.integers(1, 6))
def test_fill_property(spark, xs, size):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "pos long, x double")
    want = pd.Series(xs, dtype="float64").ffill()
    have = [r.x for r in W.ffill(df, ["x"], [], "pos", size).orderBy("pos").collect()]
    assert [None if pd.isna(v) else v for v in want] == have


@pytest.mark.parametrize("size", SIZES)
def test_cumulative_sum(spark, size):
    pdf, df = series(spark, 1)
    want = 100 + pdf.groupby("k", dropna=False)["x"].cumsum()
    close(got(W.cumulative_sum(df, "x", ["k"], "pos", "walk", 100.0, size), "walk"), expected(pdf, want))


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("k", [1, 7])
def test_lag_windows(spark, size, k):
    pdf, df = series(spark, 2)
    rows = W.lag_windows(df, ["x"], "x", k, ["k"], "pos", size, keep=["gap"]).collect()
    want = {}
    for key, g in pdf.groupby("k", dropna=False):
        x = g["x"].to_numpy()
        for i in range(len(x) - k):
            want[None if pd.isna(key) else key, i + k] = (list(x[i : i + k]), x[i + k])
    assert {(r.k, r.pos): ([s.x for s in r.x], r.y) for r in rows} == want


def test_lag_window_counts(spark):
    df = spark.range(10).select(F.col("id").alias("pos"), F.col("id").cast("double").alias("x"))
    assert W.lag_windows(df, ["x"], "x", 7, [], "pos", 4).count() == 3


@pytest.mark.parametrize("size", SIZES)
@pytest.mark.parametrize("period", [4, 5])
def test_moving_average(spark, size, period):
    pdf, df = series(spark, 3)
    half = period // 2
    weights = np.ones(period) if period % 2 else np.r_[0.5, np.ones(period - 1), 0.5]
    out = pd.Series(np.nan, index=pdf.index)
    for _, g in pdf.groupby("k", dropna=False):
        x = g["x"].to_numpy()
        for i in range(half, len(x) - half):
            out[g.index[i]] = weights @ x[i - half : i + half + 1] / period
    close(got(W.centered_moving_average(df, "x", period, ["k"], "pos", "ma", size), "ma"), expected(pdf, out))


def test_even_period_by_hand(spark):
    df = spark.createDataFrame([(i, float(i + 1)) for i in range(6)], "pos int, x double")
    out = W.centered_moving_average(df, "x", 4, [], "pos", "ma", 2).orderBy("pos")
    assert [r.ma for r in out.collect()] == [None, None, 3, 4, None, None]


def test_splits_are_ordered_and_complete(spark):
    pdf, df = series(spark, 4)
    sizes = pdf.groupby("k", dropna=False).size()
    for split, cut in ((W.chronological_split(df, ["k"], "pos"), lambda n: int(0.8 * n)), (W.tail_split(df, ["k"], "pos", 5), lambda n: max(n - 5, 0))):
        rows = split.collect()
        assert len(rows) == len(pdf)
        for k, n in sizes.items():
            mine = [r for r in rows if r.k == (None if pd.isna(k) else k)]
            assert sorted(r.pos for r in mine if r.part == "train") == list(range(cut(n)))


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_position_matches_a_plain_sort(spark, keys):
    rng = np.random.default_rng(5)
    n = 3000
    pdf = pd.DataFrame({"id": range(n), "k": rng.choice(["hot", "hot", "b", None], n), "x": rng.integers(0, 5, n)})
    # Two of five values are equal in most rows: only the tie-break tells them apart.
    rows = with_position(spark.createDataFrame(pdf).repartition(9), ["x", "id"], keys, length="n").collect()
    ordered = pdf.sort_values(["x", "id"])
    by = ordered.groupby("k", dropna=False) if keys else ordered.groupby(lambda _: 0)
    want = dict(zip(ordered.id, by.cumcount()))
    assert {r.id: r.pos for r in rows} == want
    sizes = dict(zip(ordered.id, by["x"].transform("size")))
    assert {r.id: r.n for r in rows} == sizes


def test_running_sums_descending(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"s": rng.permutation(500), "w": rng.integers(0, 9, 500)})
    df = spark.createDataFrame(pdf).repartition(6)
    rows = with_running_sums(df, [F.desc("s")], {"upto": "w"}, totals={"all": "w"}).collect()
    ordered = pdf.sort_values("s", ascending=False)
    assert {r.s: r.upto for r in rows} == dict(zip(ordered.s, ordered.w.cumsum()))
    assert {r["all"] for r in rows} == {int(pdf.w.sum())}
