import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cuadra.operators import aggregate as A


def test_quartile_of_four(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    row = A.exact_quantiles(df, "x", [0.25, 0.5, 0.75, 0.0, 1.0]).first()
    assert (row.n, row.q25, row.q50, row.q75, row.q0, row.q100) == (4, 1.75, 2.5, 4.75, 1.0, 10.0)


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_with_a_hot_group_ties_and_nulls(spark, seed):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"k": rng.choice(["hot"] * 8 + ["a", "b", None], 5000), "x": np.round(rng.normal(0, 3, 5000), 1)})
    pdf.loc[rng.integers(0, 5000, 300), "x"] = np.nan
    # One value alone holds a third of the rows.
    pdf.loc[rng.random(5000) < 0.33, "x"] = 0.5
    df = spark.createDataFrame(pdf).repartition(7)
    got = {r.k: r for r in A.exact_quantiles(df, "x", [0.1, 0.5, 0.9], ["k"]).collect()}
    want = pdf.dropna(subset=["x"]).groupby("k", dropna=False)["x"]
    assert len(got) == 4
    for k, x in want:
        k = None if pd.isna(k) else k
        assert got[k].n == len(x)
        assert [got[k].q10, got[k].q50, got[k].q90] == pytest.approx(np.quantile(x, [0.1, 0.5, 0.9]))


def test_quantiles_of_a_large_group_sort_few_values(spark):
    n = 50_000
    df = spark.range(n).select(((F.col("id") * 7919) % n).cast("double").alias("x")).withColumn("k", F.col("x") % 2)
    values = A._known(df, "x", ["k"])
    kept = A._weights(values, ["k"], (0.25, 0.5))
    assert kept.count() < n / 20 and kept.agg(F.sum("weight")).first()[0] == n
    got = {r.k: (r.n, r.q25, r.q50) for r in A.exact_quantiles(df, "x", (0.25, 0.5), ["k"]).collect()}
    for k in (0, 1):
        x = np.arange(k, n, 2)
        assert got[k] == (n / 2, np.quantile(x, 0.25), np.quantile(x, 0.5))


def test_quantiles_sort_everything_if_the_sketch_misses(spark, monkeypatch):
    # Without whole small groups the neighbourhood of a quantile holds one rank of the two.
    monkeypatch.setattr(A, "SMALL_GROUP", 0)
    df = spark.createDataFrame([(float(v),) for v in range(8)], "x double")
    assert A.exact_quantiles(df, "x", [0.25]).first().q25 == 1.75


def test_box_stats_by_hand(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 5, 100]] + [("b", 7.0)], "c string, x double")
    got = {r.c: r for r in A.box_stats(df, "c", ["x"]).collect()}
    a = got["a"]
    assert (a.q25, a.q50, a.q75, a.whisker_low, a.whisker_high, a.n_outliers) == (2.25, 3.5, 4.75, 1.0, 5.0, 1)
    assert (got["b"].whisker_low, got["b"].whisker_high, got["b"].n_outliers) == (7.0, 7.0, 0)


def test_value_counts_leaves_nulls_out(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "c string")
    assert [tuple(r) for r in A.value_counts(df, "c").collect()] == [("a", 2)]
    assert {tuple(r) for r in A.count_by(df, "c").collect()} == {("a", 2), (None, 1)}


def test_pairwise_correlation(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 2.5), (None, 9.0)], "a double, b double")
    got = {(r.a, r.b): r.r for r in A.correlation_matrix(df).collect()}
    assert got["a", "b"] == got["b", "a"] == pytest.approx(0.98198, abs=1e-5)
    assert got["a", "a"] == pytest.approx(1.0)


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 10, 10]], "x double")
    got = {r.bin: r["count"] for r in A.histogram(df, "x", 5).collect()}
    counts, _ = np.histogram([0, 1, 2, 3, 10, 10], 5)
    assert got == {i: c for i, c in enumerate(counts) if c}


def test_histogram_of_one_value(spark):
    assert A.histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), "x", 4).first()["count"] == 2


def test_describe_and_summary(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (4.0, None)], "x double, s string")
    got = {r.column: r for r in A.describe(df).collect()}
    assert (got["x"]["count"], got["x"]["mean"], got["x"]["min"], got["x"]["max"]) == (3, pytest.approx(7 / 3), "1.0", "4.0")
    assert (got["s"]["count"], got["s"]["mean"], got["s"]["min"], got["s"]["max"]) == (2, None, "a", "b")
    assert A.summary(df).first().q25 == 1.5
    assert A.summary(df, exact=False).first().q50 == 2.0


def test_describe_dates(spark):
    df = spark.sql("SELECT explode(sequence(date'2018-01-01', date'2018-01-09', interval 1 day)) AS d")
    row = A.describe_dates(df, "d").first()
    assert (row["count"], str(row["min"]), str(row.q25), str(row.q50), str(row["max"])) == (
        9, "2018-01-01", "2018-01-03", "2018-01-05", "2018-01-09")


def test_qq_table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(5, 2, 400)
    df = spark.createDataFrame(pd.DataFrame({"id": range(400), "x": x}))
    table = A.qq_table(df, "x", "id")
    rows = table.orderBy("i").collect()
    assert [r.value for r in rows] == sorted(x)
    assert rows[0].plot_position == pytest.approx(1 - 0.5 ** (1 / 400))
    assert rows[-1].plot_position == pytest.approx(0.5 ** (1 / 400))
    assert rows[1].plot_position == pytest.approx((2 - 0.3175) / 400.365)
    line = A.qq_line(table).first()
    assert line.r > 0.99 and line.slope == pytest.approx(2, abs=0.2) and line.intercept == pytest.approx(5, abs=0.3)


def test_normal_quantile(spark):
    from cuadra.functions.normal import normal_quantile

    got = spark.createDataFrame([(0.5,), (0.975,), (0.0,)], "p double").select(normal_quantile("p").alias("z")).collect()
    assert got[0].z == 0 and got[1].z == pytest.approx(1.959964, abs=1e-6) and got[2].z is None


def test_mode_counts_by_shuffle(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (2, None), (1, "y")], "a int, s string")
    assert tuple(A.most_frequent(df, ["a", "s"]).first()) == (1, "y")


def test_account_summary(spark):
    df = spark.createDataFrame([(1, None, 10.0, 1.0), (1, "b", 20.0, 3.0), (2, None, 5.0, 5.0)], "k int, op string, amount double, balance double")
    got = {r.k: tuple(r) for r in A.account_summary(df, "k", "op", "amount", "balance").collect()}
    assert got == {1: (1, "b", 15.0, 2.0, 2), 2: (2, None, 5.0, 5.0, 1)}


def test_confusion_matrix(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1)], "t int, p int")
    assert {tuple(r) for r in A.confusion_matrix(df, "t", "p").collect()} == {(0, 0, 1), (0, 1, 1), (1, 1, 2)}


def test_avg_by_names(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 3, 4.0)], "s string, x int, y double")
    out = A.avg_by(df, "s")
    assert out.columns == ["s", "avg(x)", "avg(y)"] and tuple(out.first()) == ("a", 2.0, 3.0)


def test_global_stats(spark):
    row = A.global_stats(spark.range(5).select(F.col("id").cast("double").alias("x")), "x").first()
    assert (row["mean"], row["min"], row["max"]) == (2.0, 0.0, 4.0)


def test_nan_counts_as_missing_everywhere(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (float("nan"), "a"), (3.0, "a"), (None, "a")], "x double, k string")
    assert sum(r["count"] for r in A.histogram(df, "x", 2).collect()) == 3
    assert A.avg_by(df, "k").first()["avg(x)"] == 2.0
    stats = A.global_stats(df, "x").first()
    assert (stats["mean"], stats["min"], stats["max"]) == (2.0, 1.0, 3.0)
    row = next(r for r in A.describe(df).collect() if r["column"] == "x")
    assert (row["count"], row["mean"], row["max"]) == (3, 2.0, "3.0")
