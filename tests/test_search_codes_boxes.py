"""Parameter search, category codes, trees as boxes, wide quantiles, modes and nested fits."""

import math
import random
from statistics import NormalDist

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from cuadra.functions.normal import normal_quantile
from cuadra.functions.regression import least_squares, nested_errors
from cuadra.operators import aggregate as A
from cuadra.operators import codes as C
from cuadra.operators import evaluate as E
from cuadra.operators import features as X
from cuadra.operators import models as M
from cuadra.operators import quantiles as Q
from cuadra.operators import search as P
from cuadra.operators import stationarity as S


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = []
    for i in range(500):
        size, color = rng.random() * 10, rng.choice(["red", "green", "blue"])
        label = int(size > 6 or (color == "red" and size > 3)) if rng.random() < 0.95 else rng.randint(0, 1)
        data.append((i, size, color, label, 3 * size + (color == "blue") + rng.random()))
    return spark.createDataFrame(data, "id long, size double, color string, label int, price double").cache()


# Search

def test_draws():
    space = {"a": P.uniform_int(2, 4), "b": P.log_uniform(-3, 0), "c": P.log_uniform_int(0, 3)}
    one, two = P.draw_trials(space, 50, 7), P.draw_trials(space, 50, 7)
    assert one == two and one != P.draw_trials(space, 50, 8)
    assert {d["a"] for d in one} == {2, 3, 4} and all(math.exp(-3) <= d["b"] <= 1 and 1 <= d["c"] <= 20 for d in one)


def test_search_and_its_figures(spark, rows, tmp_path):
    split, _ = P.split_once(rows, "id", "label", X.column_features(["size"], ["color"]))
    assert {r.part for r in split.select("part").distinct().collect()} == {"train", "val", "test"}
    space = {"maxDepth": P.uniform_int(1, 4), "stepSize": P.log_uniform(-2, 0), "maxIter": P.uniform_int(2, 5)}
    found = P.search_boosted(split, "id", "label", space, GBTClassifier(labelCol="label", seed=1), trials=4, parallelism=4)
    trials = found.trials.collect()
    assert len(trials) == 4 and sum(r.best for r in trials) == 1
    assert [r.val_trial_roc_auc for r in trials if r.best] == [max(r.val_trial_roc_auc for r in trials)]
    assert found.predictions.count() == 500
    # The figures follow from the saved predictions, computed by another engine.
    found.predictions.write.parquet(f"{tmp_path}/p")
    got = found.metrics.first().asDict()
    assert set(got) == {f"{p}_{m}" for p in ("train", "val", "test") for m in ("n_rows", "accuracy", "precision", "recall", "f1", "log_loss", "roc_auc")}
    sql = f"""
      WITH p AS (SELECT * FROM '{tmp_path}/p/*.parquet' WHERE part = ?)
      SELECT count(*), avg((label = (score >= 0.5)::INT)::INT), sum(label * (score >= 0.5)::INT) / sum((score >= 0.5)::INT), sum(label * (score >= 0.5)::INT) / sum(label),
             avg(-ln(CASE WHEN label = 1 THEN score ELSE 1 - score END)),
             (SELECT avg(CASE WHEN a.score > b.score THEN 1 WHEN a.score = b.score THEN 0.5 ELSE 0 END) FROM p a, p b WHERE a.label = 1 AND b.label = 0) FROM p"""
    for part in ("train", "val", "test"):
        n, accuracy, precision, recall, loss, auc = duckdb.execute(sql, [part]).fetchall()[0]
        want = {"n_rows": n, "accuracy": accuracy, "precision": precision, "recall": recall, "log_loss": loss, "roc_auc": auc, "f1": 2 * precision * recall / (precision + recall)}
        assert {m: got[f"{part}_{m}"] for m in want} == pytest.approx(want)
    assert got["test_roc_auc"] > 0.8


def test_auto_search(rows):
    small = {"maxDepth": P.uniform_int(2, 3), "maxIter": P.uniform_int(2, 4)}
    found, stages = P.auto_search(rows.drop("price"), "label", "id", "classification", slots=32, space=small, trials=2)
    assert [r.model for r in found.trials.orderBy("trial").collect()] == ["logistic", "tree", "forest", "boosted", "boosted"]
    assert found.metrics.first().test_roc_auc > 0.8 and stages.transform(rows).count() == 500
    found, _ = P.auto_search(rows.drop("label"), "price", "id", "regression", slots=32, space=small, trials=2)
    row = found.metrics.first()
    assert row.test_r2 > 0.8 and row.test_rmse == pytest.approx(math.sqrt(row.test_mse)) and "val_mae" in row
    named = rows.withColumn("label", F.when(F.col("label") == 1, "yes").when(F.col("id") > 10, "no")).drop("price")
    found, _ = P.auto_search(named, "label", "id", "classification", slots=32, space=small, trials=1)
    assert found.predictions.count() == named.filter("label IS NOT NULL").count()
    with pytest.raises(ValueError):
        P.auto_search(rows, "label", "id", "ranking", slots=8)


def test_search_without_a_figure(spark):
    rows = spark.createDataFrame([(i, float(i), 1.0) for i in range(60)], "id long, x double, y double")
    split, _ = P.split_once(rows, "id", "y", [X.assemble(["x"])])
    with pytest.raises(ValueError, match="r2"):  # all targets are equal
        P.search_boosted(split, "id", "y", {"maxIter": P.uniform_int(1, 1)}, GBTRegressor(labelCol="y", seed=1), trials=1)


# Category codes

ODD = [("a",), ("b",), ("b",), ("c",), ("c",), (None,), ("",), ("d`",)]


@pytest.mark.parametrize("unseen", ["skip", "keep", "error"])
def test_codes_are_those_of_the_indexer(spark, unseen):
    train = spark.createDataFrame(ODD, "s string").filter("s IS NOT NULL")
    rows = train if unseen == "error" else spark.createDataFrame([*ODD, ("new",)], "s string")
    want = X.fit_stages([X.index_labels(["s"], unseen=unseen)], train).transform(rows).collect()
    got = X.fit_stages([X.index_by_counts(["s"], unseen=unseen)], train).transform(rows).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_unseen_value_is_named(spark):
    train = spark.createDataFrame([("a",)], "s string")
    fitted = X.fit_stages([X.index_by_counts(["s"])], train)
    with pytest.raises(Exception, match="without a code: new"):
        fitted.transform(spark.createDataFrame([("new",)], "s string")).collect()
    with pytest.raises(ValueError):
        C.with_codes(train, C.code_table(train, ["s"]), ["s"], unseen="drop")


def test_features_from_codes(spark, rows):
    for unseen in ("keep", "skip"):
        stages = [X.column_features(["size"], ["color"], unseen=unseen, indexer=i) for i in (X.index_labels, X.index_by_counts)]
        one, two = (X.fit_stages(s, rows.filter("id > 5")).transform(rows).select("id", "features").orderBy("id").collect() for s in stages)
        assert one == two


def test_codes_of_a_million_values(spark):
    rows = spark.range(1_000_000).select(F.concat(F.lit("v"), "id").alias("s"), (F.col("id") % 3).cast("string").alias("t"))
    rows = rows.unionByName(spark.createDataFrame([("v77", "1")] * 2, "s string, t string"))
    codes = C.code_table(rows, ["s", "t"])
    assert C.code_counts(codes, ["s", "t", "none"]) == {"s": 1_000_000, "t": 3, "none": 0}
    top = codes.filter("column = 's' AND code < 3").orderBy("code").collect()
    assert [(r.value, r["count"]) for r in top] == [("v77", 3), ("v0", 1), ("v1", 1)]
    coded = C.with_codes(rows, codes, ["s", "t"])
    assert coded.agg(F.count_distinct("s_index"), F.max("s_index"), F.count_distinct("t_index")).first() == (1_000_000, 999_999.0, 3)


# Trees as boxes

def test_boxes_score_as_the_tree(rows):
    df = X.fit_stages([X.index_labels(["color"]), X.assemble(["color_index", "size"])], rows).transform(rows)
    for depth in (0, 1, 5):
        tree = M.decision_tree("label", depth=depth).fit(df)
        boxes = E.leaf_boxes(tree, df)
        scored = E.score_by_boxes(tree.transform(df).withColumnRenamed("prediction", "wanted"), boxes)
        assert scored.count() == 500 and scored.filter("NOT wanted <=> prediction").count() == 0
        assert boxes.count() == tree.numNodes // 2 + 1


# Quantiles

@pytest.mark.parametrize("keys", [[], ["k"]])
def test_wide_quantiles(spark, keys):
    rng = np.random.default_rng(2)
    n = 60_000
    data = pd.DataFrame({
        "k": rng.choice(["a", "b"], n, p=[0.999, 0.001]), "x": rng.normal(size=n), "tied": rng.integers(0, 4, n).astype(float),
        "hot": np.where(rng.random(n) < 0.7, 5.0, rng.random(n) * 10), "holes": np.where(rng.random(n) < 0.9, np.nan, rng.random(n))})
    df = spark.createDataFrame(data).withColumn("none", F.lit(None).cast("double")).repartition(7)
    cols, qs = ["x", "tied", "hot", "holes", "none"], (0.0, 0.003, 0.25, 0.5, 0.69, 0.75, 0.999, 1.0)
    for row in Q.wide_quantiles(df, cols, qs, keys).collect():
        part = data[data["k"] == row.k] if keys else data
        for i, c in enumerate(cols):
            known = part[c].dropna() if c != "none" else part["x"][:0]
            assert row[f"{i}:n"] == len(known)
            for q in qs:
                got = row[f"{i}:{Q.quantile_name(q)}"]
                assert got is None if not len(known) else got == pytest.approx(np.quantile(known, q), rel=1e-12, abs=1e-12)


def test_sorted_quantiles_are_the_same(spark):
    df = spark.range(9000).selectExpr("id % 4 AS k", "CAST((id * 7919) % 1009 AS DOUBLE) AS x")
    one, two = (sorted(map(tuple, f(df, "x", (0.01, 0.5, 0.9), ["k"]).collect())) for f in (A.exact_quantiles, A.sorted_quantiles))
    assert [list(r) for r in one] == [pytest.approx(list(r)) for r in two]


def test_quantiles_run_no_job_before_an_action(spark):
    df = spark.range(5000).selectExpr("id % 3 AS k", "CAST(id AS DOUBLE) AS x", "CAST(id * id AS DOUBLE) AS y")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "lazy")
    frames = [A.summary(df, ["x", "y"]), A.box_stats(df, "k", ["x", "y"]), A.exact_quantiles(df, "x", [0.5], ["k"])]
    assert len(tracker.getJobIdsForGroup("lazy")) == 0
    assert [f.count() for f in frames] == [2, 6, 3]
    spark.sparkContext.setJobGroup("", "")


def test_summary_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, x double")
    assert A.summary(df, ["x"]).first().q50 is None and A.box_stats(df, "k", ["x"]).count() == 0


# Modes, summaries, fits

def test_modes_in_one_scan(spark):
    df = spark.createDataFrame([(1, "b", 2.0, None), (2, "a", float("nan"), None), (2, "b", 2.0, None), (1, "a", 3.0, None)], "n int, s string, x double, z date")
    assert tuple(A.most_frequent(df, ["n", "s", "x", "z"]).first()) == (1, "a", 2.0, None)
    wide = spark.range(20).select(*[(F.col("id") % (i + 1)).alias(f"c{i}") for i in range(70)])
    assert tuple(A.most_frequent(wide, wide.columns).first()) == tuple([0] * 70)


def test_account_summary_sorts_no_raw_rows(spark):
    df = spark.createDataFrame([(1, "x", 1.0, None), (1, "y", 3.0, 2.0), (2, None, None, None)], "k int, t string, a double, b double")
    out = A.account_summary(df, "k", "t", "a", "b")
    assert sorted(map(tuple, out.collect())) == [(1, "y", 2.0, 2.0, 2), (2, None, None, None, 1)]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate(keys=[k" in plan and "SortAggregate" not in plan.split("HashAggregate")[-1]


def test_normal_quantile_to_the_last_digits(spark):
    points = [1e-300, 1e-20, 1e-7, 0.01, 0.074, 0.076, 0.3, 0.5, 0.7, 0.925, 0.99, 1 - 1e-9]
    df = spark.createDataFrame([(p,) for p in [*points, 0.0, 1.0, None, -1.0]], "p double")
    got = [r.z for r in df.select(normal_quantile("p").alias("z")).collect()]
    assert got[:len(points)] == pytest.approx([NormalDist().inv_cdf(p) for p in points], rel=1e-14)
    assert got[len(points):] == [None] * 4


def test_nested_errors():
    r = np.random.default_rng(0)
    z = np.c_[np.ones(50), r.normal(size=(50, 4)), r.normal(size=50)]
    square = z.T @ z
    assert nested_errors(square, 50) == pytest.approx([least_squares(square, np.r_[0:k + 1], 50).ssr for k in range(5)])
    z[:, 2] = z[:, 1]  # collinear
    square = z.T @ z
    assert nested_errors(square, 50) == pytest.approx([least_squares(square, np.r_[0:k + 1], 50).ssr for k in range(5)])


def test_series_of_different_lengths_have_their_own_width(spark):
    r = np.random.default_rng(4)
    data = [(k, i, float(x)) for k, n in (("long", 900), ("short", 30), ("tiny", 3)) for i, x in enumerate(np.cumsum(r.normal(size=n)))]
    df = spark.createDataFrame(data, "k string, pos int, x double")
    together = {x.k: x for x in S.adf_test(df, "x", ["k"]).collect()}
    for k in ("long", "short", "tiny"):
        alone = S.adf_test(df.filter(F.col("k") == k), "x", ["k"]).first()
        assert [v for v in together[k]] == pytest.approx(list(alone)) if k != "tiny" else together[k].statistic is None
    with pytest.raises(Exception, match="longer than the number of lags"):
        S.adf_test(df, "x", ["k"], max_lags=9, size=8).collect()


# Equal rows once, with their number

@pytest.mark.parametrize("build", [
    lambda: M.gbt_classifier("label", rounds=4, depth=4, minInstancesPerNode=150, seed=1),
    lambda: M.decision_tree("label", depth=4, minInstancesPerNode=150),
    lambda: M.boosted_regressor("y", rounds=4, rows_share=1.0, min_rows=150, features_share="all", seed=1),
])
def test_collapsed_rows_give_the_same_model(spark, build):
    rows = X.assemble(["a", "b"]).transform(spark.range(3000).selectExpr(
        "id % 7 AS a", "id % 5 AS b", "double(hash(id) % 10 > id % 7) AS label", "id % 7 * (id % 5) + hash(id) % 1000 / 1000 AS y"))
    estimator = build()
    few = M.collapse(rows, estimator)
    assert few.count() <= 70 and few.agg(F.sum("_weight")).first()[0] == 3000
    got, want = M.fit_collapsed(estimator, rows, few), estimator.fit(rows)
    assert len(E.tree_paths(want if hasattr(want, "depth") else want.trees[0])) < 35  # the least number of rows in a node binds
    both = got.transform(rows).select("a", "b", F.col("prediction").alias("p")).distinct().join(want.transform(rows).select("a", "b", "prediction").distinct(), ["a", "b"])
    assert both.count() == 35 and all(r.p == pytest.approx(r.prediction) for r in both.collect())


def test_what_is_not_collapsed(spark):
    assert not M.collapsible(M.boosted_regressor("y")) and not M.collapsible(M.random_forest("y")) and not M.collapsible(M.boosted_classifier("y", "is_val"))
    rows = X.assemble(["a"]).transform(spark.createDataFrame([(1.0, 1.0), (1.0, None), (2.0, 3.0)], "a double, y double"))
    with pytest.raises(Exception):  # a missing label is still refused
        M.fit_collapsed(GBTRegressor(labelCol="y", maxIter=1), rows)


def test_trials_read_the_rows_a_few_times_whatever_their_number(spark):
    rows = X.assemble(["x"]).transform(spark.range(4000).selectExpr("id", "id % 3 AS x", "double(hash(id) % 4 > id % 3) AS label", "CASE id % 4 WHEN 0 THEN 'val' ELSE 'train' END AS part"))
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    counted = X.assemble(["x"]).transform(rows.drop("features").mapInArrow(seen, rows.drop("features").schema))
    models = [("boosted", "", M.gbt_classifier("label", rounds=3, depth=2, stepSize=0.1 * i, seed=1)) for i in range(1, 4)]
    got = P.run_trials(counted, "label", models, parallelism=2)
    assert read.value <= 2 * 4000
    for (figures, _), (_, _, estimator) in zip(got, models):
        model = estimator.fit(rows.filter("part = 'train'"))
        want = P.measure(P._scored(model, rows.filter("part = 'val'"), True), "label", True).first().asDict()
        assert figures == {k: v if isinstance(v, (str, int)) else pytest.approx(v) for k, v in want.items()}
