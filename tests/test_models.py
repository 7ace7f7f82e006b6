import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from cuadra.operators import evaluate as E
from cuadra.operators import features as X
from cuadra.operators import models as M
from cuadra.operators import registry as R


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    n = 600
    color = rng.choice(["red", "green", "blue"], n, p=[0.5, 0.3, 0.2])
    size = rng.normal(0, 1, n)
    label = ((size > 0) ^ (color == "red")).astype(float)
    price = 3 * size + (color == "red") * 2 + rng.normal(0, 0.1, n)
    pdf = pd.DataFrame({"id": range(n), "color": color, "size": size, "label": label, "price": price})
    return spark.createDataFrame(pdf).cache()


def encoded(rows):
    return X.fit_stages(X.column_features(["size"], ["color"]), rows).transform(rows)


def slots(df, col):
    return [r[0] for r in df.select(vector_to_array(col)).collect()]


def test_index_and_one_hot(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("a",), ("c",)], "s string")
    out = X.fit_stages([X.index_labels(["s"]), X.one_hot(["s"])], df).transform(df)
    assert [r.s_index for r in out.collect()] == [1, 1, 0, 0, 2]
    assert slots(out, "s_vec") == [[0, 1], [0, 1], [1, 0], [1, 0], [0, 0]]


def test_unseen_values(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "s string")
    test = spark.createDataFrame([("a",), ("z",)], "s string")
    assert X.fit_stages([X.index_labels(["s"], unseen="skip")], train).transform(test).count() == 1
    with pytest.raises(Exception, match="Unseen label"):
        X.fit_stages([X.index_labels(["s"])], train).transform(test).collect()
    assert slots(X.fit_stages(X.one_hot_indicator(["s"]), train).transform(test), "s_vec") == [[1, 0, 0], [0, 0, 1]]


def test_assemble_refuses_nulls(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception, match="(?i)null"):
        X.assemble(["a", "b"]).transform(df).collect()


def test_standardize(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, c double")
    out = X.standardize_columns(df, ["x", "c"], ddof=0).collect()
    assert [r.x for r in out] == pytest.approx([-1.2247449, 0, 1.2247449]) and [r.c for r in out] == [0, 0, 0]
    assert [r.x for r in X.standardize_columns(df, ["x"], ddof=1).collect()] == pytest.approx([-1, 0, 1])


def test_column_features_impute_and_coerce(spark):
    df = spark.createDataFrame([("1", "a"), ("bad", "b"), ("3", "a")], "n string, s string")
    out = X.fit_stages(X.column_features(["n"], ["s"]), df).transform(df)
    assert slots(out, "features") == [[1, 1], [0, 2], [1, 3]]
    assert X.slot_names(out) == ["s_vec_a", "n_num"]


def test_auc_hard_by_hand(spark):
    df = spark.createDataFrame(list(zip([0.0, 0.0, 0.0, 1.0, 1.0, 1.0, 1.0], [0.0, 0.0, 1.0, 1.0, 0.0, 1.0, 1.0])), "label double, prediction double")
    assert M.auc_hard(df, "label") == pytest.approx(0.708333, abs=1e-6)
    assert E.auc_hard_table(df, "label", "prediction").first().auc == pytest.approx(0.708333, abs=1e-6)


def test_auc_prob_and_roc_with_ties(spark):
    rng = np.random.default_rng(1)
    y, s = rng.integers(0, 2, 400), np.round(rng.random(400), 1)
    df = spark.createDataFrame(pd.DataFrame({"y": y.astype(float), "s": s})).repartition(5)
    pos, neg = s[y == 1], s[y == 0]
    want = (np.sum(pos[:, None] > neg) + 0.5 * np.sum(pos[:, None] == neg)) / (len(pos) * len(neg))
    assert E.auc_prob(df, "y", "s").first().auc == pytest.approx(want)
    assert BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y").evaluate(df) == pytest.approx(want)
    curve = E.roc_curve(df, "y", "s").orderBy("fpr", "tpr").collect()
    assert (curve[0].fpr, curve[0].tpr, curve[-1].fpr, curve[-1].tpr) == (0, 0, 1, 1)
    x, t = np.array([r.fpr for r in curve]), np.array([r.tpr for r in curve])
    assert np.sum(np.diff(x) * (t[1:] + t[:-1]) / 2) == pytest.approx(want)


def test_auc_of_one_class_is_null(spark):
    assert E.auc_prob(spark.createDataFrame([(1.0, 0.2)], "y double, s double"), "y", "s").first().auc is None


def test_regression_metrics(spark):
    rng = np.random.default_rng(2)
    y = rng.normal(10, 3, 100)
    p = y + rng.normal(0, 1, 100)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "prediction": p}))
    row = E.regression_metrics(df, "y", prefix="val_").first()
    for name in ("r2", "rmse", "mse", "mae"):
        assert row[f"val_{name}"] == pytest.approx(RegressionEvaluator(labelCol="y", metricName=name).evaluate(df))


@pytest.mark.parametrize("build", [
    lambda: M.gbt_classifier("label", rounds=5, depth=3),
    lambda: M.decision_tree("label"),
    lambda: M.random_forest("label"),
])
def test_trees_learn_the_rule(rows, build):
    df = encoded(rows)
    assert M.auc_hard(build().fit(df).transform(df), "label") > 0.95


def test_logistic_regression_beats_chance(rows):
    df = encoded(rows.withColumn("label", F.when(F.col("size") > 0.2, 1.0).otherwise(0.0)))
    scored = M.positive_probability(M.logistic_regression("label").fit(df).transform(df))
    assert E.auc_prob(scored, "label", "score").first().auc > 0.95


def test_boosting_stops_early(rows):
    # Every fifth label is wrong, so more rounds stop paying.
    df = encoded(rows).withColumn("is_val", F.col("id") % 4 == 0)
    df = df.withColumn("label", F.when(F.hash("id") % 5 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    model = M.boosted_classifier("label", "is_val", rounds=60, maxDepth=4).fit(df)
    assert model.getNumTrees < 60 and M.auc_hard(model.transform(df), "label") > 0.7
    reg = M.boosted_regressor("price", "is_val", rounds=30, step=0.3, rows_share=0.8).fit(df)
    assert E.regression_metrics(reg.transform(df), "price").first().r2 > 0.8


def test_rules_equal_the_model(rows):
    df = encoded(rows)
    tree = M.decision_tree("label", depth=4).fit(df)
    rules = E.tree_rules(tree, df)
    assert rules.count() == (tree.numNodes + 1) // 2
    assert rules.filter(F.col("conditions").contains("color_vec")).count() > 0
    scored = tree.transform(df).withColumn("mine", E.score_by_rules(tree))
    assert scored.filter("mine <> prediction OR mine IS NULL").count() == 0


def test_rules_with_category_sets(rows):
    df = X.fit_stages([X.index_labels(["color"]), X.assemble(["color_index", "size"])], rows).transform(rows)
    tree = M.decision_tree("label", depth=4).fit(df)
    assert "in {" in tree.toDebugString
    assert tree.transform(df).filter(E.score_by_rules(tree) != F.col("prediction")).count() == 0


def test_rules_of_a_stump(rows):
    df = encoded(rows.withColumn("label", F.lit(1.0)))
    tree = M.decision_tree("label").fit(df)
    assert [tuple(r) for r in E.tree_rules(tree, df).collect()] == [(0, 0, "", 1.0)]


def test_importance_is_named_and_adds_up(rows):
    df = encoded(rows)
    table = E.feature_importance(M.decision_tree("label").fit(df), df).collect()
    assert {r.feature for r in table} == set(X.slot_names(df))
    assert sum(r.importance for r in table) == pytest.approx(1)
    assert [r.importance for r in table] == sorted((r.importance for r in table), reverse=True)


def test_repeated_holdout(rows):
    stages = [*X.column_features(["size"], ["color"]), M.decision_tree("label", depth=4)]
    table, best, scored = M.repeated_holdout(rows, stages, "label", "id")
    values = [r.auc for r in table.orderBy("split").collect()]
    assert len(values) == 3 and table.first().mean_auc == pytest.approx(np.mean(values))
    assert M.auc_hard(scored, "label") == pytest.approx(max(values)) and max(values) > 0.9
    assert best.transform(rows).count() == 600


def test_compare_models(rows):
    table = M.compare_models(
        rows, X.column_features(["size"], ["color"]), {"tree": M.decision_tree("label", depth=4), "line": M.logistic_regression("label")}, "label", "id", 2
    )
    got = {r.model: r.mean_auc for r in table.collect()}
    assert got["tree"] > got["line"]


def test_random_search(rows):
    space = {"maxDepth": lambda rng: rng.randint(1, 5), "minInfoGain": lambda rng: M.log_uniform(rng, -9, -3)}
    evaluator = BinaryClassificationEvaluator(labelCol="label")
    table, best = M.random_search(encoded(rows), M.decision_tree("label"), space, evaluator, trials=4, parallelism=4)
    assert table.count() == 4 and best.depth >= 1
    assert table.filter("metric IS NULL").count() == 0
    assert 0.04 < M.log_uniform(random.Random(1), -3, 0) < 1


def test_auto_model(rows):
    table, model = M.auto_model(rows.drop("price"), "label", "id")
    assert [r.val_metric for r in table.collect()] == sorted((r.val_metric for r in table.collect()), reverse=True)
    assert table.first().test_metric > 0.9
    assert model.transform(rows).count() == 600
    table, _ = M.auto_model(rows.drop("label"), "price", "id", problem="regression")
    assert table.first().test_metric > 0.9


def test_features_do_not_depend_on_the_size(spark):
    for n in (5, 500):
        df = spark.range(n).selectExpr("id", "concat('n', id) AS name", "concat('g', id % 3) AS grp", "id * 1.0D AS x", "id % 2 AS y")
        assert M.choose_features(df, "y", ["id"]) == (["x"], ["name", "grp"])
        assert M.choose_features(df, "y", ["id", "name"]) == (["x"], ["grp"])


def test_hashed_features(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), (None, 3.0)], "s string, n double")
    out = slots(X.fit_stages(X.hashed_features(["n"], ["s"], slots=64), df).transform(df), "features")
    assert [len(v) for v in out] == [65] * 3 and [v[-1] for v in out] == [1, 2, 3]
    assert [sum(v[:-1]) for v in out] == [1, 1, 0] and list(out[0][:-1]) != list(out[1][:-1])


def test_best_round_waits():
    assert M.best_round([5, 4, 4.5, 3, 3.5, 3.6, 1], 2) == (4, True)
    assert M.best_round([5, 4, 4.5, 3, 3.5, 3.6, 1], 3) == (7, False)
    assert M.best_round([2.0], 1) == (1, False)


def test_patience_keeps_the_best_round(rows):
    df = encoded(rows).withColumn("label", F.when(F.hash("id") % 5 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    train, val = df.filter("id % 4 <> 0"), df.filter("id % 4 = 0")
    model = M.fit_with_patience(M.boosted_classifier("label", rounds=40, maxDepth=3, seed=1), train, val, patience=3, first=4)
    longer = M.boosted_classifier("label", rounds=model.getNumTrees + 4, maxDepth=3, seed=1).fit(train)
    losses, all_losses = (list(m.evaluateEachIteration(val)) for m in (model, longer))
    assert all_losses[:len(losses)] == pytest.approx(losses) and min(all_losses) == pytest.approx(losses[-1])


@pytest.mark.parametrize("build", [lambda **p: M.gbt_classifier("label", depth=2, seed=1, **p), lambda **p: M.boosted_regressor("price", seed=1, min_rows=1, **p)])
def test_first_rounds_are_the_shorter_fit(spark, rows, build):
    df = encoded(rows)
    short, want = M.first_rounds(build(rounds=6).fit(df), 2, spark), build(rounds=2).fit(df)
    assert short.getNumTrees == short.getMaxIter() == 2 and short.numFeatures == want.numFeatures
    assert short.transform(df).select("id", "prediction").exceptAll(want.transform(df).select("id", "prediction")).isEmpty()
    assert [E.tree_paths(t) for t in short.trees] == [E.tree_paths(t) for t in want.trees]


def test_patience_fits_once_when_the_rule_fires_at_once(rows, monkeypatch):
    df = encoded(rows).withColumn("label", F.when(F.hash("id") % 3 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    fits, real = [], GBTClassifier._fit
    monkeypatch.setattr(GBTClassifier, "_fit", lambda self, data: fits.append(self.getMaxIter()) or real(self, data))
    model = M.fit_with_patience(M.boosted_classifier("label", rounds=30, maxDepth=5, seed=1), df.filter("id % 4 <> 0"), df.filter("id % 4 = 0"), patience=2, first=30)
    assert fits == [30] and model.getNumTrees < 30


def test_a_small_collapsed_table_is_one_task(rows):
    df = encoded(rows).repartition(4)
    few = M.collapse(df, M.decision_tree("label"))
    assert few.rdd.getNumPartitions() == 1 and few.agg(F.sum("_weight")).first()[0] == 600
    assert few.schema["features"].metadata == df.schema["features"].metadata


@pytest.mark.parametrize("build", [lambda: M.decision_tree("label", depth=4), lambda: M.gbt_classifier("label", rounds=3, depth=3, seed=1)])
def test_a_model_behind_its_features_reads_the_encoded_rows_once(spark, rows, build):
    read, n = spark.sparkContext.accumulator(0), 24_000  # more than Spark looks at for its thresholds
    wide = spark.range(n).selectExpr("id", "CASE hash(id) % 3 WHEN 0 THEN 'red' ELSE 'blue' END AS color", "hash(id, 7) / 1000 AS size", "double(hash(id, 8) % 3 > 0) AS label").repartition(3, "id")

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    stages = [*X.column_features(["size"], ["color"]), build()]
    got = M.fit_stages_encoded(stages, wide.mapInArrow(seen, wide.schema))
    assert read.value <= 3 * n  # the codes, the mean, the encoded rows
    want = X.fit_stages(stages, wide)
    assert got.stages[-1].toDebugString.split("\n", 1)[1] == want.stages[-1].toDebugString.split("\n", 1)[1]
    plain = [*X.column_features(["size"], ["color"]), M.logistic_regression("label")]
    assert M.fit_stages_encoded(plain, wide).stages[-1].coefficients == X.fit_stages(plain, wide).stages[-1].coefficients


def test_kmeans_and_profile(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"x": np.r_[rng.normal(0, 0.1, 50), rng.normal(9, 0.1, 30)]})
    df = X.assemble(["x"]).transform(spark.createDataFrame(pdf))
    scored = M.kmeans(2).fit(df).transform(df)
    assert sorted(r.n_rows for r in M.cluster_profile(scored, ["x"]).collect()) == [30, 50]
    assert 0.9 < M.silhouette(scored) <= 1


def test_save_load_and_score(rows):
    model = X.fit_stages([X.assemble(["size"]), LinearRegression(labelCol="price")], rows)
    again = M.save_and_load(model)
    one = M.batch_score(model, rows, ["id"])
    two = M.batch_score(again, rows, ["id"], out="reloaded")
    assert one.join(two, "id").filter("prediction <> reloaded").count() == 0
    assert M.score_by_signature(model, ["size"], rows, ["id"]).columns == ["id", "prediction"]
    with pytest.raises(ValueError):
        M.score_by_signature(model, ["size", "weight"], rows)


def test_model_udf(rows):
    double = M.model_udf(lambda frame: frame["size"] * 2)
    assert rows.filter(F.abs(double("size", "id") - F.col("size") * 2) > 1e-12).count() == 0


def test_lag_forecast_beats_the_mean(spark):
    t = np.arange(300)
    x = 10 + np.sin(2 * np.pi * t / 7) + np.random.default_rng(5).normal(0, 0.05, 300)
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "pos": t, "x": x, "part": np.where(t < 200, "train", "test")}))
    out = M.lag_forecast(df, "x", 7, ["k"], "pos")
    assert out.count() == 293
    test = out.filter("part = 'test'")
    assert E.regression_metrics(test, "y").first().r2 > 0.9


def test_trial_log(spark, tmp_path):
    path = str(tmp_path / "trials")
    R.trial_log(spark, path, "forest", {"trees": 10}, {"auc": 0.8}, run_id="one")
    R.trial_log(spark, path, "forest", {"trees": 20}, {"auc": 0.9}, run_id="two")
    R.trial_log(spark, path, "other", {}, {"auc": 0.99}, run_id="three")
    found = R.search_trials(spark, path, name="forest", metric="auc").collect()
    assert [r.run_id for r in found] == ["two", "one"] and found[0].params == {"trees": "20"}


def test_model_versions(spark, tmp_path):
    path = str(tmp_path / "stages")
    for version, run, stage, seq in [(1, "a", "None", 1), (1, "a", "Production", 2), (2, "b", "None", 3), (2, "b", "Production", 4)]:
        R.stage_event(spark, path, "wine", version, run, stage, seq)
    events = spark.read.parquet(path)
    assert {(r.version, r.stage) for r in R.model_versions(events).collect()} == {(1, "Archived"), (2, "Production")}
    assert [r.run_id for r in R.in_production(events).collect()] == ["b"]


def test_an_archived_version_stays_archived(spark):
    rows = [("m", 1, "a", "Production", 2), ("m", 2, "b", "Production", 3), ("m", 2, "b", "Archived", 4), ("n", 1, "c", "Staging", 1)]
    events = spark.createDataFrame(rows, R.STAGE_SCHEMA)
    got = {(r.model, r.version): r.stage for r in R.model_versions(events).collect()}
    assert got == {("m", 1): "Archived", ("m", 2): "Archived", ("n", 1): "Staging"}
    assert R.in_production(events).count() == 0


def _two_columns(spark, n=4000):
    rows = spark.range(n).selectExpr("id", "cast(id % 7 as double) a", "cast(id % 45 as double) b", "cast((id * 7919) % 101 + 10 * (id % 7) + (id % 45) as double) price")
    return X.assemble(["a", "b"]).transform(rows)


def test_rounds_drawn_at_once_give_the_model_of_all_rows(spark, monkeypatch):
    """Where the draws take every row, the cells must give the trees that Spark fits on the rows, over the edge of a block of rounds too."""
    monkeypatch.setattr(M, "DRAWN_ROWS", 100)
    monkeypatch.setattr(M, "DRAWN_ROUNDS", 3)
    df = _two_columns(spark)
    train, val = df.filter("id % 5 > 0"), df.filter("id % 5 = 0")
    build = lambda share: M.boosted_regressor("price", rounds=7, depth=3, step=0.2, rows_share=share, min_rows=40, features_share="all", maxBins=64, seed=1)
    drawn = M.fit_with_patience(build(1 - 1e-12), train, val, 7)
    plain = build(1.0).fit(train)
    assert drawn.getNumTrees == 7 and list(drawn.treeWeights) == list(plain.treeWeights)
    both = drawn.setPredictionCol("p").transform(plain.setPredictionCol("q").transform(df))
    assert both.filter("abs(p - q) > 1e-6").count() == 0


def test_rounds_drawn_at_once_take_their_share(spark, monkeypatch):
    df = _two_columns(spark)
    bins = [np.arange(7.0), np.arange(45.0)]
    counts = M.binned_counts(df, M.boosted_regressor("price"), bins)
    assert counts.selectExpr("sum(n)").first()[0] == 4000
    cells = M.drawn_rounds(counts.coalesce(1).sortWithinPartitions("c0", "y"), ["c0"], 0.25, 2, seed=1)
    n0, n1, other = cells.selectExpr("sum(n0)", "sum(n1)", "sum(abs(n0 - n1))").first()
    assert 850 < n0 < 1150 and 850 < n1 < 1150 and other > 0
    again = M.drawn_rounds(counts.coalesce(1).sortWithinPartitions("c0", "y"), ["c0"], 0.25, 2, seed=1)
    assert sorted(again.collect()) == sorted(cells.collect())
    monkeypatch.setattr(M, "DRAWN_ROWS", 100)
    fitted = M.fit_with_patience(M.boosted_regressor("price", rounds=40, rows_share=0.5, step=0.3, seed=1), df.filter("id % 5 > 0"), df.filter("id % 5 = 0"), 5)
    error = fitted.transform(df).selectExpr("avg(pow(price - prediction, 2))", "var_pop(price)").first()
    assert error[0] < 0.8 * error[1]


def test_rounds_drawn_at_once_refuse_a_missing_label(spark, monkeypatch):
    monkeypatch.setattr(M, "DRAWN_ROWS", 100)
    df = _two_columns(spark).withColumn("price", F.expr("if(id = 77, null, price)"))
    with pytest.raises(Exception, match="missing"):
        M.fit_with_patience(M.boosted_regressor("price", rounds=3, seed=1), df, df, 5)


def test_bins_of_many_features_and_values():
    assert M.middles(np.array([3.0, 1.0, 1.0, 2.0]), 4).tolist() == [1.0, 2.0, 3.0]
    assert len(M.middles(np.arange(1000.0), 32)) == 32
    assert [at for at, _ in M._places([np.arange(32.0)] * 13)] == [0] * 12 + [1]
