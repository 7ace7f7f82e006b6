import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import functions as F

from cuadra.operators import boosting as B
from cuadra.operators import evaluate as E
from cuadra.operators import features as X
from cuadra.operators import models as M

N = 24_000  # more than Spark looks at for its thresholds


@pytest.fixture(scope="module")
def wide(spark):
    """Numbers with many and with few values, categories in one slot and in several, and a constant."""
    df = spark.range(0, N, 1, 3).selectExpr(
        "id", "CASE pmod(hash(id), 5) WHEN 0 THEN 'a' WHEN 1 THEN 'b' WHEN 2 THEN 'c' WHEN 3 THEN 'd' ELSE 'e' END AS color", "concat('k', pmod(hash(id, 11), 7)) AS kind",
        "hash(id, 7) / 1e6 AS size", "pmod(hash(id, 9), 9) + 0.0D AS few", "hash(id, 13) / 1e7 AS z", "1.0D AS same")
    push = F.col("size") * F.sin("z") + F.col("few") * 100 + F.when(F.col("color") == "a", 500).when(F.col("kind") > "k4", -300).otherwise(0)
    return df.withColumn("label", (push + F.hash("id", F.lit(5)) / 2e6 > 0).cast("double"))


def encoded(df):
    return X.fit_stages([X.index_labels(["color", "kind"]), X.one_hot(["color"]), X.assemble(["kind_index", "color_vec", "size", "few", "z", "same"])], df).transform(df)


@pytest.mark.parametrize("params", [{"minInstancesPerNode": 40, "stepSize": 0.3}, {"depth": 3, "bins": 40, "minInfoGain": 0.01, "checkpointInterval": 2}, {"depth": 3, "minWeightFractionPerNode": 0.02}])
def test_blocks_give_the_model_of_spark(wide, params):
    rows = encoded(wide).persist()
    estimator = M.gbt_classifier("label", seed=3, **{"rounds": 3, "depth": 5} | params)
    got, want = B.fit_blocks(estimator, rows, N), estimator.fit(rows)
    assert isinstance(got, GBTClassificationModel) and (got.numFeatures, got.numClasses, got.getMaxIter()) == (want.numFeatures, 2, 3)
    assert got.treeWeights == want.treeWeights and [t.numNodes for t in got.trees] == [t.numNodes for t in want.trees]
    assert got.trees[0].toDebugString.split("\n", 1)[1] == want.trees[0].toDebugString.split("\n", 1)[1]
    each = [M.positive_probability(m.transform(rows)).select("id", F.col("score").alias(n)) for n, m in (("a", got), ("b", want))]
    assert each[0].join(each[1], "id").agg(F.max(F.abs(F.col("a") - F.col("b"))), F.count("a")).first() == (pytest.approx(0, abs=1e-9), N)
    # Impurity and gain of the nodes on the way down to the left, and the leaf.
    one, other = (m.trees[-1]._java_obj.rootNode() for m in (got, want))
    while True:
        assert one.impurity() == pytest.approx(other.impurity(), abs=1e-9) and one.prediction() == pytest.approx(other.prediction(), abs=1e-9)
        if "LeafNode" in one.getClass().getName():
            break
        assert one.gain() == pytest.approx(other.gain(), abs=1e-9)
        one, other = one.leftChild(), other.leftChild()
    rows.unpersist()


def test_many_rows_are_boosted_in_blocks(spark, wide, monkeypatch):
    """Spark's own fit, with an object for each row, is not asked for; few rows are fitted by it as before."""
    fits, real = [], GBTClassifier._fit
    monkeypatch.setattr(GBTClassifier, "_fit", lambda self, data: fits.append(1) or real(self, data))
    monkeypatch.setattr(M, "OBJECT_ROWS", 10_000)
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    stages = [*X.column_features(["size", "few", "z"], ["color", "kind"]), M.gbt_classifier("label", rounds=2, depth=4, seed=1)]
    got = M.fit_stages_encoded(stages, wide.mapInArrow(seen, wide.schema), N)
    assert not fits and read.value < 5 * N  # the codes, the means, the sample, the blocks and a few rows
    want = M.fit_stages_encoded(stages, wide.filter("id < 9000"), 9_000)
    assert fits == [1] and len(want.stages) == len(got.stages)
    want = X.fit_stages(stages, wide)
    figures = [E.auc_prob(M.positive_probability(m.transform(wide)), "label", "score").first().auc for m in (got, want)]
    assert figures[0] == pytest.approx(figures[1], abs=1e-9) and figures[0] > 0.6


def test_blocks_refuse_what_spark_refuses(spark, wide):
    rows = encoded(wide)
    estimator = M.gbt_classifier("label", rounds=1, depth=2, seed=1)
    last = F.col("id") == N - 1
    for label in (F.when(last, 2.0).otherwise(F.col("label")), F.when(~last, F.col("label"))):
        with pytest.raises(SparkRuntimeException):
            B.fit_blocks(estimator, rows.withColumn("label", label), N)


def test_features_without_a_split(spark):
    rows = X.assemble(["x"]).transform(spark.range(600).selectExpr("id", "1.0D AS x", "double(id % 3 = 0) AS label"))
    model = B.fit_blocks(M.gbt_classifier("label", rounds=2, depth=2, seed=1), rows, 600)
    want = M.gbt_classifier("label", rounds=2, depth=2, seed=1).fit(rows)
    assert [t.numNodes for t in model.trees] == [1, 1]
    assert [t._java_obj.rootNode().prediction() for t in model.trees] == pytest.approx([t._java_obj.rootNode().prediction() for t in want.trees])
