"""Models on feature vectors: fitting, comparing, searching and scoring."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator, RegressionEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import TrainValidationSplit
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuadra.functions.regression import least_squares
from cuadra.functions.scalars import vector_element
from cuadra.operators.blocks import BLOCK, with_edges
from cuadra.operators.boosting import blockable, fit_blocks
from cuadra.operators.features import fit_stages, hashed_features, index_labels
from cuadra.operators.order import hash_split
from cuadra.operators.timeseries import reject_nulls
from cuadra.operators.windows import lag_windows
from cuadra.session import scratch_path, written_once


def logistic_regression(label: str, features: str = "features", **params) -> LogisticRegression:
    return LogisticRegression(featuresCol=features, labelCol=label, **params)


def gbt_classifier(label: str, features: str = "features", rounds: int = 25, depth: int = 6, bins: int = 16, **params):
    return GBTClassifier(featuresCol=features, labelCol=label, maxIter=rounds, maxDepth=depth, maxBins=bins, **params)


def decision_tree(label: str, features: str = "features", depth: int = 10, bins: int = 32, **params):
    return DecisionTreeClassifier(featuresCol=features, labelCol=label, maxDepth=depth, maxBins=bins, **params)


def random_forest(label: str, features: str = "features", trees: int = 10, seed: int = 123, **params):
    return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=trees, seed=seed, **params)


def boosted_classifier(
    label: str, validation: str | None = None, features: str = "features", rounds: int = 1000, gain: float = 0.01, **params
):
    """Boosting that stops when the rows marked by ``validation`` no longer gain.

    Spark stops at the first round that gains less than ``gain``. Without ``validation`` it makes all
    rounds; ``fit_with_patience`` waits for a number of rounds before it gives up.
    """
    if validation:
        params |= {"validationIndicatorCol": validation, "validationTol": gain}
    return GBTClassifier(featuresCol=features, labelCol=label, maxIter=rounds, **params)


def boosted_regressor(
    label: str,
    validation: str | None = None,
    features: str = "features",
    rounds: int = 2474,
    depth: int = 4,
    step: float = 0.049,
    rows_share: float = 0.228,
    min_rows: int = 19,
    features_share: float = 0.79,
    seed: int = 0,
    **params,
):
    """Boosted trees on a number, with row and feature sampling and the stop rule above.

    Spark draws the share of features per node.
    """
    if validation:
        params["validationIndicatorCol"] = validation
    return GBTRegressor(
        featuresCol=features,
        labelCol=label,
        maxIter=rounds,
        maxDepth=depth,
        stepSize=step,
        subsamplingRate=rows_share,
        minInstancesPerNode=min_rows,
        featureSubsetStrategy=str(features_share),
        seed=seed,
        **params,
    )


OBJECT_ROWS = 1_000_000  # up to so many rows Spark boosts itself, with an object for each
WEIGHT = "_weight"
TASK_ROWS = 25_000  # of a collapsed table that one task goes through


def _averages(estimator: Estimator) -> bool:
    """Whether a tree sees only the mean label of equal rows: squared error splits into a part between and one inside them."""
    return isinstance(estimator, DecisionTreeRegressor) or (isinstance(estimator, GBTRegressor) and estimator.getLossType() == "squared")


def collapsible(estimator: Estimator) -> bool:
    """Whether a model is the same when equal rows come once with their number as weight.

    So it is for trees and boosting; not if they draw rows, mark some for validation or have weights already.
    """
    if not isinstance(estimator, (GBTClassifier, GBTRegressor, DecisionTreeClassifier, DecisionTreeRegressor)) or estimator.isSet("weightCol"):
        return False
    drawn = isinstance(estimator, (GBTClassifier, GBTRegressor)) and estimator.getSubsamplingRate() < 1.0
    return not drawn and not (estimator.hasParam("validationIndicatorCol") and estimator.isSet("validationIndicatorCol"))


def collapse(rows: DataFrame, estimator: Estimator) -> DataFrame:
    """Equal rows of features and label as one with their number as ``_weight``, written; for squared error the mean label of equal features.

    The table has as many rows as there are different ones, however often each comes. The columns are
    the estimator's; a label that is missing stays so, and the estimator refuses it as before.
    """
    label, features = estimator.getLabelCol(), estimator.getFeaturesCol()
    named = rows.select(F.col(features), F.col(label).cast("double").alias(label, metadata=rows.schema[label].metadata))
    count = F.count(F.lit(1)).cast("double").alias(WEIGHT)
    if _averages(estimator):
        mean = F.when(F.count(label) == F.count(F.lit(1)), F.avg(label)).alias(label)
        few = written_once(named.groupBy(features).agg(mean, count))
    else:
        few = written_once(named.groupBy(features, label).agg(count))
    # Every level of every tree is a job: tasks of a few rows would only add to their number.
    return few.coalesce(max(1, -(-few.count() // TASK_ROWS)))


def same_collapse(one: Estimator, other: Estimator) -> bool:
    """Whether both estimators take the same collapsed table."""
    return (one.getFeaturesCol(), one.getLabelCol(), _averages(one)) == (other.getFeaturesCol(), other.getLabelCol(), _averages(other))


def weighted(estimator: Estimator, few: DataFrame) -> Estimator | None:
    """The estimator for collapsed rows; its least number of rows in a node becomes a weight. None if that is half of all rows or more."""
    least = estimator.getMinInstancesPerNode()
    params = {estimator.weightCol: WEIGHT}
    if least > 1:
        share = (least - 0.5) / (few.agg(F.sum(WEIGHT)).first()[0] or 1.0)
        if share >= 0.5:
            return None
        params |= {estimator.minInstancesPerNode: 1, estimator.minWeightFractionPerNode: max(share, estimator.getMinWeightFractionPerNode())}
    return estimator.copy(params)


def fit_collapsed(estimator: Estimator, rows: DataFrame, few: DataFrame | None = None) -> Transformer:
    """Fit on the different rows with their numbers where that gives the same model, so a pass over the data is one over those.

    ``few`` is the collapsed table, if the caller has it. Spark takes its thresholds from a sample of 10,000 rows when there are
    more, and now from the different ones: of columns with more values than bins it may choose others, of other columns not.
    """
    if not collapsible(estimator):
        return estimator.fit(rows)
    few = collapse(rows, estimator) if few is None else few
    light = weighted(estimator, few)
    return estimator.fit(rows) if light is None else unweighted(light.fit(few))


def fit_stages_encoded(stages: Sequence[Transformer | Estimator], train: DataFrame, rows: int | None = None) -> PipelineModel:
    """``fit_stages``, where a tree or boosting at the end reads encoded rows that are kept for it.

    It goes through its input several times before it has binned rows of its own. The rows stay in their partitions
    and their order, so it draws the same sample for its thresholds and the model is the same.

    ``rows`` is their number, if the caller knows it. More than ``OBJECT_ROWS`` are boosted in blocks (``fit_blocks``), with the
    same thresholds; the encoded rows, which are much larger than the blocks, are then computed for each of two passes and not kept.
    """
    *before, last = stages
    if not collapsible(last):
        return fit_stages(stages, train)
    encoder = fit_stages(before, train)
    encoded = encoder.transform(train).select(last.getFeaturesCol(), last.getLabelCol())
    if blockable(last) and (rows or 0) > OBJECT_ROWS:
        return PipelineModel(stages=[*encoder.stages, fit_blocks(last, encoded, rows)])
    encoded = encoded.persist()
    model = last.fit(encoded)
    encoded.unpersist()
    return PipelineModel(stages=[*encoder.stages, model])


def unweighted(model: Transformer) -> Transformer:
    """The fitted model without the name of the weights, which other rows do not have."""
    model.clear(model.weightCol)
    return model


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """The round with the smallest loss before ``patience`` rounds in a row were no better, and whether there were so many."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_with_patience(
    estimator: GBTClassifier | GBTRegressor, train: DataFrame, validation: DataFrame, patience: int = 50, first: int = 50,
    few: tuple[DataFrame, DataFrame] | None = None,
) -> Transformer:
    """Boosting with the number of rounds that is best on ``validation``, at most the estimator's own.

    Rounds do not depend on later ones, so the number is doubled from ``first`` until the rule has
    fired, and the model of the best round is the beginning of the last one. Equal rows are collapsed as in ``fit_collapsed``;
    ``few`` holds both collapsed tables, if the caller has them. Where each round draws its rows, more than ``DRAWN_ROWS`` of them
    are drawn for many rounds at once (``fit_drawn``).
    """
    if drawable(estimator) and (rows := train.count()) > DRAWN_ROWS:
        return fit_drawn(estimator, train, validation, patience, rows)
    if collapsible(estimator):
        few = few or (collapse(train, estimator), collapse(validation, estimator))
        light = weighted(estimator, few[0])
        if light is not None:
            return unweighted(_fit_with_patience(light, *few, patience, first))
    return _fit_with_patience(estimator, train, validation, patience, first)


def first_rounds(model: Transformer, rounds: int, spark: SparkSession) -> Transformer:
    """The boosted model after its first ``rounds`` rounds, which is the one that a fit with so many rounds gives."""
    java, jvm = model._java_obj, spark._jvm
    kind, classes = (jvm.org.apache.spark.ml.classification.GBTClassificationModel, (2,)) if isinstance(model, GBTClassificationModel) else (
        jvm.org.apache.spark.ml.regression.GBTRegressionModel, ())
    trees = model._new_java_array(list(java.trees())[:rounds], jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel)
    weights = model._new_java_array(list(java.treeWeights())[:rounds], jvm.double)
    short = type(model)(kind(java.uid(), trees, weights, java.numFeatures(), *classes))
    return model._copyValues(short, {model.maxIter: rounds})


DRAWN_ROWS = 1_000_000  # up to so many rows Spark draws them itself, in every pass of every round
DRAWN_ROUNDS = 16  # whose rows are drawn in one pass
SPLIT_ROWS = 10_000  # Spark's own sample for its thresholds


def drawable(estimator: Estimator) -> bool:
    """Whether the rounds draw their rows, and a tree sees only sums of those of equal binned features."""
    return (
        isinstance(estimator, GBTRegressor) and _averages(estimator) and estimator.getSubsamplingRate() < 1.0
        and not estimator.isSet("weightCol") and not estimator.isSet("validationIndicatorCol")
    )


def middles(values: np.ndarray, bins: int) -> np.ndarray:
    """The values that stand for the bins of a column: all of them, or ``bins`` at equal shares of the rows.

    A value belongs to the nearest; the thresholds half way between are those that Spark finds in a column of these.
    """
    seen, n = np.unique(values, return_counts=True)
    if len(seen) <= bins:
        return seen
    return seen[np.unique(np.searchsorted(np.cumsum(n), (np.arange(bins) + 0.5) * len(values) / bins))]


def _places(bins: Sequence[np.ndarray]) -> list[tuple[int, int]]:
    """For each feature the number of the long that holds its bin, and the shift in it."""
    bits = max(1, max(len(m) - 1 for m in bins).bit_length())
    each = 63 // bits
    return [(i // each, i % each * bits) for i in range(len(bins))]


def binned_counts(rows: DataFrame, estimator: Estimator, bins: Sequence[np.ndarray]) -> DataFrame:
    """c0, ..., the bins of the features packed into longs, y, the label, and n, the number of such rows."""
    places = _places(bins)
    codes = [f"c{i}" for i in range(places[-1][0] + 1)]

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = b.column(1).to_numpy(zero_copy_only=False).astype(float)
            if not len(y):
                continue
            x = b.column(0).flatten().to_numpy()
            if b.column(0).null_count or not np.isfinite(y).all() or np.isnan(x).any():
                raise ValueError("a label or feature is missing")
            x = x.reshape(len(y), len(bins))
            packed = np.zeros((len(codes), len(y)), np.int64)
            for i, (m, (at, shift)) in enumerate(zip(bins, places)):
                packed[at] |= np.searchsorted((m[1:] + m[:-1]) / 2, x[:, i]) << shift
            # Equal rows of a batch are added up here, so a frequent one is no long run anywhere.
            order = np.lexsort((y, *packed))
            y, packed = y[order], packed[:, order]
            first = np.flatnonzero(np.append(True, (y[1:] != y[:-1]) | (packed[:, 1:] != packed[:, :-1]).any(axis=0)))
            n = np.diff(np.append(first, len(y)))
            yield pa.RecordBatch.from_arrays([*(pa.array(c[first]) for c in packed), pa.array(y[first]), pa.array(n)], [*codes, "y", "n"])

    plain = rows.select(vector_to_array(estimator.getFeaturesCol()).alias("x"), F.col(estimator.getLabelCol()).cast("double").alias("y"))
    return plain.mapInArrow(near, f"{', '.join(f'{c} long' for c in codes)}, y double, n long")


def unpacked(bins: Sequence[np.ndarray]) -> Column:
    """The features that stand for the packed bins, as a vector."""
    mask = (1 << max(1, max(len(m) - 1 for m in bins).bit_length())) - 1
    each = [F.array(*map(F.lit, m.tolist()))[F.shiftright(f"c{at}", shift).bitwiseAND(mask).cast("int")] for m, (at, shift) in zip(bins, _places(bins))]
    return array_to_vector(F.array(*each)).alias("features")


def drawn_rounds(counts: DataFrame, codes: Sequence[str], share: float, rounds: int, seed: int, start: int = 0) -> DataFrame:
    """The draws of some rounds from counted rows in their order: for each round the rows taken of a cell (n0, ...) and their mean label (y0, ...).

    Of n equal rows a binomial number is taken, as if each were drawn alone. Rows of one cell lie together, so a batch gives
    one row for each of its cells; a cell between two batches has two, which is the same to a tree.
    """
    names = [f"n{i}" for i in range(rounds)] + [f"y{i}" for i in range(rounds)]

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dice = np.random.default_rng([seed % (1 << 64), start, TaskContext.get().partitionId()])
        for b in batches:
            *packed, y, n = (c.to_numpy() for c in b.columns)
            if not len(y):
                continue
            begins = np.flatnonzero(np.append(True, np.any([c[1:] != c[:-1] for c in packed], axis=0)))
            taken = (dice.random((len(n), rounds)) < share).astype(float)
            many = np.flatnonzero(n > 1)
            taken[many] = dice.binomial(n[many, None], share, (len(many), rounds))
            sums, taken = np.add.reduceat(taken * y[:, None], begins), np.add.reduceat(taken, begins)
            means = np.divide(sums, taken, out=np.zeros_like(sums), where=taken > 0)
            columns = [*(c[begins] for c in packed), *taken.T, *means.T]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], [*codes, *names])

    return counts.select(*codes, "y", "n").mapInArrow(drawn, ", ".join([*(f"{c} long" for c in codes), *(f"{c} double" for c in names)]))


def boosted_of(estimator: GBTRegressor, trees: Sequence[Transformer], spark: SparkSession, whole: bool = True) -> GBTRegressionModel:
    """The boosted model of trees that were fitted one after another: the first counts whole, if it is the first of all, the others by the step."""
    jvm, kind, step = spark._jvm, spark._jvm.org.apache.spark.ml.regression, estimator.getStepSize()
    parts = GBTRegressionModel._new_java_array([t._java_obj for t in trees], kind.DecisionTreeRegressionModel)
    weights = GBTRegressionModel._new_java_array([1.0 if whole else step] + [step] * (len(trees) - 1), jvm.double)
    model = GBTRegressionModel(kind.GBTRegressionModel(estimator.uid, parts, weights, trees[0].numFeatures))
    return estimator._copyValues(model, {estimator.maxIter: len(trees)})


def fit_drawn(estimator: GBTRegressor, train: DataFrame, validation: DataFrame, patience: int, rows: int) -> GBTRegressionModel:
    """Boosting whose rounds draw from ``rows`` training rows, fitted on cells of equal binned features.

    A tree knows a row by its bins, so all rows of a cell have one prediction, and the number and mean label of those that a
    round draws are all that its tree needs. One pass counts the rows of each cell and label; a pass over the counts draws for
    ``DRAWN_ROUNDS`` rounds, and each round is a tree of Spark on weighted cells. Every row is drawn alone with the estimator's
    share, but with other dice than Spark's, and the thresholds come from a sample of their own.
    """
    spark, most, seed = train.sparkSession, estimator.getMaxIter(), estimator.getSeed()
    seen = train.sample(min(1.0, max(estimator.getMaxBins() ** 2, SPLIT_ROWS) / max(rows, 1)), seed)
    seen = np.array([r.x for r in seen.select(vector_to_array(estimator.getFeaturesCol()).alias("x")).collect()])
    bins = [middles(seen[:, i], estimator.getMaxBins()) for i in range(seen.shape[1])]
    codes = [f"c{i}" for i in range(_places(bins)[-1][0] + 1)]
    counts = written_once(binned_counts(train, estimator, bins)).repartitionByRange(*codes, "y").groupBy(*codes, "y").agg(F.sum("n").alias("n"))
    counts = written_once(counts.sortWithinPartitions(*codes, "y"))
    cells = binned_counts(validation, estimator, bins).groupBy(*codes).agg((F.sum(F.col("y") * F.col("n")) / F.sum("n")).alias("y"), F.sum("n").alias("n"))
    cells = written_once(cells.select(unpacked(bins), "y", "n"))

    def based(df: DataFrame) -> DataFrame:
        """The rows with what the trees so far give, kept in tasks of many rows."""
        model = boosted_of(estimator, trees, spark).setFeaturesCol("features").setPredictionCol("_base") if trees else None
        kept = written_once(model.transform(df) if model else df.withColumn("_base", F.lit(0.0)))
        return kept.coalesce(max(1, -(-kept.count() // TASK_ROWS)))

    trees, losses, fired = [], [], False
    while not fired and len(trees) < most:
        start, rounds = len(trees), min(DRAWN_ROUNDS, most - len(trees))
        drawn = drawn_rounds(counts, codes, estimator.getSubsamplingRate(), rounds, seed, start)
        drawn, held_out = based(drawn.withColumn("features", unpacked(bins)).drop(*codes)), based(cells).persist()
        totals = drawn.agg(F.count(F.lit(1)), *[F.sum(f"n{i}") for i in range(rounds)]).first()
        recent = lambda df: df.withColumn("_after", F.col("_base"))
        for i in range(rounds):
            # What is left is twice the difference: Spark goes by the gradient of the squared error.
            left = 2 * (F.col(f"y{i}") - F.col("_after")) if trees else F.col(f"y{i}")
            few = recent(drawn).select("features", left.alias("_left"), F.col(f"n{i}").alias(WEIGHT)).persist()
            least = max((estimator.getMinInstancesPerNode() - 0.5) / max(totals[i + 1], 1.0), estimator.getMinWeightFractionPerNode())
            # A forest of one whole tree, for the features drawn in each node. So many bins that Spark looks at all cells for its
            # thresholds, which are then those between the bins.
            tree = RandomForestRegressor(
                numTrees=1, bootstrap=False, featuresCol="features", labelCol="_left", weightCol=WEIGHT, seed=seed + start + i,
                maxDepth=estimator.getMaxDepth() if least < 0.5 else 0, maxBins=max(estimator.getMaxBins(), math.isqrt(totals[0]) + 1),
                minInfoGain=estimator.getMinInfoGain(), minWeightFractionPerNode=least if least < 0.5 else 0.0,
                featureSubsetStrategy=estimator.getFeatureSubsetStrategy(), maxMemoryInMB=estimator.getMaxMemoryInMB(),
            )
            trees.append(tree.fit(few).trees[0])
            few.unpersist()
            last = boosted_of(estimator, trees[start:], spark, start == 0).setFeaturesCol("features").setPredictionCol("_step")
            recent = lambda df, last=last: last.transform(df).withColumn("_after", F.col("_base") + F.col("_step"))
            gap = F.col("y") - F.col("_after")
            loss = recent(held_out).agg(F.sum(gap * gap * F.col("n")) / F.sum("n")).first()[0]
            losses.append(math.nan if loss is None else loss)
            best, fired = best_round(losses, patience)
            if fired:
                break
        held_out.unpersist()
    return boosted_of(estimator, trees[:best], spark)


def _fit_with_patience(estimator, train: DataFrame, validation: DataFrame, patience: int, first: int) -> Transformer:
    most = estimator.getMaxIter()
    rounds = min(max(first, patience + 1), most)
    squared = ["squared"] if isinstance(estimator, GBTRegressor) else []
    while True:
        model = estimator.copy({estimator.maxIter: rounds}).fit(train)
        best, fired = best_round(model.evaluateEachIteration(validation, *squared), patience)
        if fired or rounds == most:
            return model if best == rounds else first_rounds(model, best, train.sparkSession)
        rounds = min(2 * rounds, most)


def kmeans(k: int = 5, seed: int = 1, features: str = "features") -> KMeans:
    return KMeans(k=k, seed=seed, featuresCol=features)


def cluster_profile(scored: DataFrame, means: Sequence[str] = (), prediction: str = "prediction") -> DataFrame:
    """Rows per cluster, and the mean of the given columns."""
    return scored.groupBy(prediction).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.avg(c).alias(f"avg_{c}") for c in means]
    )


def silhouette(scored: DataFrame, features: str = "features", prediction: str = "prediction") -> float:
    """Mean silhouette with squared Euclidean distance, between -1 and 1."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=prediction).evaluate(scored)


def auc_hard(scored: DataFrame, label: str, prediction: str = "prediction") -> float:
    """Area under the curve of the 0/1 predictions: the mean of both class recalls."""
    return BinaryClassificationEvaluator(rawPredictionCol=prediction, labelCol=label).evaluate(scored)


def metric_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few measured figures as a table."""
    return spark.createDataFrame(list(rows), schema)


def repeated_holdout(
    df: DataFrame,
    stages: Sequence[Transformer | Estimator],
    label: str,
    key: str,
    repeats: int = 3,
    train_share: float = 0.7,
    metric: Callable[[DataFrame, str], float] = auc_hard,
) -> tuple[DataFrame, PipelineModel, DataFrame]:
    """Fit and measure on several random splits.

    Returns one row per split with its metric and the mean, the best fitted model, and its test
    predictions. The splits go by key hash, so each is the same whenever it is read again.
    """
    marked, names = df, [f"_part{i}" for i in range(repeats)]
    for i, name in enumerate(names):
        marked = hash_split(marked, key, [("train", train_share), ("test", 1 - train_share)], name, salt=f"{i}:")
    cached = marked.persist()
    best, figures = None, []
    for i, name in enumerate(names):
        model = fit_stages_encoded(stages, cached.filter(F.col(name) == "train").drop(*names))
        scored = model.transform(cached.filter(F.col(name) == "test").drop(*names))
        value = float(metric(scored, label))
        figures.append((i, value))
        if best is None or value > best[0]:
            best = (value, model, scored)
    cached.unpersist()
    mean = sum(v for _, v in figures) / len(figures)
    table = metric_rows(df.sparkSession, [(i, v, mean) for i, v in figures], "split int, auc double, mean_auc double")
    return table, best[1], best[2]


def compare_models(
    df: DataFrame, features: Sequence[Transformer | Estimator], models: Mapping[str, Estimator], label: str, key: str, repeats: int = 3
) -> DataFrame:
    """The same features, label and splits for several models; one row per model."""
    rows = []
    for name, model in models.items():
        table, _, _ = repeated_holdout(df, [*features, model], label, key, repeats)
        values = [r.auc for r in table.collect()]
        rows.append((name, sum(values) / len(values), max(values)))
    return metric_rows(df.sparkSession, rows, "model string, mean_auc double, best_auc double")


def log_uniform(rng: random.Random, low: float, high: float) -> float:
    """A draw whose logarithm is uniform between ``low`` and ``high``."""
    return math.exp(rng.uniform(low, high))


def random_search(
    train: DataFrame,
    estimator: Estimator,
    space: Mapping[str, Callable[[random.Random], object]],
    evaluator,
    trials: int = 12,
    parallelism: int = 10,
    train_share: float = 0.75,
    seed: int = 123,
) -> tuple[DataFrame, Transformer]:
    """Try parameters drawn from ``space`` and keep the best by a validation metric.

    Returns the trial table (trial, parameters as text, metric) and the best model.
    """
    rng = random.Random(seed)
    draws = [{name: draw(rng) for name, draw in space.items()} for _ in range(trials)]
    grid = [{estimator.getParam(n): v for n, v in d.items()} for d in draws]
    search = TrainValidationSplit(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=evaluator,
        trainRatio=train_share,
        parallelism=parallelism,
        seed=seed,
    )
    fitted = search.fit(train)
    rows = [
        (i, ", ".join(f"{n}={v:.6g}" if isinstance(v, float) else f"{n}={v}" for n, v in d.items()), float(m))
        for i, (d, m) in enumerate(zip(draws, fitted.validationMetrics))
    ]
    return metric_rows(train.sparkSession, rows, "trial int, params string, metric double"), fitted.bestModel


def choose_features(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric and text columns but the target and ``exclude``, by the schema alone.

    Names and identifiers are left out by naming them in ``exclude``.
    """
    skip = {target, *exclude}
    left = [f for f in df.schema.fields if f.name not in skip]
    return (
        [f.name for f in left if isinstance(f.dataType, T.NumericType)],
        [f.name for f in left if isinstance(f.dataType, T.StringType)],
    )


def auto_model(
    df: DataFrame,
    target: str,
    key: str,
    problem: str = "classification",
    candidates: Mapping[str, Estimator] | None = None,
    exclude: Sequence[str] = (),
) -> tuple[DataFrame, PipelineModel]:
    """Pick features, encode them, try candidate models and return the best by validation.

    The rows are split 60/20/20 by key hash. All columns but the key and ``exclude`` are features, texts
    by their hash. Boosted candidates keep their best number of rounds. Returns one row per candidate with its validation and
    test metric (AUC or r2), best first, and the fitted stages of the winner.
    """
    numeric, categorical = choose_features(df, target, [key, *exclude])
    label = "_label"
    if problem == "classification":
        prepare = [index_labels([target], suffix="_label_index", unseen="skip")]
        known = fit_stages(prepare, df).transform(df).withColumnRenamed(f"{target}_label_index", label)
        models = candidates or {
            "logistic": logistic_regression(label),
            "tree": decision_tree(label),
            "forest": random_forest(label),
            "boosted": gbt_classifier(label, seed=123),
        }
        evaluator = BinaryClassificationEvaluator(labelCol=label)
    elif problem == "regression":
        known = df.filter(F.col(target).isNotNull()).withColumn(label, F.col(target).cast("double"))
        models = candidates or {
            "linear": LinearRegression(labelCol=label),
            "tree": DecisionTreeRegressor(labelCol=label, maxDepth=10),
            "forest": RandomForestRegressor(labelCol=label, numTrees=10, seed=123),
            "boosted": GBTRegressor(labelCol=label, maxIter=25, maxDepth=6, seed=123),
        }
        evaluator = RegressionEvaluator(labelCol=label, metricName="r2")
    else:
        raise ValueError(f"unknown problem {problem!r}")
    parts = hash_split(known, key, [("train", 0.6), ("val", 0.2), ("test", 0.2)], "_part").persist()
    part = {p: parts.filter(F.col("_part") == p) for p in ("train", "val", "test")}
    features = hashed_features(numeric, categorical)
    encoder = fit_stages(features, part["train"])
    encoded = {p: encoder.transform(d).select(key, label, "features").persist() for p, d in part.items()}
    tried = []
    for name, model in models.items():
        boosted = isinstance(model, (GBTClassifier, GBTRegressor))
        fitted = fit_with_patience(model, encoded["train"], encoded["val"], 5) if boosted else model.fit(encoded["train"])
        val, test = (float(evaluator.evaluate(fitted.transform(encoded[p]))) for p in ("val", "test"))
        tried.append((val, test, name, fitted))
    tried.sort(key=lambda t: -t[0])
    for d in [*encoded.values(), parts]:
        d.unpersist()
    table = metric_rows(
        df.sparkSession, [(n, v, t) for v, t, n, _ in tried], "model string, val_metric double, test_metric double"
    )
    return table, PipelineModel(stages=[encoder, tried[0][3]])


def lag_regression(df: DataFrame, col: str, k: int, keys: Sequence[str], pos: str, part: str = "part", size: int = BLOCK) -> tuple[float, list[float]]:
    """Intercept and the weights of the last 1 to ``k`` values, by least squares over the training rows of all series.

    Each block adds up the cross products of its windows, so no window is ever a row. The driver gets one
    square of k + 2.
    """
    rows = with_edges(reject_nulls(df.select(*keys, pos, part, col), col), pos, before=k, after=0, size=size)

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(pos)
        y = pdf[col].to_numpy(float)
        at = np.flatnonzero(pdf["_own"].to_numpy() & (pdf[pos].to_numpy() >= k) & (pdf[part] == "train").to_numpy())
        z = np.stack([np.ones(len(at)), *[y[at - j] for j in range(1, k + 1)], y[at]], 1)
        return pd.DataFrame({"gram": [(z.T @ z).ravel()], "n": [len(at)]})

    parts = rows.groupBy(*keys, "_block").applyInPandas(block, "gram array<double>, n long")
    total = parts.agg(vector_to_array(Summarizer.sum(array_to_vector("gram"))).alias("gram"), F.sum("n").alias("n")).first()
    if not total.n:
        raise ValueError("no training row has a full window")
    fit = least_squares(np.array(total.gram).reshape(k + 2, k + 2), np.arange(k + 1), total.n)
    return float(fit.coef[0]), [float(c) for c in fit.coef[1:]]


def lag_forecast(
    df: DataFrame, col: str, k: int, keys: Sequence[str], pos: str, part: str = "part", model: Estimator | None = None
) -> DataFrame:
    """One-step forecast from the last ``k`` values.

    A regression is fitted on the windows whose target row is in the training part, over all
    series, and predicts the windows of every row that has one. Without ``model`` it is linear and needs
    only sums of products.
    """
    windows = lag_windows(df.select(*keys, pos, col, part), [col], col, k, keys, pos, keep=[part])
    values = F.transform("x", lambda s: s[col].cast("double"))
    if model is None:
        base, weights = lag_regression(df, col, k, keys, pos, part)
        oldest_first = F.array(*[F.lit(w) for w in reversed(weights)])
        predicted = F.lit(base) + F.aggregate(F.zip_with(values, oldest_first, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        return windows.select(*keys, pos, part, "y", predicted.alias("prediction"))
    # Other models read the windows several times; they are built once.
    vectors = written_once(windows.select(*keys, pos, part, "y", array_to_vector(values).alias("features")))
    fitted = model.fit(vectors.filter(F.col(part) == "train"))
    return fitted.transform(vectors).select(*keys, pos, part, "y", F.col("prediction"))


def batch_score(model: PipelineModel, table: DataFrame, keep: Sequence[str], out: str = "prediction") -> DataFrame:
    """Apply a fitted model to a stored table, adding one column."""
    return model.transform(table).select(*keep, F.col("prediction").alias(out))


def save_and_load(model: PipelineModel, path: str | None = None) -> PipelineModel:
    """Write a fitted model and read it back, as a later job would."""
    spark = SparkSession.getActiveSession()
    path = path or scratch_path(spark, "model")
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def positive_probability(scored: DataFrame, out: str = "score", col: str = "probability") -> DataFrame:
    """The probability of class 1 as a plain number."""
    return scored.withColumn(out, vector_element(col, 1))


def score_by_signature(model: PipelineModel, inputs: Sequence[str], table: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Score with the input columns that the model was trained on; other columns are ignored.

    A missing input column is an error that names it.
    """
    absent = [c for c in inputs if c not in table.columns]
    if absent:
        raise ValueError(f"the table lacks the model inputs {absent}")
    return model.transform(table.select(*dict.fromkeys([*keep, *inputs]))).select(*keep, "prediction")


def model_udf(predict: Callable, returns: str = "double") -> Callable[..., Column]:
    """A column function from a plain predictor over a pandas frame, run on Arrow batches.

    For models that are not Spark's own. Give it columns, or one struct column.
    """
    @F.pandas_udf(returns)
    def scored(features: pd.DataFrame) -> pd.Series:
        return pd.Series(predict(features))

    return lambda *cols: scored(cols[0] if len(cols) == 1 else F.struct(*cols))
