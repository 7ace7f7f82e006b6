"""Parameter search as concurrent Spark jobs over one split, and the search over whole model families.

The rows are split by key hash and written once, so all trials see the same parts and none of them sees
the test rows before the end. Trials are independent jobs that a thread pool submits; Spark runs their
stages side by side. The predictions of the winner are written, and all its figures are computed from them.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuadra.functions.scalars import vector_element
from cuadra.operators.evaluate import auc_by, regression_metrics
from cuadra.operators.features import fit_stages, hashed_features, index_labels
from cuadra.operators.models import (
    WEIGHT, choose_features, collapse, collapsible, decision_tree, fit_collapsed, fit_with_patience, gbt_classifier, logistic_regression, metric_rows,
    random_forest, same_collapse,
)
from cuadra.operators.order import hash_split
from cuadra.session import written_once

PARTS = (("train", 0.6), ("val", 0.2), ("test", 0.2))
Draw = Callable[[random.Random], object]


def uniform_int(low: int, high: int) -> Draw:
    """A whole number between ``low`` and ``high``, both included."""
    return lambda rng: rng.randint(low, high)


def log_uniform(low: float, high: float) -> Draw:
    """A number whose logarithm is uniform between ``low`` and ``high``."""
    return lambda rng: math.exp(rng.uniform(low, high))


def log_uniform_int(low: float, high: float) -> Draw:
    """The same, rounded down to a whole number of at least 1."""
    return lambda rng: max(1, int(math.exp(rng.uniform(low, high))))


def draw_trials(space: Mapping[str, Draw], trials: int, seed: int) -> list[dict[str, object]]:
    """The parameters of each trial; the same seed gives the same trials."""
    rng = random.Random(seed)
    return [{name: draw(rng) for name, draw in space.items()} for _ in range(trials)]


def params_text(params: Mapping[str, object]) -> str:
    return ", ".join(f"{n}={v:.6g}" if isinstance(v, float) else f"{n}={v}" for n, v in params.items())


def classification_metrics(
    scored: DataFrame, label: str, score: str = "score", keys: Sequence[str] = ("part",), at: float = 0.5, weight: str | None = None,
) -> DataFrame:
    """n_rows, accuracy, precision, recall, f1, log_loss and roc_auc per group; a score of ``at`` or more calls a 1.

    A measure without rows to divide by is null. ``weight`` is a column that says how often a row comes.
    """
    y, called, w = F.col(label).cast("double"), (F.col(score) >= at).cast("double"), F.col(weight) if weight else F.lit(1.0)
    p = F.greatest(F.least(F.col(score), F.lit(1 - 1e-15)), F.lit(1e-15))

    def mean(x: Column) -> Column:
        return F.try_divide(F.sum(w * x), F.sum(F.when(x.isNotNull(), w))) if weight else F.avg(x)

    counts = scored.groupBy(*keys).agg(
        (F.sum(w).cast("long") if weight else F.count(F.lit(1))).alias("n_rows"), F.sum(w * y).alias("_pos"), F.sum(w * called).alias("_called"), F.sum(w * y * called).alias("_hit"),
        mean((y == called).cast("double")).alias("accuracy"), mean(-F.log(F.when(y == 1, p).otherwise(1 - p))).alias("log_loss"))
    measured = counts.select(
        *keys, "n_rows", "accuracy", F.try_divide("_hit", "_called").alias("precision"), F.try_divide("_hit", "_pos").alias("recall"),
        F.try_divide(2 * F.col("_hit"), F.col("_called") + F.col("_pos")).alias("f1"), "log_loss")
    return measured.join(auc_by(scored, label, score, keys, weight).withColumnRenamed("auc", "roc_auc"), [*keys], "left")


def prefixed(measured: DataFrame, parts: Sequence[str] = ("train", "val", "test"), part: str = "part") -> DataFrame:
    """One row with a column ``part_measure`` for each part and measure; the groups are a handful."""
    names = [c for c in measured.columns if c != part]
    return measured.agg(*[F.max(F.when(F.col(part) == p, F.col(c))).alias(f"{p}_{c}") for p in parts for c in names])


def split_once(df: DataFrame, key: str, label: str, stages: Sequence[Transformer | Estimator], parts=PARTS) -> tuple[DataFrame, PipelineModel]:
    """key, label, features and part, written; the stages are fitted on the first part."""
    marked = hash_split(df, key, parts)
    encoder = fit_stages(stages, marked.filter(F.col("part") == parts[0][0]))
    return written_once(encoder.transform(marked).select(key, F.col(label).cast("double").alias(label), "features", "part")), encoder


@dataclass
class Found:
    """What a search returns: one row per trial, the best model, its written predictions and their figures."""

    trials: DataFrame
    model: Transformer
    predictions: DataFrame
    metrics: DataFrame


def _scored(model: Transformer, rows: DataFrame, classify: bool) -> DataFrame:
    out = model.transform(rows)
    return out.withColumn("score", vector_element("probability", 1)) if classify else out.withColumn("score", F.col("prediction"))


def measure(scored: DataFrame, label: str, classify: bool, weight: str | None = None) -> DataFrame:
    """The measures of a scored table, one row per part; only those of classes take weights."""
    if classify:
        return classification_metrics(scored, label, weight=weight)
    return regression_metrics(scored, label, "score", ["part"])


def run_trials(
    split: DataFrame, label: str, models: Sequence[tuple[str, str, Estimator]], parallelism: int = 10, patience: int | None = None,
) -> list[tuple[dict, Transformer]]:
    """Fit (name, parameters, estimator) on the training part and measure on the validation part, so many at a time.

    Boosted models stop after ``patience`` rounds without a gain on the validation part, if it is given.
    Trees and boosted models are fitted on the different rows and their numbers, which are counted once for all trials.
    Returns the validation figures and the model of each, in the given order.
    """
    train, val = (split.filter(F.col("part") == p) for p in ("train", "val"))
    like = next((m for _, _, m in models if collapsible(m)), None)
    few = (collapse(train, like), collapse(val, like)) if like else None

    def trial(entry: tuple[str, str, Estimator]) -> tuple[dict, Transformer]:
        estimator = entry[2]
        boosted = isinstance(estimator, (GBTClassifier, GBTRegressor))
        shared = few if collapsible(estimator) and same_collapse(estimator, like) else None
        if boosted and patience:
            # Over the different rows a few more rounds cost less than to begin again with twice as many.
            model = fit_with_patience(estimator, train, val, patience, first=max(50, 2 * patience) if shared else 2 * patience, few=shared)
        else:
            model = fit_collapsed(estimator, train, shared and shared[0])
        classify = estimator.hasParam("probabilityCol")
        if classify and shared:  # the different rows and their numbers
            return measure(_scored(model, shared[1].withColumn("part", F.lit("val")), classify), label, classify, WEIGHT).first().asDict(), model
        return measure(_scored(model, val, classify), label, classify).first().asDict(), model

    with ThreadPoolExecutor(parallelism) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(trial), m) for m in models]]


def _found(split: DataFrame, key: str, label: str, models, results, metric: str, smallest: bool, classify: bool) -> tuple[Found, int]:
    """The winner by a validation measure; without a measure a trial cannot win, and the first of equal ones does."""
    values = [r[0].get(metric) for r in results]
    known = [i for i, v in enumerate(values) if v is not None]
    if not known:
        raise ValueError(f"no trial has a {metric} on the validation part")
    best = min(known, key=lambda i: values[i] if smallest else -values[i])
    model = results[best][1]
    predictions = written_once(_scored(model, split, classify).select(key, "part", label, "score"))
    rows = [(i, name, text, values[i], i == best) for i, (name, text, _) in enumerate(models)]
    trials = metric_rows(split.sparkSession, rows, f"trial int, model string, params string, val_trial_{metric} double, best boolean")
    return Found(trials, model, predictions, prefixed(measure(predictions, label, classify))), best


def search_boosted(
    split: DataFrame, key: str, label: str, space: Mapping[str, Draw], estimator: GBTClassifier | GBTRegressor, metric: str | None = None,
    trials: int = 12, parallelism: int = 10, patience: int | None = None, seed: int = 123,
) -> Found:
    """Random search over the parameters of a boosted model; ``split`` comes from ``split_once``.

    The best trial has the largest ``roc_auc`` or ``r2`` on the validation part; ``log_loss``, ``rmse``, ``mse`` and ``mae`` are better when smaller.
    """
    classify = isinstance(estimator, GBTClassifier)
    metric = metric or ("roc_auc" if classify else "r2")
    draws = draw_trials(space, trials, seed)
    models = [("boosted", params_text(d), estimator.copy({estimator.getParam(n): v for n, v in d.items()})) for d in draws]
    results = run_trials(split, label, models, parallelism, patience)
    return _found(split, key, label, models, results, metric, metric in ("log_loss", "rmse", "mse", "mae"), classify)[0]


# What is searched for each kind of boosted model, as (parameter, draw).
BOOSTED_SPACE = {"maxDepth": uniform_int(2, 6), "stepSize": log_uniform(-3, -0.5), "maxIter": uniform_int(10, 25), "minInstancesPerNode": log_uniform_int(0, 3)}


def auto_search(
    df: DataFrame, target: str, key: str, problem: str, slots: int, exclude: Sequence[str] = (), space: Mapping[str, Draw] | None = None,
    trials: int = 12, parallelism: int = 10, patience: int | None = 5, seed: int = 123,
) -> tuple[Found, PipelineModel]:
    """Pick features, encode them, try families of models with searched parameters, and return the best by validation.

    All columns but the key, the target and ``exclude`` are features; ``slots`` is the number of places that the
    values of all text columns are hashed to, and should grow with them. A linear model, a tree and a forest
    have fixed parameters; the other trials are drawn for boosting. ``metrics`` of the result has every measure with the prefixes
    train, val and test. A target without a value is left out. Returns the fitted stages from raw columns to prediction as well.
    """
    if problem not in ("classification", "regression"):
        raise ValueError(f"unknown problem {problem!r}")
    classify = problem == "classification"
    numeric, texts = choose_features(df, target, [key, *exclude])
    known, label = df.filter(F.col(target).isNotNull()), "_label"
    if not classify:
        known = known.withColumn(label, F.col(target).cast("double"))
        families: list[tuple[str, Estimator]] = [
            ("linear", LinearRegression(labelCol=label)), ("tree", DecisionTreeRegressor(labelCol=label, maxDepth=10)),
            ("forest", RandomForestRegressor(labelCol=label, numTrees=10, seed=seed))]
        boosted: GBTClassifier | GBTRegressor = GBTRegressor(labelCol=label, seed=seed)
    else:
        if isinstance(df.schema[target].dataType, (T.NumericType, T.BooleanType)):
            known = known.withColumn(label, F.col(target).cast("double"))
        else:
            known = fit_stages([index_labels([target], suffix="_label_index", unseen="skip")], known).transform(known).withColumnRenamed(f"{target}_label_index", label)
        families = [("logistic", logistic_regression(label)), ("tree", decision_tree(label)), ("forest", random_forest(label))]
        boosted = gbt_classifier(label, seed=seed)
    split, encoder = split_once(known, key, label, hashed_features(numeric, texts, slots=slots))
    draws = draw_trials(space or BOOSTED_SPACE, trials, seed)
    models = [(n, "", m) for n, m in families] + [("boosted", params_text(d), boosted.copy({boosted.getParam(n): v for n, v in d.items()})) for d in draws]
    results = run_trials(split, label, models, parallelism, patience)
    found, best = _found(split, key, label, models, results, "roc_auc" if classify else "r2", False, classify)
    return found, PipelineModel(stages=[encoder, results[best][1]])
