"""Boosted trees for two classes on blocks of binned rows.

Spark's boosting keeps an object for every row and updates the sums of a level row by row and feature by feature. Here a
row is a few bytes of a block: features that together have up to 256 combinations of bins share a byte, and numpy adds up
the rows of a block by node and byte. The thresholds are those that Spark finds, from the same sample, and each level takes
the splits of Spark's rules, so the trees differ from Spark's own only where two splits are equal but for rounding.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cuadra.session import shared_dir, written_once

BLOCK_ROWS = 32_768
TASK_BLOCKS = 128  # that one task goes through, if there are enough for all cores
CODES = 256  # combinations of bins that share a byte
EPSILON = 2.0**-52  # below it Spark calls a node pure


def blockable(estimator: Estimator) -> bool:
    """Whether ``fit_blocks`` does all that the estimator asks for: every row and feature for every tree, and few bins and levels."""
    return (
        isinstance(estimator, GBTClassifier) and estimator.getSubsamplingRate() == 1.0 and estimator.getFeatureSubsetStrategy() in ("auto", "all")
        and not estimator.isSet("weightCol") and not estimator.isSet("validationIndicatorCol")
        and estimator.getMaxBins() <= CODES and estimator.getMaxDepth() <= 10
    )


@dataclass
class Feature:
    """How a feature is binned, and where its bin is found: in byte ``group``, times ``stride``."""

    bins: int
    thresholds: np.ndarray | None  # None: its values are the numbers of categories
    group: int = 0
    stride: int = 1


def _module(package, name: str):
    """A Scala object without static methods."""
    return getattr(getattr(package, f"{name}$"), "MODULE$")


def binned_features(estimator: GBTClassifier, rows: DataFrame, count: int) -> list[Feature]:
    """The bins that Spark's own fit would give the features of ``count`` rows. It checks all labels and features, too."""
    jvm, ml = rows.sparkSession._jvm, rows.sparkSession._jvm.org.apache.spark.ml
    estimator._transfer_params_to_java()
    java = estimator._java_obj

    def instances(df: DataFrame):
        return _module(ml.util, "DatasetUtils").extractInstances(java, df._jdf, jvm.scala.Option.apply(2))

    categories = ml.util.MetadataUtils.getCategoricalFeatures(rows._jdf.schema().apply(estimator.getFeaturesCol()))
    strategy = java.getOldStrategy(categories, 0, jvm.org.apache.spark.mllib.tree.configuration.Algo.Regression(), java.getOldImpurity())
    # Spark goes through all rows to count them; the rest of what it finds, so many rows tell that are not fewer than bins.
    few = ml.tree.impl.DecisionTreeMetadata.buildMetadata(instances(rows.limit(CODES)), strategy, 1, estimator.getFeatureSubsetStrategy())
    metadata = ml.tree.impl.DecisionTreeMetadata(
        few.numFeatures(), count, float(count), few.numClasses(), few.maxBins(), few.featureArity(), few.unorderedFeatures(), few.numBins(), few.impurity(),
        few.quantileStrategy(), few.maxDepth(), few.minInstancesPerNode(), few.minWeightFractionPerNode(), few.minInfoGain(), few.numTrees(), few.numFeaturesPerNode())
    splits = _module(ml.tree.impl, "RandomForest").findSplits(instances(rows), metadata, estimator.getSeed())
    found = []
    for i in range(metadata.numFeatures()):
        if metadata.isContinuous(i):
            thresholds = np.array([s.threshold() for s in splits[i]], float)
            found.append(Feature(len(thresholds) + 1, thresholds))
        else:
            found.append(Feature(list(metadata.numBins())[i], None))
    return found


def share_bytes(features: Sequence[Feature]) -> int:
    """Give every feature its place in a byte; how many bytes there are."""
    used: list[int] = []
    for f in sorted((f for f in features if f.bins > 1), key=lambda f: -f.bins):
        f.group = next((g for g, n in enumerate(used) if n * f.bins <= CODES), len(used))
        if f.group == len(used):
            used.append(1)
        f.stride = used[f.group]
        used[f.group] *= f.bins
    return len(used)


def blocks_of(rows: DataFrame, estimator: GBTClassifier, features: Sequence[Feature], groups: int) -> DataFrame:
    """Blocks of rows: codes, the bytes of the first group, of the second and so on, and y, the labels."""

    def packed(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        codes = np.zeros((groups, len(y)), np.uint8)
        for i, f in enumerate(features):
            if f.thresholds is not None:
                at = np.searchsorted(f.thresholds, x[:, i])
            else:
                at = x[:, i].astype(int)
                if ((at < 0) | (at >= f.bins)).any():
                    raise ValueError(f"feature {i} has values other than its {f.bins} categories")
            if f.bins > 1:
                codes[f.group] += (at * f.stride).astype(np.uint8)
        return pa.RecordBatch.from_arrays([pa.array([codes.tobytes()], pa.binary()), pa.array([y.astype(np.uint8).tobytes()], pa.binary())], ["codes", "y"])

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append((b.column(0).flatten().to_numpy().reshape(b.num_rows, -1), b.column(1).to_numpy()))
                n += b.num_rows
            if n >= BLOCK_ROWS:
                x, y = map(np.concatenate, zip(*held))
                for at in range(0, n - BLOCK_ROWS + 1, BLOCK_ROWS):
                    yield packed(x[at:at + BLOCK_ROWS], y[at:at + BLOCK_ROWS])
                rest = n % BLOCK_ROWS
                held, n = [(x[n - rest:].copy(), y[n - rest:].copy())], rest
        if n:
            yield packed(*map(np.concatenate, zip(*held)))

    plain = rows.select(vector_to_array(estimator.getFeaturesCol()).alias("x"), F.col(estimator.getLabelCol()).cast("double").alias("y"))
    return plain.mapInArrow(block, "codes binary, y binary")


@dataclass
class Tree:
    """A tree in the order of a heap: the children of node i are 2 i + 1 and 2 i + 2."""

    depth: int
    n: np.ndarray = field(init=False)  # rows, sum and sum of squares of what was fitted
    s: np.ndarray = field(init=False)
    q: np.ndarray = field(init=False)
    gain: np.ndarray = field(init=False)
    barred: np.ndarray = field(init=False)  # nodes for which no split was allowed
    split: dict[int, tuple[int, int | frozenset[int]]] = field(default_factory=dict)  # feature, and the last bin or the set of bins to the left
    steps: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # by level: the byte that a place looks at; the next place by place and code

    def __post_init__(self):
        size = 2 ** (self.depth + 1) - 1
        self.n, self.s, self.q, self.gain = (np.zeros(size) for _ in range(4))
        self.barred = np.zeros(size, bool)

    def predict(self) -> np.ndarray:
        return np.divide(self.s, self.n, out=np.zeros_like(self.s), where=self.n > 0)

    def impurity(self) -> np.ndarray:
        return np.divide(self.q - self.predict() * self.s, self.n, out=np.zeros_like(self.s), where=self.n > 0)

    def at_the_end(self) -> np.ndarray:
        """What a row gets that ends at a place of the last level so far; nodes that are not split go on to the left."""
        value = self.predict()
        for i in range(len(value) // 2):
            if i not in self.split:
                value[2 * i + 1] = value[i]
        return value[2 ** len(self.steps) - 1:2 ** (len(self.steps) + 1) - 1]


Steps = Sequence[tuple[np.ndarray, np.ndarray]]
Block = tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray | None]  # codes, labels, margins, sums of squares at the ends of the last tree


def _places(codes: np.ndarray, steps: Steps) -> np.ndarray:
    """The place of each row of a block on the level after ``steps``."""
    n = codes.shape[1]
    place, rows, flat = np.zeros(n, np.int64), np.arange(n), codes.ravel()
    for group, following in steps:
        if len(group) == 1:
            place = following[0].take(codes[group[0]])
            continue
        at = (group * n).take(place)
        at += rows
        place *= CODES
        place += flat.take(at)
        place = following.ravel().take(place)
    return place


def _targets(y: np.ndarray, margin: np.ndarray | None) -> np.ndarray:
    """What the next tree is fitted on: the labels as -1 and 1, later the gradient of the logistic loss."""
    if margin is None:
        return 2.0 * y - 1.0
    gradient = 4.0 * y - 2.0
    with np.errstate(over="ignore"):
        below = np.exp(gradient * margin)
    below += 1.0
    gradient *= 2.0
    gradient /= below
    return gradient


def after(state: RDD, tree: Tree, weight: float) -> RDD:
    """The blocks with the margins after one more tree, and the sums of squares of what it was fitted on at its ends."""
    steps, value = tree.steps, tree.at_the_end()

    def moved(block: Block) -> Block:
        codes, y, margin, _ = block
        place = _places(codes, steps)
        step = (weight * value).take(place)
        return codes, y, step if margin is None else margin + step, np.bincount(place, _targets(y, margin) ** 2, len(value))

    return state.map(moved, preservesPartitioning=True)


def level_sums(
    state: RDD, features: Sequence[Feature], groups: int, steps: Steps, nodes: Sequence[int], ends: int,
) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Rows, sum and sum of squares by node; rows and sum by node and bin of each feature; and the sums of squares that ``after`` left."""
    slot = np.full(2 ** len(steps), len(nodes))
    slot[np.array(nodes, int) - (2 ** len(steps) - 1)] = np.arange(len(nodes))
    many = len(nodes) + 1  # the last one is for rows that have come to a leaf

    def summed(blocks: Iterator[Block]) -> Iterator[np.ndarray]:
        totals, sums, left = np.zeros((3, many)), np.zeros((groups, 2, many * CODES)), np.zeros(ends)
        for codes, y, margin, q in blocks:
            g = _targets(y, margin)
            at = slot.take(_places(codes, steps))
            totals += [np.bincount(at, None, many), np.bincount(at, g, many), np.bincount(at, g * g, many)]
            at *= CODES
            for i in range(groups):
                cell = at + codes[i]
                sums[i, 0] += np.bincount(cell, None, many * CODES)
                sums[i, 1] += np.bincount(cell, g, many * CODES)
            if ends:
                left += q
        parts = [totals[:, :-1], *(_by_bin(sums[f.group], f, many)[:, :-1] for f in features if f.bins > 1), left]
        yield np.concatenate([p.ravel() for p in parts])

    whole = sum(state.mapPartitions(summed).collect())
    shapes = [(3, len(nodes)), *((2, len(nodes), f.bins) for f in features if f.bins > 1), (ends,)]
    totals, *each, left = (a.reshape(s) for a, s in zip(np.split(whole, np.cumsum([int(np.prod(s)) for s in shapes])[:-1]), shapes))
    return totals, each, left


def _by_bin(sums: np.ndarray, f: Feature, many: int) -> np.ndarray:
    """Sums by node and bin of one feature, from those by node and byte."""
    bins = np.arange(CODES) // f.stride % f.bins
    out = np.zeros((2, many, f.bins))
    for b in range(f.bins):
        out[:, :, b] = sums.reshape(2, many, CODES)[:, :, bins == b].sum(axis=2)
    return out


def best_splits(
    totals: np.ndarray, each: Sequence[np.ndarray], features: Sequence[Feature], least_rows: float, least_gain: float,
) -> list[tuple[float, int, int | frozenset[int], float, float] | None]:
    """For each node the first split of the largest gain: gain, feature, what goes left, and its rows and sum; None if none is allowed."""
    n, s = totals[0][:, None], totals[1][:, None]
    best: list[tuple[float, int, int | frozenset[int], float, float] | None] = [None] * totals.shape[1]
    for (i, f), sums in zip(((i, f) for i, f in enumerate(features) if f.bins > 1), each):
        if f.thresholds is None:  # categories by their mean, those without rows last
            mean = np.divide(sums[1], sums[0], out=np.full_like(sums[1], np.finfo(float).max), where=sums[0] > 0)
            order = np.argsort(mean, axis=1, kind="stable")
            sums = np.take_along_axis(sums, order[None], axis=2)
        left_n, left_s = np.cumsum(sums, axis=2)[:, :, :-1]
        right_n, right_s = n - left_n, s - left_s
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (left_s**2 / left_n + right_s**2 / right_n - s**2 / n) / n
        gain = np.where((left_n >= least_rows) & (right_n >= least_rows) & (gain >= least_gain), gain, -np.inf)
        at = gain.argmax(axis=1)
        for node, (k, top) in enumerate(zip(at, gain.max(axis=1))):
            if top > -np.inf and (best[node] is None or top > best[node][0]):
                left = int(k) if f.thresholds is not None else frozenset(order[node, :k + 1].tolist())
                best[node] = (float(top), i, left, left_n[node, k], left_s[node, k])
    return best


def grow(
    state: RDD, tree: Tree, features: Sequence[Feature], groups: int, least_rows: float, least_gain: float, before: Tree | None,
) -> None:
    """Fit the tree level by level; the first pass also completes the tree before."""
    nodes = [0]
    for level in range(tree.depth + 1):
        first = 2**level - 1
        if level == tree.depth and level:  # the last leaves are known from the splits above
            break
        ends = 2 ** len(before.steps) if level == 0 and before else 0
        totals, each, left = level_sums(state, features, groups, tree.steps, nodes, ends)
        if ends:
            complete(before, left)
        tree.n[nodes], tree.s[nodes], tree.q[nodes] = totals
        # Places that are not split go on to the left.
        group, following, further = np.zeros(2**level, np.int64), np.repeat(2 * np.arange(2**level)[:, None], CODES, axis=1), []
        pure = tree.impurity()[nodes] < EPSILON
        found = best_splits(totals, each, features, least_rows, least_gain) if tree.depth else []
        for node, best, alike in zip(nodes, found, pure):
            if alike and level:
                continue
            tree.barred[node] = best is None
            if best is None or best[0] <= 0:
                continue
            gain, i, to_left, n, s = best
            tree.gain[node], tree.split[node] = gain, (i, to_left)
            f, a, b = features[i], 2 * node + 1, 2 * node + 2
            bins = np.arange(CODES) // f.stride % f.bins
            group[node - first] = f.group
            following[node - first] += bins > to_left if f.thresholds is not None else ~np.isin(bins, list(to_left))
            tree.n[[a, b]], tree.s[[a, b]] = (n, tree.n[node] - n), (s, tree.s[node] - s)
            further += [a, b]
        if not further:
            break
        tree.steps.append((group, following))
        nodes = further


def complete(tree: Tree, left: np.ndarray) -> None:
    """Give the leaves of the last level the sums of squares that were found when the rows came to them."""
    first = 2 ** len(tree.steps) - 1
    for node in range(first, first + len(left)):
        if (node - 1) // 2 in tree.split:
            tree.q[node] = left[node - first]


def java_trees(trees: Sequence[Tree], features: Sequence[Feature], spark: SparkSession) -> list:
    """The trees as models of Spark."""
    jvm, ml = spark._jvm, spark._jvm.org.apache.spark.ml
    # Every name of a package and every call is a question to the JVM; equal splits are one object.
    inner, leaf, regression = ml.tree.InternalNode, ml.tree.LeafNode, ml.regression.DecisionTreeRegressionModel
    parse, calculator = jvm.org.apache.spark.mllib.linalg.Vectors.parse, jvm.org.apache.spark.mllib.tree.impurity.VarianceAggregator().getCalculator

    @cache
    def split(i: int, left: int | frozenset[int]):
        if features[i].thresholds is not None:
            return ml.tree.ContinuousSplit(i, float(features[i].thresholds[left]))
        return ml.tree.CategoricalSplit(i, GBTClassificationModel._new_java_array([float(c) for c in sorted(left)], jvm.double), features[i].bins)

    def model(tree: Tree):
        predict, unlike = tree.predict().tolist(), tree.impurity().tolist()
        figures = parse(str(np.stack([tree.n, tree.s, tree.q, tree.n], axis=1).ravel().tolist())).toArray()

        def built(node: int) -> tuple[object, float | None]:
            """A node, and its prediction if it is a leaf. Equal leaves become one, as in Spark."""
            stats = calculator(figures, 4 * node)
            if node not in tree.split:
                return leaf(predict[node], -1.0 if tree.barred[node] else unlike[node], stats), predict[node]
            (a, a_value), (b, b_value) = built(2 * node + 1), built(2 * node + 2)
            if a_value is not None and a_value == b_value:
                return leaf(a_value, unlike[node], stats), a_value
            return inner(predict[node], unlike[node], float(tree.gain[node]), a, b, split(*tree.split[node]), stats), None

        return regression(built(0)[0], len(features))

    return [model(t) for t in trees]


def fit_blocks(estimator: GBTClassifier, rows: DataFrame, count: int) -> GBTClassificationModel:
    """The model of ``estimator.fit(rows)``, for a ``blockable`` one and ``count`` rows, many more than bins.

    The rows are read for the sample and for the blocks, which are written once. After each tree its margins are kept with them
    in memory or on disk, and written at the estimator's checkpoint interval; a level is one pass over them that gives the driver
    a few sums for each node and bin.
    """
    spark = rows.sparkSession
    features = binned_features(estimator, rows, count)
    groups = share_bytes(features)
    blocks = written_once(blocks_of(rows, estimator, features, groups))
    cores = spark.sparkContext.defaultParallelism
    tasks = cores * -(-count // (BLOCK_ROWS * TASK_BLOCKS * cores))

    def loaded(row: Row) -> Block:
        y = np.frombuffer(row.y, np.uint8)
        return np.frombuffer(row.codes, np.uint8).reshape(groups, len(y)), y, None, None

    shared_dir(spark)  # for the checkpoints
    state = blocks.repartition(tasks).rdd.map(loaded).persist(StorageLevel.MEMORY_AND_DISK)
    least = max(estimator.getMinInstancesPerNode(), estimator.getMinWeightFractionPerNode() * count)
    trees, weights = [], [1.0] + [estimator.getStepSize()] * (estimator.getMaxIter() - 1)
    for i, weight in enumerate(weights):
        tree = Tree(estimator.getMaxDepth())
        grow(state, tree, features, groups, least, estimator.getMinInfoGain(), trees[-1] if trees else None)
        trees.append(tree)
        if i:
            held.unpersist()
        held, state = state, after(state, tree, weight).persist(StorageLevel.MEMORY_AND_DISK)
        if estimator.getCheckpointInterval() > 0 and (i + 1) % estimator.getCheckpointInterval() == 0:
            state.checkpoint()
    complete(trees[-1], sum(state.map(lambda block: block[3]).collect()))
    held.unpersist()
    state.unpersist()
    kind = spark._jvm.org.apache.spark.ml.classification.GBTClassificationModel
    parts = GBTClassificationModel._new_java_array(java_trees(trees, features, spark), spark._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel)
    java = kind(estimator.uid, parts, GBTClassificationModel._new_java_array(weights, spark._jvm.double), len(features), 2)
    return estimator._copyValues(GBTClassificationModel(java))
