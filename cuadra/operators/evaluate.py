"""Measures of scored tables, and readable forms of fitted trees."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuadra.operators.aggregate import missing
from cuadra.operators.features import slot_names
from cuadra.operators.position import with_running_sums
from cuadra.session import broadcast_if_small


def auc_hard_table(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """AUC of 0/1 predictions as one row: the mean of both class recalls."""
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return df.groupBy(*keys).agg(
        ((F.avg(F.when(F.col(label) == 1, hit)) + F.avg(F.when(F.col(label) == 0, hit))) / 2).alias("auc")
    )


def _by_score(df: DataFrame, label: str, score: str, keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Positives and negatives per distinct score, with running totals from the highest score; rows without a score are left out."""
    y, w = F.col(label).cast("long"), F.col(weight).cast("long") if weight else F.lit(1)
    counts = df.filter(~missing(df, score)).groupBy(*keys, score).agg(F.sum(y * w).alias("pos"), F.sum((1 - y) * w).alias("neg"))
    return with_running_sums(counts, [F.desc(score)], {"tp": "pos", "fp": "neg"}, keys, totals={"n_pos": "pos", "n_neg": "neg"})


def auc_by(df: DataFrame, label: str, score: str, keys: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """AUC of a score per group; tied scores count half, rows without a score do not count. ``weight`` is how often a row comes."""
    ranked = _by_score(df, label, score, keys, weight)
    totals = F.max("tp") * F.max("fp")
    # A negative beats the positives that come later and ties with those of its own score.
    won = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") + F.col("pos") / 2.0))
    return ranked.groupBy(*keys).agg(F.try_divide(won, totals).alias("auc"))


def auc_prob(df: DataFrame, label: str, score: str) -> DataFrame:
    """AUC of a score as one row."""
    return auc_by(df, label, score)


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """False and true positive rate at every distinct score, from (0, 0) to (1, 1)."""
    ranked = _by_score(df, label, score)
    points = ranked.select(
        F.col(score).cast("double").alias("threshold"),
        F.try_divide(F.col("fp"), F.col("n_neg")).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("n_pos")).alias("tpr"),
    )
    start = ranked.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(points)


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction", keys: Sequence[str] = (), prefix: str = "") -> DataFrame:
    """r2, RMSE, MSE and MAE in one aggregation, per part if ``keys`` names one."""
    err = F.col(label) - F.col(prediction)
    sst = F.var_pop(label) * F.count(label)
    return df.groupBy(*keys).agg(
        (1 - F.try_divide(F.sum(err * err), sst)).alias(f"{prefix}r2"),
        F.sqrt(F.avg(err * err)).alias(f"{prefix}rmse"),
        F.avg(err * err).alias(f"{prefix}mse"),
        F.avg(F.abs(err)).alias(f"{prefix}mae"),
    )


def feature_importance(model, encoded: DataFrame, features: str = "features") -> DataFrame:
    """Importance per named slot of the feature vector, largest first."""
    weights = model.featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(slot_names(encoded, features), weights)]
    table = encoded.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


_TEST = re.compile(r"(If|Else) \(feature (\d+) (<=|>|in|not in) (\{[^}]*\}|[^)]*)\)")
_LEAF = re.compile(r"Predict: (\S+)")


def tree_paths(model) -> list[tuple[list[tuple[int, str, object]], float]]:
    """The leaves of one fitted tree: conditions (slot, test, value) from the root, prediction.

    They are read from the text that the model prints of itself.
    """
    stack: list[tuple[int, str, object]] = []
    leaves = []
    for line in model.toDebugString.splitlines()[1:]:
        depth = len(line) - len(line.lstrip(" "))
        test, leaf = _TEST.search(line), _LEAF.search(line)
        if test:
            value = test.group(4)
            wanted = {float(v) for v in value[1:-1].split(",")} if value.startswith("{") else float(value)
            del stack[depth - 2 :]
            stack.append((int(test.group(2)), test.group(3), wanted))
        elif leaf:
            leaves.append((list(stack[: depth - 2]), float(leaf.group(1))))
    return leaves


def _text(cond: tuple[int, str, object], names: Sequence[str]) -> str:
    slot, test, value = cond
    shown = "{" + ", ".join(f"{v:g}" for v in sorted(value)) + "}" if isinstance(value, set) else repr(value)
    return f"{names[slot] if slot < len(names) else slot} {test} {shown}"


def tree_rules(model, encoded: DataFrame, features: str = "features") -> DataFrame:
    """One row per leaf: number, depth, conditions as text and prediction."""
    names = slot_names(encoded, features)
    rows = [
        (i, len(path), " AND ".join(_text(c, names) for c in path), value)
        for i, (path, value) in enumerate(tree_paths(model))
    ]
    return encoded.sparkSession.createDataFrame(rows, "leaf int, depth int, conditions string, prediction double")


def score_by_rules(model, features: str = "features") -> Column:
    """The same rules as one expression over the feature vector."""
    slots = vector_to_array(features)

    def holds(cond) -> Column:
        slot, test, value = cond
        x = F.get(slots, F.lit(slot))
        if isinstance(value, set):
            member = x.isin(*sorted(value))
            return member if test == "in" else ~member
        return x <= value if test == "<=" else x > value

    paths = tree_paths(model)
    scored = None
    for path, value in paths:
        cond = F.lit(True)
        for c in path:
            cond = cond & holds(c)
        scored = F.when(cond, value) if scored is None else scored.when(cond, value)
    return scored


def leaf_boxes(model, encoded: DataFrame, features: str = "features") -> DataFrame:
    """One row per leaf: the part of the feature space that it covers, and its prediction.

    ``low`` (not included) and ``high`` (included) have a bound for each slot, infinite where there is none;
    ``allowed`` has the codes of a slot that was split by sets, null otherwise. Every point lies in one box.
    """
    names = slot_names(encoded, features)
    rows = []
    for i, (path, value) in enumerate(tree_paths(model)):
        slots = max([len(names), *[c[0] + 1 for c in path]])
        low, high = [float("-inf")] * slots, [float("inf")] * slots
        members: list[list[tuple[str, list[float]]]] = [[] for _ in range(slots)]
        for slot, test, wanted in path:
            if test == "<=":
                high[slot] = min(high[slot], wanted)
            elif test == ">":
                low[slot] = max(low[slot], wanted)
            else:
                members[slot].append((test, sorted(wanted)))
        allowed, barred = ([sorted(set.intersection(*own)) if (own := [set(v) for t, v in m if t == "in"]) else None for m in members],
                           [sorted({x for t, v in m if t == "not in" for x in v}) for m in members])
        rows.append((i, low, high, allowed, barred, value))
    schema = "leaf int, low array<double>, high array<double>, allowed array<array<double>>, barred array<array<double>>, prediction double"
    return encoded.sparkSession.createDataFrame(rows, schema)


def score_by_boxes(df: DataFrame, boxes: DataFrame, features: str = "features") -> DataFrame:
    """``df`` with leaf and prediction, by a range join with the boxes of a tree; a tree has at most 2^depth of them.

    Only slots that some box bounds are compared.
    """
    bounds = boxes.agg(*[F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.expr(e))))).alias(name) for name, e in (
        ("ranged", "filter(transform(low, (l, i) -> if(l > double('-Infinity') or high[i] < double('Infinity'), i, -1)), i -> i >= 0)"),
        ("coded", "filter(transform(allowed, (a, i) -> if(a is not null or size(barred[i]) > 0, i, -1)), i -> i >= 0)"))]).first()
    right = broadcast_if_small(boxes.select(*[F.col(c).alias(f"_{c}") for c in boxes.columns]))
    x = F.col("_slots")
    inside = F.lit(True)
    for s in bounds.ranged:
        inside = inside & (x[s] > F.col("_low")[s]) & (x[s] <= F.col("_high")[s])
    for s in bounds.coded:
        inside = inside & (F.col("_allowed")[s].isNull() | F.array_contains(F.col("_allowed")[s], x[s])) & ~F.array_contains(F.col("_barred")[s], x[s])
    joined = df.withColumn("_slots", vector_to_array(features)).join(right, inside, "left")
    return joined.select(*df.columns, F.col("_leaf").alias("leaf"), F.col("_prediction").alias("prediction"))
