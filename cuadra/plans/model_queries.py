"""Queries that encode features, fit models, measure and score.

Where a model has a closed form (a regression on one number, class shares per category) the SQL
computes it. Other models are run for their rows and checked by properties in the tests.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadra.operators import evaluate as E
from cuadra.operators import features as X
from cuadra.operators import models as M
from cuadra.operators import registry as R
from cuadra.operators import search as P
from cuadra.operators.order import hash_bucket, hash_split
from cuadra.plans.registry import Tables, query
from cuadra.plans.table_queries import HOLED_SQL, KEYS, MODEL_COLUMNS, _holed, mining_clean_frame, rounded
from cuadra.session import scratch_path, written_once
from cuadra.sources import files as S

LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _slots(df: DataFrame, n: int, col: str, prefix: str = "s") -> DataFrame:
    arr = vector_to_array(col)
    return df.withColumns({f"{prefix}{i}": F.round(arr[i], 6) + 0.0 for i in range(n)}).drop(col)


# ---- encoding ---------------------------------------------------------------------------------------

PRIORITY_CODES = """
WITH p AS (SELECT o_orderkey, nullif(o_orderpriority, '1-URGENT') AS p FROM orders),
codes AS (SELECT p, CAST(row_number() OVER (ORDER BY count(*) DESC, p) - 1 AS DOUBLE) AS code FROM p WHERE p IS NOT NULL GROUP BY p)
"""


def _priorities(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("p"))


@query(PRIORITY_CODES + "SELECT o_orderkey, p.p, code AS p_index FROM p JOIN codes ON p.p = codes.p")
def index_labels(t):
    rows = _priorities(t)
    return X.fit_stages([X.index_by_counts(["p"], unseen="skip")], rows).transform(rows)


@query(PRIORITY_CODES + """
SELECT o_orderkey, CAST(code = 0 AS INT) + 0.0::DOUBLE AS s0, CAST(code = 1 AS INT) + 0.0::DOUBLE AS s1, CAST(code = 2 AS INT) + 0.0::DOUBLE AS s2
FROM p JOIN codes ON p.p = codes.p""")
def one_hot_drop_last(t):
    rows = _priorities(t)
    encoded = X.fit_stages([X.index_by_counts(["p"], unseen="skip"), X.one_hot(["p"])], rows).transform(rows)
    return _slots(encoded.select("o_orderkey", "p_vec"), 3, "p_vec")


@query("""
WITH codes AS (SELECT o_orderpriority AS p, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS code
               FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY o_orderpriority)
SELECT o_orderkey, CAST(coalesce(code, 4) = 0 AS INT) + 0.0::DOUBLE AS s0, CAST(coalesce(code, 4) = 1 AS INT) + 0.0::DOUBLE AS s1,
       CAST(coalesce(code, 4) = 2 AS INT) + 0.0::DOUBLE AS s2, CAST(coalesce(code, 4) = 3 AS INT) + 0.0::DOUBLE AS s3,
       CAST(coalesce(code, 4) = 4 AS INT) + 0.0::DOUBLE AS s4
FROM orders LEFT JOIN codes ON o_orderpriority = p""")
def one_hot_indicator(t):
    """Fitted without one category, which then falls into the slot for unseen values."""
    rows = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("p"))
    encoded = X.fit_stages(X.one_hot_indicator(["p"], X.index_by_counts), rows.filter(F.col("p") != "5-LOW")).transform(rows)
    return _slots(encoded.select("o_orderkey", "p_vec"), 5, "p_vec")


@query("SELECT p_partkey, p_size + 0.0::DOUBLE AS s0, p_retailprice AS s1 FROM part")
def assemble(t):
    return _slots(X.assemble(["p_size", "p_retailprice"]).transform(t.part).select("p_partkey", "features"), 2, "features")


@query(HOLED_SQL + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(coalesce(discount, (SELECT avg(discount) FROM holed)), 6) AS discount,
       round(coalesce(tax, (SELECT avg(tax) FROM holed)), 6) AS tax
FROM holed""")
def impute_mean(t):
    rows = _holed(t).select(*LINE, "discount", "tax")
    return rounded(X.impute_mean(["discount", "tax"]).fit(rows).transform(rows), ["discount", "tax"])


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem), 6) + 0.0 AS l_quantity
FROM lineitem""")
def standardize_population(t):
    scaled = X.standardize_columns(t.lineitem.select(*LINE, "l_quantity"), ["l_quantity"], ddof=0)
    return scaled.withColumn("l_quantity", F.round("l_quantity", 6) + 0.0)


@query("""
SELECT p_partkey, round((p_size - (SELECT avg(p_size) FROM part)) / (SELECT stddev_samp(p_size) FROM part), 6) + 0.0 AS s0,
       round((p_retailprice - (SELECT avg(p_retailprice) FROM part)) / (SELECT stddev_samp(p_retailprice) FROM part), 6) + 0.0 AS s1
FROM part""")
def standardize_vector(t):
    rows = X.assemble(["p_size", "p_retailprice"]).transform(t.part).select("p_partkey", "features")
    return _slots(X.standardize_vector().fit(rows).transform(rows).drop("features"), 2, "scaled")


@query(HOLED_SQL + """
, codes AS (SELECT flag, row_number() OVER (ORDER BY count(*) DESC, flag) - 1 AS code FROM holed WHERE flag IS NOT NULL GROUP BY flag),
filled AS (SELECT * REPLACE (coalesce(discount, (SELECT avg(discount) FROM holed)) AS discount) FROM holed)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(coalesce(code, 2) = 0 AS INT) + 0.0::DOUBLE AS s0,
       CAST(coalesce(code, 2) = 1 AS INT) + 0.0::DOUBLE AS s1, CAST(coalesce(code, 2) = 2 AS INT) + 0.0::DOUBLE AS s2,
       round((discount - (SELECT avg(discount) FROM filled)) / (SELECT stddev_samp(discount) FROM filled), 6) + 0.0 AS s3,
       round((quantity - (SELECT avg(quantity) FROM filled)) / (SELECT stddev_samp(quantity) FROM filled), 6) + 0.0 AS s4
FROM filled LEFT JOIN codes USING (flag)""")
def column_features(t):
    rows = _holed(t)
    encoded = X.fit_stages(X.column_features(["discount", "quantity"], ["flag"], scale=True, unseen="keep", indexer=X.index_by_counts), rows).transform(rows)
    return _slots(encoded.select(*LINE, "features"), 5, "features")


# ---- classifiers --------------------------------------------------------------------------------------


def _status_rows(t: Tables) -> DataFrame:
    lines = t.lineitem.select(*LINE, "l_returnflag", F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0).alias("label"))
    stages = [X.index_labels(["l_returnflag"]), X.one_hot(["l_returnflag"]), X.assemble(["l_returnflag_vec"])]
    return X.fit_stages(stages, lines).transform(lines)


@query("""
WITH s AS (SELECT l_returnflag, avg(CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END) AS p FROM lineitem GROUP BY l_returnflag)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(p, 4) AS score FROM lineitem JOIN s USING (l_returnflag)""")
def logistic_regression(t):
    """On one category the fitted probability is the share of class 1 in it."""
    rows = _status_rows(t)
    model = M.logistic_regression("label", tol=1e-12, maxIter=200).fit(rows)
    return rounded(M.positive_probability(model.transform(rows)).select(*LINE, "score"), ["score"], 4)


@query("""
WITH s AS (SELECT l_quantity, CASE WHEN avg(CASE WHEN l_extendedprice > 40000 THEN 1.0 ELSE 0.0 END) > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
           FROM lineitem GROUP BY l_quantity)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, prediction FROM lineitem JOIN s USING (l_quantity)""")
def decision_tree(t):
    """On one column with few values the tree finds the larger class of each value."""
    label = F.when(F.col("l_extendedprice") > 40_000, 1.0).otherwise(0.0)
    rows = X.assemble(["l_quantity"]).transform(t.lineitem.select(*LINE, "l_quantity", label.alias("label")))
    return M.decision_tree("label", bins=64).fit(rows).transform(rows).select(*LINE, "prediction")


def _quality_rows(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "lang", "source", "n_chars").join(t.labels.select("doc_id", "quality"), "doc_id")


def _quality_features() -> list:
    return X.column_features(["n_chars"], ["lang", "source"], unseen="keep")


def _quality_encoded(t: Tables) -> DataFrame:
    rows = _quality_rows(t)
    encoded = X.fit_stages(_quality_features(), rows).transform(rows)
    marked = encoded.select("doc_id", F.col("quality").cast("double").alias("quality"), "features")
    return written_once(hash_split(marked, "doc_id", [("train", 0.6), ("val", 0.2), ("test", 0.2)]))


def _candidate_rows(t: Tables) -> DataFrame:
    # A key of whole numbers: the averages differ in their last digits from run to run.
    return mining_clean_frame(t).withColumn("row_key", F.concat_ws("-", *KEYS))


def _candidates(t: Tables) -> DataFrame:
    return written_once(_candidate_rows(t))


def _candidate_features() -> list:
    categories = ["region", "frequency", "operation"]
    numbers = [c for c in MODEL_COLUMNS if c not in categories]
    return [X.index_labels(["candidate"]), *X.column_features(numbers, categories)]


@query()
def gbt_classifier(t):
    label = "candidate_index"
    # The parts are written with the rows, so no pass has to hash their keys again.
    parts = written_once(hash_split(_candidate_rows(t), "row_key", [("train", 0.7), ("test", 0.3)]))
    train = parts.filter(F.col("part") == "train")
    model = M.fit_stages_encoded([*_candidate_features(), M.gbt_classifier(label, seed=1)], train, train.count())
    scored = M.positive_probability(model.transform(parts.filter(F.col("part") == "test")))
    # Written, since the filter on missing scores would be pushed down with the model in it and score each row again.
    return E.auc_prob(written_once(scored.select(label, "score")), label, "score")


@query()
def random_forest(t):
    rows = _quality_encoded(t)
    model = M.random_forest("quality").fit(rows.filter(F.col("part") == "train"))
    return M.positive_probability(model.transform(rows)).select("doc_id", "part", "quality", "score")


@query()
def boosted_classifier(t):
    rows = _quality_encoded(t)
    part = {p: rows.filter(F.col("part") == p) for p in ("train", "val", "test")}
    model = M.fit_with_patience(M.boosted_classifier("quality", seed=1), part["train"], part["val"], patience=50)
    scored = M.positive_probability(model.transform(part["test"]))
    return E.auc_prob(scored, "quality", "score").withColumn("rounds", F.lit(model.getNumTrees))


@query()
def holdout_candidates(t):
    rows = _candidates(t)
    table, _, _ = M.repeated_holdout(
        rows, [*_candidate_features(), M.decision_tree("candidate_index")], "candidate_index", "row_key"
    )
    return table


@query()
def compare_models(t):
    rows = _quality_rows(t).withColumn("quality", F.col("quality").cast("double"))
    models = {
        "logistic": M.logistic_regression("quality"), "tree": M.decision_tree("quality"), "boosted": M.gbt_classifier("quality", seed=1),
    }
    return M.compare_models(rows, _quality_features(), models, "quality", "doc_id")


def _with_figures(found: P.Found) -> DataFrame:
    """The trials, each with the figures of the best model on all three parts."""
    return found.trials.join(F.broadcast(found.metrics), how="cross")  # one row


@query()
def random_search(t):
    split, _ = P.split_once(_quality_rows(t), "doc_id", "quality", _quality_features())
    return _with_figures(P.search_boosted(split, "doc_id", "quality", P.BOOSTED_SPACE, M.gbt_classifier("quality", seed=1)))


CLOSED_SPACE = {"stepSize": P.log_uniform(-3, -0.5), "maxIter": P.uniform_int(2, 20)}
CLOSED_TRIALS = P.draw_trials(CLOSED_SPACE, 12, 123)


def _closed_rows(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.concat_ws("-", *LINE).alias("row_key"), F.col("l_linenumber").cast("double").alias("x"),
        F.when(F.col("l_quantity") % 10 < F.col("l_linenumber"), 1).otherwise(0).alias("label"))


# Boosting on one column with few values: each round every value gets the mean of its gradients.
CLOSED_SQL = f"""
WITH RECURSIVE r AS (
  SELECT l_linenumber AS x, CAST(l_quantity % 10 < l_linenumber AS INT) AS y,
         ('0x' || substr(md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 8))::BIGINT % 10000 AS bucket
  FROM lineitem),
cells AS (SELECT x, CASE WHEN bucket < 6000 THEN 'train' WHEN bucket < 8000 THEN 'val' ELSE 'test' END AS part, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS pos
          FROM r GROUP BY ALL),
shares AS (SELECT x, pos / n AS p FROM cells WHERE part = 'train'),
trials(trial, params, step, rounds) AS (VALUES {", ".join(f"({i}, '{P.params_text(d)}', {d['stepSize']!r}::DOUBLE, {d['maxIter']})" for i, d in enumerate(CLOSED_TRIALS))}),
boost AS (
  SELECT trial, step, rounds, x, p, 1 AS t, 2 * p - 1 AS f FROM shares, trials
  UNION ALL
  SELECT trial, step, rounds, x, p, t + 1, f + step * (p * 4 / (1 + exp(2 * f)) - (1 - p) * 4 / (1 + exp(-2 * f))) FROM boost WHERE t < rounds),
scored AS (SELECT trial, x, 1 / (1 + exp(-2 * f)) AS s FROM boost WHERE t = rounds),
each AS (SELECT trial, part, n, pos, n - pos AS neg, s FROM cells JOIN scored USING (x)),
auc AS (SELECT a.trial, a.part, sum(a.pos * b.neg * CASE WHEN a.s > b.s THEN 1 WHEN a.s = b.s THEN 0.5 ELSE 0 END) / sum(a.pos * b.neg) AS auc
        FROM each a JOIN each b ON a.trial = b.trial AND a.part = b.part GROUP BY ALL),
figures AS (
  SELECT trial, part, sum(n) AS n_rows, sum(CASE WHEN s >= 0.5 THEN pos ELSE neg END) / sum(n) AS accuracy,
         sum(CASE WHEN s >= 0.5 THEN pos END) / sum(CASE WHEN s >= 0.5 THEN n END) AS precision,
         coalesce(sum(CASE WHEN s >= 0.5 THEN pos END), 0) / sum(pos) AS recall,
         -sum(pos * ln(s) + neg * ln(1 - s)) / sum(n) AS log_loss, auc.auc AS roc_auc
  FROM each JOIN auc USING (trial, part) GROUP BY trial, part, auc.auc),
best AS (SELECT trial AS best FROM figures WHERE part = 'val' ORDER BY log_loss, trial LIMIT 1),
wide AS (SELECT {", ".join(f"max(CASE WHEN part = '{p}' THEN {c} END) AS {p}_{c}" for p in ("train", "val", "test") for c in ("n_rows", "accuracy", "recall", "log_loss", "roc_auc"))}
         FROM figures JOIN best ON trial = best)
SELECT t.trial, 'boosted' AS model, t.params, round(v.log_loss, 6) AS val_trial_log_loss, t.trial = best AS best,
       {", ".join(f"{p}_n_rows::BIGINT AS {p}_n_rows, " + ", ".join(f"round({p}_{c}, 6) AS {p}_{c}" for c in ("accuracy", "recall", "log_loss", "roc_auc")) for p in ("train", "val", "test"))}
FROM trials t JOIN figures v ON v.trial = t.trial AND v.part = 'val', best, wide
"""


@query(CLOSED_SQL)
def search_trials(t):
    """All trials of a search and the figures of its best model, where boosting has a closed form."""
    split, _ = P.split_once(_closed_rows(t), "row_key", "label", [X.assemble(["x"])])
    found = P.search_boosted(split, "row_key", "label", CLOSED_SPACE, M.gbt_classifier("label", depth=6, seed=1), metric="log_loss")
    measures = [f"{p}_{c}" for p in ("train", "val", "test") for c in ("accuracy", "recall", "log_loss", "roc_auc")]
    rows = _with_figures(found)
    return rounded(rows.select("trial", "model", "params", "val_trial_log_loss", "best", *[f"{p}_n_rows" for p in ("train", "val", "test")], *measures),
                   ["val_trial_log_loss", *measures])


def _closed_parts(expr: str, count: int) -> str:
    """SQL for the rows of the closed forms with a part for each of ``count`` salted splits; ``expr`` cuts the bucket."""
    return ", ".join(f"""CASE WHEN ('0x' || substr(md5('{i}:' || concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 8))::BIGINT % 10000 < {expr} THEN 'train' ELSE 'test' END AS p{i}"""
                     for i in range(count))


# A tree that can tell all values of its column apart calls the larger class of each, of equal ones the 0.
HOLDOUT_SQL = f"""
WITH r AS (SELECT l_linenumber AS x, CAST(l_quantity % 10 < l_linenumber AS INT) AS y, {_closed_parts("7000", 3)} FROM lineitem),
long AS (SELECT 0 AS split, x, y, p0 AS part FROM r UNION ALL SELECT 1, x, y, p1 FROM r UNION ALL SELECT 2, x, y, p2 FROM r),
calls AS (SELECT split, x, CAST(avg(y) > 0.5 AS INT) AS call FROM long WHERE part = 'train' GROUP BY ALL),
aucs AS (SELECT split, (avg(CASE WHEN y = 1 THEN call END) + avg(CASE WHEN y = 0 THEN 1 - call END)) / 2 AS auc
         FROM long JOIN calls USING (split, x) WHERE part = 'test' GROUP BY split)
"""


@query(HOLDOUT_SQL + "SELECT split, round(auc, 8) AS auc, round(avg(auc) OVER (), 8) AS mean_auc FROM aucs")
def holdout_closed(t):
    """Repeated random splits of a tree whose calls have a closed form."""
    table, _, _ = M.repeated_holdout(_closed_rows(t), [X.assemble(["x"]), M.decision_tree("label", depth=6)], "label", "row_key")
    return rounded(table, ["auc", "mean_auc"], 8)


@query(HOLDOUT_SQL + "SELECT m AS model, round((SELECT avg(auc) FROM aucs), 8) AS mean_auc, round((SELECT max(auc) FROM aucs), 8) AS best_auc FROM (VALUES ('boosted'), ('tree')) v(m)")
def compare_closed(t):
    """Two models that must agree on such a column: a tree, and boosting, whose first tree is the same."""
    models = {"tree": M.decision_tree("label", depth=6), "boosted": M.gbt_classifier("label", rounds=1, depth=6, seed=1)}
    return rounded(M.compare_models(_closed_rows(t), [X.assemble(["x"])], models, "label", "row_key"), ["mean_auc", "best_auc"], 8)


@query("""
WITH RECURSIVE shares AS (SELECT l_linenumber AS x, avg(CAST(l_quantity % 10 < l_linenumber AS INT)) AS p FROM lineitem GROUP BY 1),
boost AS (SELECT x, p, 1 AS t, 2 * p - 1 AS f FROM shares
          UNION ALL SELECT x, p, t + 1, f + 0.1 * (p * 4 / (1 + exp(2 * f)) - (1 - p) * 4 / (1 + exp(-2 * f))) FROM boost WHERE t < 25)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(1 / (1 + exp(-2 * f)), 6) AS score FROM lineitem JOIN boost ON x = l_linenumber WHERE t = 25""")
def boosted_scores(t):
    """The probabilities of 25 rounds of boosting on one column with few values."""
    rows = X.assemble(["x"]).transform(_closed_rows(t).withColumn("l", F.split("row_key", "-")))
    model = M.fit_collapsed(M.gbt_classifier("label", rounds=25, depth=6, seed=1), rows)
    scored = M.positive_probability(model.transform(rows))
    return rounded(scored.select(*[F.get("l", F.lit(i)).cast(kind).alias(c) for i, (c, kind) in enumerate((c, t.lineitem.schema[c].dataType) for c in LINE)], "score"), ["score"])


@query("""
WITH m AS (SELECT l_linenumber, avg(l_extendedprice) AS prediction FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(prediction, 4) AS prediction FROM lineitem JOIN m USING (l_linenumber)""")
def boosted_means(t):
    """Boosting a number on one column with few values ends at the mean of each value."""
    rows = X.assemble(["l_linenumber"]).transform(t.lineitem.select(*LINE, F.col("l_extendedprice").alias("label")))
    model = M.fit_collapsed(M.boosted_regressor("label", rounds=3, depth=6, rows_share=1.0, features_share="all", min_rows=1, seed=1), rows)
    return rounded(model.transform(rows).select(*LINE, "prediction"), ["prediction"], 4)


@query()
def auto_classify(t):
    # As many places as sources and languages can fill without most of them meeting.
    found, _ = P.auto_search(_quality_rows(t), "quality", "doc_id", "classification", slots=1024)
    return _with_figures(found)


@query()
def auto_regress(t):
    lines = t.lineitem.select(
        "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_extendedprice", F.concat_ws("-", *LINE).alias("row_key"))
    found, _ = P.auto_search(lines, "l_extendedprice", "row_key", "regression", slots=64)
    return _with_figures(found)


@query()
def boosted_regressor(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    rows = X.assemble(["l_quantity", "l_discount", "p_retailprice", "p_size"]).transform(joined)
    marked = written_once(
        rows.select(F.col("l_extendedprice").alias("label"), "features", (hash_bucket("l_orderkey") < 20).alias("is_val"))
    )
    model = M.fit_with_patience(M.boosted_regressor("label", seed=1), marked.filter("NOT is_val"), marked.filter("is_val"), patience=5)
    return E.regression_metrics(model.transform(marked), "label", keys=["is_val"])


# ---- clusters -------------------------------------------------------------------------------------------


def _vectors(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", F.col("label").alias("prediction"), array_to_vector("embedding").alias("features"))


@query()
def kmeans(t):
    rows = _vectors(t).drop("prediction")
    scored = M.kmeans(k=5, seed=1).fit(rows).transform(rows)
    return scored.select("vec_id", "prediction")


ELEMENTS = 64  # of each embedding


@query(f"SELECT label AS prediction, count(*) AS n_rows, {', '.join(f'round(avg(embedding[{i + 1}]::DOUBLE), 6) AS avg_e{i}' for i in range(ELEMENTS))}, "
       "round(avg(vec_id), 4) AS avg_vec_id FROM embeddings GROUP BY label")
def cluster_profile(t):
    elements = [F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(ELEMENTS)]
    rows = t.embeddings.select("vec_id", F.col("label").alias("prediction"), *elements)
    names = [f"e{i}" for i in range(ELEMENTS)]
    return rounded(rounded(M.cluster_profile(rows, [*names, "vec_id"]), [f"avg_{n}" for n in names]), ["avg_vec_id"], 4)


@query("""
WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
d AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.v, b.v) ** 2) AS s, count(*) AS n
      FROM e a, e b GROUP BY ALL),
m AS (SELECT vec_id, max(CASE WHEN label = other THEN s / (n - 1) END) AS a, min(CASE WHEN label <> other THEN s / n END) AS b FROM d GROUP BY vec_id)
SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM m""")
def silhouette(t):
    value = M.silhouette(_vectors(t))
    return rounded(M.metric_rows(t.spark, [(value,)], "silhouette double"), ["silhouette"])


# ---- measures ------------------------------------------------------------------------------------------------


def _scored_lines(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"),
        F.round(F.col("l_discount") * 10, 1).alias("score"),
        F.when(F.col("l_discount") > 0.05, 1.0).otherwise(0.0).alias("prediction"),
        "l_linestatus",
    )


SCORED = """
WITH s AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, round(l_discount * 10, 1) + 0.0 AS score,
                  CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS prediction, l_linestatus FROM lineitem),
c AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM s GROUP BY score),
r AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp FROM c)
"""
HARD = "round((avg(prediction) FILTER (label = 1) + avg(1 - prediction) FILTER (label = 0)) / 2, 8) AS auc"


@query(SCORED + f"SELECT {HARD} FROM s")
def auc_hard(t):
    value = M.auc_hard(_scored_lines(t), "label")
    return rounded(M.metric_rows(t.spark, [(value,)], "auc double"), ["auc"], 8)


@query(SCORED + f"SELECT l_linestatus, {HARD} FROM s GROUP BY l_linestatus")
def auc_hard_by_group(t):
    return rounded(E.auc_hard_table(_scored_lines(t), "label", "prediction", ["l_linestatus"]), ["auc"], 8)


@query(SCORED + "SELECT round(sum(neg * (tp - pos + pos / 2.0)) / (sum(pos) * sum(neg)), 8) AS auc FROM r")
def auc_prob(t):
    return rounded(E.auc_prob(_scored_lines(t), "label", "score"), ["auc"], 8)


@query(SCORED + """
SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT score + 0.0, round(fp / (SELECT sum(neg) FROM c), 8), round(tp / (SELECT sum(pos) FROM c), 8) FROM r""")
def roc_curve(t):
    curve = rounded(E.roc_curve(_scored_lines(t), "label", "score"), ["fpr", "tpr"], 8)
    return curve.withColumn("threshold", F.col("threshold") + 0.0)


@query("""
WITH p AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 2000 AS f FROM lineitem)
SELECT l_returnflag, round(1 - sum((y - f) ** 2) / (var_pop(y) * count(*)), 6) AS r2, round(sqrt(avg((y - f) ** 2)), 4) AS rmse,
       round(avg((y - f) ** 2), 1) AS mse, round(avg(abs(y - f)), 4) AS mae
FROM p GROUP BY l_returnflag""")
def regression_metrics(t):
    scored = t.lineitem.select("l_returnflag", F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 2000).alias("prediction"))
    m = E.regression_metrics(scored, "y", keys=["l_returnflag"])
    return rounded(rounded(rounded(m, ["r2"]), ["rmse", "mae"], 4), ["mse"], 1)


# ---- fitted trees as tables -------------------------------------------------------------------------------------


def _candidate_tree(t: Tables):
    rows = _candidates(t)
    model = X.fit_stages([*_candidate_features(), M.decision_tree("candidate_index")], rows)
    return model.stages[-1], model.transform(rows)


@query()
def feature_importance(t):
    tree, scored = _candidate_tree(t)
    return E.feature_importance(tree, scored)


@query()
def tree_rules(t):
    tree, scored = _candidate_tree(t)
    return E.tree_rules(tree, scored)


@query("SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM lineitem JOIN part ON l_partkey = p_partkey")
def rules_match_model(t):
    """The rules read from a fitted tree score every row as the tree does."""
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    rows = joined.withColumn("label", F.when(F.col("l_extendedprice") > 40_000, 1.0).otherwise(0.0))
    stages = X.column_features(["l_quantity", "p_retailprice", "p_size"], ["p_type", "l_returnflag"])
    model = X.fit_stages([*stages, M.decision_tree("label", depth=6)], written_once(rows))
    scored = model.transform(rows).withColumn("by_rules", E.score_by_rules(model.stages[-1]))
    different = F.sum((~F.col("by_rules").eqNullSafe(F.col("prediction"))).cast("long"))
    return scored.agg(F.count(F.lit(1)).alias("n_rows"), different.alias("n_different"))


# Of each quantity the larger class; leaves may be cut anywhere between two quantities.
LARGER_CLASS = """
WITH s AS (SELECT l_quantity, CASE WHEN avg(CASE WHEN l_extendedprice > 40000 THEN 1.0 ELSE 0.0 END) > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
           FROM lineitem GROUP BY l_quantity)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, prediction FROM lineitem JOIN s USING (l_quantity)"""


def _quantity_tree(t: Tables):
    label = F.when(F.col("l_extendedprice") > 40_000, 1.0).otherwise(0.0)
    rows = X.assemble(["l_quantity"]).transform(t.lineitem.select(*LINE, "l_quantity", label.alias("label")))
    return rows, M.decision_tree("label", bins=64).fit(rows)


@query(LARGER_CLASS)
def rules_predictions(t):
    """Every row scored by the rules that were read from the tree."""
    rows, tree = _quantity_tree(t)
    return rows.select(*LINE, E.score_by_rules(tree).alias("prediction"))


@query(LARGER_CLASS)
def boxes_predictions(t):
    """Every row scored by a range join with the leaves as boxes."""
    rows, tree = _quantity_tree(t)
    return E.score_by_boxes(rows, E.leaf_boxes(tree, rows)).select(*LINE, "prediction")


# ---- scoring stored tables ------------------------------------------------------------------------------------------

LINEAR = """
WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(a + b * l_quantity, 3) AS prediction FROM lineitem, m"""


def _linear_model(t: Tables):
    rows = t.lineitem.select("l_quantity", F.col("l_extendedprice").alias("label"))
    return X.fit_stages([X.assemble(["l_quantity"]), LinearRegression(solver="normal")], rows)


@query(LINEAR)
def batch_score(t):
    """A saved and reloaded model on a stored table."""
    path = scratch_path(t.spark, "to-score")
    S.write_path(t.lineitem.select(*LINE, "l_quantity"), path)
    model = M.save_and_load(_linear_model(t))
    return rounded(M.batch_score(model, S.read_path(t.spark, path), LINE), ["prediction"], 3)


@query(LINEAR)
def score_by_signature(t):
    return rounded(M.score_by_signature(_linear_model(t), ["l_quantity"], t.lineitem, LINE), ["prediction"], 3)


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity * 3 + l_tax, 4) AS prediction FROM lineitem")
def model_udf(t):
    """A predictor that is not Spark's own, on Arrow batches of one struct column."""
    predict = M.model_udf(lambda frame: frame["l_quantity"] * 3 + frame["l_tax"])
    packed = t.lineitem.select(*LINE, F.struct("l_quantity", "l_tax").alias("inputs"))
    return rounded(packed.select(*LINE, predict(F.col("inputs")).alias("prediction")), ["prediction"], 4)


# ---- trial log and model versions ----------------------------------------------------------------------------------------


@query("SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderpriority AS name, o_orderstatus AS status, o_totalprice AS metric FROM orders WHERE o_orderpriority = '2-HIGH'")
def trial_log(t):
    path = scratch_path(t.spark, "trials")
    runs = t.orders.select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderdate").cast("timestamp").alias("logged_at"),
        F.create_map(F.lit("status"), "o_orderstatus").alias("params"),
        F.create_map(F.lit("auc"), "o_totalprice").alias("metrics"),
    )
    R.log_trials(runs, path)
    found = R.search_trials(t.spark, path, name="2-HIGH", metric="auc")
    return found.select("run_id", "name", F.col("params")["status"].alias("status"), "metric")


STAGES = """
WITH e AS (SELECT CAST(o_custkey AS VARCHAR) AS model, CAST(o_orderkey % 4 AS INT) AS version, CAST(o_orderkey AS VARCHAR) AS run_id,
                  CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Staging' ELSE 'Archived' END AS stage, o_orderkey AS seq
           FROM orders),
p AS (SELECT model, max(seq) AS promoted FROM e WHERE stage = 'Production' GROUP BY model),
l AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY model, version ORDER BY seq DESC) = 1),
v AS (SELECT model, version, run_id, CASE WHEN stage = 'Production' AND seq < promoted THEN 'Archived' ELSE stage END AS stage, seq
      FROM l LEFT JOIN p USING (model))
"""


def _stage_events(t: Tables) -> DataFrame:
    stage = F.when(F.col("o_orderstatus") == "F", "Production").when(F.col("o_orderstatus") == "O", "Staging").otherwise("Archived")
    return t.orders.select(
        F.col("o_custkey").cast("string").alias("model"),
        (F.col("o_orderkey") % 4).cast("int").alias("version"),
        F.col("o_orderkey").cast("string").alias("run_id"),
        stage.alias("stage"),
        F.col("o_orderkey").alias("seq"),
    )


@query(STAGES + "SELECT * FROM v")
def model_versions(t):
    return R.model_versions(_stage_events(t))


@query(STAGES + "SELECT * FROM v WHERE stage = 'Production'")
def production_models(t):
    return R.in_production(_stage_events(t))
