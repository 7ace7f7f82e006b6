"""Trial log and model versions as append-only Parquet tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRIAL_SCHEMA = "run_id string, name string, logged_at timestamp, params map<string,string>, metrics map<string,double>"
STAGE_SCHEMA = "model string, version int, run_id string, stage string, seq bigint"


def trial_log(
    spark: SparkSession, path: str, name: str, params: Mapping[str, object], metrics: Mapping[str, float], run_id: str | None = None
) -> str:
    """Append one run with its parameters and metrics; returns its id."""
    run_id = run_id or uuid.uuid4().hex
    row = (run_id, name, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), {k: str(v) for k, v in params.items()}, dict(metrics))
    spark.createDataFrame([row], TRIAL_SCHEMA).write.mode("append").parquet(path)
    return run_id


def log_trials(runs: DataFrame, path: str) -> None:
    """Append many runs at once from a table with the columns of the log."""
    runs.select("run_id", "name", "logged_at", "params", "metrics").write.mode("append").parquet(path)


def search_trials(spark: SparkSession, path: str, name: str | None = None, metric: str | None = None) -> DataFrame:
    """Logged runs, by name if given, best first if a metric is given."""
    runs = spark.read.schema(TRIAL_SCHEMA).parquet(path)
    if name is not None:
        runs = runs.filter(F.col("name") == name)
    if metric is not None:
        runs = runs.withColumn("metric", F.col("metrics")[metric]).orderBy(F.desc_nulls_last("metric"), "run_id")
    return runs


def stage_event(spark: SparkSession, path: str, model: str, version: int, run_id: str, stage: str, seq: int) -> None:
    """Append one stage change; ``seq`` orders the events of a model."""
    spark.createDataFrame([(model, version, run_id, stage, seq)], STAGE_SCHEMA).write.mode("append").parquet(path)


def model_versions(events: DataFrame) -> DataFrame:
    """Current stage of every model version.

    The last event of a version counts. A version that was promoted to Production before another
    one of the same model is Archived, and stays so when that other one leaves Production later. So a
    model has one Production version at most.
    """
    latest = events.groupBy("model", "version").agg(
        F.max_by("run_id", "seq").alias("run_id"), F.max_by("stage", "seq").alias("stage"), F.max("seq").alias("seq")
    )
    promoted = F.when(F.col("stage") == "Production", F.col("seq"))
    newest = events.groupBy("model").agg(F.max(promoted).alias("_live"))
    stale = (F.col("stage") == "Production") & (F.col("seq") < F.col("_live"))
    return (
        latest.join(newest, "model")
        .withColumn("stage", F.when(stale, "Archived").otherwise(F.col("stage")))
        .select("model", "version", "run_id", "stage", "seq")
    )


def in_production(events: DataFrame) -> DataFrame:
    """The Production version of each model."""
    return model_versions(events).filter(F.col("stage") == "Production")
