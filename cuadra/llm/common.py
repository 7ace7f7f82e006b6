"""What the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadra.session import adapt, broadcast_if_small

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Texts travel to Python in batches of this many rows, so that a worker holds a few MB of text.
BATCH_ROWS = 500


def query(name: str, sql: str | None = None):
    """Register a function of (session, data folder) as a query."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(prepared(spark), folder)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return fn

    return register


def prepared(spark: SparkSession) -> SparkSession:
    """Adaptive execution on, and small batches for texts."""
    adapt(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """A text column in which null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def held_out(doc_id: Column) -> Column:
    """The fold that no model may learn from: crc32 of the id as text is a multiple of 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def fresh_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as no column of ``df`` has, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(docs: DataFrame, gone: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The rows of ``docs`` whose keys are not in ``gone``; a null key matches a null key.

    ``gone`` is written first and broadcast only if its measured size allows it.
    """
    names = {k: fresh_name(docs, f"gone_{k}") for k in keys}
    right = broadcast_if_small(gone.select(*[F.col(k).alias(name) for k, name in names.items()]).distinct())
    match = F.lit(True)
    for k, name in names.items():
        match = match & F.col(k).eqNullSafe(F.col(name))
    return docs.join(right, match, "left_anti")
