"""Category codes from a table instead of a list of labels.

The values of all columns are counted in one scan, ordered by frequency across partitions and written as a
table (column, value, count, code). Columns are then coded by joins, so neither the driver nor any task
ever holds all labels of a column. The codes are those of Spark's own indexer: the most frequent value is 0,
ties are in alphabetical order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadra.operators.position import with_position
from cuadra.session import broadcast_if_small, written_once


def code_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """column, value, count and code of every value, written; null has no code."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    counts = df.select(F.inline(cells)).filter("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    return written_once(with_position(counts, [F.desc("count"), "value"], ["column"], name="code"))


def code_counts(codes: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """How many values each column has: one number a column."""
    found = {r.column: r.n for r in codes.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {c: found.get(c, 0) for c in cols}


def with_codes(df: DataFrame, codes: DataFrame, cols: Sequence[str], unseen: str = "error", suffix: str = "_index") -> DataFrame:
    """Add the code of each column as a double.

    A value without a code, null too, stops the query (``error``), drops its row (``skip``), or gets the number
    behind all codes (``keep``). The new columns carry the number of categories as metadata, without their names.
    """
    if unseen not in ("error", "skip", "keep"):
        raise ValueError(f"unknown treatment of unseen values: {unseen!r}")
    sizes = code_counts(codes, cols)
    for c in cols:
        own = broadcast_if_small(codes.filter(F.col("column") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code")))
        df = df.join(own, F.col(c).cast("string") == F.col("_value"), "inner" if unseen == "skip" else "left")
        code, n = F.col("_code").cast("double"), sizes[c]
        if unseen == "keep":
            code, n = F.coalesce(code, F.lit(float(n))), n + 1
        elif unseen == "error":
            stop = F.raise_error(F.concat(F.lit(f"column {c} has a value without a code: "), F.coalesce(F.col(c).cast("string"), F.lit("null"))))
            code = F.coalesce(code, stop.cast("double"))
        meta = {"ml_attr": {"type": "nominal", "name": f"{c}{suffix}", "num_vals": n}}
        df = df.withColumn(f"{c}{suffix}", code.alias(f"{c}{suffix}", metadata=meta)).drop("_value", "_code")
    return df


class CodeModel(Model):
    """Codes columns by a fitted code table; a stage of a pipeline."""

    def __init__(self, codes: DataFrame, cols: Sequence[str], unseen: str, suffix: str):
        super().__init__()
        self.codes, self.cols, self.unseen, self.suffix = codes, list(cols), unseen, suffix

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_codes(dataset, self.codes, self.cols, self.unseen, self.suffix)


class CodeIndexer(Estimator):
    """Fits a ``CodeModel``; in a pipeline it stands where Spark's indexer would."""

    def __init__(self, cols: Sequence[str], unseen: str = "error", suffix: str = "_index"):
        super().__init__()
        self.cols, self.unseen, self.suffix = list(cols), unseen, suffix

    def _fit(self, dataset: DataFrame) -> CodeModel:
        return CodeModel(code_table(dataset, self.cols), self.cols, self.unseen, self.suffix)
