"""Equality joins on one key, and joins of series and predictions.

No side is broadcast by a hint: adaptive execution broadcasts a side whose measured size is small
and otherwise shuffles, splitting skewed partitions. Columns of the two sides need distinct names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadra.operators.aggregate import account_summary


def left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    return left.join(right, left[left_key] == right[right_key], "left")


def inner_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Every match gives a row, so repeated keys multiply."""
    return left.join(right, left[left_key] == right[right_key], "inner")


def right_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Keep every right row; left columns are null without a match."""
    return left.join(right, left[left_key] == right[right_key], "right")


def left_join_agg(
    left: DataFrame, left_key: str, detail: DataFrame, key: str, text: str, amount: str, balance: str
) -> DataFrame:
    """Left join to the per-account summary of a detail table; a null key finds nothing."""
    stats = account_summary(detail, key, text, amount, balance).withColumnRenamed(key, "_account")
    return left.join(stats, left[left_key] == stats["_account"], "left").drop("_account")


def align_on_time(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, col: str, out: str) -> DataFrame:
    """Attach a column of another series by date; no match gives null, other dates are dropped."""
    other = right.select(*keys, ts, F.col(col).alias(out))
    return left.join(other, [*keys, ts], "left")


def side_by_side(a: DataFrame, b: DataFrame, key: str, col: str, name_a: str, name_b: str) -> DataFrame:
    """Two prediction columns of the same rows, paired by key."""
    left = a.select(key, F.col(col).alias(name_a))
    return left.join(b.select(key, F.col(col).alias(name_b)), key, "inner")


def prediction_parity(a: DataFrame, b: DataFrame, key: str, col: str, name_a: str, name_b: str) -> DataFrame:
    """``side_by_side`` and the absolute difference."""
    return side_by_side(a, b, key, col, name_a, name_b).withColumn("diff", F.abs(F.col(name_a) - F.col(name_b)))
