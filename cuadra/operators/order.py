"""Top and bottom rows, edges, sorting, splits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bottom_k(df: DataFrame, col: str, tie: str, k: int = 5) -> DataFrame:
    """The ``k`` smallest, nulls first."""
    return df.orderBy(F.asc_nulls_first(col), F.asc(tie)).limit(k)


def top_k(df: DataFrame, col: str, tie: str, k: int = 5) -> DataFrame:
    """The ``k`` largest, nulls last."""
    return df.orderBy(F.desc_nulls_last(col), F.asc(tie)).limit(k)


def preview(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows of a stated order."""
    return df.orderBy(*order).limit(n)


def edge_rows(df: DataFrame, part: str, ts: str, tie: str, n: int = 5) -> DataFrame:
    """The last ``n`` train rows and the first ``n`` test rows, to look at the cut of a split."""
    last = df.filter(F.col(part) == "train").orderBy(F.desc(ts), F.desc(tie)).limit(n)
    first = df.filter(F.col(part) == "test").orderBy(F.asc(ts), F.asc(tie)).limit(n)
    return last.unionByName(first)


def sort_by_time(df: DataFrame, ts: str, *tie: str) -> DataFrame:
    return df.orderBy(F.asc(ts), *tie)


def rank_features(df: DataFrame, importance: str = "importance", feature: str = "feature") -> DataFrame:
    """Features by falling importance."""
    return df.orderBy(F.desc(importance), F.asc(feature))


def best_by_metric(df: DataFrame, metric: str, tie: str, largest: bool = True) -> DataFrame:
    """The single best row; without a metric a row cannot win."""
    first = F.desc(metric) if largest else F.asc(metric)
    return df.filter(F.col(metric).isNotNull()).orderBy(first, F.asc(tie)).limit(1)


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Random parts. Which rows a part gets depends on the partitioning; ``hash_split`` does not."""
    return df.randomSplit(list(weights), seed)


def hash_bucket(key: str | Column, buckets: int = 100, salt: str = "") -> Column:
    """A bucket from the md5 of the key: the same on every run, partitioning and engine.

    Null is a key of its own and is hashed as a text that no other key has in practice.
    """
    k = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit("\x00null"))
    text = F.concat(F.lit(salt), k) if salt else k
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % F.lit(buckets)


def hash_split(df: DataFrame, key: str, parts: Sequence[tuple[str, float]], out: str = "part", salt: str = "") -> DataFrame:
    """Label rows by key hash; ``parts`` are (name, share) and the shares add up to 1."""
    at, upto, label = F.col("_bucket"), 0.0, None
    for name, share in parts[:-1]:
        upto += share
        cond = at < round(upto * 10_000)
        label = F.when(cond, name) if label is None else label.when(cond, name)
    last = parts[-1][0]
    label = F.lit(last) if label is None else label.otherwise(last)
    return df.withColumn("_bucket", hash_bucket(key, 10_000, salt)).withColumn(out, label).drop("_bucket")


def sample_fraction(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Each row with the given probability."""
    return df.sample(fraction=fraction, seed=seed)


def sample_n(df: DataFrame, key: str, n: int = 100, salt: str = "") -> DataFrame:
    """Exactly min(n, rows) rows, chosen by key hash; another ``salt`` chooses others."""
    return df.orderBy(F.md5(F.concat(F.lit(salt), F.col(key).cast("string"))), F.col(key)).limit(n)
