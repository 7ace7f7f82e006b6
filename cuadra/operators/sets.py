"""Stacking tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both by column name, duplicates kept."""
    return a.unionByName(b)
