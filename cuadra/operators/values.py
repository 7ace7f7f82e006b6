"""Which columns are numbers and which values count as missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _is_float(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType))


def missing(df: DataFrame, col: str) -> Column:
    """Null, or NaN in a floating column."""
    return F.col(col).isNull() | F.isnan(col) if _is_float(df, col) else F.col(col).isNull()


def present(df: DataFrame, col: str) -> Column:
    """The value, null where it is missing."""
    return F.when(~missing(df, col), F.col(col)) if _is_float(df, col) else F.col(col)
