"""Projections, recodes, predicates and missing values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuadra.operators.aggregate import missing, most_frequent


def select_cols(df: DataFrame, *cols: str | Column) -> DataFrame:
    return df.select(*cols)


def alias(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the columns of ``{old: new}`` under their new names."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def rename(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename one column; its old name may contain a dot."""
    return df.withColumnRenamed(old, new)


def normalize_names(df: DataFrame) -> DataFrame:
    """Every blank in every column name becomes ``_``."""
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def drop_cols(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def with_column(df: DataFrame, name: str, expr: str | Column) -> DataFrame:
    """Add or replace a column by an expression or a copy of another column."""
    return df.withColumn(name, F.col(expr) if isinstance(expr, str) else expr)


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def case_when(col: str | Column, mapping: Mapping[str, str], default: str) -> Column:
    """Recode values; whatever is not listed, null included, becomes ``default``."""
    c = F.col(col) if isinstance(col, str) else col
    branches = reduce(lambda acc, kv: acc.when(c == kv[0], kv[1]), mapping.items(), F)
    return branches.otherwise(default)


def gender_from_birth(col: str | Column, pad: bool = True) -> Column:
    """``hombre`` when digits 3 and 4 of the birth number are at most '50', else ``mujer``.

    The comparison is of text. ``pad`` restores a leading zero lost by reading the number as an
    integer.
    """
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    digits = F.lpad(text, 6, "0") if pad else text
    return F.when(F.substring(digits, 3, 2) <= "50", "hombre").otherwise("mujer")


def label_in_set(col: str | Column, values: Sequence[str], yes: str, no: str) -> Column:
    """Two-class label by membership; null is not a member."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isin(*values), yes).otherwise(no)


def threshold_flag(df: DataFrame, col: str, at: float) -> DataFrame:
    """Replace ``col`` by 1 where it reaches ``at``, else 0."""
    return df.withColumn(col, F.when(F.col(col) >= at, 1).otherwise(0))


def filter_eq(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))


def null_mask(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """The same cells as true where missing."""
    return df.select(*[missing(df, c).alias(c) for c in cols or df.columns])


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: missing cells per column."""
    return df.agg(*[F.coalesce(F.sum(missing(df, c).cast("long")), F.lit(0)).alias(c) for c in cols or df.columns])


def any_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: whether each column has a missing cell."""
    return df.agg(*[F.coalesce(F.bool_or(missing(df, c)), F.lit(False)).alias(c) for c in cols or df.columns])


def drop_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any missing cell.

    One test per column, joined by AND: the optimizer can push each below an outer join and then
    turn that join into an inner one, which it cannot do with ``na.drop``.
    """
    tests = [~missing(df, c) for c in cols or df.columns]
    return df.filter(reduce(lambda a, b: a & b, tests))


def fill_mean(df: DataFrame, col: str) -> DataFrame:
    """Missing cells become the mean of the column."""
    mean = df.agg(F.avg(F.when(~missing(df, col), F.col(col))).alias("_mean"))
    filled = F.when(missing(df, col), F.col("_mean")).otherwise(F.col(col))
    return df.crossJoin(F.broadcast(mean)).withColumn(col, filled).drop("_mean")


def fill_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing cells become the most frequent value of their column."""
    modes = most_frequent(df, cols).select(*[F.col(c).alias(f"_mode_{c}") for c in cols])
    filled = {c: F.when(missing(df, c), F.col(f"_mode_{c}")).otherwise(F.col(c)) for c in cols}
    return df.crossJoin(F.broadcast(modes)).withColumns(filled).select(*df.columns)


def coerce_numeric(df: DataFrame, cols: Sequence[str] | None = None, to: str = "double") -> DataFrame:
    """Text to number in every listed column; text that is no number becomes null."""
    wanted = set(cols if cols is not None else df.columns)
    return df.select(*[F.col(c).try_cast(to).alias(c) if c in wanted else F.col(c) for c in df.columns])


def select_supported(df: DataFrame, supported: Sequence[str]) -> DataFrame:
    """Keep a fixed feature list, whatever else the table has."""
    return df.select(*supported)


def pack_struct(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    """Pack columns into one struct, the shape a model input takes."""
    return df.withColumn(out, F.struct(*cols))
