"""Reading and writing files: CSV in its variants, and columnar data at a path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
    infer: bool = False,
) -> DataFrame:
    """A CSV table.

    With ``schema`` the columns are taken by position and the header names are ignored. Without it
    all columns are text, or typed from a second pass over the file if ``infer`` is set. Leading
    blanks stay in text.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_timeseries_csv(
    spark: SparkSession, path: str, date_col: str, value_schema: str, fmt: str = "dd/MM/yyyy", sep: str = ",", out: str = "ts"
) -> DataFrame:
    """A CSV whose text column ``date_col`` is parsed by ``fmt`` and becomes the order key ``out``.

    ``value_schema`` lists all columns of the file by position, the date as text.
    """
    rows = read_csv(spark, path, schema=value_schema, sep=sep)
    kept = [c for c in rows.columns if c != date_col]
    return rows.select(F.try_to_date(F.col(date_col), fmt).alias(out), *kept)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", header).option("sep", sep).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_path(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Replace the columnar data at a path. ``fmt`` may name any source that the session has."""
    writer = df.write.mode("overwrite").format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)
