"""Catalog tables and views, schema reports, and small frames to and from the driver."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def create_csv_table(
    spark: SparkSession, name: str, path: str, columns: str | None = None, sep: str = ",", header: bool = True, infer: bool = False
) -> DataFrame:
    """A catalog table over CSV files; ``columns`` is a typed SQL column list."""
    cols = f"({columns})" if columns else ""
    options = f"path '{path}', header '{str(header).lower()}', sep '{sep}', inferSchema '{str(infer).lower()}'"
    spark.sql(f"CREATE TABLE {name} {cols} USING csv OPTIONS ({options})")
    return spark.table(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def write_table(df: DataFrame, name: str, mode: str = "errorifexists", path: str | None = None) -> None:
    """Save as a catalog table; by default an existing table is an error."""
    writer = df.write.mode(mode).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def ctas(spark: SparkSession, name: str, query: str, path: str | None = None) -> DataFrame:
    """A table from a query."""
    where = f"LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE {name} USING parquet {where} AS {query}")
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table if there is one, so that a run can be repeated."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_empty_table(spark: SparkSession, name: str, columns: str, path: str | None = None) -> DataFrame:
    where = f"LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {where}")
    return spark.table(name)


def insert_select(source: DataFrame, columns: list[str], name: str) -> None:
    """Append a projection by position.

    Each column is cast to the target's type, and text that does not fit becomes null: the default
    store assignment would refuse text for a number.
    """
    target = source.sparkSession.table(name).schema
    if len(columns) != len(target):
        raise ValueError(f"{name} has {len(target)} columns, {len(columns)} were given")
    cast = [F.col(c).try_cast(f.dataType).alias(f.name) for c, f in zip(columns, target)]
    source.select(*cast).write.insertInto(name)


def create_view(df: DataFrame, name: str) -> None:
    """Name a query for reuse; nothing runs."""
    df.createOrReplaceTempView(name)


def schema_report(df: DataFrame) -> DataFrame:
    """Column names and types as rows."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def from_local(spark: SparkSession, frame: pd.DataFrame, schema: T.StructType | str | None = None) -> DataFrame:
    """A local frame as a distributed one."""
    return spark.createDataFrame(frame, schema=schema)


def collect_small(df: DataFrame, limit: int = 10_000) -> pd.DataFrame:
    """An aggregate or a sample on the driver; more than ``limit`` rows is an error, not a cut."""
    frame = df.limit(limit + 1).toPandas()
    if len(frame) > limit:
        raise ValueError(f"more than {limit} rows: aggregate or sample first")
    return frame
