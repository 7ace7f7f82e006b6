import math

import pytest
from pyspark.sql import functions as F

from cuadra.functions import scalars
from cuadra.operators import columns as P


def values(df, col):
    return [r[col] for r in df.collect()]


def test_gender_rule(spark):
    df = spark.createDataFrame([("706213",), ("450204",), ("45204",), (None,)], "birth string")
    assert values(df.select(P.gender_from_birth("birth").alias("g")), "g") == ["mujer", "hombre", "mujer", "mujer"]
    # Without padding the digits of the third number shift.
    assert values(df.select(P.gender_from_birth("birth", pad=False).alias("g")), "g")[2] == "hombre"


def test_gender_rule_reads_integers(spark):
    df = spark.createDataFrame([(706213,), (45204,)], "birth int")
    assert values(df.select(P.gender_from_birth("birth").alias("g")), "g") == ["mujer", "mujer"]


def test_case_when_sends_null_to_default(spark):
    df = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    assert values(df.select(P.case_when("c", {"a": "one", "b": "two"}, "other").alias("r")), "r") == ["one", "two", "other", "other"]


def test_label_in_set(spark):
    df = spark.createDataFrame([("A",), ("B",), ("C",), (None,)], "s string")
    assert values(df.select(P.label_in_set("s", ("A", "C"), "yes", "no").alias("r")), "r") == ["yes", "no", "yes", "no"]


def test_threshold_replaces_the_column(spark):
    df = spark.createDataFrame([(6,), (7,), (8,)], "quality int")
    once = P.threshold_flag(df, "quality", 7)
    assert values(once, "quality") == [0, 1, 1]
    assert values(P.threshold_flag(once, "quality", 7), "quality") == [0, 0, 0]


def test_missing_counts_nan_too(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None), (float("nan"), "b")], "x double, s string")
    assert P.null_counts(df).first().asDict() == {"x": 2, "s": 1}
    assert P.any_null(df).first().asDict() == {"x": True, "s": True}
    assert [tuple(r) for r in P.null_mask(df).collect()] == [(False, False), (True, True), (True, False)]
    assert P.drop_nulls(df).count() == df.na.drop().count() == 1


def test_null_counts_of_an_empty_table(spark):
    assert P.null_counts(spark.createDataFrame([], "x double")).first().x == 0


def test_fill_mean_and_mode(spark):
    df = spark.createDataFrame([(1.0, "b"), (3.0, "a"), (None, None), (float("nan"), "b"), (2.0, "a")], "x double, s string")
    assert values(P.fill_mean(df, "x"), "x") == [1.0, 3.0, 2.0, 2.0, 2.0]
    # Equally frequent: the smallest value wins.
    assert values(P.fill_mode(df, ["s"]), "s") == ["b", "a", "a", "b", "a"]


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("1.5", "x"), ("bad", "y"), (None, "z")], "a string, b string")
    out = P.coerce_numeric(df, ["a"])
    assert values(out, "a") == [1.5, None, None] and values(out, "b") == ["x", "y", "z"]


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a b c` int, `churn.` int")
    assert P.normalize_names(df).columns == ["a_b_c", "churn."]
    assert P.rename(df, "churn.", "churn").columns == ["a b c", "churn"]
    assert P.alias(df, {"churn.": "c"}).columns == ["c"]


def test_drop_nulls_turns_an_outer_join_into_an_inner_one(spark):
    left = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    right = spark.range(50).select(F.col("id").alias("k2"), F.col("id").alias("w"))
    joined = P.drop_nulls(left.join(right, left.k == right.k2, "right"), ["v", "w"])
    assert "RightOuter" not in joined._jdf.queryExecution().optimizedPlan().toString()


def test_scalars(spark):
    df = spark.createDataFrame([("  a ", "31/12/1999", "930704", "x"), ("b", "1999-12-31", "45204", "2")], "t string, d string, y string, n string")
    out = df.select(
        scalars.trim(F.col("t")).alias("t"),
        scalars.parse_day_first(F.col("d")).cast("string").alias("d"),
        scalars.parse_yymmdd(F.col("y")).cast("string").alias("y"),
        scalars.to_number(F.col("n")).alias("n"),
        scalars.substring(F.lit(45204), 3, 2).alias("s"),
        scalars.ratio(F.lit(1.0), F.lit(0.0)).alias("r"),
    ).collect()
    assert tuple(out[0]) == ("a", "1999-12-31", "1993-07-04", None, "20", None)
    assert out[1].d is None and out[1].n == 2.0
    # A lost leading zero: 045204 has no month 52.
    assert out[1].y is None


def test_normal_random(spark):
    got = spark.range(20_000).select(scalars.normal_random(10.0, 2.0, 1).alias("x")).agg(F.avg("x"), F.stddev("x")).first()
    assert got[0] == pytest.approx(10, abs=0.1) and got[1] == pytest.approx(2, abs=0.1)
    assert not math.isnan(got[0])
