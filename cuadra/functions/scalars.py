"""Scalar column functions that fix a format, a default or a direction."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def substring(col: Column, start: int, length: int) -> Column:
    """Part of a text, counted from 1; a number is read as its digits."""
    return F.substring(col.cast("string"), start, length)


def trim(col: Column) -> Column:
    """Blanks off both ends."""
    return F.trim(col)


def parse_day_first(col: Column) -> Column:
    """``dd/MM/yyyy`` to a date; other text becomes null."""
    return F.try_to_date(col, "dd/MM/yyyy")


def parse_yymmdd(col: Column, century: int = 1900) -> Column:
    """Six digits to a date in the given century; a lost leading zero is restored."""
    digits = F.lpad(col.cast("string"), 6, "0")
    return F.try_to_date(F.concat(F.lit(str(century // 100)), digits), "yyyyMMdd")


def to_number(col: Column, to: str = "double") -> Column:
    """Text to number; text that is no number becomes null."""
    return col.try_cast(to)


def flag(cond: Column) -> Column:
    """A test as 0 or 1; an unknown test stays null."""
    return cond.cast("int")


def ratio(a: Column, b: Column) -> Column:
    """``a / b``, null when ``b`` is 0."""
    return F.try_divide(a, b)


def normal_random(mean: float, sd: float, seed: int) -> Column:
    """Normal draws with the given mean and deviation."""
    return F.randn(seed) * sd + mean


def vector_element(col: str | Column, i: int) -> Column:
    """Element ``i`` of a vector column, such as the positive probability."""
    return F.get(vector_to_array(col), F.lit(i))
