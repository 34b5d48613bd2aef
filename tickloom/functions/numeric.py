"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round the decimal image of a double half up.

    Values outside DECIMAL(38,9), NaN included, fall back to plain ``round`` so that
    a very large sum is still answered.
    """
    exact = F.round(value.try_cast("decimal(38,9)"), digits).cast("double")
    return F.coalesce(exact, F.round(value, digits))


# JSON's bare non-numbers, which Spark hands over in quotes.
QUOTED_NON_NUMBERS = ('"NaN"', '"Infinity"', '"+Infinity"', '"-Infinity"', '"INF"', '"+INF"', '"-INF"')


def to_number(text: Column) -> Column:
    """Text to double, NULL when it is not a number.

    JSON's bare NaN and Infinity are judged as values. A trailing ``d`` or ``f`` is a number only
    to Java, so it is refused.
    """
    number = text.try_cast("double")
    java_suffix = F.right(F.rtrim(text), F.lit(1)).isin("d", "D", "f", "F") & (F.abs(number) < float("inf"))
    bare = F.when(text.isin(*QUOTED_NON_NUMBERS), F.btrim(text, F.lit('"')).try_cast("double"))
    return F.when(~F.coalesce(java_suffix, F.lit(False)), F.coalesce(number, bare))


def positive_finite(value: Column) -> Column:
    """True for 0 < value < Infinity; NaN sorts above every number and so fails the upper bound."""
    return (value > 0) & (value < F.lit(float("inf")))


def percent_spread(high: Column, low: Column) -> Column:
    """(high - low) / low * 100, NULL when low is zero."""
    return F.try_divide(high - low, low) * 100
