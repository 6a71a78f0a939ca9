"""Numeric column helpers."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F


def column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def nan_to_null(value) -> Column:
    """NaN compares above every number in Spark; treat it as missing."""
    value = column(value)
    return F.when(F.isnan(value), F.lit(None)).otherwise(value)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division where a zero or missing denominator gives 0.0."""
    return F.coalesce(
        F.try_divide(numerator.cast("double"), denominator.cast("double")),
        F.lit(0.0),
    )


def harmonic_mean(a: Column, b: Column) -> Column:
    """F1 of a precision and a recall, 0.0 when both are zero."""
    return F.coalesce(F.try_divide(F.lit(2.0) * a * b, a + b), F.lit(0.0))


def percent_text(value, digits: int = 1) -> Column:
    """0.1234 -> '12.3%', rounding the exact binary value half to even."""
    plain = F.replace(F.format_number(column(value) * F.lit(100.0), digits), F.lit(","), F.lit(""))
    return F.concat(plain, F.lit("%"))


def thousands_text(value) -> Column:
    """1234567 -> '1,234,567'."""
    return F.format_number(column(value), 0)


def vector_element(vector, index: int = 1) -> Column:
    """One element of an ML vector as a double."""
    return vector_to_array(column(vector))[index]


def last_of_vector_text(value) -> Column:
    """Last number of '[0.9 0.1]' or '[0.9,0.1]'; null when it is no number."""
    inner = F.regexp_replace(column(value), r"^[\[\]\s]+|[\[\]\s]+$", "")
    return F.element_at(F.split(inner, r"[,\s]+"), -1).try_cast("double")
