"""Column names, column sets and type enforcement."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from faultline.functions.numeric import nan_to_null
from faultline.operators.profile import is_missing
from faultline.functions.text import clean_name
from faultline.schemas import CLEAN_COLUMNS


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename every column to lower snake case in one projection."""
    names = [clean_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names collide after clean-up: {clashes}")
    return df.toDF(*names)


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def schema_diff(df: DataFrame, expected: Iterable[str]) -> DataFrame:
    """One row per column that is missing from or extra to the expectation."""
    expected = list(expected)
    rows = [(c, "missing") for c in expected if c not in df.columns]
    rows += [(c, "extra") for c in df.columns if c not in expected]
    return df.sparkSession.createDataFrame(rows, "column string, status string")


def column_check(df: DataFrame, expected: Iterable[str]) -> DataFrame:
    """Every expected or present column with its status and missing values."""
    expected = list(expected)
    entries = []
    for name in dict.fromkeys([*expected, *df.columns]):
        present = name in df.columns
        status = "extra" if name not in expected else "present" if present else "missing"
        quoted = f"`{name}`"
        nulls = F.count_if(is_missing(df, name)) if present else F.lit(None).cast("bigint")
        entries.append(
            F.struct(
                F.lit(name).alias("column"), F.lit(status).alias("status"), nulls.alias("nulls")
            )
        )
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def typed(name: str, kind: str) -> Column:
    """A column under its type; what is no value of it, or NaN, is null.

    A whole number written with a decimal point, as in ``1551.0``, is an
    integer; one with a fraction is not.
    """
    value = F.col(name).try_cast(kind)
    if kind in ("int", "bigint"):
        number = F.col(name).try_cast("decimal(38,6)")
        whole = F.when(number == F.floor(number), F.floor(number).try_cast(kind))
        return F.coalesce(value, whole).alias(name)
    return (nan_to_null(value) if kind == "double" else value).alias(name)


def enforce_types(
    df: DataFrame, columns: Sequence[tuple[str, str]] = CLEAN_COLUMNS
) -> DataFrame:
    """Fixed typed projection; a field that is no value of its type is null.

    NaN becomes null, so later comparisons agree with a missing value.
    """
    return df.select(*[typed(name, kind) for name, kind in columns])


def enforce_present_types(
    df: DataFrame, columns: Sequence[tuple[str, str]] = CLEAN_COLUMNS
) -> DataFrame:
    """Known columns typed where they occur; every other column as it is."""
    kinds = dict(columns)
    return df.select(*[typed(c, kinds[c]) if c in kinds else F.col(c) for c in df.columns])


def cast_losses(df: DataFrame, columns: Sequence[tuple[str, str]] = CLEAN_COLUMNS) -> DataFrame:
    """Values per column that type enforcement turns into null, one scan."""
    entries = [
        F.struct(
            F.lit(name).alias("column"),
            F.count_if(F.col(name).isNotNull() & typed(name, kind).isNull()).alias("lost"),
        )
        for name, kind in columns
    ]
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def drop_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)
