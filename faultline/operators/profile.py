"""Column and label profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from faultline.functions.numeric import nan_to_null, ratio
from faultline.storage import materialize


def is_missing(df: DataFrame, name: str):
    quoted = F.col(f"`{name}`")
    return (nan_to_null(quoted) if dict(df.dtypes)[name] in ("double", "float") else quoted).isNull()


def null_profile(df: DataFrame, top: int = 15) -> DataFrame:
    """Columns with the most missing values, all counted in one scan."""
    return (
        df.agg(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("column"),
                        F.count_if(is_missing(df, name)).alias("nulls"),
                    )
                    for name in df.columns
                ]
            ).alias("entries")
        )
        .select(F.inline("entries"))
        .orderBy(F.desc("nulls"), "column")
        .limit(top)
    )


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and share of each class, from one scan: the total is summed from the
    written counts, whatever the number of classes."""
    known = df.filter(F.col(label).isNotNull()).select(label)
    counted = materialize(known.groupBy(label).agg(F.count("*").alias("count")), "classes")
    return counted.withColumn("share", ratio(F.col("count"), counted.agg(F.sum("count")).scalar()))


def prevalence(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.avg(F.col(label).cast("double")).alias("prevalence"))


def sensor_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value of each column in one scan."""
    return df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.min(nan_to_null(c)).cast("double").alias("low"),
                    F.max(nan_to_null(c)).cast("double").alias("high"),
                )
                for c in columns
            ]
        ).alias("entries")
    ).select(F.inline("entries"))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once; counts combine before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).filter("count > 1")
