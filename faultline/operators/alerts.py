"""Ranked alert table: ordering, optional filters, summary, preview."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from faultline.functions.numeric import nan_to_null
from faultline.operators.ranking import flag_alerts, flag_first, global_rank, top_k_ranked

# Identifier columns and the leading columns of the alert table.
ID_COLUMNS = ["udi", "product_id"]
LEADING = ["p_failure", "rank", "alert_topk", "TempDiff", "Torque_x_RPM"]

# Columns that accept an inclusive range filter.
RANGE_COLUMNS = ["tool_wear_min", "torque_nm", "rotational_speed_rpm", "TempDiff"]


def leading_columns(df: DataFrame, ids: Sequence[str] = ID_COLUMNS) -> DataFrame:
    """Identifiers, scores and engineered columns first, the rest after."""
    front = [c for c in [*ids, *LEADING] if c in df.columns]
    return df.select(*front, *[c for c in df.columns if c not in front])


def rank_and_flag(df: DataFrame, k: int, key: str = "udi", score: str = "p_failure") -> DataFrame:
    """Rank every row, flag exactly the top k, put the key columns in front."""
    return leading_columns(flag_alerts(global_rank(df, score, key), score, k))


def flag_only(df: DataFrame, k: int, key: str = "udi", score: str = "p_failure") -> DataFrame:
    """Flag exactly the top k without ranking the rest; row-local given the k-th row.

    Enough for totals and filters: ``scoring_summary`` and
    ``filter_scored(alerts_only=True)`` need no rank.
    """
    return flag_first(df, score, key, k)


def ranked_alerts(df: DataFrame, k: int, key: str = "udi", score: str = "p_failure") -> DataFrame:
    """The alert rows of ``rank_and_flag`` and only they: the k-th row cuts them
    off first, so no more than k rows are sorted."""
    scored = df.filter(nan_to_null(score).isNotNull())
    return leading_columns(flag_alerts(top_k_ranked(scored, score, key, k), score, k))


def filter_scored(
    df: DataFrame,
    min_score: float | None = None,
    categories: Sequence[str] | None = None,
    ranges: Mapping[str, tuple[float, float]] | None = None,
    alerts_only: bool = False,
    category: str = "type",
    score: str = "p_failure",
) -> DataFrame:
    """All optional filters as one conjunction; absent columns are skipped.

    Plain comparisons, so they reach the file scan. NaN is above every number
    in Spark: a range's upper end excludes it, a minimum needs a test of its own.
    """
    tests: list[Column] = []
    if min_score is not None:
        tests += [F.col(score) >= F.lit(float(min_score)), ~F.isnan(score)]
    if categories and category in df.columns:
        tests.append(F.col(category).isin(list(categories)))
    for name, (low, high) in (ranges or {}).items():
        if name in df.columns:
            tests.append(F.col(name).between(low, high))
    if alerts_only:
        tests.append(F.col("alert_topk"))
    return df.filter(reduce(Column.__and__, tests)) if tests else df


def category_domain(df: DataFrame, category: str = "type") -> DataFrame:
    """Distinct non-null categories, sorted."""
    return (
        df.select(F.col(category).cast("string").alias("value"))
        .filter("value is not null")
        .distinct()
        .orderBy("value")
    )


def range_domain(df: DataFrame, columns: Sequence[str] = RANGE_COLUMNS) -> DataFrame:
    """Smallest and largest value of each present numeric column, one scan."""
    present = [c for c in columns if c in df.columns]
    return df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.min(nan_to_null(c)).cast("double").alias("low"),
                    F.max(nan_to_null(c)).cast("double").alias("high"),
                )
                for c in present
            ]
        ).alias("domains")
    ).select(F.inline("domains"))


def scoring_summary(df: DataFrame, score: str = "p_failure") -> DataFrame:
    """Rows, alerts, cutoff, sure failures, distinct and missing scores."""
    value = nan_to_null(score)
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if("alert_topk").alias("alerts"),
        F.min(F.when(F.col("alert_topk"), value)).alias("cutoff_score"),
        F.count_if(value == F.lit(1.0)).alias("sure_failures"),
        F.count_distinct(value).alias("distinct_scores"),
        F.count_if(value.isNull()).alias("missing_scores"),
    )


def alerts_preview(
    df: DataFrame, n: int = 10, ids: Sequence[str] = ID_COLUMNS, score: str = "p_failure"
) -> DataFrame:
    """First n alerts with identifiers, score and rank."""
    shown = [c for c in ids if c in df.columns]
    return df.filter("alert_topk").select(*shown, score, "rank").orderBy("rank").limit(n)
