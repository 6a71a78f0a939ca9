"""Global order without a single-task window.

``row_number().over(Window.orderBy(...))`` moves every row into one task. Here
the rows are range-sorted (``orderBy``), each row is stamped with its sort
partition and position, and the stamped rows are written once. Rank = rows in
earlier partitions + position, so a second pass needs one small table with one
row per sort partition. The sort key ends in the unique row key, so a score
shared by a third of all rows still spreads over many partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from faultline.functions.numeric import nan_to_null
from faultline.operators.selection import selected
from faultline.storage import materialize

SLICE, POSITION = "_slice", "_position"

# Up to here "first k rows" is a bounded top-k merge; above it, a global rank.
HEAD_LIMIT = 10_000


def score_order(score: str, *keys: str) -> list[Column]:
    """Highest score first, missing and NaN last, ties by ascending key."""
    return [F.desc_nulls_last(nan_to_null(score)), *[F.asc(key) for key in keys]]


def laid_out(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """Rows written in global order, with their slice and position in it.

    monotonically_increasing_id is (partition << 33) + row number within it.
    """
    stamped = df.orderBy(*order).withColumn("_row", F.monotonically_increasing_id())
    rows = materialize(stamped, label)
    return rows.select(
        *df.columns,
        F.shiftright("_row", 33).alias(SLICE),
        F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)).alias(POSITION),
    )


def global_rank(df: DataFrame, score: str, key: str, out: str = "rank") -> DataFrame:
    """Add the 1-based rank by descending score, ties in key order.

    ``key`` should be unique: rows that share score and key all get a rank,
    but in no fixed order and in one sort partition.
    """
    rows = laid_out(df, score_order(score, key), "rank")
    # one row per sort partition, so this window and this broadcast are tiny
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(SLICE)
        .agg(F.count("*").alias("_rows"))
        .select(SLICE, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        rows.join(F.broadcast(offsets), SLICE)
        .withColumn(out, F.col("_before") + F.col(POSITION) + 1)
        .select(*df.columns, out)
    )


def top_k(df: DataFrame, score: str, key: str, k: int) -> DataFrame:
    """The k rows with the highest score, ties by lowest key, in that order.

    Rows without a score follow only where fewer than k have one.
    """
    if k <= HEAD_LIMIT:
        return df.orderBy(*score_order(score, key)).limit(k)
    return top_k_ranked(df, score, key, k, "_rank").drop("_rank")


def top_k_ranked(df: DataFrame, score: str, key: str, k: int, out: str = "rank") -> DataFrame:
    """``top_k`` with the display rank 1..k."""
    if k <= HEAD_LIMIT:
        head = top_k(df, score, key, k)
        # at most HEAD_LIMIT rows reach this window
        return head.withColumn(
            out, F.row_number().over(Window.orderBy(*score_order(score, key))).cast("bigint")
        )
    first = first_rows(df, score, key, k)
    return in_rank_order(global_rank(first, score, key, out).filter(F.col(out) <= k), out)


def first_rows(df: DataFrame, score: str, key: str, k: int) -> DataFrame:
    """The rows that can have a rank up to k: only they have to be sorted."""
    if df.filter(nan_to_null(score).isNotNull()).count() < k:
        return df
    return df.filter(selected(df, score, key, k, HEAD_LIMIT))


def flag_first(df: DataFrame, score: str, key: str, k: int) -> DataFrame:
    """``flag_alerts`` for rows without a rank: each is compared with the k-th
    row, nothing is sorted. The key must be unique for exactly k alerts."""
    return df.withColumn("alert_topk", selected(df, score, key, k, HEAD_LIMIT))


def flag_alerts(df: DataFrame, score: str, k: int, rank: str = "rank") -> DataFrame:
    """Exactly the first k ranked rows are alerts; a missing score never is."""
    flagged = (F.col(rank) <= k) & nan_to_null(score).isNotNull()
    return df.withColumn("alert_topk", F.coalesce(flagged, F.lit(False)))


def in_rank_order(df: DataFrame, rank: str = "rank") -> DataFrame:
    return df.orderBy(rank)


def last_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The n rows that come last in the given order."""
    return df.orderBy(*[F.desc(name) for name in order]).limit(n)
