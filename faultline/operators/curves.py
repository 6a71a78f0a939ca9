"""Exact threshold curves and the areas under them.

Rows are first combined per distinct score, so the map side shrinks a score
held by a third of all rows to one row per task. The distinct scores are sorted
by range, and running sums are taken inside the sorted partitions as they are
written; each partition adds one row of totals in a file of its own. The curve
is then a scan that adds the totals of earlier partitions: it moves no score again.
Rows with a missing score form the last group: below every threshold, still
counted in the totals.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, Window, functions as F

from faultline.functions.numeric import nan_to_null, ratio
from faultline.operators.ranking import SLICE
from faultline.storage import materialize

TOTAL = "_total"


def running_sums(sorted_counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Adds to rows in global order their slice and the sums of ``pos`` and
    ``rows`` up to them within (group, slice). A further row with ``TOTAL`` for
    each (group, slice) holds its sums and its lowest score."""
    by = list(by)

    def add(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slice_ = TaskContext.get().partitionId()
        # group, rows in it so far as (pos, rows), lowest score
        group, so_far, lowest = None, (0, 0), None

        def total() -> pd.DataFrame:
            values = [*group, lowest, *so_far, *so_far, slice_, True]
            return pd.DataFrame([values], columns=names)

        names = [*by, "score", "pos", "rows", "_run_pos", "_run_rows", SLICE, TOTAL]
        for part in parts:
            # groups are neighbours: a batch holds the rest of one and some whole ones
            pieces = part.groupby(by, sort=False, dropna=False) if by else [((), part)]
            for key, piece in pieces:
                key = tuple(None if pd.isna(v) else v for v in key)
                if key != group:
                    if group is not None:
                        yield total()
                    group, so_far, lowest = key, (0, 0), None
                piece = piece.assign(
                    _run_pos=piece["pos"].cumsum() + so_far[0],
                    _run_rows=piece["rows"].cumsum() + so_far[1],
                )
                so_far = (int(piece["_run_pos"].iloc[-1]), int(piece["_run_rows"].iloc[-1]))
                known = piece["score"].dropna()
                lowest = float(known.iloc[-1]) if len(known) else lowest
                yield piece.assign(**{SLICE: slice_, TOTAL: False})[names]
        if group is not None:
            yield total()

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in sorted_counts.schema]
    added = f"_run_pos long, _run_rows long, {SLICE} int, {TOTAL} boolean"
    return sorted_counts.mapInPandas(add, f"{', '.join(kinds)}, {added}")


def laid_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """``cumulative_counts`` with the lowest score of the group in ``lowest``."""
    by = list(by)
    grouped = (
        df.select(
            *by,
            nan_to_null(score).cast("double").alias("score"),
            F.col(label).cast("bigint").alias("_y"),
        )
        .groupBy(*by, "score")
        .agg(F.coalesce(F.sum("_y"), F.lit(0)).alias("pos"), F.count("*").alias("rows"))
    )
    order = [*[F.asc(name) for name in by], F.desc_nulls_last("score")]
    laid = materialize(running_sums(grouped.orderBy(*order), by), "curve", apart=TOTAL)

    # one row per (group, slice): as many as sort partitions plus groups
    group = Window.partitionBy(*by)
    earlier = group.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = laid.filter(TOTAL).select(
        *[F.col(name).alias(f"_of_{name}") for name in by],
        F.col(SLICE).alias("_of_slice"),
        F.coalesce(F.sum("pos").over(earlier), F.lit(0)).alias("_pos_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_rows_before"),
        F.sum("pos").over(group).alias("positives"),
        F.sum("rows").over(group).alias("total"),
        F.min("score").over(group).alias("lowest"),
    )
    same = F.col(SLICE) == F.col("_of_slice")
    for name in by:
        same &= F.col(name).eqNullSafe(F.col(f"_of_{name}"))
    return (
        laid.filter(~F.col(TOTAL))
        .join(F.broadcast(offsets), same)
        .select(
            *by,
            "score",
            "pos",
            "rows",
            (F.col("_run_pos") + F.col("_pos_before")).alias("tp"),
            (F.col("_run_rows") + F.col("_rows_before")).alias("selected"),
            "positives",
            "total",
            "lowest",
        )
    )


def cumulative_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: positives and rows here (``pos``, ``rows``), at or
    above (``tp``, ``selected``), and in total (``positives``, ``total``)."""
    return laid_counts(df, score, label, by).drop("lowest")


def roc_auc_of(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mann-Whitney area, ties counted half; null when a class is missing."""
    negatives = (F.col("rows") - F.col("pos")).cast("double")
    above = F.col("tp").cast("double") - F.col("pos").cast("double") / F.lit(2.0)
    positives = F.col("positives").cast("double")
    pairs = positives * (F.col("total").cast("double") - positives)
    return counts.groupBy(*by).agg(
        F.try_divide(F.sum(negatives * above), F.max(pairs)).alias("roc_auc")
    )


def average_precision_of(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum of recall steps times precision; 0.0 without positives."""
    step = ratio(F.col("pos"), F.col("positives")) * ratio(F.col("tp"), F.col("selected"))
    return counts.groupBy(*by).agg(F.sum(step).alias("average_precision"))


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    return roc_auc_of(cumulative_counts(df, score, label))


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    return average_precision_of(cumulative_counts(df, score, label))


def pr_curve_of(counts: DataFrame) -> DataFrame:
    precision = ratio(F.col("tp"), F.col("selected"))
    recall = ratio(F.col("tp"), F.col("positives"))
    return counts.filter(F.col("score").isNotNull()).select(
        F.col("score").alias("threshold"),
        precision.alias("precision"),
        recall.alias("recall"),
        "tp",
        "selected",
    )


def pr_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """Precision and recall of ``score >= threshold`` per distinct score."""
    return pr_curve_of(cumulative_counts(df, score, label))


def with_f1(curve: DataFrame) -> DataFrame:
    """F1 of precision and recall; its denominator carries a fixed 1e-12 guard."""
    p, r = F.col("precision"), F.col("recall")
    return curve.withColumn("f1", F.lit(2.0) * (p * r) / (p + r + F.lit(1e-12)))


def f1_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """``pr_curve`` with F1."""
    return with_f1(pr_curve(df, score, label))


def best_f1_threshold(
    df: DataFrame, score: str, label: str, reference_offset: bool = False
) -> DataFrame:
    """Threshold with the highest F1; among equals the lowest threshold.

    ``reference_offset`` reproduces the recorded off-by-one: the lowest
    threshold is no candidate and the next lower distinct score is returned.
    """
    counts = laid_counts(df, score, label)
    curve = with_f1(pr_curve_of(counts))
    if not reference_offset:
        return curve.orderBy(F.desc("f1"), F.asc("threshold")).limit(1)
    # the written curve is read twice: for the best candidate, for the next lower score
    best = (
        with_f1(pr_curve_of(counts.filter(F.col("score") > F.col("lowest"))))
        .agg(F.max(F.struct("f1", (-F.col("threshold")).alias("fall"))).alias("best"))
        .select(-F.col("best.fall"))
        .scalar()
    )
    # a single distinct score leaves no candidate: that score is the answer
    chosen = curve.filter(F.coalesce(F.col("threshold") < best, F.lit(True)))
    return chosen.orderBy(F.desc("threshold")).limit(1)


def auc_fast(df: DataFrame, label: str, raw: str = "rawPrediction") -> float:
    """Binned area from Spark's own evaluator: one pass, approximate."""
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=raw, metricName="areaUnderROC"
    )
    return evaluator.evaluate(df)

