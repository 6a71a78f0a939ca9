"""Alert policies under a fixed inspection capacity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from faultline.functions.numeric import harmonic_mean, nan_to_null, ratio
from faultline.operators.curves import cumulative_counts
from faultline.operators.metrics import non_null_scores
from faultline.operators.ranking import HEAD_LIMIT, top_k, top_k_ranked

# Capacities of the recorded sweep.
DEFAULT_CAPACITIES = [10, 20, 30, 40, 50, 75, 100]


def capacity_threshold(df: DataFrame, score: str, key: str, k: int) -> DataFrame:
    """Score of the k-th best row (of the last row when there are fewer).

    Small k merges per-task heads; a larger one reads it off the cumulative
    counts, which never hold k rows in one task.
    """
    usable = non_null_scores(df.select(score, key), score)
    if k <= HEAD_LIMIT:
        return (
            top_k(usable, score, key, k)
            .agg(F.min(score).alias("cutoff_score"), F.count("*").alias("selected"))
            .select(F.lit(k).alias("k"), "cutoff_score", "selected")
        )
    counts = cumulative_counts(usable.withColumn("_y", F.lit(0)), score, "_y")
    return counts.agg(
        F.coalesce(F.max(F.when(F.col("selected") >= k, F.col("score"))), F.min("score")).alias(
            "cutoff_score"
        ),
        F.least(
            F.coalesce(F.max("selected"), F.lit(0)).cast("bigint"), F.lit(k).cast("bigint")
        ).alias("selected"),
    ).select(F.lit(k).alias("k"), "cutoff_score", "selected")


def k_sweep(
    df: DataFrame, score: str, label: str, key: str, ks: Sequence[int] = DEFAULT_CAPACITIES
) -> DataFrame:
    """Outcome of inspecting exactly the top k rows, for every k in the list.

    Two scans whatever the length of the list: one ranks the first max(k)
    rows, one counts totals and the rows at or above every cutoff.
    """
    ks = list(ks)
    narrow = df.select(
        F.col(key), nan_to_null(score).alias("_score"), F.col(label).cast("int").alias("_y")
    )
    head = top_k_ranked(narrow.filter("_score is not null"), "_score", key, max(ks), "_rank")

    def cut(k: int) -> Column:
        inside = F.col("_rank") <= k
        return F.struct(
            F.lit(k).alias("k"),
            F.count_if(inside).alias("selected"),
            F.count_if(inside & (F.col("_y") == 1)).alias("tp"),
            F.min(F.when(inside, F.col("_score"))).alias("cutoff_score"),
        )

    cuts = head.agg(F.array(*[cut(k) for k in ks]).alias("cuts")).scalar()
    # the cut-offs enter the second scan as one scalar array, no join
    whole = narrow.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("_y") == 1).alias("positives"),
        F.array(
            *[F.count_if(F.col("_score") >= cuts[i]["cutoff_score"]) for i in range(len(ks))]
        ).alias("reached"),
    )
    rows = whole.select(
        "total",
        "positives",
        F.inline(F.arrays_zip(cuts.alias("cut"), F.col("reached"))),
    ).select("total", "positives", "cut.*", F.col("reached").alias("num_ge_cutoff"))
    tp, selected, positives = F.col("tp"), F.col("selected"), F.col("positives")
    return rows.select(
        "k",
        ratio(tp, selected).alias("precision"),
        ratio(tp, F.greatest(positives, F.lit(1))).alias("recall"),
        "tp",
        (selected - tp).alias("fp"),
        (positives - tp).alias("fn"),
        (F.col("total") - positives - selected + tp).alias("tn"),
        "cutoff_score",
        "num_ge_cutoff",
        "selected",
    )


def precision_recall_at_k(
    df: DataFrame, score: str, label: str, key: str, ks: Sequence[int]
) -> DataFrame:
    return k_sweep(df, score, label, key, ks).select("k", "precision", "recall", "selected")


def report_columns(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Two-class report as flat columns, computed from the four counts alone."""
    total = tp + fp + fn + tn
    support = {"0": tn + fp, "1": tp + fn}
    out: dict[str, Column] = {}
    for name, hits, predicted in (("0", tn, tn + fn), ("1", tp, tp + fp)):
        p, r = ratio(hits, predicted), ratio(hits, support[name])
        out[f"precision_{name}"], out[f"recall_{name}"] = p, r
        out[f"f1_{name}"] = harmonic_mean(p, r)
        out[f"support_{name}"] = support[name]
    out["accuracy"] = ratio(tp + tn, total)
    for metric in ("precision", "recall", "f1"):
        a, b = out[f"{metric}_0"], out[f"{metric}_1"]
        out[f"{metric}_macro"] = (a + b) / F.lit(2.0)
        out[f"{metric}_weighted"] = ratio(a * support["0"] + b * support["1"], total)
    return out


def decision_report(df: DataFrame, score: str, label: str, key: str, k: int) -> DataFrame:
    """One row describing the top-k policy: cutoff, selection, matrix, report."""
    cells = [F.col(c) for c in ("tp", "fp", "fn", "tn")]
    return k_sweep(df, score, label, key, [k]).select(
        "k",
        "cutoff_score",
        "selected",
        "num_ge_cutoff",
        "tn",
        "fp",
        "fn",
        "tp",
        *[c.alias(n) for n, c in report_columns(*cells).items()],
    )
