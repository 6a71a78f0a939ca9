"""Confusion counts and the metrics derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from faultline.functions.numeric import harmonic_mean, nan_to_null, ratio
from faultline.functions.risk import (
    ACCURACY_CUTS,
    AT_RISK_CUTS,
    BAD_HIGH,
    GOOD_HIGH,
    METRIC_CUTS,
    RECALL_CUTS,
    at_risk,
    band,
    is_correct,
)

CELLS = ["tp", "fp", "fn", "tn"]


def outcome_cells(label: str, prediction: str) -> list[Column]:
    """The four outcome counts as aggregates of one scan."""
    y, p = F.col(label), F.col(prediction)
    return [
        F.count_if((p == 1) & (y == 1)).alias("tp"),
        F.count_if((p == 1) & (y == 0)).alias("fp"),
        F.count_if((p == 0) & (y == 1)).alias("fn"),
        F.count_if((p == 0) & (y == 0)).alias("tn"),
    ]


def confusion_grouped(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per (label, prediction), ordered; at most classes squared rows."""
    return df.groupBy(label, prediction).agg(F.count("*").alias("count")).orderBy(label, prediction)


def confusion_cells(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.agg(*outcome_cells(label, prediction))


def rates(tp="tp", fp="fp", fn="fn", tn="tn") -> dict[str, Column]:
    """Accuracy, precision, recall and F1 from the four counts, 0.0 for 0/0."""
    tp, fp, fn, tn = (F.col(c) if isinstance(c, str) else c for c in (tp, fp, fn, tn))
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return {
        "accuracy": ratio(tp + tn, tp + fp + fn + tn),
        "precision": precision,
        "recall": recall,
        "f1": harmonic_mean(precision, recall),
    }


def binary_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: the four counts, accuracy, precision, recall and F1.

    Accuracy is the share of all rows whose prediction equals the label.
    """
    counted = df.agg(
        *outcome_cells(label, prediction),
        F.count("*").alias("rows"),
        F.count_if(is_correct(prediction, label)).alias("correct"),
    )
    by_name = rates()
    by_name["accuracy"] = ratio(F.col("correct"), F.col("rows"))
    return counted.select(*CELLS, "rows", *[c.alias(n) for n, c in by_name.items()])


def class_text(df: DataFrame, name: str) -> Column:
    """Class name of a label or prediction column; 1.0 and 1 are one class."""
    whole = dict(df.dtypes)[name] in ("double", "float")
    return (F.col(name).cast("bigint") if whole else F.col(name)).cast("string")


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and
    weighted average rows. Works for any number of classes.

    One scan builds the (label, prediction) counts; all later steps see at
    most classes squared rows.
    """
    y, p = class_text(df, label), class_text(df, prediction)
    cells = df.groupBy(y.alias("y"), p.alias("p")).agg(F.count("*").alias("n"))
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(F.lit(0))
    per_class = (
        cells.select(
            F.inline(
                F.array(
                    F.struct(
                        F.col("y").alias("label"),
                        F.col("n").alias("support"),
                        F.lit(0).cast("bigint").alias("predicted"),
                        hit.alias("hits"),
                    ),
                    F.struct(
                        F.col("p").alias("label"),
                        F.lit(0).cast("bigint").alias("support"),
                        F.col("n").alias("predicted"),
                        F.lit(0).cast("bigint").alias("hits"),
                    ),
                )
            )
        )
        .groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    precision = ratio(F.col("hits"), F.col("predicted"))
    recall = ratio(F.col("hits"), F.col("support"))
    scored = per_class.select(
        "label",
        precision.alias("precision"),
        recall.alias("recall"),
        harmonic_mean(precision, recall).alias("f1_score"),
        "support",
        "hits",
    )
    weight = F.col("support").cast("double")
    names = ("precision", "recall", "f1_score")
    overall = scored.agg(
        F.sum("support").alias("total"),
        ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        *[F.avg(n).alias(f"macro_{n}") for n in names],
        *[ratio(F.sum(F.col(n) * weight), F.sum(weight)).alias(f"weighted_{n}") for n in names],
    )
    missing = F.lit(None).cast("double")

    def row(name, p_, r_, f_):
        return F.struct(
            F.lit(name).alias("label"),
            p_.alias("precision"),
            r_.alias("recall"),
            f_.alias("f1_score"),
            F.col("total").alias("support"),
        )

    summary = overall.select(
        F.inline(
            F.array(
                row("accuracy", missing, missing, F.col("accuracy")),
                row("macro avg", *[F.col(f"macro_{n}") for n in names]),
                row("weighted avg", *[F.col(f"weighted_{n}") for n in names]),
            )
        )
    )
    return scored.drop("hits").unionByName(summary)


def with_threshold_prediction(
    df: DataFrame, score: str, threshold: float, out: str = "prediction"
) -> DataFrame:
    """1 where the score reaches the threshold; a missing score does not."""
    return df.withColumn(out, at_risk(score, threshold).cast("int"))


def report_at_threshold(df: DataFrame, score: str, label: str, threshold: float) -> DataFrame:
    flagged = with_threshold_prediction(df.select(score, label), score, threshold, "_flag")
    return classification_report(flagged, label, "_flag").withColumn(
        "threshold", F.lit(float(threshold))
    )


def confusion_at_threshold(df: DataFrame, score: str, label: str, threshold: float) -> DataFrame:
    flagged = with_threshold_prediction(df.select(score, label), score, threshold, "_flag")
    return confusion_cells(flagged, label, "_flag").withColumn(
        "threshold", F.lit(float(threshold))
    )


def kpi_status(
    df: DataFrame, score: str, label: str, prediction: str, threshold: float
) -> DataFrame:
    """One row per headline number with its green / amber / red status."""
    counted = df.agg(
        *outcome_cells(label, prediction),
        F.count("*").alias("rows"),
        F.count_if(is_correct(prediction, label)).alias("correct"),
        F.count_if(at_risk(score, threshold)).alias("n_at_risk"),
    )
    by_name = rates()
    by_name["accuracy"] = ratio(F.col("correct"), F.col("rows"))

    def entry(name, value, status):
        return F.struct(
            F.lit(name).alias("kpi"), value.cast("double").alias("value"), status.alias("status")
        )

    entries = [
        entry("machines_scored", F.col("rows"), F.lit("green")),
        entry(
            "flagged_for_alert",
            F.col("n_at_risk"),
            band("n_at_risk", AT_RISK_CUTS, BAD_HIGH, strict=True),
        ),
        entry(
            "missed_failures",
            F.col("fn"),
            F.when(F.col("fn") == 0, F.lit("green")).otherwise(F.lit("red")),
        ),
        entry("model_recall", by_name["recall"], band(by_name["recall"], RECALL_CUTS, GOOD_HIGH)),
        entry(
            "model_accuracy",
            by_name["accuracy"],
            band(by_name["accuracy"], ACCURACY_CUTS, GOOD_HIGH),
        ),
        *[
            entry(f"metric_{name}", value, band(value, METRIC_CUTS, GOOD_HIGH))
            for name, value in by_name.items()
        ],
    ]
    return counted.select(F.inline(F.array(*entries)))


def non_null_scores(df: DataFrame, score: str) -> DataFrame:
    return df.filter(nan_to_null(score).isNotNull())
