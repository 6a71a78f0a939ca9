"""Policy selection: split, fit, measure, choose a threshold, save."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from faultline.models.calibrate import fit_calibrated
from faultline.models.features import (
    CATEGORICAL,
    ENGINEERED,
    LEAKAGE,
    SAFE_NUMERIC,
    TARGET,
    engineered,
    label_as_int,
    model_inputs,
)
from faultline.models.score import with_failure_probability
from faultline.models.train import fit_boosting, fit_logistic, save_model
from faultline.operators.curves import (
    average_precision_of,
    cumulative_counts,
    pr_curve_of,
    roc_auc_of,
    with_f1,
)
from faultline.operators.metrics import confusion_at_threshold, report_at_threshold
from faultline.operators.policy import (
    DEFAULT_CAPACITIES,
    capacity_threshold,
    decision_report,
    k_sweep,
    precision_recall_at_k,
)
from faultline.operators.splitting import split_frames, stratified_split
from faultline.sources.writers import metadata_record, write_metadata
from faultline.storage import materialize

# Capacities at which learners are compared; the second sets a threshold.
COMPARED_CAPACITIES = [10, 20, 50, 100]


def prepare(df: DataFrame, key: str = "udi", label: str = TARGET) -> DataFrame:
    """Leakage-safe inputs with key and integer label."""
    return model_inputs(label_as_int(engineered(df), label), keep=(key, label))


def measured(
    scored: DataFrame, key: str, label: str, ks: Sequence[int] = COMPARED_CAPACITIES
) -> dict:
    """Both areas, precision and recall of the first k rows, and the reports at the
    threshold of best F1 and at the one of the smallest but one capacity.

    ``scored`` is a written table with ``p_failure``; only metric rows reach
    the driver, and one curve serves both areas and the threshold.
    """
    counts = materialize(cumulative_counts(scored, "p_failure", label), "policy-counts")
    curve = with_f1(pr_curve_of(counts)).orderBy(F.desc("f1"), F.asc("threshold"))
    best = curve.select("threshold").first()
    cutoff = capacity_threshold(scored, "p_failure", key, ks[1]).first()["cutoff_score"]
    thresholds = {"best_f1": best and best["threshold"], f"top_{ks[1]}": cutoff}
    at_k = precision_recall_at_k(scored, "p_failure", label, key, ks).collect()
    return {
        "pr_auc": average_precision_of(counts).first()[0],
        "roc_auc": roc_auc_of(counts).first()[0],
        "at_k": {r["k"]: (r["precision"], r["recall"]) for r in at_k},
        "thresholds": thresholds,
        "reports": {
            name: [r.asDict() for r in report_at_threshold(scored, "p_failure", label, value).collect()]
            for name, value in thresholds.items()
            if value is not None
        },
        "confusion": {
            name: confusion_at_threshold(scored, "p_failure", label, value).first().asDict()
            for name, value in thresholds.items()
            if value is not None
        },
    }


def compare(
    df: DataFrame,
    key: str = "udi",
    label: str = TARGET,
    seed: int = 42,
    ks: Sequence[int] = COMPARED_CAPACITIES,
    logistic: dict | None = None,
    boosted: dict | None = None,
) -> dict[str, dict]:
    """Baseline and boosted learner on one split: name -> measures (see ``measured``).

    The split is written once and read by both fits; each test part is scored once.
    """
    split = materialize(stratified_split(prepare(df, key, label), label, key, 0.2, seed), "compare-split")
    train, test = split_frames(split)
    fitted = {
        "logistic": fit_logistic(train, label=label, **(logistic or {})),
        "boosting": fit_boosting(train, label=label, **{"seed": seed, **(boosted or {})}),
    }
    return {
        name: measured(materialize(with_failure_probability(test, model), f"compare-{name}"), key, label, ks)
        for name, model in fitted.items()
    }


def run(
    df: DataFrame,
    model_path: str,
    metadata_path: str,
    data_path: str = "",
    key: str = "udi",
    label: str = TARGET,
    k: int = 50,
    ks: Sequence[int] = DEFAULT_CAPACITIES,
    seed: int = 42,
    **learner_settings,
):
    """Fit the calibrated model, evaluate it on the test part, save both.

    Returns (model, scored test rows, metadata record). Only metric rows reach
    the driver; the scored test part is written once and read per metric.
    """
    spark = df.sparkSession
    train, test = split_frames(stratified_split(prepare(df, key, label), label, key, 0.2, seed))
    model = fit_calibrated(train, key, label=label, seed=seed, **learner_settings)
    scored = materialize(with_failure_probability(test, model), "policy-scored")
    counts = materialize(cumulative_counts(scored, "p_failure", label), "policy-counts")
    record = metadata_record(
        metrics={
            "pr_auc": average_precision_of(counts).first()[0],
            "roc_auc": roc_auc_of(counts).first()[0],
        },
        decision=decision_report(scored, "p_failure", label, key, k).first().asDict(),
        sweep=[r.asDict() for r in k_sweep(scored, "p_failure", label, key, sorted({*ks, k})).collect()],
        features={
            "categorical": CATEGORICAL,
            "numerical": SAFE_NUMERIC,
            "engineered": ENGINEERED,
            "dropped": LEAKAGE,
            "target": label,
        },
        data_path=data_path,
        model_type="boosting",
        seed=seed,
    )
    save_model(model, model_path)
    write_metadata(spark, record, metadata_path)
    return model, scored, record
