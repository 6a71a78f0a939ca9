"""File sinks. Every task writes its own part; nothing passes the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faultline.functions.numeric import vector_element
from faultline.operators.fieldlog import valid_entries, with_defaults
from faultline.schemas import RUN_METADATA
from faultline.storage import beside, delete, only_part, publish


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV; blanks at either end of a text survive."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def export_predictions(predictions: DataFrame, path: str) -> None:
    """Replace the probability vector by its failure element and write CSV."""
    flat = predictions.withColumn("prob_failure", vector_element("probability"))
    write_csv(flat.drop("probability"), path)


def export_scored(scored: DataFrame, path: str, rank: str = "rank") -> None:
    """Ranked rows as CSV; global order, so the parts concatenate in rank order."""
    write_csv(scored.orderBy(rank) if rank in scored.columns else scored, path)


def append_log(entries: DataFrame, path: str) -> None:
    """Append valid entries, defaults filled, any number at a time."""
    write_csv(with_defaults(valid_entries(entries)), path, mode="append")


def export_log(log: DataFrame, path: str) -> None:
    write_csv(log, path)


def write_metadata(spark: SparkSession, record: dict, path: str) -> None:
    """One run-metadata record as one JSON file, published when it is complete."""
    staged = beside(path)
    try:
        frame = spark.createDataFrame([record], RUN_METADATA)
        frame.coalesce(1).write.option("ignoreNullFields", False).json(staged)
        publish(spark, only_part(spark, staged), path)
    finally:
        delete(spark, staged)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """A metadata record, its JSON on one line or on many."""
    return spark.read.schema(RUN_METADATA).option("multiLine", True).json(path)


def report_entries(decision: dict) -> dict:
    """Report of two classes from a flat decision row: entries by name."""
    rows = decision["support_0"] + decision["support_1"]
    names = {"0": "0", "1": "1", "macro avg": "macro", "weighted avg": "weighted"}
    report = {
        label: {
            "precision": decision[f"precision_{suffix}"],
            "recall": decision[f"recall_{suffix}"],
            "f1-score": decision[f"f1_{suffix}"],
            "support": float(decision.get(f"support_{suffix}", rows)),
        }
        for label, suffix in names.items()
    }
    return report | {"accuracy": decision["accuracy"]}


def metadata_record(
    metrics: dict,
    decision: dict,
    sweep: list[dict],
    features: dict,
    data_path: str,
    model_type: str,
    calibrated: bool = True,
    policy: str = "topk",
    seed: int = 42,
) -> dict:
    """Run metadata from metric rows that were already computed."""
    chosen = next(row for row in sweep if row["k"] == decision["k"])
    names = ("k", "precision", "recall", "tp", "fp", "fn", "tn", "cutoff_score", "num_ge_cutoff")
    return {
        "data_path": data_path,
        "model_type": model_type,
        "calibrated": calibrated,
        "policy": policy,
        "topk_k": decision["k"],
        "seed": seed,
        "metrics": metrics,
        "decision_report": {
            "k": decision["k"],
            "cutoff_score": decision["cutoff_score"],
            "selected": decision["selected"],
            "num_ge_cutoff": decision["num_ge_cutoff"],
            "confusion_matrix": [
                [decision["tn"], decision["fp"]],
                [decision["fn"], decision["tp"]],
            ],
            "classification_report": report_entries(decision),
        },
        "cutoff_or_threshold": decision["cutoff_score"],
        "precision_at_k": chosen["precision"],
        "recall_at_k": chosen["recall"],
        "k_sweep": [{name: row[name] for name in names} for row in sweep],
        "features": features,
    }

