"""Explicit schemas of every dataset; nothing is inferred from file content."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw file header names and their types, in file order.
RAW_COLUMNS = [
    ("UDI", "int"),
    ("Product ID", "string"),
    ("Type", "string"),
    ("Air temperature [K]", "double"),
    ("Process temperature [K]", "double"),
    ("Rotational speed [rpm]", "int"),
    ("Torque [Nm]", "double"),
    ("Tool wear [min]", "int"),
    ("Machine failure", "int"),
    ("TWF", "int"),
    ("HDF", "int"),
    ("PWF", "int"),
    ("OSF", "int"),
    ("RNF", "int"),
]

# Column names and types of the cleaned table, in order.
CLEAN_COLUMNS = [
    ("udi", "int"),
    ("product_id", "string"),
    ("type", "string"),
    ("air_temperature_k", "double"),
    ("process_temperature_k", "double"),
    ("rotational_speed_rpm", "int"),
    ("torque_nm", "double"),
    ("tool_wear_min", "int"),
    ("machine_failure", "int"),
    ("twf", "int"),
    ("hdf", "int"),
    ("pwf", "int"),
    ("osf", "int"),
    ("rnf", "int"),
]

FAILURE_FLAGS = ["twf", "hdf", "pwf", "osf", "rnf"]

# Columns of the field-report log, in order; all text.
LOG_COLUMNS = [
    "timestamp",
    "machine_id",
    "technician",
    "urgency",
    "transcript",
    "ai_response",
    "detected_language",
    "source",
    "audio_filename",
]

# Urgency levels a technician can declare.
URGENCY_LEVELS = [
    "High — stop immediately",
    "Medium — fix within shift",
    "Low — schedule next maintenance",
    "Unknown",
]

# Fields of a maintenance report, in order.
REPORT_COLUMNS = [
    "machine_id",
    "location",
    "technician",
    "report_date",
    "fault_description",
    "root_cause",
    "work_performed",
    "parts_used",
    "downtime_hours",
    "recommendations",
    "next_maintenance_date",
]


TYPES = {"int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType()}


def _struct(columns) -> T.StructType:
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in columns])


def raw_schema() -> T.StructType:
    return _struct(RAW_COLUMNS)


def raw_text_schema() -> T.StructType:
    """Raw file with every field kept as text, so bad fields reach the casts."""
    return _struct([(name, "string") for name, _ in RAW_COLUMNS])


def log_schema() -> T.StructType:
    return _struct([(name, "string") for name in LOG_COLUMNS])


def predictions_csv_schema() -> T.StructType:
    return _struct(
        [
            ("udi", "int"),
            ("machine_failure", "int"),
            ("prediction", "double"),
            ("prob_failure", "double"),
        ]
    )


def predictions_text_schema() -> T.StructType:
    """Predictions whose probability vector was exported as text."""
    return _struct(
        [
            ("udi", "int"),
            ("machine_failure", "int"),
            ("prediction", "double"),
            ("probability", "string"),
        ]
    )


# Keys of one extracted report record, in order.
EXTRACTED_FIELDS = [
    "fault_description",
    "root_cause",
    "work_performed",
    "parts_used",
    "downtime_hours",
    "recommendations",
    "next_maintenance_date",
]

# Layout of the run metadata record, names included.
_RATES = "precision: double, recall: double, `f1-score`: double, support: double"
RUN_METADATA = (
    "data_path string, model_type string, calibrated boolean, policy string, "
    "topk_k int, seed int, metrics struct<pr_auc: double, roc_auc: double>, "
    "decision_report struct<k: int, cutoff_score: double, selected: bigint, "
    "num_ge_cutoff: bigint, confusion_matrix: array<array<bigint>>, "
    f"classification_report: struct<`0`: struct<{_RATES}>, `1`: struct<{_RATES}>, "
    f"accuracy: double, `macro avg`: struct<{_RATES}>, `weighted avg`: struct<{_RATES}>>>, "
    "cutoff_or_threshold double, precision_at_k double, recall_at_k double, "
    "k_sweep array<struct<k: int, precision: double, recall: double, tp: bigint, "
    "fp: bigint, fn: bigint, tn: bigint, cutoff_score: double, num_ge_cutoff: bigint>>, "
    "features struct<categorical: array<string>, numerical: array<string>, "
    "engineered: array<string>, dropped: array<string>, target: string>"
)
