"""Feature sets and the Spark ML stages that turn them into vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from faultline.functions.numeric import nan_to_null
from faultline.operators.cleaning import drop_present, require_columns
from faultline.schemas import FAILURE_FLAGS

# Target, sensor columns, engineered columns, category column.
TARGET = "machine_failure"
CATEGORICAL = ["type"]
SENSORS = [
    "air_temperature_k",
    "process_temperature_k",
    "rotational_speed_rpm",
    "torque_nm",
    "tool_wear_min",
]
ENGINEERED = ["TempDiff", "Torque_x_RPM"]

# Columns no model may see: identifiers, failure-mode flags, the target.
LEAKAGE = ["udi", "product_id", *FAILURE_FLAGS, TARGET]

SAFE_NUMERIC = [*SENSORS, *ENGINEERED]
FULL_NUMERIC = [*SENSORS, *FAILURE_FLAGS]


def engineered(df: DataFrame) -> DataFrame:
    """Process minus air temperature, and torque times speed."""
    return df.withColumns(
        {
            "TempDiff": F.col("process_temperature_k") - F.col("air_temperature_k"),
            "Torque_x_RPM": F.col("torque_nm") * F.col("rotational_speed_rpm"),
        }
    )


def label_as_int(df: DataFrame, label: str = TARGET) -> DataFrame:
    return df.withColumn(label, F.col(label).cast("int"))


def model_inputs(
    df: DataFrame,
    categorical: Sequence[str] = CATEGORICAL,
    numeric: Sequence[str] = SAFE_NUMERIC,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Feature columns in order, numbers as double, leakage columns dropped.

    ``keep`` carries columns that are not features (row key, label) along.
    """
    require_columns(df, [*categorical, *numeric, *keep])
    kept = [F.col(c) for c in keep]
    clean = drop_present(df.select(*categorical, *numeric), set(LEAKAGE) - {*categorical, *numeric})
    numbers = [nan_to_null(F.col(c).cast("double")).alias(c) for c in numeric]
    features = clean.columns
    return df.select(*kept, *[c for c in features if c in categorical], *numbers)


def feature_stages(
    categorical: Sequence[str] = CATEGORICAL,
    numeric: Sequence[str] = SAFE_NUMERIC,
    scaled: bool = False,
    out: str = "features",
) -> list:
    """Index, one-hot, optionally standardise, assemble; numbers come first.

    Categories are indexed in alphabetical order. An unseen or missing one gets
    the extra index, which is the slot the encoder drops, so it encodes as all
    zeros and every known category has a slot of its own.
    """
    indexed = [f"{out}_{c}_index" for c in categorical]
    encoded = [f"{out}_{c}_onehot" for c in categorical]
    stages = [
        StringIndexer(
            inputCols=list(categorical),
            outputCols=indexed,
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=encoded),
    ]
    if not scaled:
        return [
            *stages,
            VectorAssembler(inputCols=[*numeric, *encoded], outputCol=out, handleInvalid="keep"),
        ]
    return [
        *stages,
        VectorAssembler(inputCols=list(numeric), outputCol=f"{out}_numbers", handleInvalid="keep"),
        StandardScaler(
            inputCol=f"{out}_numbers", outputCol=f"{out}_scaled", withMean=True, withStd=True
        ),
        VectorAssembler(
            inputCols=[f"{out}_scaled", *encoded], outputCol=out, handleInvalid="keep"
        ),
    ]


def feature_vectors(
    df: DataFrame,
    include_flags: bool = False,
    categorical: Sequence[str] = CATEGORICAL,
    ids: Sequence[str] = ("udi", "product_id", TARGET),
):
    """(fitted feature stages, frame of ids + vector)."""
    numeric = FULL_NUMERIC if include_flags else SAFE_NUMERIC
    fitted = Pipeline(stages=feature_stages(categorical, numeric)).fit(df)
    return fitted, fitted.transform(df).select(*ids, "features")
