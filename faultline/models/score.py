"""Batch scoring and the score-and-alert composition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from faultline.functions.numeric import vector_element
from faultline.models.features import (
    CATEGORICAL,
    ENGINEERED,
    SAFE_NUMERIC,
    SENSORS,
    TARGET,
    engineered,
)
from faultline.operators.alerts import rank_and_flag
from faultline.operators.cleaning import require_columns
from faultline.operators.ranking import top_k
from faultline.storage import materialize


def with_failure_probability(df: DataFrame, model: PipelineModel, out: str = "p_failure") -> DataFrame:
    """Input columns plus the failure probability: the calibrated score of a
    calibrated model, else element 1 of the classifier's probability vector."""
    plain = df.drop("p_failure", "probability", out)
    scored = model.transform(plain)
    calibrated = "p_failure" in scored.columns
    value = F.col("p_failure") if calibrated else vector_element("probability")
    return scored.select(*plain.columns, value.alias(out))


def serving_rows(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Key, label, prediction and probability vector under fixed types."""
    return df.select(
        F.col("udi").cast("int").alias("udi"),
        F.col(label).cast("int").alias(label),
        F.col("prediction").cast("double").alias("prediction"),
        F.col("probability"),
    )


def score_and_alert(
    df: DataFrame,
    model: PipelineModel,
    k: int = 50,
    key: str = "udi",
    categorical: Sequence[str] = CATEGORICAL,
    numeric: Sequence[str] = SAFE_NUMERIC,
) -> DataFrame:
    """Engineer, check, score, rank, flag the top k, put key columns first.

    Scored rows are written before they are ranked: a range sort reads its
    input twice (once to find the ranges) and must not run the model twice.
    Without the key column ties go by order of appearance, which the write
    fixes. One row is scored by the same path as a table.
    """
    inputs = [c for c in (*categorical, *numeric) if c not in ENGINEERED]
    ready = engineered(require_columns(df, dict.fromkeys([*SENSORS, *inputs])))
    order = key if key in df.columns else "_appearance"
    if order not in df.columns:
        ready = ready.withColumn(order, F.monotonically_increasing_id())
    scored = materialize(with_failure_probability(ready, model), "scored")
    return rank_and_flag(scored, k, order).drop("_appearance")


def inspect_list(
    df: DataFrame, model: PipelineModel, k: int = 20, key: str = "udi", label: str = TARGET
) -> DataFrame:
    """The k rows most in need of inspection, with their true label."""
    scored = with_failure_probability(df, model, "failure_probability")
    return top_k(scored.withColumnRenamed(label, "y_true"), "failure_probability", key, k)

