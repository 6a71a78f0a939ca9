"""Learners. Spark ML does the distributed work; defaults are the reference
settings, round counts are parameters."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import AtomicType

from faultline.models.features import CATEGORICAL, SAFE_NUMERIC, TARGET, feature_stages
from faultline.storage import beside, delete, enable_checkpoints, publish

# Default hyperparameters.
FOREST = {"numTrees": 80, "maxDepth": 8}
BOOSTING = {"maxDepth": 6, "stepSize": 0.05, "maxIter": 300}
LOGISTIC = {"maxIter": 3000}
SEED = 42

#: Rows in a partition of a learner's input, and its partitions at least.
ROWS_PER_PARTITION = 100_000
LEAST_PARTITIONS = 8


def forest(label: str = TARGET, features: str = "features", seed: int = SEED, **overrides):
    return RandomForestClassifier(
        labelCol=label, featuresCol=features, seed=seed, **{**FOREST, **overrides}
    )


def boosting(label: str = TARGET, features: str = "features", seed: int = SEED, **overrides):
    return GBTClassifier(
        labelCol=label, featuresCol=features, seed=seed, **{**BOOSTING, **overrides}
    )


def spread(rows: DataFrame, count: int | None = None) -> DataFrame:
    """Rows dealt out by their plain columns and sorted by them in each partition.

    Learners seed their sampling by partition and place, so both follow from
    the rows and their number alone, not from files, cores or cluster. Keep
    the row key among the columns: rows that share all plain columns are
    interchangeable only if their vectors are equal too.
    """
    count = rows.count() if count is None else count
    n = max(LEAST_PARTITIONS, math.ceil(count / ROWS_PER_PARTITION))
    plain = [f.name for f in rows.schema if isinstance(f.dataType, AtomicType)]
    return rows.repartition(n, *plain).sortWithinPartitions(*plain)


def fit_forest(
    train: DataFrame,
    numeric: Sequence[str] = SAFE_NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
    label: str = TARGET,
    **overrides,
) -> PipelineModel:
    stages = feature_stages(categorical, numeric)
    return Pipeline(stages=[*stages, forest(label, **overrides)]).fit(spread(train))


def fit_boosting(
    train: DataFrame,
    numeric: Sequence[str] = SAFE_NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
    label: str = TARGET,
    **overrides,
) -> PipelineModel:
    enable_checkpoints(train.sparkSession)
    stages = feature_stages(categorical, numeric)
    return Pipeline(stages=[*stages, boosting(label, **overrides)]).fit(spread(train))


def with_class_weights(df: DataFrame, label: str = TARGET, out: str = "class_weight") -> DataFrame:
    """Weight n / (2 * n_class) per row, so both classes weigh the same."""
    counts = df.agg(
        F.struct(
            F.count("*").cast("double").alias("rows"),
            F.count_if(F.col(label) == 1).cast("double").alias("positives"),
        )
    ).scalar()
    rows, positives = counts["rows"], counts["positives"]
    of_class = F.when(F.col(label) == 1, positives).otherwise(rows - positives)
    return df.withColumn(out, rows / (F.lit(2.0) * of_class))


def fit_logistic(
    train: DataFrame,
    numeric: Sequence[str] = SAFE_NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
    label: str = TARGET,
    **overrides,
) -> PipelineModel:
    """Class-weighted logistic regression on standardised inputs.

    The penalty is 1/n: the weights sum to n and Spark averages the loss, so
    this equals an inverse regularisation strength of 1.
    """
    count = train.count()
    settings = {"regParam": 1.0 / count, "standardization": False, **LOGISTIC, **overrides}
    learner = LogisticRegression(
        labelCol=label, featuresCol="features", weightCol="class_weight", **settings
    )
    stages = feature_stages(categorical, numeric, scaled=True)
    return Pipeline(stages=[*stages, learner]).fit(with_class_weights(spread(train, count), label))


def save_model(model: PipelineModel, path: str) -> None:
    """Save under a staged name, then publish: a failed save leaves the old model."""
    spark = SparkSession.active()
    staged = beside(path)
    try:
        model.write().save(staged)
        publish(spark, staged, path)
    finally:
        delete(spark, staged)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
