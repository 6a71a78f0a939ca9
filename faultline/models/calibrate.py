"""Isotonic calibration over label-stratified folds.

For every fold, the whole model is refitted on the other folds and an isotonic
curve maps its raw score to a probability on the held-out fold. The calibrated
score is the mean over folds. The result is one ordinary ``PipelineModel``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from multiprocessing.pool import ThreadPool

import pandas as pd
from pyspark import TaskContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from faultline.models.features import (
    CATEGORICAL,
    SAFE_NUMERIC,
    TARGET,
    feature_stages,
)
from faultline.models.train import SEED, boosting, spread
from faultline.operators.splitting import stratified_folds
from faultline.functions.numeric import nan_to_null
from faultline.storage import enable_checkpoints, materialize

FOLDS = 3

#: Neighbouring slices whose blocks one task merges.
FAN = 8

BLOCK = ["first", "last", "total", "weight"]


def pool(blocks: Iterable[tuple]) -> list[tuple]:
    """Pools blocks (first, last, total, weight) in score order until their means rise.

    Pooling parts first and then their blocks gives the same as pooling all at once.
    """
    out: list[tuple] = []
    for block in blocks:
        while out and out[-1][2] * block[3] >= block[2] * out[-1][3]:
            first, _, total, weight = out.pop()
            block = (first, block[1], total + block[2], weight + block[3])
        out.append(block)
    return out


def isotonic_blocks(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Isotonic regression of label on score: (first, last, value, weight) of each
    step, scores ascending, values strictly ascending.

    Rows are combined per distinct score and sorted by range; every sorted
    partition pools its own violators, and then neighbouring partitions merge
    what is left, ``FAN`` at a time. Only pooled blocks move. Missing scores
    and labels take no part.
    """
    value = nan_to_null(score).cast("double")
    points = (
        scored.select(value.alias("first"), F.col(label).cast("double").alias("_y"))
        .filter("first is not null and _y is not null")
        .groupBy("first")
        .agg(F.sum("_y").alias("total"), F.count("*").cast("double").alias("weight"))
        .select("first", F.col("first").alias("last"), "total", "weight")
    )

    def pool_slice(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slice_ = TaskContext.get().partitionId()
        rows = (row for part in parts for row in part[BLOCK].itertuples(index=False, name=None))
        yield pd.DataFrame(pool(rows), columns=BLOCK).astype("float64").assign(slice=slice_)

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        rows = part.sort_values("first")[BLOCK].itertuples(index=False, name=None)
        return pd.DataFrame(pool(rows), columns=BLOCK).assign(slice=part["slice"].iloc[0] // FAN)

    kind = "first double, last double, total double, weight double, slice long"
    blocks = materialize(points.orderBy("first").mapInPandas(pool_slice, kind), "isotonic-blocks")
    while (blocks.agg(F.max("slice")).first()[0] or 0) > 0:
        merged = blocks.groupBy(F.floor(F.col("slice") / FAN).alias("of")).applyInPandas(merge, kind)
        blocks = materialize(merged, "isotonic-blocks")
    return blocks.select("first", "last", (F.col("total") / F.col("weight")).alias("value"), "weight")


def fit_isotonic(scored: DataFrame, score: str, label: str):
    """Isotonic curve of label on score as a Spark model.

    The model is fitted on the two ends of every pooled block, which it leaves
    as they are: the driver sees nothing but final blocks.
    """
    blocks = isotonic_blocks(scored, score, label)
    wide = F.col("first") < F.col("last")
    ends = F.when(wide, F.array("first", "last")).otherwise(F.array("first"))
    points = blocks.select(
        F.explode(ends).alias(score),
        "value",
        F.when(wide, F.col("weight") / 2).otherwise(F.col("weight")).alias("_weight"),
    )
    learner = IsotonicRegression(featuresCol=score, labelCol="value", weightCol="_weight")
    return learner.fit(points)


def with_shared_vectors(fold_stages: Sequence[Sequence]) -> tuple[list, list[str]]:
    """The stages of all folds in a row, and the names of the vectors they make.

    Feature stages follow from the categories that a fold knows. Folds that know
    the same ones read one vector, so a row is turned into it once, not per fold.
    """
    stages, vectors = [], {}
    for indexer, *others, classifier, curve in fold_stages:
        known = tuple(map(tuple, indexer.labelsArray))
        if known not in vectors:
            vectors[known] = classifier.getFeaturesCol()
            stages += [indexer, *others]
        stages += [classifier.setFeaturesCol(vectors[known]), curve]
    return stages, list(vectors.values())


def fit_calibrated(
    train: DataFrame,
    key: str = "udi",
    numeric: Sequence[str] = SAFE_NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
    label: str = TARGET,
    folds: int = FOLDS,
    seed: int = SEED,
    out: str = "p_failure",
    learner: Callable = boosting,
    parallelism: int = FOLDS,
    **overrides,
) -> PipelineModel:
    """Fit ``folds`` models with their isotonic curves; one pipeline results."""
    enable_checkpoints(train.sparkSession)
    assigned = spread(stratified_folds(train, label, key, folds, seed, "_fold")).persist()

    def fit_fold(i: int) -> list:
        features, raw = f"features_{i}", f"raw_{i}"
        classifier = (
            learner(label, features, seed, **overrides)
            .setRawPredictionCol(raw)
            .setProbabilityCol(f"probability_{i}")
            .setPredictionCol(f"prediction_{i}")
        )
        fitted = Pipeline(
            stages=[*feature_stages(categorical, numeric, out=features), classifier]
        ).fit(assigned.filter(F.col("_fold") != i))
        held_out = fitted.transform(assigned.filter(F.col("_fold") == i)).select(
            vector_to_array(raw)[1].alias("_raw"), label
        )
        curve = fit_isotonic(held_out, "_raw", label)
        # at scoring time the curve reads element 1 of the raw vector
        curve.setFeaturesCol(raw).setFeatureIndex(1).setPredictionCol(f"calibrated_{i}")
        return [*fitted.stages, curve]

    # folds are independent: fitted side by side, as CrossValidator does
    try:
        with ThreadPool(parallelism) as pool:
            fold_stages = pool.map(
                inheritable_thread_target(assigned.sparkSession)(fit_fold), range(folds)
            )
    finally:
        assigned.unpersist()
    stages, vectors = with_shared_vectors(fold_stages)
    parts = [f"calibrated_{i}" for i in range(folds)]
    made = [f"{name}_{i}" for name in ("raw", "probability", "prediction", "calibrated") for i in range(folds)]
    of_vectors = [
        name
        for vector in vectors
        for name in (vector, *[f"{vector}_{c}_{kind}" for c in categorical for kind in ("index", "onehot")])
    ]
    helpers = [*of_vectors, *made]
    mean = SQLTransformer(
        statement=(
            f"SELECT * EXCEPT ({', '.join(helpers)}), "
            f"({' + '.join(parts)}) / {folds}D AS {out} FROM __THIS__"
        )
    )
    return PipelineModel([*stages, mean])
