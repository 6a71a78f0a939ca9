"""Impurity and permutation importances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window, functions as F

from faultline.functions.hashing import key_hash
from faultline.models.features import CATEGORICAL, SAFE_NUMERIC, TARGET
from faultline.models.score import with_failure_probability
from faultline.operators.curves import average_precision_of, cumulative_counts
from faultline.operators.ranking import POSITION, SLICE, laid_out
from faultline.storage import materialize


def slot_names(df: DataFrame, vector: str = "features") -> list[str]:
    """Names of the vector slots, from the column's ML attributes."""
    attrs = df.schema[vector].metadata["ml_attr"]["attrs"]
    slots = [slot for group in attrs.values() for slot in group]
    return [slot["name"] for slot in sorted(slots, key=lambda slot: slot["idx"])]


def feature_importance(
    model: PipelineModel, transformed: DataFrame, top: int | None = 5, vector: str = "features"
) -> DataFrame:
    """Impurity importance per vector slot, largest first.

    The rows come from the fitted model, one per slot, not from the data.
    """
    weights = model.stages[-1].featureImportances.toArray().tolist()
    names = slot_names(transformed, vector)
    rows = [(i, name, weight) for i, (name, weight) in enumerate(zip(names, weights))]
    frame = transformed.sparkSession.createDataFrame(
        rows, "slot int, feature string, importance double"
    ).orderBy(F.desc("importance"), "slot")
    return frame if top is None else frame.limit(top)


def positions(df: DataFrame, by: str, order: Sequence) -> DataFrame:
    """1-based position of every row inside its ``by`` group, in one sort."""
    rows = laid_out(df, [F.asc(by), *order], "positions")
    earlier = Window.partitionBy(by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # one row per (group, slice)
    offsets = (
        rows.groupBy(by, SLICE)
        .agg(F.count("*").alias("_n"), F.min(POSITION).alias("_first"))
        .select(by, SLICE, "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    return (
        rows.join(F.broadcast(offsets), [by, SLICE])
        .withColumn("_place", F.col("_before") + F.col(POSITION) - F.col("_first") + 1)
        .select(*df.columns, "_place")
    )


def shuffled_variants(
    inputs: DataFrame, columns: Sequence[str], label: str, key: str, repeats: int, seed: int
) -> DataFrame:
    """Every row once per (shuffled column, repeat), that column's value taken
    from another row.

    The row at place i in key order takes the value of the row at place i in
    the order of ``hash(seed : repeat : key)``: a permutation of the column.
    One sort places the rows, one sort places the rows of all repeats, one join
    on the place pairs them.
    """
    columns = list(columns)
    base = positions(inputs.withColumn("_repeat", F.lit(0)), "_repeat", [F.asc(key)])
    copies = inputs.drop(label).withColumn(
        "_repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    )
    shuffle_order = key_hash(F.concat_ws(":", F.col("_repeat"), F.col(key)), seed)
    donors = positions(copies, "_repeat", [shuffle_order, F.asc(key)]).select(
        "_repeat", "_place", *[F.col(c).alias(f"_donor_{c}") for c in columns]
    )
    paired = base.drop("_repeat").join(donors, "_place").withColumn(
        "_shuffled", F.explode(F.array(*[F.lit(c) for c in columns]))
    )
    return paired.select(
        "_shuffled",
        "_repeat",
        label,
        *[
            F.when(F.col("_shuffled") == c, F.col(f"_donor_{c}")).otherwise(F.col(c)).alias(c)
            for c in columns
        ],
    )


def permutation_importance(
    df: DataFrame,
    model: PipelineModel,
    columns: Sequence[str] = (*CATEGORICAL, *SAFE_NUMERIC),
    label: str = TARGET,
    key: str = "udi",
    repeats: int = 8,
    seed: int = 42,
    score: str = "p_failure",
) -> DataFrame:
    """Mean drop in average precision when one input column is shuffled.

    All (column, repeat) variants are scored and measured in one pass.
    """
    columns = list(columns)
    inputs = materialize(df.select(key, label, *columns), "importance-input")
    variants = shuffled_variants(inputs, columns, label, key, repeats, seed)
    baseline = inputs.select(
        F.lit("").alias("_shuffled"), F.lit(0).alias("_repeat"), label, *columns
    )
    scored = with_failure_probability(baseline.unionByName(variants), model, score)
    groups = ["_shuffled", "_repeat"]
    areas = average_precision_of(cumulative_counts(scored, score, label, groups), groups)
    # columns x repeats + 1 rows from here on
    areas = materialize(areas, "importance-areas")
    whole = areas.filter("_shuffled = ''").agg(F.max("average_precision")).scalar()
    drop = whole - F.col("average_precision")
    return (
        areas.filter("_shuffled <> ''")
        .groupBy(F.col("_shuffled").alias("feature"))
        .agg(F.avg(drop).alias("importance_mean"), F.stddev_pop(drop).alias("importance_std"))
        .orderBy(F.desc("importance_mean"), "feature")
    )
