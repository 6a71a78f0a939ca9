"""Fleet risk view: flags, tiers, distributions and summary rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import AtomicType

from faultline.functions import risk as fr
from faultline.functions.numeric import (
    column,
    last_of_vector_text,
    nan_to_null,
    percent_text,
    ratio,
    vector_element,
)
from faultline.operators.metrics import outcome_cells, rates
from faultline.operators.ranking import top_k_ranked

# Score levels counted in the fleet summary.
FLEET_LEVELS = [0.30, 0.50, 0.80, 0.90, 0.95]


def with_probability(df: DataFrame) -> DataFrame:
    """Derive ``prob_failure`` from a vector or its text when it is absent."""
    if "prob_failure" in df.columns or "probability" not in df.columns:
        return df
    if dict(df.dtypes)["probability"] == "string":
        return df.withColumn("prob_failure", last_of_vector_text("probability"))
    return df.withColumn("prob_failure", vector_element("probability"))


def risk_frame(df: DataFrame, threshold: float = fr.DEFAULT_THRESHOLD) -> DataFrame:
    """Row-local risk columns every panel starts from."""
    return df.withColumns(
        {
            "at_risk": fr.at_risk("prob_failure", threshold),
            "correct": fr.is_correct("prediction", "machine_failure"),
            "risk_tier": fr.risk_tier("prob_failure"),
            "score_band": fr.score_band("prob_failure"),
        }
    )


def top_alerts(df: DataFrame, k: int = 10, key: str = "udi") -> DataFrame:
    """Top-k machines with display rank, label, tier and outcome text."""
    head = top_k_ranked(
        df.select(key, "prob_failure", "machine_failure"), "prob_failure", key, k, "display_rank"
    )
    return head.select(
        "display_rank",
        F.format_string("%02d", "display_rank").alias("rank_text"),
        F.col(key),
        fr.machine_label(key).alias("machine"),
        fr.risk_tier("prob_failure").alias("risk_tier"),
        "prob_failure",
        percent_text("prob_failure").alias("probability_text"),
        fr.outcome_text("machine_failure").alias("actual"),
    )


def machine_options(df: DataFrame, k: int = 20, key: str = "udi") -> DataFrame:
    """Labels of the k riskiest machines, in order."""
    head = top_k_ranked(df.select(key, "prob_failure"), "prob_failure", key, k, "position")
    return head.select("position", fr.machine_label(key).alias("machine"))


def tier_counts(df: DataFrame, prob: str = "prob_failure") -> DataFrame:
    """Rows per tier, all three tiers present, in tier order."""
    counted = df.agg(
        *[
            F.count_if(fr.risk_tier(prob) == name).alias(f"n{i}")
            for i, name in enumerate(fr.TIERS)
        ]
    )
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i + 1).alias("tier_order"),
                        F.lit(name).alias("risk_tier"),
                        F.col(f"n{i}").alias("count"),
                    )
                    for i, name in enumerate(fr.TIERS)
                ]
            )
        )
    )


def tier_failure_rate(df: DataFrame) -> DataFrame:
    """Observed failure rate of each tier that occurs."""
    return (
        df.select(fr.risk_tier("prob_failure").alias("risk_tier"), "machine_failure")
        .filter(F.col("risk_tier").isNotNull())
        .groupBy("risk_tier")
        .agg(
            F.count("machine_failure").alias("count"),
            F.sum(F.col("machine_failure").cast("bigint")).alias("failures"),
        )
        .withColumn("rate", ratio(F.col("failures"), F.col("count")))
    )


def counts_above(
    df: DataFrame, levels: Sequence[float] = FLEET_LEVELS, score: str = "prob_failure"
) -> DataFrame:
    """Rows at or above each level, all levels in one scan."""
    score = nan_to_null(score)
    return df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(float(level)).alias("threshold"),
                    F.count_if(score >= F.lit(float(level))).alias("count"),
                )
                for level in levels
            ]
        ).alias("levels")
    ).select(F.inline("levels"))


def fleet_summary(df: DataFrame, threshold: float = fr.DEFAULT_THRESHOLD) -> DataFrame:
    """Every fleet-wide number in one row and one scan."""
    prob = nan_to_null("prob_failure")
    counted = df.agg(
        F.count("*").alias("machines"),
        F.count_if(fr.at_risk("prob_failure", threshold)).alias("n_at_risk"),
        F.sum(F.col("machine_failure").cast("bigint")).alias("failures"),
        F.avg(prob).alias("mean_probability"),
        F.max(prob).alias("max_probability"),
        F.count_if(fr.is_correct("prediction", "machine_failure")).alias("correct"),
        *[
            F.count_if(fr.risk_tier("prob_failure") == name).alias(f"tier_{name.lower()}")
            for name in fr.TIERS
        ],
        *outcome_cells("machine_failure", "prediction"),
        *[
            F.count_if(prob >= F.lit(level)).alias(f"above_{round(level * 100)}")
            for level in FLEET_LEVELS
        ],
    )
    by_name = rates()
    return counted.select(
        F.lit(float(threshold)).alias("threshold"),
        *[c for c in counted.columns if c != "correct"],
        ratio(F.col("correct"), F.col("machines")).alias("accuracy"),
        *[by_name[n].alias(n) for n in ("precision", "recall", "f1")],
    )


def histogram(
    df: DataFrame,
    value: str,
    bins: int,
    lower: float | None = None,
    upper: float | None = None,
) -> DataFrame:
    """Equal-width counts, empty bins included, the last bin closed.

    A bound that is not given is the data's minimum or maximum, widened by a
    half when those are equal. Values outside given bounds are not
    counted.
    """
    spark = df.sparkSession
    values = df.select(nan_to_null(value).alias("_x")).filter("_x is not null")
    if lower is None or upper is None:
        span = values.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"))).scalar()
        flat = span["lo"] == span["hi"]
        lo = F.when(flat, span["lo"] - F.lit(0.5)).otherwise(span["lo"])
        hi = F.when(flat, span["hi"] + F.lit(0.5)).otherwise(span["hi"])
    lo = lo if lower is None else F.lit(float(lower))
    hi = hi if upper is None else F.lit(float(upper))
    x = F.col("_x")
    place = F.floor((x - lo) / (hi - lo) * F.lit(float(bins)))
    counted = (
        values.filter((x >= lo) & (x <= hi))
        .groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count("*").alias("count"))
    )
    # all bins once: their number is a parameter, so both sides have `bins` rows
    every_bin = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / F.lit(float(bins))
    return every_bin.join(counted, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("lower"),
        (lo + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
    )


def lookup(df: DataFrame, unit: int, order: str, unit_column: str = "udi") -> DataFrame:
    """First row of one machine; the equality filter reaches the file scan.

    Rows that share ``order`` are told apart by their other plain columns.
    """
    ties = [f.name for f in df.schema if isinstance(f.dataType, AtomicType) and f.name != order]
    return df.filter(column(unit_column) == unit).orderBy(order, *ties).limit(1)
