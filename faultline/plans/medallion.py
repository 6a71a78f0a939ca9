"""Raw file -> bronze -> silver -> gold -> predictions -> exported CSV."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from faultline.functions.numeric import vector_element
from faultline.models.features import CATEGORICAL, FULL_NUMERIC, SAFE_NUMERIC, TARGET
from faultline.models.features import engineered, feature_stages
from faultline.models.importance import feature_importance
from faultline.models.score import serving_rows
from faultline.models.train import forest, spread
from faultline.operators import cleaning, quality
from faultline.operators.curves import roc_auc
from faultline.operators.metrics import binary_metrics, confusion_cells
from faultline.operators.splitting import hash_split, split_counted
from faultline.schemas import CLEAN_COLUMNS, raw_text_schema
from faultline.sources.readers import read_csv
from faultline.sources.tables import ensure_table, use_namespace, write_checked
from faultline.sources.writers import export_predictions

BRONZE, SILVER, GOLD, PREDICTIONS = (
    "bronze_raw",
    "silver_clean",
    "gold_features",
    "predictions",
)


@dataclass
class MedallionRun:
    bronze: DataFrame
    silver: DataFrame
    gold: DataFrame
    predictions: DataFrame
    model: PipelineModel
    warnings: list
    metrics: Row
    roc_auc: float
    importance: DataFrame
    scorer: PipelineModel


def build_bronze(
    spark: SparkSession, path: str, expected_rows: int | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Raw text columns under clean names; kept when already complete."""

    def build() -> DataFrame:
        raw = cleaning.sanitize_columns(read_csv(spark, path, raw_text_schema()))
        return cleaning.require_columns(raw, [name for name, _ in CLEAN_COLUMNS])

    return ensure_table(spark, BRONZE, build, expected_rows, fmt)


def build_silver(
    bronze: DataFrame,
    rules: quality.Rules = quality.SENSOR_RULES,
    expected_rows: int | None = None,
    fmt: str = "parquet",
) -> tuple[DataFrame, list]:
    """Typed rows behind the quality gate, and the warnings it gave."""
    silver = cleaning.enforce_types(bronze)
    rules = replace(rules, expected_rows=expected_rows)
    warned = quality.enforce(quality.typed_report(bronze, rules))
    # one typed row per bronze row: counting bronze reads no column
    return write_checked(silver, SILVER, fmt, expected_rows=bronze.count()), warned


def build_gold(
    silver: DataFrame, include_flags: bool = False, fmt: str = "parquet"
) -> tuple[DataFrame, PipelineModel]:
    """Ids, label and feature vector; every vector must be free of NaN, which
    a missing sensor value becomes and no learner accepts."""
    ready = silver if include_flags else engineered(silver)
    numeric = FULL_NUMERIC if include_flags else SAFE_NUMERIC
    fitted = Pipeline(stages=feature_stages(CATEGORICAL, numeric)).fit(ready)
    gold = fitted.transform(ready).select("udi", "product_id", TARGET, "features")
    written = write_checked(gold, GOLD, fmt, expected_rows=silver.count())
    finite = F.when(~F.exists(vector_to_array("features"), F.isnan), F.lit(1)).alias("features")
    quality.enforce(
        quality.quality_report(written.select(finite), quality.Rules(not_null=("features",)))
    )
    return written, fitted


def run(
    spark: SparkSession,
    path: str,
    namespace: str,
    location: str | None = None,
    expected_rows: int | None = None,
    include_flags: bool = False,
    test_fraction: float = 0.2,
    seed: int = 42,
    fmt: str = "parquet",
    export_path: str | None = None,
    **forest_settings,
) -> MedallionRun:
    """All layers. Predictions are written before they are measured, so the
    test part is scored once."""
    use_namespace(spark, namespace, location)
    bronze = build_bronze(spark, path, expected_rows, fmt)
    silver, warned = build_silver(bronze, expected_rows=expected_rows, fmt=fmt)
    gold, fitted = build_gold(silver, include_flags, fmt)

    train, test, _, test_rows = split_counted(hash_split(gold, "udi", test_fraction, seed))
    model = PipelineModel([forest(seed=seed, **forest_settings).fit(spread(train))])
    scored = model.transform(test)
    predictions = write_checked(serving_rows(scored), PREDICTIONS, fmt, "warn", test_rows)
    metrics = binary_metrics(predictions, TARGET, "prediction").first()
    warned += quality.enforce(
        quality.missed_failures_report(confusion_cells(predictions, TARGET, "prediction"))
    )
    if export_path:
        export_predictions(predictions, export_path)
    measured = predictions.select(TARGET, vector_element("probability").alias("_score"))
    return MedallionRun(
        bronze,
        silver,
        gold,
        predictions,
        model,
        warned,
        metrics,
        roc_auc(measured, "_score", TARGET).first()[0],
        feature_importance(model, scored.select(F.col("features"))),
        # feature stages and learner together: scores typed sensor rows, not only gold ones
        PipelineModel([*fitted.stages, *model.stages]),
    )
