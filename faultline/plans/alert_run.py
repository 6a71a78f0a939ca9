"""Batch scoring run: file in, ranked alerts out, summary on the side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from faultline.models.score import score_and_alert
from faultline.models.train import load_model
from faultline.operators import alerts, risk
from faultline.operators.cleaning import enforce_present_types, sanitize_columns
from faultline.schemas import raw_text_schema
from faultline.sources.readers import read_csv
from faultline.sources.writers import export_scored


@dataclass
class AlertRun:
    scored: DataFrame
    filtered: DataFrame
    summary: DataFrame
    histogram: DataFrame
    preview: DataFrame
    categories: DataFrame
    ranges: DataFrame


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw sensor file under clean names and types. It need not have a label or
    failure flags, and columns of its own are carried along."""
    return enforce_present_types(sanitize_columns(read_csv(spark, path, raw_text_schema())))


def run(
    spark: SparkSession,
    path: str,
    model_path: str,
    k: int = 50,
    key: str = "udi",
    min_score: float = 0.0,
    categories: Sequence[str] | None = None,
    ranges: Mapping[str, tuple[float, float]] | None = None,
    alerts_only: bool = True,
    export_path: str | None = None,
    filtered_path: str | None = None,
) -> AlertRun:
    """Score a file once. The ranked rows are already written (see
    ``ranking.global_rank``), so each panel and export reads only its columns."""
    scored = score_and_alert(read_raw(spark, path), load_model(model_path), k, key)
    filtered = alerts.filter_scored(scored, min_score, categories, ranges, alerts_only)
    if export_path:
        export_scored(scored, export_path)
    if filtered_path:
        export_scored(filtered, filtered_path)
    return AlertRun(
        scored,
        filtered,
        alerts.scoring_summary(scored),
        risk.histogram(scored, "p_failure", 30),
        alerts.alerts_preview(scored),
        alerts.category_domain(scored),
        alerts.range_domain(scored),
    )
