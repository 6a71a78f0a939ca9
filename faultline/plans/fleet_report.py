"""Fleet risk report: every panel from one prepared risk table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from faultline.functions.risk import DEFAULT_THRESHOLD
from faultline.operators import fieldlog, metrics, reports, risk
from faultline.sources.readers import first_available
from faultline.storage import materialize

LABEL, PREDICTION, SCORE = "machine_failure", "prediction", "prob_failure"


def load(
    spark: SparkSession, sources: Sequence[tuple[str, StructType | None]]
) -> DataFrame:
    """Predictions from the first source that exists."""
    return first_available(spark, sources)


def panels(
    predictions: DataFrame,
    log: DataFrame,
    log_order: Sequence[str],
    threshold: float = DEFAULT_THRESHOLD,
    k: int = 10,
    key: str = "udi",
    written: bool = True,
) -> dict[str, DataFrame]:
    """Name -> frame. ``log_order`` names columns that order the log fully;
    stamps have seconds and tie. The risk table is written once, so a CSV is parsed once
    and panels read the columns they need. Pass ``written=False`` when the
    predictions are a columnar table already: the risk columns are row-local.
    """
    table = risk.risk_frame(predictions, threshold)
    if written:
        table = materialize(table, "risk-table")
    return {
        "risk_table": table,
        "kpis": metrics.kpi_status(table, SCORE, LABEL, PREDICTION, threshold),
        "top_alerts": risk.top_alerts(table, k, key),
        "machine_options": risk.machine_options(table, 20, key),
        "machine_facts": fieldlog.machine_facts(table, log, k, key),
        "score_histogram": risk.histogram(table, SCORE, 40, 0.0, 1.0),
        "tier_counts": risk.tier_counts(table),
        "tier_failure_rate": risk.tier_failure_rate(table),
        "confusion": metrics.confusion_grouped(table, LABEL, PREDICTION),
        "metrics": metrics.binary_metrics(table, LABEL, PREDICTION),
        "fleet_brief": reports.fleet_brief(table, log, log_order, threshold=threshold, key=key),
        "shift_summary": reports.shift_summary(
            table, log, log_order, k, threshold=threshold, key=key
        ),
        "log_kpis": fieldlog.log_kpis(log),
        "urgency_breakdown": fieldlog.urgency_breakdown(log),
        "latest_log": fieldlog.latest_log(log, *log_order),
    }
