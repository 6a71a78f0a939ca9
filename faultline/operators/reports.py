"""Maintenance-report and shift-report rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from faultline.functions.numeric import column, nan_to_null, percent_text
from faultline.functions.risk import (
    DEFAULT_THRESHOLD,
    machine_label,
    machine_number,
    risk_tier,
)
from faultline.functions.text import blank_to_null, shortened
from faultline.operators.fieldlog import SPACE
from faultline.operators.metrics import outcome_cells
from faultline.operators.ranking import last_rows, top_k_ranked
from faultline.operators.risk import fleet_summary
from faultline.schemas import REPORT_COLUMNS

# Section headings and the report fields behind them, in order.
SECTIONS = [
    ("Fault Description", "fault_description"),
    ("Root Cause Analysis", "root_cause"),
    ("Work Performed", "work_performed"),
    ("Parts Used", "parts_used"),
    ("Downtime", "downtime_hours"),
    ("Recommendations", "recommendations"),
    ("Next Maintenance Date", "next_maintenance_date"),
]
LINKED_HEADING = "LINKED SHIFT REPORT"


def with_report_defaults(reports: DataFrame) -> DataFrame:
    """The eleven report fields as text; absent ones blank, ids trimmed."""
    filled = {
        name: F.coalesce(F.col(name).cast("string"), F.lit(""))
        if name in reports.columns
        else F.lit("")
        for name in REPORT_COLUMNS
    }
    filled["machine_id"] = F.btrim(filled["machine_id"], F.lit(SPACE))
    filled["technician"] = F.when(filled["technician"] == "", F.lit("Unknown")).otherwise(
        filled["technician"]
    )
    others = [c for c in reports.columns if c not in REPORT_COLUMNS]
    return reports.select(*others, *[filled[name].alias(name) for name in REPORT_COLUMNS])


def reject_reason() -> Column:
    """Why a report cannot be issued; null when it can."""
    no_machine = F.btrim("machine_id", F.lit(SPACE)) == ""
    no_content = (
        (F.col("fault_description") == "")
        & (F.col("root_cause") == "")
        & (F.col("recommendations") == "")
    )
    return F.when(no_machine, F.lit("machine id missing")).when(
        no_content, F.lit("no fault, cause or recommendation")
    )


def valid_reports(reports: DataFrame) -> DataFrame:
    return with_report_defaults(reports).filter(reject_reason().isNull())


def rejected_reports(reports: DataFrame) -> DataFrame:
    checked = with_report_defaults(reports).withColumn("reason", reject_reason())
    return checked.filter(F.col("reason").isNotNull())


def one_score_per_machine(scored: DataFrame, key: str = "udi", order: str = "udi") -> DataFrame:
    """First score of every machine by ``order``; combines on the map side.

    Rows that share machine and order give the lowest score, missing ones last.
    """
    score = nan_to_null("prob_failure")
    first = F.struct(F.col(order), score.isNull(), score)
    return scored.groupBy(F.col(key).cast("bigint").alias("unit")).agg(
        F.min_by(score, first).alias("prob_failure")
    )


def with_machine_risk(
    reports: DataFrame, scored: DataFrame, key: str = "udi", order: str = "udi"
) -> DataFrame:
    """Left lookup of tier and score by the number in the machine label."""
    scores = one_score_per_machine(scored, key, order).select(
        "unit", "prob_failure", risk_tier("prob_failure").alias("risk_tier")
    )
    return (
        reports.withColumn("unit", machine_number("machine_id"))
        .join(scores, "unit", "left")
        .drop("unit")
    )


def downtime_text(value) -> Column:
    """'<value> hours' unless blank or zero."""
    text = blank_to_null(value)
    zero = text.try_cast("double") == 0
    return F.when(text.isNotNull() & ~F.coalesce(zero, F.lit(False)), F.concat(text, F.lit(" hours")))


def report_rows(reports: DataFrame, shift_report: str | Column | None = None) -> DataFrame:
    """Display row of every report: header, risk, sections, document name.

    Blank sections are null. A probability of 0.0 is a value, not missing.
    """
    linked = F.lit(None).cast("string") if shift_report is None else column(shift_report)
    others = [
        c
        for c in reports.columns
        if c not in REPORT_COLUMNS and c not in ("prob_failure", "risk_tier")
    ]
    bodies = {
        name: downtime_text(name) if name == "downtime_hours" else blank_to_null(name)
        for _, name in SECTIONS
    }
    probability = nan_to_null("prob_failure")
    return reports.select(
        *others,
        "machine_id",
        F.coalesce(blank_to_null("location"), F.lit("—")).alias("location"),
        "technician",
        "report_date",
        F.coalesce("risk_tier", F.lit("N/A")).alias("risk_tier"),
        F.coalesce(percent_text(probability), F.lit("N/A")).alias("probability_text"),
        *[body.alias(name) for name, body in bodies.items()],
        blank_to_null(shortened(linked)).alias("linked_shift_report"),
        F.concat(
            F.lit("maint_report_"),
            F.replace("machine_id", F.lit(" "), F.lit("_")),
            F.lit("_"),
            F.col("report_date"),
            F.lit(".pdf"),
        ).alias("document_name"),
    )


def report_sections(rows: DataFrame, *ids: str) -> DataFrame:
    """One row per non-blank section of ``report_rows``, in print order."""
    headed = [*SECTIONS, (LINKED_HEADING, "linked_shift_report")]
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"), F.lit(heading).alias("heading"), F.col(name).alias("body")
            )
            for i, (heading, name) in enumerate(headed, start=1)
        ]
    )
    kept = F.filter(entries, lambda entry: entry["body"].isNotNull())
    return rows.select(*ids, F.inline(kept))


def bounded_lines(head: DataFrame, order: Sequence[str], parts: Sequence[Column]) -> Column:
    """Rows of a short, limited frame as one text, a line per row."""
    line = F.concat_ws(" | ", *parts)
    lines = head.agg(F.sort_array(F.collect_list(F.struct(*order, line.alias("line")))).alias("l"))
    return F.concat_ws("\n", lines.scalar()["line"])


def top_machines_text(scored: DataFrame, k: int, key: str = "udi") -> Column:
    """The k riskiest machines: label, probability, tier, outcome per line."""
    top = top_k_ranked(
        scored.select(key, "prob_failure", "machine_failure"), "prob_failure", key, k, "_rank"
    )
    return bounded_lines(
        top,
        ["_rank"],
        [
            machine_label(key),
            percent_text("prob_failure"),
            F.coalesce(risk_tier("prob_failure"), F.lit("N/A")),
            F.col("machine_failure").cast("string"),
        ],
    )


def recent_reports_text(log: DataFrame, n: int, log_order: Sequence[str]) -> Column:
    """The last n log rows in append order, one per line."""
    shown = [F.col(c) for c in ("timestamp", "machine_id", "urgency", "transcript")]
    return bounded_lines(last_rows(log, n, *log_order), log_order, shown)


def shift_summary(
    scored: DataFrame,
    log: DataFrame,
    log_order: Sequence[str],
    k: int = 10,
    log_rows: int = 10,
    threshold: float = DEFAULT_THRESHOLD,
    key: str = "udi",
) -> DataFrame:
    """One handover row: counts, the top k machines and the last log rows."""
    return scored.agg(
        F.count("*").alias("machines"),
        F.count_if(risk_tier("prob_failure") == "High").alias("high_risk"),
        F.sum(F.col("machine_failure").cast("bigint")).alias("failures"),
        *outcome_cells("machine_failure", "prediction"),
    ).select(
        "machines",
        F.lit(float(threshold)).alias("threshold"),
        "high_risk",
        "failures",
        "tp",
        F.col("fn").alias("missed"),
        top_machines_text(scored, k, key).alias("top_machines"),
        recent_reports_text(log, log_rows, log_order).alias("recent_reports"),
    )


def fleet_brief(
    scored: DataFrame,
    log: DataFrame,
    log_order: Sequence[str],
    k: int = 5,
    log_rows: int = 5,
    threshold: float = DEFAULT_THRESHOLD,
    key: str = "udi",
) -> DataFrame:
    """The fleet summary with the top machines and the last log rows."""
    return fleet_summary(scored, threshold).withColumns(
        {
            "top_machines": top_machines_text(scored, k, key),
            "recent_reports": recent_reports_text(log, log_rows, log_order),
        }
    )
