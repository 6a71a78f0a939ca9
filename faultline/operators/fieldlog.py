"""Field-report log: defaults, counts, latest rows, matching, extraction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from faultline.functions.numeric import column, nan_to_null, percent_text
from faultline.functions.risk import machine_label, machine_number, outcome_text, risk_tier
from faultline.functions.text import (
    is_report_object,
    report_struct,
    spoken_form,
    strip_code_fence,
)
from faultline.operators.ranking import last_rows, top_k_ranked
from faultline.schemas import EXTRACTED_FIELDS, LOG_COLUMNS
from faultline.storage import materialize

SPACE = " \t\r\n\f\v"

# Columns of the history table and its length.
HISTORY_COLUMNS = ["timestamp", "machine_id", "technician", "urgency", "transcript"]
HISTORY_ROWS = 20


def with_defaults(entries: DataFrame) -> DataFrame:
    """Trim identifiers, name a blank technician, blank absent log columns.

    A missing timestamp becomes the time of the job.
    """
    present = entries.columns
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    filled = {
        name: F.coalesce(F.col(name).cast("string"), F.lit("")) if name in present else F.lit("")
        for name in LOG_COLUMNS
    }
    filled["timestamp"] = (
        F.coalesce(F.col("timestamp").cast("string"), now) if "timestamp" in present else now
    )
    filled["machine_id"] = F.btrim(filled["machine_id"], F.lit(SPACE))
    technician = F.btrim(filled["technician"], F.lit(SPACE))
    filled["technician"] = F.when(technician == "", F.lit("Unknown")).otherwise(technician)
    return entries.select(*[filled[name].alias(name) for name in LOG_COLUMNS])


def valid_entries(entries: DataFrame) -> DataFrame:
    """Log entries need a machine id."""
    return entries.filter(F.btrim("machine_id", F.lit(SPACE)) != "")


def log_kpis(log: DataFrame) -> DataFrame:
    return log.agg(
        F.count("*").alias("reports"),
        F.count_distinct("machine_id").alias("machines"),
        F.count_distinct("technician").alias("technicians"),
    )


def urgency_status(urgency) -> Column:
    """Colour by the level named in the text; the first of the three wins."""
    urgency = column(urgency)
    return (
        F.when(urgency.contains("High"), F.lit("red"))
        .when(urgency.contains("Medium"), F.lit("amber"))
        .when(urgency.contains("Low"), F.lit("green"))
        .otherwise(F.lit("neutral"))
    )


def urgency_breakdown(log: DataFrame) -> DataFrame:
    """Reports per declared urgency, most frequent first, with a status."""
    return (
        log.filter("urgency is not null")
        .groupBy("urgency")
        .agg(F.count("*").alias("reports"))
        .withColumn("status", urgency_status("urgency"))
        .orderBy(F.desc("reports"), "urgency")
    )


def latest_log(log: DataFrame, *tie_order: str, n: int = HISTORY_ROWS) -> DataFrame:
    """Newest rows by timestamp text, then by the given keys, present columns."""
    shown = [c for c in HISTORY_COLUMNS if c in log.columns]
    kept = list(dict.fromkeys([*shown, *tie_order]))
    return last_rows(log.select(*kept), n, "timestamp", *tie_order)


def log_tail(log: DataFrame, n: int, *order: str) -> DataFrame:
    """Last n rows in append order, given by the order columns."""
    return last_rows(log, n, *order)


def numbers_inside(text) -> Column:
    """Every whole number whose decimal text occurs somewhere in ``text``.

    Used to turn "the id text contains this number" into an equality join.
    A bigint has at most 20 characters, so the work is linear in the text.
    """
    runs = F.regexp_extract_all(column(text), F.lit(r"(-?[0-9]+)"), F.lit(1))

    def pieces(run):
        return F.flatten(
            F.transform(
                F.sequence(F.lit(1), F.length(run)),
                lambda start: F.transform(
                    F.sequence(F.lit(1), F.lit(20)), lambda size: F.substr(run, start, size)
                ),
            )
        )

    texts = F.array_distinct(F.flatten(F.transform(runs, pieces)))
    canonical = F.filter(texts, lambda t: t.rlike(r"^(0|-?[1-9][0-9]{0,18})$"))
    numbers = F.transform(canonical, lambda t: t.try_cast("bigint"))
    return F.filter(numbers, lambda n: n.isNotNull())


MODES = ("exact", "contains")


def log_index(
    log: DataFrame, log_columns: Sequence[str] = ("timestamp", "urgency", "transcript")
) -> DataFrame:
    """Written rows (udi, exact, contains, log columns): each log row once for
    every number its machine id names or contains.

    The texts are taken apart once, whatever is asked of the index afterwards.
    """
    inside = log.select("machine_id", *log_columns).withColumns(
        {"_named": machine_number("machine_id"), "_inside": numbers_inside("machine_id")}
    )
    numbers = F.array_compact(F.array_distinct(F.array_append(F.col("_inside"), F.col("_named"))))
    rows = inside.withColumn("udi", F.explode(numbers)).select(
        "udi",
        F.coalesce(F.col("udi") == F.col("_named"), F.lit(False)).alias("exact"),
        F.array_contains("_inside", F.col("udi")).alias("contains"),
        *log_columns,
    )
    return materialize(rows, "log-index")


def indexed_reports(
    machines: DataFrame,
    index: DataFrame,
    log_columns: Sequence[str] = ("timestamp", "urgency", "transcript"),
    mode: str = "exact",
) -> DataFrame:
    """``machine_reports`` from a ``log_index``."""
    if mode not in MODES:
        raise ValueError(f"unknown match mode: {mode}")
    reports = index.filter(mode).select("udi", *log_columns)
    units = machines.withColumn("udi", F.col("udi").cast("bigint"))
    matched = reports.join(units, "udi")
    unmatched = units.join(reports.select("udi").distinct(), "udi", "left_anti")
    return matched.select(*units.columns, *log_columns).unionByName(
        unmatched, allowMissingColumns=True
    )


def machine_reports(
    machines: DataFrame,
    log: DataFrame,
    log_columns: Sequence[str] = ("timestamp", "urgency", "transcript"),
    mode: str = "exact",
) -> DataFrame:
    """Machines with their field reports, one row per pair; machines without a
    report stay once with nulls. ``machines`` has one row per ``udi``.

    The log is the probe side of an inner equality join, so a machine owning a
    third of the log is split by Spark's skew handling (an outer join from the
    machine side could not be); unmatched machines are added by an anti join.
    """
    if mode not in MODES:
        raise ValueError(f"unknown match mode: {mode}")
    return indexed_reports(machines, log_index(log, log_columns), log_columns, mode)


def machine_facts(
    scored: DataFrame,
    log: DataFrame,
    k: int = 10,
    key: str = "udi",
    log_columns: Sequence[str] = ("timestamp", "urgency", "transcript"),
    mode: str = "exact",
) -> DataFrame:
    """Fact sheet of the k riskiest machines, a row per matching report."""
    scored = scored.withColumn("prob_failure", nan_to_null("prob_failure"))
    fleet_mean = scored.agg(F.avg("prob_failure")).scalar()
    narrow = scored.select(key, "prob_failure", "machine_failure")
    head = top_k_ranked(narrow, "prob_failure", key, k, "display_rank")
    facts = head.select(
        F.col(key).alias("udi"),
        machine_label(key).alias("machine"),
        "prob_failure",
        percent_text("prob_failure").alias("probability_text"),
        risk_tier("prob_failure").alias("risk_tier"),
        outcome_text("machine_failure", "YES", "No").alias("failure_recorded"),
        fleet_mean.alias("fleet_mean"),
    )
    # k rows, joined twice: ranked once
    return machine_reports(materialize(facts, "machine-facts"), log, log_columns, mode)


def match_option(
    df: DataFrame, spoken: str | Column, options: Sequence[str], out: str = "choice"
) -> DataFrame:
    """Add the first option that contains, or is contained in, the spoken phrase.

    The options are a short literal list, so this is row-local and no join. A
    phrase with nothing left after clean-up matches nothing.
    """
    # a column of its own, so the phrase is cleaned once and not per option
    rows = df.withColumn("_heard", spoken_form(spoken))
    heard = F.col("_heard")
    tests = []
    for option in options:
        form = spoken_form(F.lit(option))  # literal, folded before the job starts
        tests.append(F.when(heard.contains(form) | form.contains(heard), F.lit(option)))
    choice = F.when(heard != "", F.coalesce(*tests))
    return rows.withColumn(out, choice).drop("_heard")


def extract_report_fields(log: DataFrame, json_text: str, transcript: str) -> DataFrame:
    """Add the seven report fields; unreadable JSON falls back to the transcript
    as the fault description with every other field blank."""
    # columns of their own, so the text is cleaned and parsed once and not per field
    rows = log.withColumn("_json", strip_code_fence(json_text)).withColumn(
        "_parsed", report_struct("_json")
    )
    readable = is_report_object("_json", "_parsed")
    columns = {}
    for name in EXTRACTED_FIELDS:
        value = F.when(readable, F.col("_parsed")[name])
        if name == "fault_description":
            columns[name] = F.when(readable, F.coalesce(value, F.lit(""))).otherwise(
                F.col(transcript)
            )
        elif name == "downtime_hours":
            columns[name] = F.coalesce(value.try_cast("double"), F.lit(0.0))
        else:
            columns[name] = F.coalesce(value, F.lit(""))
    date_text = F.when(readable, F.col("_parsed")["next_maintenance_date"])
    columns["next_date"] = F.when(
        date_text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), date_text.try_cast("date")
    )
    columns["json_readable"] = readable
    return rows.withColumns(columns).drop("_json", "_parsed")
