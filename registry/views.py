"""Failure-risk views of the test tables, each one scan of whole tables.

The sensor and the score view both come from ``events``; a query that needs
both takes ``labelled``, one projection, instead of joining them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from faultline.functions.risk import machine_label

RAW_FLAGS = ["TWF", "HDF", "PWF", "OSF", "RNF"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash32(value):
    digest = F.md5(value.cast("string").cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def score_columns() -> dict:
    prob = F.least(F.col("value") / F.lit(200.0), F.lit(1.0))
    fails = (F.col("value") > 100) & F.col("event_type").isin("error", "purchase", "signup")
    noise = hash32(F.col("event_id")) % 100 < 2
    return {
        "udi": F.col("event_id"),
        "machine_id": F.col("user_id"),
        "type": F.col("event_type"),
        "prob_failure": prob,
        "prediction": (prob >= F.lit(0.45)).cast("double"),
        "machine_failure": (fails | noise).cast("int"),
    }


def sensor_columns() -> dict:
    hour = F.hour("ts").cast("double") / F.lit(2.0)
    return {
        "udi": F.col("event_id"),
        "product_id": F.concat("event_type", F.lit("-"), F.col("user_id").cast("string")),
        "type": F.col("event_type"),
        "air_temperature_k": F.lit(295.0) + hour,
        "process_temperature_k": F.lit(303.0)
        + hour
        + (F.col("user_id") % 5).cast("double"),
        "rotational_speed_rpm": (F.lit(1200) + F.floor(F.col("value") * 3)).cast("int"),
        "torque_nm": F.get_json_object("props", "$.k").cast("double") / F.lit(2.0),
        "tool_wear_min": (F.col("event_id") % 254).cast("int"),
    }


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        *[c.alias(n) for n, c in score_columns().items()]
    )


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        *[c.alias(n) for n, c in sensor_columns().items()]
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensors with the label, the score and failure flags, in one projection."""
    columns = sensor_columns()
    scores = score_columns()
    columns["machine_failure"] = scores["machine_failure"]
    columns["p_failure"] = scores["prob_failure"]
    for i, flag in enumerate(RAW_FLAGS):
        hit = (scores["machine_failure"] == 1) & (F.col("event_id") % 5 == i)
        columns[flag.lower()] = hit.cast("int")
    return table(spark, sf_dir, "events").select(*[c.alias(n) for n, c in columns.items()])


def raw_text(spark: SparkSession, sf_dir: str, damaged: bool = True) -> DataFrame:
    """The raw file's columns as text; some torque fields unreadable or NaN."""
    base = labelled(spark, sf_dir)
    torque = F.col("torque_nm").cast("string")
    if damaged:
        torque = (
            F.when(F.col("udi") % 97 == 0, F.lit("n/a"))
            .when(F.col("udi") % 101 == 0, F.lit("NaN"))
            .otherwise(torque)
        )
    named = {
        "UDI": "udi",
        "Product ID": "product_id",
        "Type": "type",
        "Air temperature [K]": "air_temperature_k",
        "Process temperature [K]": "process_temperature_k",
        "Rotational speed [rpm]": "rotational_speed_rpm",
        "Torque [Nm]": torque,
        "Tool wear [min]": "tool_wear_min",
        "Machine failure": "machine_failure",
        **{flag: flag.lower() for flag in RAW_FLAGS},
    }
    return base.select(
        *[
            (F.col(c).cast("string") if isinstance(c, str) else c).alias(n)
            for n, c in named.items()
        ]
    )


def field_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows; (conv_id, turn) is their append order and unique."""
    urgency = (
        F.when(F.col("conv_id") % 4 == 0, F.lit("High"))
        .when(F.col("conv_id") % 4 == 1, F.lit("Medium"))
        .when(F.col("conv_id") % 4 == 2, F.lit("Low"))
        .otherwise(F.lit("Unknown"))
    )
    # without a time zone, so the text is the same under any session zone
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    moment = F.timestamp_add("SECOND", (F.col("conv_id") * 60 + F.col("turn")).cast("int"), start)
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        machine_label(F.col("conv_id") % 50).alias("machine_id"),
        F.col("role").alias("technician"),
        urgency.alias("urgency"),
        F.col("text").alias("transcript"),
    )


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maintenance reports, some without a machine and some without content."""
    conv, turn, blank = F.col("conv_id"), F.col("turn"), F.lit("")
    machine = (
        F.when(conv % 11 == 0, F.lit("   "))
        .when(conv % 13 == 0, F.concat(F.lit(" LINE "), conv.cast("string")))
        .otherwise(F.concat(F.lit("M-"), (conv * 7 % 500).cast("string")))
    )
    silent = turn % 4 == 3
    day = F.lpad((conv % 28 + 1).cast("string"), 2, "0")
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        machine.alias("machine_id"),
        F.when(turn % 2 == 0, F.concat(F.lit("Line "), turn.cast("string")))
        .otherwise(blank)
        .alias("location"),
        F.when(F.col("role") == "system", blank).otherwise(F.col("role")).alias("technician"),
        F.concat(F.lit("2024-01-"), day).alias("report_date"),
        F.when(silent, blank).otherwise(F.col("text")).alias("fault_description"),
        F.when(turn % 3 == 0, F.lit("wear")).otherwise(blank).alias("root_cause"),
        F.lit("  ").alias("work_performed"),
        F.when(conv % 2 == 0, F.lit("seal kit")).alias("parts_used"),
        turn.cast("string").alias("downtime_hours"),
        F.when(silent, blank).otherwise(F.lit("inspect")).alias("recommendations"),
        F.when(conv % 3 == 0, F.lit("2024-03-01")).otherwise(blank).alias("next_maintenance_date"),
        F.col("text").alias("shift_report"),
    )


def extracted_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows with extraction output: JSON, fenced JSON, prose, cut JSON."""
    log = field_log(spark, sf_dir)
    record = F.to_json(
        F.struct(
            F.col("transcript").alias("fault_description"),
            F.lit("worn seal").alias("root_cause"),
            F.col("turn").alias("downtime_hours"),
            F.when(F.col("conv_id") % 2 == 0, F.lit("2024-02-11"))
            .otherwise(F.lit("next week"))
            .alias("next_maintenance_date"),
        )
    )
    raw = (
        F.when(F.col("turn") % 4 == 0, record)
        .when(F.col("turn") % 4 == 1, F.concat(F.lit("```json\n"), record, F.lit("\n```")))
        .when(F.col("turn") % 4 == 2, F.col("transcript"))
        .otherwise(F.substring(record, 1, 40))
    )
    return log.select("conv_id", "turn", "transcript", raw.alias("extracted"))


def documents_with_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
