"""Joins on a key that owns a third or more of all rows are split by Spark."""

import pytest
from pyspark.sql import functions as F

from faultline.operators import fieldlog, reports

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_limits(spark):
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def hot_log(spark, rows=20_000):
    unit = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 997)
    return spark.range(0, rows, 1, 8).select(
        F.concat(F.lit("M-"), unit.cast("string")).alias("machine_id"),
        F.col("id").alias("n"),
        F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("transcript"),
    )


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_machine_in_the_log(spark, small_limits):
    machines = spark.range(1200).selectExpr("id udi", "0.5D prob_failure")
    out = fieldlog.machine_reports(machines, hot_log(spark), ("n", "transcript"))
    rows = out.collect()
    assert len(rows) == 20_000 + 203
    hot = sum(i % 2 == 0 or i % 997 == 7 for i in range(20_000))
    assert sum(r["udi"] == 7 for r in rows) == hot
    assert "skew=true" in final_plan(out)


def test_reports_without_a_known_machine(spark, small_limits):
    """Half of all reports carry no machine number, so their join key is null."""
    made = hot_log(spark).select(
        F.when(F.col("n") % 2 == 0, F.lit("LINE 3")).otherwise(F.col("machine_id")).alias("machine_id"),
        F.col("transcript").alias("fault_description"),
    )
    scored = spark.range(1200).selectExpr("id udi", "0.5D prob_failure")
    out = reports.with_machine_risk(reports.valid_reports(made), scored)
    rows = out.collect()
    assert len(rows) == 20_000
    assert sum(r["risk_tier"] is None for r in rows) == 10_000
    assert "skew=true" in final_plan(out)
