"""Cases that the test tables do not show."""

from pyspark.sql import functions as F

from faultline.functions.text import is_report_object
from faultline.operators import cleaning, fieldlog, policy, reports, risk


def test_whole_numbers_with_a_point_are_integers(spark):
    raw = spark.createDataFrame(
        [("1551.0",), ("1.5",), ("7",), ("x",), (None,), ("99999999999.0",)], "n string"
    )
    got = [r.n for r in raw.select(cleaning.typed("n", "int")).collect()]
    assert got == [1551, None, 7, None, None, None]
    assert cleaning.cast_losses(raw, [("n", "int")]).first().lost == 3


def test_nan_text_is_reported_as_lost(spark):
    raw = spark.createDataFrame([("NaN",), ("1.5",), (None,)], "v string")
    assert cleaning.cast_losses(raw, [("v", "double")]).first().lost == 1
    column = raw.select(F.col("v").cast("double"))
    assert cleaning.column_check(column, ["v"]).first().nulls == 2


def test_one_given_bound(spark):
    frame = spark.createDataFrame([(0.0,), (4.0,), (10.0,)], "v double")
    rows = risk.histogram(frame, "v", 2, lower=2.0).orderBy("bin").collect()
    assert [(r.lower, r.upper, r["count"]) for r in rows] == [(2.0, 6.0, 1), (6.0, 10.0, 1)]


def test_capacity_of_an_empty_frame(spark):
    empty = spark.createDataFrame([], "s double, k long")
    for k in (10_000, 10_001):
        row = policy.capacity_threshold(empty, "s", "k", k).first()
        assert (row.cutoff_score, row.selected) == (None, 0)


def test_nan_score_does_not_spread(spark):
    scored = spark.createDataFrame(
        [(1, 0.5, 0), (2, float("nan"), 1), (3, 0.4, 0)],
        "udi long, prob_failure double, machine_failure int",
    )
    log = spark.createDataFrame(
        [], "machine_id string, timestamp string, urgency string, transcript string"
    )
    rows = fieldlog.machine_facts(scored, log, 3).collect()
    assert {r.fleet_mean for r in rows} == {0.45}
    assert not any("NaN" in (r.probability_text or "") for r in rows)


def test_text_behind_the_object_is_no_report(spark):
    good = '{"fault_description":"x"}'
    frame = spark.createDataFrame([(good,), (good + " {}",), (good + " trailing }",)], "j string")
    parsed = F.from_json("j", "fault_description string, _corrupt_record string")
    got = [r[0] for r in frame.select(is_report_object("j", parsed)).collect()]
    assert got == [True, False, False]


def test_look_ups_break_ties_by_value(spark):
    rows = [(1, 0.9, 0), (1, 0.1, 1), (2, float("nan"), 0), (2, 0.4, 1)]
    columns = "udi int, prob_failure double, machine_failure int"
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, columns).repartition(3)
        got = {r["unit"]: r["prob_failure"] for r in reports.one_score_per_machine(df).collect()}
        assert got == {1: 0.1, 2: 0.4}
        assert tuple(risk.lookup(df, 1, "udi").first()) == (1, 0.1, 1)
