import pytest

from faultline.operators import cleaning, profile, quality
from faultline.schemas import CLEAN_COLUMNS, RAW_COLUMNS

COLUMNS = [("udi", "int"), ("torque_nm", "double"), ("type", "string")]


def test_sanitize_columns(spark):
    df = spark.createDataFrame([("1", "2")], "`Torque [Nm]` string, `Product ID` string")
    assert cleaning.sanitize_columns(df).columns == ["torque_nm", "product_id"]


def test_name_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, a_b int")
    with pytest.raises(ValueError, match="a_b"):
        cleaning.sanitize_columns(df)


def test_raw_names_become_clean_names(spark):
    from faultline.schemas import raw_schema

    df = spark.createDataFrame([], raw_schema())
    assert cleaning.sanitize_columns(df).columns == [n for n, _ in CLEAN_COLUMNS]


def test_required_columns(spark):
    with pytest.raises(ValueError, match=r"\['x', 'y'\]"):
        cleaning.require_columns(spark.range(1), ["id", "y", "x"])


def test_schema_diff(spark):
    diff = cleaning.schema_diff(spark.range(1), [n for n, _ in RAW_COLUMNS][:1])
    assert {tuple(r) for r in diff.collect()} == {("UDI", "missing"), ("id", "extra")}
    assert cleaning.schema_diff(spark.range(1), ["id"]).count() == 0


def test_malformed_fields_become_null_and_are_reported(spark):
    rows = [("1", "2.5", "L"), ("x", "NaN", None), (None, "oops", "M")]
    df = spark.createDataFrame(rows, "udi string, torque_nm string, type string").coalesce(1)
    typed = cleaning.enforce_types(df, COLUMNS)
    assert dict(typed.dtypes) == dict(COLUMNS)
    assert [tuple(r) for r in typed.collect()] == [(1, 2.5, "L"), (None, None, None), (None, None, "M")]
    losses = cleaning.cast_losses(df, COLUMNS)
    assert {r["column"]: r["lost"] for r in losses.collect()} == {"udi": 1, "torque_nm": 2, "type": 0}
    warned = quality.enforce(quality.cast_loss_report(losses))
    assert {r["column"] for r in warned} == {"udi", "torque_nm"}


def sensors(spark, rows):
    return spark.createDataFrame(
        rows, "udi int, type string, machine_failure int, air_temperature_k double"
    )


GOOD = [(1, "L", 0, 300.0), (2, "M", 1, 301.0)]


def test_gate_passes(spark):
    assert quality.enforce(quality.quality_report(sensors(spark, GOOD), quality.SENSOR_RULES)) == []


@pytest.mark.parametrize(
    "rows, check",
    [
        ([*GOOD, (2, "L", 0, 300.0)], "unique"),
        ([*GOOD, (3, None, 0, 300.0)], "not_null"),
        ([(1, "L", 0, 300.0)], "class_present"),
    ],
)
def test_gate_raises(spark, rows, check):
    with pytest.raises(quality.QualityError, match=check):
        quality.enforce(quality.quality_report(sensors(spark, rows), quality.SENSOR_RULES))


def test_row_count_rule(spark):
    report = quality.quality_report(sensors(spark, GOOD), quality.Rules(expected_rows=3))
    with pytest.raises(quality.QualityError, match="row_count"):
        quality.enforce(report)
    empty = quality.quality_report(sensors(spark, []), quality.Rules(not_empty=True))
    with pytest.raises(quality.QualityError, match="not_empty"):
        quality.enforce(empty)


def test_range_only_warns(spark):
    rows = [(1, "L", 0, 100.0), (2, "M", 1, 301.0)]
    warned = quality.enforce(quality.quality_report(sensors(spark, rows), quality.SENSOR_RULES))
    assert [(r["check"], r["value"]) for r in warned] == [("range_low", 100.0)]


def test_range_of_an_all_null_column_fails_without_error(spark):
    rows = [(1, "L", 0, None), (2, "M", 1, None)]
    warned = quality.enforce(quality.quality_report(sensors(spark, rows), quality.SENSOR_RULES))
    assert {r["check"] for r in warned} == {"range_low", "range_high"}


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (None, 3.0)], "a int, b double")
    rows = [tuple(r) for r in profile.null_profile(df).collect()]
    assert rows == [("b", 2), ("a", 1)]
    assert profile.null_profile(df, top=1).count() == 1


def test_label_distribution(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,), (None,)], "y int")
    got = {r["y"]: (r["count"], r["share"]) for r in profile.label_distribution(df, "y").collect()}
    assert got == {0: (3, 0.75), 1: (1, 0.25)}
    assert profile.prevalence(df, "y").first()[0] == 0.25
