"""Operators that take their input apart once."""

from pyspark.sql import functions as F

from faultline.operators import cleaning, fieldlog, profile, quality
from faultline.schemas import CLEAN_COLUMNS


def text_plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_one_index_serves_exact_and_contained_numbers(spark):
    rows = [("M-7", "a"), ("M-17", "b"), ("line 7 of 17", "c"), ("", "d"), (None, "e"), ("M-007", "f")]
    log = spark.createDataFrame(rows, "machine_id string, transcript string")
    machines = spark.createDataFrame([(7,), (17,), (99,)], "udi int")
    index = fieldlog.log_index(log, ["transcript"])
    assert index.columns == ["udi", "exact", "contains", "transcript"]
    for mode in fieldlog.MODES:
        found = fieldlog.indexed_reports(machines, index, ["transcript"], mode)
        assert "Generate" not in text_plan(found)
        got = {(r["udi"], r["transcript"]) for r in found.collect()}
        again = fieldlog.machine_reports(machines, log, ["transcript"], mode).collect()
        assert got == {(r["udi"], r["transcript"]) for r in again} and len(again) == len(got)
        assert (99, None) in got
    inside = {(r["udi"], r["transcript"]) for r in index.filter("contains").collect()}
    assert {(7, "a"), (7, "b"), (17, "b"), (7, "c"), (17, "c"), (7, "f")} <= inside
    assert {(7, "a"), (17, "b")} <= {(r["udi"], r["transcript"]) for r in index.filter("exact").collect()}


def test_each_field_of_the_gate_is_cast_once(spark, tmp_path):
    bronze = spark.createDataFrame(
        [tuple("1" for _ in CLEAN_COLUMNS), tuple("x" for _ in CLEAN_COLUMNS), tuple(None for _ in CLEAN_COLUMNS)],
        ", ".join(f"{n} string" for n, _ in CLEAN_COLUMNS),
    )
    bronze.write.parquet(str(tmp_path / "bronze"))
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    rules = quality.Rules(expected_rows=3, not_null=("udi", "type"), ranges={"torque_nm": (0.0, 2.0)})
    together = quality.typed_report(bronze, rules)
    apart = quality.quality_report(cleaning.enforce_types(bronze), rules).unionByName(
        quality.cast_loss_report(cleaning.cast_losses(bronze))
    )
    assert sorted(map(tuple, together.collect())) == sorted(map(tuple, apart.collect()))
    # the duplicate check is a scan of its own in neither
    assert text_plan(together).count("Relation [") == 1 and text_plan(apart).count("Relation [") == 2


def test_shares_come_from_written_counts(spark, tmp_path):
    path = str(tmp_path / "labels")
    spark.createDataFrame([(1,), (1,), (0,), (None,)], "y int").write.parquet(path)
    shares = profile.label_distribution(spark.read.parquet(path), "y")
    assert path not in shares.select(F.input_file_name()).first()[0]
    assert {r["y"]: (r["count"], r["share"]) for r in shares.collect()} == {1: (2, 2 / 3), 0: (1, 1 / 3)}
    empty = spark.createDataFrame([], "y int")
    assert profile.label_distribution(empty, "y").count() == 0
