import pytest
from pyspark.sql import functions as F

from faultline.operators.quality import QualityError
from faultline.plans import alert_run, fleet_report, medallion, policy_run
from faultline.sources import readers, writers
from faultline.sources.tables import table_exists
from registry import views


@pytest.fixture(scope="module")
def raw_file(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "sensors.csv")
    writers.write_csv(views.raw_text(spark, sf_dir, damaged=False), path)
    return path


def test_all_layers(spark, raw_file, tmp_path):
    out = str(tmp_path / "predictions")
    done = medallion.run(
        spark, raw_file, "medallion_db", expected_rows=1000, export_path=out, numTrees=5, maxDepth=4
    )
    spark.sql("USE default")
    for name in (medallion.BRONZE, medallion.SILVER, medallion.GOLD, medallion.PREDICTIONS):
        assert table_exists(spark, f"medallion_db.{name}")
    assert done.bronze.count() == done.silver.count() == done.gold.count() == 1000
    assert done.gold.columns == ["udi", "product_id", "machine_failure", "features"]
    assert dict(done.predictions.dtypes) == {
        "udi": "int", "machine_failure": "int", "prediction": "double", "probability": "vector",
    }
    assert len(done.gold.first()["features"]) == 12
    assert done.roc_auc > 0.6 and done.importance.count() == 5
    # the scorer takes silver rows and gives what the gold rows gave
    from faultline.models.features import engineered
    from faultline.models.train import load_model, save_model

    save_model(done.scorer, str(tmp_path / "scorer"))
    rescored = load_model(str(tmp_path / "scorer")).transform(engineered(done.silver))
    both = rescored.select("udi", F.col("prediction").alias("again")).join(done.predictions, "udi")
    assert both.filter("again <> prediction").count() == 0 < both.count()
    exported = readers.read_predictions(spark, out)
    assert exported.count() == done.predictions.count() == done.metrics["rows"]
    if done.metrics["fn"]:
        assert "missed_failures" in {w["check"] for w in done.warnings}


def test_flags_give_the_larger_vector(spark, raw_file):
    done = medallion.run(spark, raw_file, "flags_db", include_flags=True, numTrees=30, maxDepth=6)
    spark.sql("USE default")
    assert len(done.gold.first()["features"]) == 15
    assert done.roc_auc > 0.9


def test_wrong_row_count_stops_the_run(spark, raw_file):
    with pytest.raises(RuntimeError, match="sent 999 rows, stored 1000"):
        medallion.run(spark, raw_file, "short_db", expected_rows=999)
    spark.sql("USE default")


def test_damaged_sensor_values_stop_before_training(spark, sf_dir, tmp_path):
    path = str(tmp_path / "damaged.csv")
    writers.write_csv(views.raw_text(spark, sf_dir), path)
    with pytest.raises(QualityError, match="features"):
        medallion.run(spark, path, "damaged_db", numTrees=3)
    spark.sql("USE default")


def test_missing_column_stops_at_bronze(spark, sf_dir, tmp_path):
    path = str(tmp_path / "narrow.csv")
    writers.write_csv(views.raw_text(spark, sf_dir).withColumnRenamed("RNF", "Other"), path)
    with pytest.raises(ValueError, match="rnf"):
        medallion.run(spark, path, "narrow_db")
    spark.sql("USE default")


def test_policy_run(spark, sf_dir, tmp_path):
    model, scored, record = policy_run.run(
        views.labelled(spark, sf_dir),
        str(tmp_path / "model"),
        str(tmp_path / "meta"),
        data_path="events",
        k=20,
        maxIter=3,
    )
    assert record["metrics"]["roc_auc"] > 0.6 and record["topk_k"] == 20
    assert [row["k"] for row in record["k_sweep"]] == [10, 20, 30, 40, 50, 75, 100]
    (tn, fp), (fn, tp) = record["decision_report"]["confusion_matrix"]
    assert tn + fp + fn + tp == scored.count() and tp + fp == 20
    saved = readers_metadata(spark, str(tmp_path / "meta"))
    assert saved["features"]["target"] == "machine_failure"
    assert saved["precision_at_k"] == record["precision_at_k"]
    report = saved["decision_report"]["classification_report"]
    assert report.__fields__ == ["0", "1", "accuracy", "macro avg", "weighted avg"]
    rows = report["0"]["support"] + report["1"]["support"]
    assert rows == report["macro avg"]["support"] == scored.count()
    assert report["accuracy"] == (tn + tp) / rows
    assert saved["k_sweep"][1]["cutoff_score"] == record["cutoff_or_threshold"]


def test_learners_are_compared_on_one_split(spark, sf_dir):
    rows = views.labelled(spark, sf_dir)
    got = policy_run.compare(rows, logistic={"maxIter": 20}, boosted={"maxIter": 2, "maxDepth": 3})
    assert list(got) == ["logistic", "boosting"]
    for measures in got.values():
        assert 0.5 < measures["roc_auc"] <= 1 and 0 < measures["pr_auc"] <= 1
        assert list(measures["at_k"]) == [10, 20, 50, 100]
        recalls = [recall for _, recall in measures["at_k"].values()]
        assert recalls == sorted(recalls)
        assert list(measures["thresholds"]) == list(measures["reports"]) == ["best_f1", "top_20"]
        for name, cells in measures["confusion"].items():
            total = sum(cells[c] for c in ("tp", "fp", "fn", "tn"))
            assert total == next(r["support"] for r in measures["reports"][name] if r["label"] == "macro avg")
        top = measures["confusion"]["top_20"]
        assert top["tp"] + top["fp"] >= 20


def readers_metadata(spark, path):
    return writers.read_metadata(spark, path).first()


def test_probability_columns_of_each_kind(spark):
    from faultline.operators.risk import with_probability

    text = spark.createDataFrame([("[0.4 0.6]",)], "probability string")
    assert with_probability(text).first()["prob_failure"] == 0.6
    plain = spark.range(1).withColumn("prob_failure", F.lit(0.3))
    assert with_probability(plain).first()["prob_failure"] == 0.3


@pytest.fixture(scope="module")
def saved_model(spark, sf_dir, tmp_path_factory):
    from faultline.models import train

    rows = policy_run.prepare(views.labelled(spark, sf_dir))
    path = str(tmp_path_factory.mktemp("model") / "forest")
    train.save_model(train.fit_forest(rows, numTrees=5, maxDepth=4), path)
    return path


def test_alert_run(spark, raw_file, saved_model, tmp_path):
    out, kept = str(tmp_path / "scored"), str(tmp_path / "filtered")
    done = alert_run.run(
        spark, raw_file, saved_model, k=30, categories=["error", "view"], export_path=out, filtered_path=kept
    )
    summary = done.summary.first()
    assert (summary["rows"], summary["alerts"]) == (1000, 30)
    assert done.histogram.agg(F.sum("count")).first()[0] == 1000
    assert done.preview.count() == 10 and done.categories.count() == 5 and done.ranges.count() == 4
    written = spark.read.option("header", True).csv(out)
    assert written.count() == 1000 and written.columns == done.scored.columns
    shown = spark.read.option("header", True).csv(kept)
    assert shown.count() == done.filtered.count() <= 30
    assert {r["type"] for r in shown.collect()} <= {"error", "view"}


def test_alert_run_on_unlabelled_file(spark, sf_dir, saved_model, tmp_path):
    """Columns in another order, one of its own, no label and no flags."""
    path = str(tmp_path / "upload.csv")
    raw = views.raw_text(spark, sf_dir, damaged=False)
    kept = [c for c in reversed(raw.columns) if c not in ("Machine failure", *views.RAW_FLAGS)]
    writers.write_csv(raw.select(*kept, F.lit("hall 2").alias("Line")), path)
    done = alert_run.run(spark, path, saved_model, k=5)
    assert done.scored.columns[:3] == ["udi", "product_id", "p_failure"]
    assert done.scored.select("line").distinct().first()[0] == "hall 2"
    assert done.scored.count() == 1000 and done.filtered.count() == 5
    types = dict(done.scored.dtypes)
    assert (types["udi"], types["torque_nm"], types["line"]) == ("int", "double", "string")


def test_rows_with_missing_sensors_are_still_scored(spark, sf_dir, saved_model, tmp_path):
    path = str(tmp_path / "damaged.csv")
    writers.write_csv(views.raw_text(spark, sf_dir), path)
    done = alert_run.run(spark, path, saved_model, k=5)
    summary = done.summary.first()
    assert (summary["rows"], summary["missing_scores"], summary["alerts"]) == (1000, 0, 5)
    assert done.scored.filter("torque_nm is null").count() > 0


def test_fleet_report(spark, sf_dir):
    log = views.field_log(spark, sf_dir)
    frames = fleet_report.panels(views.scored(spark, sf_dir), log, ("conv_id", "turn"))
    rows = {name: df.count() for name, df in frames.items()}
    assert rows["risk_table"] == 1000 and rows["top_alerts"] == 10 and rows["tier_counts"] == 3
    assert rows["fleet_brief"] == rows["shift_summary"] == rows["metrics"] == 1
    assert rows["machine_facts"] >= 10 and rows["latest_log"] == 20
    brief = frames["fleet_brief"].first()
    assert len(brief["top_machines"].split("\n")) == 5


def test_fleet_report_before_the_first_log_entry(spark, sf_dir, tmp_path):
    log = readers.read_log(spark, str(tmp_path / "none"))
    frames = fleet_report.panels(views.scored(spark, sf_dir), log, ("timestamp", "transcript"))
    assert frames["fleet_brief"].first()["recent_reports"] == ""
    assert frames["machine_facts"].count() == 10


def test_report_from_the_first_source(spark, sf_dir, tmp_path):
    from faultline.schemas import predictions_csv_schema

    path = str(tmp_path / "p")
    scored = views.scored(spark, sf_dir)
    writers.write_csv(scored.select("udi", "machine_failure", "prediction", "prob_failure"), path)
    loaded = fleet_report.load(spark, [("missing_table", None), (path, predictions_csv_schema())])
    assert loaded.count() == 1000


def test_row_local_operators_take_a_stream(spark, sf_dir, tmp_path):
    from faultline.operators import alerts, risk

    path = str(tmp_path / "in")
    views.scored(spark, sf_dir).write.parquet(path)
    rows = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    kept = alerts.filter_scored(risk.risk_frame(rows), min_score=0.45, score="prob_failure")
    query = kept.writeStream.format("memory").queryName("at_risk_stream").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    expected = views.scored(spark, sf_dir).filter("prob_failure >= 0.45").count()
    assert spark.table("at_risk_stream").filter("at_risk").count() == expected
