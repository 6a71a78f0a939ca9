import pytest

from faultline.operators import fieldlog
from faultline.schemas import LOG_COLUMNS, predictions_csv_schema
from faultline.sources import readers, tables, writers
from faultline.storage import application_folder, materialize, release, shared_folder


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    rows = materialize(spark.range(5), "probe")
    assert rows.count() == 5 and rows.inputFiles()[0].find(application_folder(spark)) >= 0


def test_csv_keeps_awkward_text(spark, tmp_path):
    path = str(tmp_path / "log")
    text = ' a "quoted", line\nand \\ another, é \n'
    entry = spark.createDataFrame([("M-1", text)], "machine_id string, transcript string")
    writers.append_log(entry, path)
    row = readers.read_log(spark, path).first()
    assert row["transcript"] == text and row["technician"] == "Unknown"


def test_columns_are_found_by_name(spark, tmp_path):
    path = str(tmp_path / "p")
    swapped = spark.createDataFrame(
        [(0.25, 1.0, 7, 1, "x")],
        "prob_failure double, prediction double, udi int, machine_failure int, site string",
    )
    writers.write_csv(swapped, path)
    row = readers.read_csv(spark, path, predictions_csv_schema()).first()
    assert (row["udi"], row["machine_failure"], row["prob_failure"], row["site"]) == (7, 1, 0.25, "x")


def test_files_with_different_headers_are_refused(spark, tmp_path):
    path = str(tmp_path / "p")
    writers.write_csv(spark.createDataFrame([(1, 2)], "a int, b int"), path)
    writers.write_csv(spark.createDataFrame([(1, 2)], "b int, a int"), path, mode="append")
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, path, predictions_csv_schema()).collect()


def test_log_before_first_write(spark, tmp_path):
    log = readers.read_log(spark, str(tmp_path / "none"))
    assert log.columns == LOG_COLUMNS and log.count() == 0
    assert tuple(fieldlog.log_kpis(log).first()) == (0, 0, 0)


def test_log_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    for n in range(3):
        writers.append_log(spark.createDataFrame([(f"M-{n}",)], "machine_id string"), path)
    assert sorted(r["machine_id"] for r in readers.read_log(spark, path).collect()) == [
        "M-0", "M-1", "M-2",
    ]
    copy = str(tmp_path / "copy")
    writers.export_log(readers.read_log(spark, path), copy)
    assert readers.read_log(spark, copy).count() == 3


def test_export_predictions(spark, tmp_path):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame(
        [(1, 0, 0.0, Vectors.dense([0.75, 0.25]))], ["udi", "machine_failure", "prediction", "probability"]
    )
    path = str(tmp_path / "p")
    writers.export_predictions(df, path)
    assert tuple(readers.read_predictions(spark, path).first()) == (1, 0, 0.0, 0.25)


def test_vector_text_predictions(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame(
        [(1, 0, 0.0, "[0.75 0.25]")], "udi int, machine_failure int, prediction double, probability string"
    )
    writers.write_csv(df, path)
    assert readers.read_predictions(spark, path, vector_text=True).first()["prob_failure"] == 0.25


def test_export_scored_is_in_rank_order(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.range(100).selectExpr("id udi", "100 - id rank").repartition(7)
    writers.export_scored(df, path)
    parts = sorted((tmp_path / "s").glob("part-*"))
    ranks = [int(line.split(",")[1]) for p in parts for line in p.read_text().splitlines()[1:]]
    assert ranks == list(range(1, 101))


def test_first_available(spark, tmp_path):
    path = str(tmp_path / "p")
    schema = predictions_csv_schema()
    sources = [(path, schema), ("no_such_table", None)]
    with pytest.raises(FileNotFoundError):
        readers.first_available(spark, sources)
    spark.createDataFrame([(1, 0, 0.0, 0.5)], schema).createOrReplaceTempView("fallback_view")
    assert readers.first_available(spark, [*sources, ("fallback_view", None)]).count() == 1
    writers.write_csv(spark.createDataFrame([(1, 0, 0.0, 0.5), (2, 1, 1.0, 0.9)], schema), path)
    assert readers.first_available(spark, [*sources, ("fallback_view", None)]).count() == 2


def test_ensure_table(spark):
    tables.use_namespace(spark, "ensure_db")
    calls = []

    def build(n):
        def run():
            calls.append(n)
            return spark.range(n)

        return run

    assert tables.ensure_table(spark, "t", build(5), 5).count() == 5
    tables.ensure_table(spark, "t", build(5), 5)
    assert calls == [5]
    assert tables.ensure_table(spark, "t", build(7), 7).count() == 7
    assert tables.ensure_table(spark, "t", build(6)).count() == 6
    with pytest.raises(RuntimeError, match="sent 9 rows, stored 8"):
        tables.ensure_table(spark, "t", build(8), 9)
    assert tables.table_exists(spark, "t")
    tables.drop_table(spark, "t")
    assert not tables.table_exists(spark, "t")
    spark.sql("USE default")


def test_overwrite_replaces_the_schema(spark):
    tables.use_namespace(spark, "overwrite_db")
    tables.write_checked(spark.range(3), "t")
    out = tables.write_checked(spark.range(2).selectExpr("id", "'x' as name"), "t")
    assert out.columns == ["id", "name"] and out.count() == 2
    with pytest.warns(UserWarning, match="stored 2"):
        tables.write_checked(spark.range(2), "t", severity="warn", expected_rows=4)
    assert tables.append_table(spark.range(2), "t").count() == 4
    assert readers.read_table(spark, "t").count() == 4
    spark.sql("USE default")


def stored_tables(spark, namespace):
    return [t.name for t in spark.catalog.listTables(namespace) if not t.isTemporary]


def test_a_table_is_replaced_by_rows_of_its_own(spark):
    tables.use_namespace(spark, "swap_db")
    tables.write_checked(spark.range(10), "t")
    tables.write_checked(spark.table("t").filter("id % 2 = 0"), "t")
    assert sorted(r["id"] for r in spark.table("t").collect()) == [0, 2, 4, 6, 8]
    tables.overwrite_table(spark.table("t").selectExpr("id + 1 as id", "'x' as name"), "swap_db.t")
    assert sorted(tuple(r) for r in spark.table("t").collect()) == [(i + 1, "x") for i in range(0, 10, 2)]
    assert stored_tables(spark, "swap_db") == ["t"]
    spark.sql("USE default")


def test_a_failed_write_leaves_the_old_table(spark):
    tables.use_namespace(spark, "failed_db")
    tables.write_checked(spark.range(10), "t")
    broken = spark.range(5).selectExpr("assert_true(id < 3) as ok", "id")
    for write in (tables.write_checked, tables.overwrite_table):
        with pytest.raises(Exception, match="assert_true|is not true"):
            write(broken, "t")
    assert spark.table("t").count() == 10
    assert stored_tables(spark, "failed_db") == ["t"]
    spark.sql("USE default")


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    """The input runs once, settings and views of the session hold, and models
    that are fitted later can still be used."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    runs = spark.sparkContext.accumulator(0)

    def count(parts):
        for part in parts:
            runs.add(len(part))
            yield part

    tables.use_namespace(spark, "counted_db")
    spark.range(40).createOrReplaceTempView("counted_view")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        rows = spark.sql("select id, cast(timestamp'2024-01-01 00:00:00 UTC' as string) as at from counted_view")
        written = tables.write_checked(rows.mapInPandas(count, rows.schema), "t")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert runs.value == 40 and written.count() == 40
    assert written.first()["at"] == "2024-01-01 09:00:00"
    assert written.sparkSession._jsparkSession.equals(spark._jsparkSession)
    spark.sql("USE default")
    labelled = spark.range(60).selectExpr("double(id % 2) as y", "double(id % 5) as a")
    ready = VectorAssembler(inputCols=["a"], outputCol="features").transform(labelled)
    model = RandomForestClassifier(labelCol="y", numTrees=2).fit(ready)
    assert model.transform(ready).select("probability").count() == 60
    assert len(model.transform(ready).select("probability").collect()) == 60


RECORDED = {
    "data_path": "data/raw.csv", "model_type": "boosting", "calibrated": True, "policy": "topk",
    "topk_k": 50, "seed": 42, "metrics": {"pr_auc": 0.9069876185020286, "roc_auc": 0.9791438314456217},
    "decision_report": {
        "k": 50, "cutoff_score": 0.7151300236406618, "selected": 50, "num_ge_cutoff": 50,
        "confusion_matrix": [[1932, 0], [18, 50]],
        "classification_report": {
            "0": {"precision": 0.9907692307692307, "recall": 1.0, "f1-score": 0.9953632148377125, "support": 1932.0},
            "1": {"precision": 1.0, "recall": 0.7352941176470589, "f1-score": 0.847457627118644, "support": 68.0},
            "accuracy": 0.991,
            "macro avg": {"precision": 0.9953846153846153, "recall": 0.8676470588235294, "f1-score": 0.9214104209781783, "support": 2000.0},
            "weighted avg": {"precision": 0.9910830769230768, "recall": 0.991, "f1-score": 0.9903344248552642, "support": 2000.0},
        },
    },
    "cutoff_or_threshold": 0.7151300236406618, "precision_at_k": 1.0, "recall_at_k": 0.7352941176470589,
    "k_sweep": [
        {"k": 10, "precision": 1.0, "recall": 0.14705882352941177, "tp": 10, "fp": 0, "fn": 58, "tn": 1932,
         "cutoff_score": 0.9901960784313726, "num_ge_cutoff": 11},
    ],
    "features": {
        "categorical": ["Type"], "numerical": ["Torque [Nm]", "TempDiff"], "engineered": ["TempDiff"],
        "dropped": ["UDI", "Machine failure"], "target": "Machine failure",
    },
}


def test_a_recorded_run_reads_and_writes_back_equal(spark, tmp_path):
    import json

    recorded, copy = tmp_path / "recorded.json", tmp_path / "deep" / "copy.json"
    recorded.write_text(json.dumps(RECORDED, indent=2))
    row = writers.read_metadata(spark, str(recorded)).first()
    for _ in range(2):  # the second publishes over the first
        writers.write_metadata(spark, row.asDict(recursive=True), str(copy))
    assert json.loads(copy.read_text()) == RECORDED
    assert [p.name for p in copy.parent.iterdir() if not p.name.endswith(".crc")] == ["copy.json"]


def test_the_decision_rows_of_a_record(spark):
    flat = {"support_0": 1932, "support_1": 68, "accuracy": 0.991}
    for suffix in ("0", "1", "macro", "weighted"):
        flat |= {f"precision_{suffix}": 0.5, f"recall_{suffix}": 0.25, f"f1_{suffix}": 0.1}
    report = writers.report_entries(flat)
    assert sorted(report) == ["0", "1", "accuracy", "macro avg", "weighted avg"]
    assert [report[n]["support"] for n in ("0", "1", "macro avg", "weighted avg")] == [1932.0, 68.0, 2000.0, 2000.0]


def test_publish_replaces_files_and_folders(spark, tmp_path):
    from faultline.storage import publish

    for i in range(2):
        for name in ("file", "folder/inner"):
            place = tmp_path / f"staged{i}-{name}"
            place.parent.mkdir(exist_ok=True)
            place.write_text(f"{i}")
        publish(spark, str(tmp_path / f"staged{i}-file"), str(tmp_path / "out"))
        publish(spark, str(tmp_path / f"staged{i}-folder"), str(tmp_path / "dir"))
        assert (tmp_path / "out").read_text() == (tmp_path / "dir" / "inner").read_text() == f"{i}"


def test_release_deletes_intermediate_tables(spark):
    import os

    materialize(spark.range(3), "gone")
    folder = application_folder(spark)
    assert os.path.isdir(folder)
    release(spark)
    assert not os.path.isdir(folder)
