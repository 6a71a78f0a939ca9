"""Fits give the same scores on other core counts and file layouts."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

RUN = """
import json, sys
from pyspark.sql import SparkSession
cores, files, shuffles, folder = sys.argv[1:]
spark = (
    SparkSession.builder.master(f"local[{cores}]")
    .config("spark.sql.shuffle.partitions", shuffles)
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.session.timeZone", "UTC")
    .config("spark.checkpoint.dir", folder + "/checkpoints")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
from faultline.models import calibrate, score, train
from faultline.plans import policy_run
from registry import views

rows = policy_run.prepare(views.labelled(spark, "/root/testdata/sf0.001"))
rows.repartition(int(files)).write.parquet(folder + "/rows")
rows = spark.read.parquet(folder + "/rows")
fits = {
    "forest": lambda: train.fit_forest(rows, numTrees=6, maxDepth=4),
    "logistic": lambda: train.fit_logistic(rows, maxIter=20),
    "boosting": lambda: train.fit_boosting(rows, maxIter=3, maxDepth=4),
    "calibrated": lambda: calibrate.fit_calibrated(rows, folds=2, maxIter=2, maxDepth=3),
}
out = {}
for name, fit in fits.items():
    scored = score.with_failure_probability(rows, fit()).select("udi", "p_failure").collect()
    out[name] = [p for _, p in sorted(map(tuple, scored))]
json.dump(out, open(folder + "/scores.json", "w"))
"""


def scores(folder, cores, files, shuffles):
    folder.mkdir()
    command = [sys.executable, "-c", RUN, str(cores), str(files), str(shuffles), str(folder)]
    subprocess.run(command, cwd=ROOT, check=True, timeout=280, capture_output=True)
    return json.loads((folder / "scores.json").read_text())


@pytest.fixture(scope="module")
def both(tmp_path_factory):
    base = tmp_path_factory.mktemp("layout")
    return scores(base / "a", 2, 4, 4), scores(base / "b", 5, 40, 9)


@pytest.mark.parametrize("learner", ["forest", "logistic", "boosting", "calibrated"])
def test_scores_do_not_depend_on_cores_and_files(both, learner):
    one, two = (run[learner] for run in both)
    assert len(one) == 1000 and len(set(one)) > 5
    if learner == "logistic":
        # gradients are summed in the order in which tasks end
        assert one == pytest.approx(two, abs=1e-9)
    else:
        assert one == two
