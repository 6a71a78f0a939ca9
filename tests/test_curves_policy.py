import random

import pytest
from pyspark.sql import functions as F

from faultline.operators import curves, metrics, policy, ranking


def sample(n=1200, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.2)
        s = 0.5 if rng.random() < 0.34 else round(min(1.0, rng.random() * 0.7 + 0.3 * y), 2)
        rows.append((i, s, y))
    return rows


def frame(spark, rows, layout=3):
    return spark.createDataFrame(rows, "udi long, s double, y int").repartition(layout)


def brute_auc(rows):
    pos = [s for _, s, y in rows if y]
    neg = [s for _, s, y in rows if not y]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return wins / (len(pos) * len(neg))


def brute_ap(rows):
    positives, last, area = sum(y for _, _, y in rows), 0.0, 0.0
    for t in sorted({s for _, s, _ in rows}, reverse=True):
        picked = [y for _, s, y in rows if s >= t]
        recall = sum(picked) / positives
        area += (recall - last) * sum(picked) / len(picked)
        last = recall
    return area


@pytest.mark.parametrize("layout", [1, 4, 17])
def test_areas_equal_brute_force(spark, layout):
    rows = sample()
    df = frame(spark, rows, layout)
    assert curves.roc_auc(df, "s", "y").first()[0] == pytest.approx(brute_auc(rows), abs=1e-12)
    assert curves.average_precision(df, "s", "y").first()[0] == pytest.approx(
        brute_ap(rows), abs=1e-12
    )


def test_curves_over_many_slices(spark):
    """The offsets of earlier slices are added when the sort has many partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(i, i / 5000, int(i % 7 == 0 or i > 4500)) for i in range(5000)]
        df = frame(spark, rows)
        counts = curves.cumulative_counts(df, "s", "y")
        got = {r["score"]: (r["tp"], r["selected"]) for r in counts.collect()}
        auc = curves.roc_auc_of(counts).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    tp = 0
    for n, (_, s, y) in enumerate(sorted(rows, key=lambda r: -r[1]), start=1):
        tp += y
        assert got[s] == (tp, n)
    assert 0.5 < auc < 1


def test_grouped_counts_equal_separate_ones(spark):
    parts = {g: sample(400, seed=g) for g in range(3)}
    rows = [(g, *r) for g, part in parts.items() for r in part]
    df = spark.createDataFrame(rows, "g int, udi long, s double, y int")
    areas = curves.average_precision_of(curves.cumulative_counts(df, "s", "y", ["g"]), ["g"])
    for r in areas.collect():
        assert r["average_precision"] == pytest.approx(brute_ap(parts[r["g"]]), abs=1e-12)


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange") - plan.count("BroadcastExchange")


def test_the_written_curve_is_scanned_without_moving_scores(spark):
    df = frame(spark, sample(300))
    counts = curves.laid_counts(df, "s", "y")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    # the only exchange gathers the totals, a row for each sort partition
    assert exchanges(counts) == 1 and "SinglePartition" in plan
    assert "PartitionFilters: [isnotnull(_total" in plan
    best = curves.best_f1_threshold(df, "s", "y", reference_offset=True)
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_run_pos") > 0 and plan.count("NOT _total") == 2


def test_groups_that_span_slices_and_batches(spark):
    """Null groups, one group with most rows, batches smaller than a group."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(None if i % 9 == 0 else "a" if i % 9 < 7 else "b", i, (i % 500) / 500, int(i % 3 == 0)) for i in range(2000)]
        rows += [("c", 5000, None, 1), ("c", 5001, float("nan"), 0), ("d", 5002, 0.5, None)]
        df = spark.createDataFrame(rows, "g string, udi long, s double, y int").repartition(3)
        got = {(r["g"], r["score"]): r for r in curves.laid_counts(df, "s", "y", ["g"]).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len({(g, s if s == s else None) for g, _, s, _ in rows})
    for (g, s), r in got.items():
        mine = [(v if v is not None and v == v else None, y or 0) for h, _, v, y in rows if h == g]
        over = [y for v, y in mine if s is None or (v is not None and v >= s)]
        here = [y for v, y in mine if v == s]
        assert (r["pos"], r["rows"], r["tp"], r["selected"]) == (sum(here), len(here), sum(over), len(over))
        assert (r["positives"], r["total"]) == (sum(y for _, y in mine), len(mine))
        assert r["lowest"] == min((v for v, _ in mine if v is not None), default=None)


def test_empty_curve(spark):
    df = frame(spark, [])
    assert curves.pr_curve(df, "s", "y").count() == 0
    assert curves.roc_auc(df, "s", "y").first()[0] is None
    assert curves.best_f1_threshold(df, "s", "y", reference_offset=True).count() == 0


def test_single_class(spark):
    df = frame(spark, [(1, 0.1, 0), (2, 0.2, 0)])
    assert curves.roc_auc(df, "s", "y").first()[0] is None
    assert curves.average_precision(df, "s", "y").first()[0] == 0.0


def test_missing_scores_are_below_every_threshold(spark):
    df = frame(spark, [(1, 0.9, 1), (2, None, 1), (3, float("nan"), 0), (4, 0.1, 0)])
    curve = curves.pr_curve(df, "s", "y").orderBy("threshold").collect()
    assert [(r["threshold"], r["recall"]) for r in curve] == [(0.1, 0.5), (0.9, 0.5)]
    assert curves.roc_auc(df, "s", "y").first()[0] == pytest.approx((2 + 0 + 0.5) / 4)


def test_best_f1(spark):
    df = frame(spark, [(1, 0.9, 1), (2, 0.8, 1), (3, 0.7, 0), (4, 0.1, 0)])
    assert curves.best_f1_threshold(df, "s", "y").first()["threshold"] == 0.8
    offset = curves.best_f1_threshold(df, "s", "y", reference_offset=True)
    assert offset.first()["threshold"] == 0.7
    one = frame(spark, [(1, 0.5, 1), (2, 0.5, 0)])
    single = curves.best_f1_threshold(one, "s", "y", reference_offset=True)
    assert single.first()["threshold"] == 0.5


def test_ties_at_the_cutoff(spark):
    df = frame(spark, [(1, 0.9, 1), (2, 0.8, 0), (3, 0.8, 1), (4, 0.8, 1), (5, 0.1, 0)])
    row = policy.k_sweep(df, "s", "y", "udi", [2]).first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (1, 1, 2, 1)
    assert (row["cutoff_score"], row["num_ge_cutoff"], row["selected"]) == (0.8, 4, 2)


def test_k_above_rows(spark):
    df = frame(spark, [(1, 0.9, 1), (2, 0.8, 0), (3, 0.1, 0)])
    row = policy.k_sweep(df, "s", "y", "udi", [10]).first()
    assert (row["selected"], row["precision"], row["recall"]) == (3, pytest.approx(1 / 3), 1.0)
    assert policy.capacity_threshold(df, "s", "udi", 10).first()[1:] == (0.1, 3)


def test_no_positives(spark):
    df = frame(spark, [(1, 0.9, 0), (2, 0.8, 0)])
    row = policy.k_sweep(df, "s", "y", "udi", [1]).first()
    assert (row["precision"], row["recall"]) == (0.0, 0.0)


@pytest.mark.parametrize("k", [1, 50, 700, 1200, 5000])
def test_large_capacity_path_equals_head_path(spark, monkeypatch, k):
    df = frame(spark, sample())
    head = policy.k_sweep(df, "s", "y", "udi", [k]).first()
    cut = policy.capacity_threshold(df, "s", "udi", k).first()
    monkeypatch.setattr(ranking, "HEAD_LIMIT", 0)
    monkeypatch.setattr(policy, "HEAD_LIMIT", 0)
    assert policy.k_sweep(df, "s", "y", "udi", [k]).first() == head
    assert policy.capacity_threshold(df, "s", "udi", k).first() == cut


# The recorded sweep over 2000 test rows with 68 failures.
RECORDED = [
    (10, 10, 1.0, 0.14705882352941177),
    (20, 20, 1.0, 0.29411764705882354),
    (30, 30, 1.0, 0.4411764705882353),
    (40, 40, 1.0, 0.5882352941176471),
    (50, 50, 1.0, 0.7352941176470589),
    (75, 59, 0.7866666666666666, 0.8676470588235294),
    (100, 60, 0.6, 0.8823529411764706),
]


def recorded_rows():
    """Rows in rank order with the recorded number of hits up to each k."""
    hits, last_k, last_tp = [], 0, 0
    for k, tp, _, _ in RECORDED:
        new = tp - last_tp
        hits += [1] * new + [0] * (k - last_k - new)
        last_k, last_tp = k, tp
    hits += [1] * (68 - sum(hits))
    hits += [0] * (2000 - len(hits))
    return [(i, 1.0 - i / 4000, y) for i, y in enumerate(hits)]


def test_recorded_sweep(spark):
    df = frame(spark, recorded_rows())
    got = {r["k"]: r for r in policy.k_sweep(df, "s", "y", "udi").collect()}
    for k, tp, precision, recall in RECORDED:
        row = got[k]
        assert (row["tp"], row["precision"], row["recall"]) == (tp, precision, recall)
        assert row["tp"] + row["fp"] == k and row["tp"] + row["fn"] == 68
        assert row["tn"] == 1932 - row["fp"]


def test_recorded_report(spark):
    row = policy.decision_report(frame(spark, recorded_rows()), "s", "y", "udi", 50).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (1932, 0, 18, 50)
    recorded = {
        "precision_0": 0.9907692307692307,
        "recall_0": 1.0,
        "f1_0": 0.9953632148377125,
        "precision_1": 1.0,
        "recall_1": 0.7352941176470589,
        "f1_1": 0.847457627118644,
        "accuracy": 0.991,
        "precision_macro": 0.9953846153846153,
        "recall_macro": 0.8676470588235294,
        "f1_macro": 0.9214104209781783,
        "precision_weighted": 0.9910830769230768,
        "recall_weighted": 0.991,
        "f1_weighted": 0.9903344248552642,
    }
    for name, value in recorded.items():
        assert row[name] == pytest.approx(value, abs=1e-14), name


def test_class_report_rows(spark):
    df = frame(spark, recorded_rows()).withColumn("flag", (F.col("udi") < 50).cast("int"))
    got = {r["label"]: r for r in metrics.classification_report(df, "y", "flag").collect()}
    assert got["1"]["f1_score"] == pytest.approx(0.847457627118644, abs=1e-14)
    assert got["macro avg"]["recall"] == pytest.approx(0.8676470588235294, abs=1e-14)
    assert got["weighted avg"]["precision"] == pytest.approx(0.9910830769230768, abs=1e-14)
    assert (got["accuracy"]["f1_score"], got["accuracy"]["support"]) == (0.991, 2000)


def test_binary_metrics_without_predictions(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 0.0)], "y int, p double")
    row = metrics.binary_metrics(df, "y", "p").first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_class_report_of_text_classes(spark):
    rows = [("L", "L"), ("L", "M"), ("M", "M"), ("H", "L")]
    df = spark.createDataFrame(rows, "y string, p string")
    got = {r["label"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert set(got) == {"L", "M", "H", "accuracy", "macro avg", "weighted avg"}
    assert (got["L"]["precision"], got["L"]["recall"], got["L"]["support"]) == (0.5, 0.5, 2)
    assert (got["H"]["precision"], got["H"]["recall"]) == (0.0, 0.0)
    assert got["accuracy"]["f1_score"] == 0.5
