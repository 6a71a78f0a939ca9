import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from faultline.models import calibrate, features, importance, score, train
from faultline.operators import curves, splitting

KEY, LABEL = "udi", "machine_failure"


@pytest.fixture(scope="module")
def raw(spark):
    """Failures follow torque; the other sensors carry no signal."""
    df = spark.range(1500).select(
        F.col("id").alias(KEY),
        F.concat(F.lit("P"), "id").alias("product_id"),
        F.element_at(F.array(*[F.lit(c) for c in "LMH"]), (F.col("id") % 3 + 1).cast("int")).alias("type"),
        (F.lit(295.0) + F.col("id") % 7).alias("air_temperature_k"),
        (F.lit(305.0) + F.col("id") % 5).alias("process_temperature_k"),
        (F.lit(1200) + F.col("id") * 37 % 500).cast("int").alias("rotational_speed_rpm"),
        (F.col("id") * 7919 % 1000 / 10.0).alias("torque_nm"),
        (F.col("id") * 31 % 250).cast("int").alias("tool_wear_min"),
    )
    noisy = (F.col("torque_nm") > 70) & (F.col("id_hash") % 10 > 1)
    df = df.withColumn("id_hash", F.abs(F.hash(KEY)))
    return df.withColumn(LABEL, noisy.cast("int")).drop("id_hash")


@pytest.fixture(scope="module")
def parts(raw):
    inputs = features.model_inputs(features.engineered(raw), keep=(KEY, LABEL))
    train_rows, test_rows = splitting.split_frames(splitting.stratified_split(inputs, LABEL, KEY))
    return train_rows.persist(), test_rows.persist()


@pytest.fixture(scope="module")
def calibrated(parts):
    return calibrate.fit_calibrated(parts[0], KEY, maxIter=5)


def auc(df):
    return curves.roc_auc(df, "p_failure", LABEL).first()[0]


def check_scores(df, floor):
    bad = df.filter("p_failure is null or p_failure < 0 or p_failure > 1").count()
    assert bad == 0
    assert auc(df) > floor


def test_inputs_leave_out_leakage(parts):
    assert parts[0].columns == [
        KEY, LABEL, "type", "air_temperature_k", "process_temperature_k",
        "rotational_speed_rpm", "torque_nm", "tool_wear_min", "TempDiff", "Torque_x_RPM",
    ]


def test_missing_input_column(raw):
    with pytest.raises(ValueError, match="TempDiff"):
        features.model_inputs(raw)


def test_forest(parts):
    model = train.fit_forest(parts[0], numTrees=10, maxDepth=4)
    scored = score.with_failure_probability(parts[1], model)
    assert scored.count() == parts[1].count() and scored.columns == [*parts[1].columns, "p_failure"]
    check_scores(scored, 0.9)
    top = importance.feature_importance(model, model.transform(parts[1])).collect()
    assert top[0]["feature"] in ("torque_nm", "Torque_x_RPM") and len(top) == 5
    everything = importance.feature_importance(model, model.transform(parts[1]), top=None)
    assert everything.count() == 10
    assert everything.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_logistic(parts):
    check_scores(score.with_failure_probability(parts[1], train.fit_logistic(parts[0])), 0.9)


def test_class_weights_balance(parts):
    weighted = train.with_class_weights(parts[0])
    sums = {r[0]: r[1] for r in weighted.groupBy(LABEL).agg(F.sum("class_weight")).collect()}
    assert sums[0] == pytest.approx(sums[1]) == pytest.approx(parts[0].count() / 2)


def test_boosting(parts):
    model = train.fit_boosting(parts[0], maxIter=5)
    check_scores(score.with_failure_probability(parts[1], model), 0.9)


def test_calibrated(parts, calibrated):
    scored = score.with_failure_probability(parts[1], calibrated)
    assert scored.columns == [*parts[1].columns, "p_failure"]
    check_scores(scored, 0.9)
    # a calibrated mean is close to the observed rate
    means = scored.agg(F.avg("p_failure"), F.avg(LABEL)).first()
    assert means[0] == pytest.approx(means[1], abs=0.06)


def test_folds_with_equal_categories_share_their_vector(parts, calibrated):
    kinds = [type(stage).__name__ for stage in calibrated.stages]
    assert kinds.count("VectorAssembler") == 1 and kinds.count("GBTClassificationModel") == 3
    # one row of the category: the folds that train without it keep a vector of their own
    rare = F.when(F.col(KEY) == parts[0].agg(F.min(KEY)).first()[0], "R").otherwise(F.col("type"))
    rows = parts[0].withColumn("type", rare)
    model = calibrate.fit_calibrated(rows, KEY, maxIter=1, maxDepth=2)
    labels = [stage.labelsArray[0] for stage in model.stages if hasattr(stage, "labelsArray")]
    assert sorted(map(len, labels)) == [3, 4]
    scored = score.with_failure_probability(rows, model)
    assert scored.columns == [*rows.columns, "p_failure"]
    check_scores(scored, 0.9)


def test_saved_model_gives_the_same_scores(parts, calibrated, tmp_path):
    path = str(tmp_path / "model")
    train.save_model(calibrated, path)
    again = train.load_model(path)
    one = score.with_failure_probability(parts[1], calibrated)
    two = score.with_failure_probability(parts[1], again).select(KEY, F.col("p_failure").alias("q"))
    assert one.join(two, KEY).filter(F.abs(F.col("p_failure") - F.col("q")) > 1e-12).count() == 0


def test_isotonic_equals_pool_adjacent_violators(spark):
    rows = [(0.1, 0), (0.2, 1), (0.3, 0), (0.3, 1), (0.4, 0), (0.5, 1), (0.6, 1)]
    df = spark.createDataFrame(rows, "s double, y int")
    curve = calibrate.fit_isotonic(df, "s", "y")
    points = spark.createDataFrame([(s,) for s in (0.0, 0.1, 0.2, 0.4, 0.5, 0.9)], "s double")
    got = [r["prediction"] for r in curve.transform(points).collect()]
    # the points .2 .3 .3 .4 pool to 2/4
    assert got == pytest.approx([0.0, 0.0, 0.5, 0.5, 1.0, 1.0])


def pooled_brute(rows):
    """Step values by the largest mean that starts early and the least that ends late."""
    scores = sorted({s for s, _ in rows})
    sums = [(sum(y for v, y in rows if v == s), sum(v == s for v, _ in rows)) for s in scores]
    out = {}
    for i, s in enumerate(scores):
        mean = lambda a, b: sum(t for t, _ in sums[a : b + 1]) / sum(w for _, w in sums[a : b + 1])
        out[s] = max(min(mean(a, b) for b in range(i, len(scores))) for a in range(i + 1))
    return out


def test_isotonic_blocks_over_many_slices(spark, monkeypatch):
    monkeypatch.setattr(calibrate, "FAN", 2)
    rng = random.Random(8)
    rows = [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(400)]
    rows += [(0.5, i % 2) for i in range(200)] + [(0.97, 0)] * 30
    want = pooled_brute(rows)
    odd = [(None, 1), (float("nan"), 1), (0.2, None)]
    df = spark.createDataFrame(rows + odd, "s double, y int").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = calibrate.isotonic_blocks(df, "s", "y").orderBy("first").collect()
        curve = calibrate.fit_isotonic(df, "s", "y")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    values = [b["value"] for b in blocks]
    assert values == sorted(set(values)) and sum(b["weight"] for b in blocks) == len(rows)
    for s, v in want.items():
        (block,) = [b for b in blocks if b["first"] <= s <= b["last"]]
        assert block["value"] == pytest.approx(v, abs=1e-12)
    points = spark.createDataFrame([(s,) for s in want], "s double")
    for r in curve.transform(points).collect():
        assert r["prediction"] == pytest.approx(want[r["s"]], abs=1e-12)
    # the model holds two ends of each block at most
    assert curve.boundaries.size <= 2 * len(blocks)


def test_isotonic_blocks_of_nothing(spark):
    assert calibrate.isotonic_blocks(spark.createDataFrame([], "s double, y int"), "s", "y").count() == 0


def test_unknown_category_encodes_as_zeros(raw):
    fitted, vectors = features.feature_vectors(features.engineered(raw))
    odd = features.engineered(raw).limit(2).withColumn("type", F.when(F.col(KEY) == -1, "Z"))
    known = vectors.select(vector_to_array("features").alias("v")).first()["v"]
    unseen = fitted.transform(odd).select(vector_to_array("features").alias("v")).first()["v"]
    assert len(known) == len(unseen) == 10
    assert sum(known[7:]) == 1.0 and unseen[7:] == [0.0, 0.0, 0.0]
    replaced = odd.withColumn("type", F.lit("Z"))
    assert fitted.transform(replaced).select(vector_to_array("features").alias("v")).first()["v"][7:] == [0.0] * 3


def test_flags_are_an_option(raw):
    flagged = raw.withColumns({f: F.lit(0) for f in ("twf", "hdf", "pwf", "osf", "rnf")})
    _, vectors = features.feature_vectors(flagged, include_flags=True)
    assert vectors.columns == [KEY, "product_id", LABEL, "features"]
    assert len(vectors.first()["features"]) == 13


def test_score_and_alert(raw, calibrated):
    out = score.score_and_alert(raw, calibrated, 50)
    assert out.columns[:7] == [
        "udi", "product_id", "p_failure", "rank", "alert_topk", "TempDiff", "Torque_x_RPM",
    ]
    assert out.filter("alert_topk").count() == 50
    assert out.count() == 1500 and out.agg(F.max("rank")).first()[0] == 1500
    with pytest.raises(ValueError, match="torque_nm', 'type"):
        score.score_and_alert(raw.drop("type", "torque_nm"), calibrated)


def test_rows_without_a_key_rank_by_appearance(raw, calibrated):
    one = raw.orderBy(KEY).coalesce(1)
    with_key = score.score_and_alert(one, calibrated, 50)
    without = score.score_and_alert(one.drop(KEY), calibrated, 50)
    assert without.columns[:2] == ["product_id", "p_failure"]
    assert "_appearance" not in without.columns
    pairs = with_key.select("product_id", "rank").exceptAll(without.select("product_id", "rank"))
    assert pairs.count() == 0


def test_one_record_is_scored_like_a_table(spark, raw, calibrated):
    record = spark.createDataFrame(
        [("M", 300.0, 310.0, 1500.0, 40.0, 50.0)],
        "type string, air_temperature_k double, process_temperature_k double, "
        "rotational_speed_rpm double, torque_nm double, tool_wear_min double",
    )
    ready = features.engineered(record)
    assert (ready.first()["TempDiff"], ready.first()["Torque_x_RPM"]) == (10.0, 60000.0)
    p = score.with_failure_probability(ready, calibrated).first()["p_failure"]
    assert 0.0 <= p <= 1.0


def test_inspect_list(parts, calibrated):
    rows = score.inspect_list(parts[1], calibrated, 20).collect()
    scores = [r["failure_probability"] for r in rows]
    assert len(rows) == 20 and scores == sorted(scores, reverse=True)
    assert "y_true" in rows[0].asDict()


def test_places_inside_groups(spark):
    df = spark.range(300).selectExpr("id % 3 as g", "id")
    got = importance.positions(df, "g", [F.desc("id")]).collect()
    for r in got:
        assert r["_place"] == (299 - r["id"]) // 3 + 1


def test_permutation_importance(parts, calibrated):
    rows = importance.permutation_importance(parts[1], calibrated, repeats=3).collect()
    drops = {r["feature"]: r["importance_mean"] for r in rows}
    assert len(drops) == 8
    assert max(drops, key=drops.get) in ("torque_nm", "Torque_x_RPM")
    assert abs(drops["type"]) < 0.05 and max(drops.values()) > 0.1


def test_shuffles_are_permutations(spark):
    rows = [(i, i % 2, f"t{i}", float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "udi long, y int, a string, b double")
    out = importance.shuffled_variants(df, ["a", "b"], "y", "udi", 3, 9).collect()
    orders = set()
    for column, other in (("a", "b"), ("b", "a")):
        for repeat in range(3):
            part = [r for r in out if r["_shuffled"] == column and r["_repeat"] == repeat]
            assert len(part) == 300
            assert sorted(r["a"] for r in part) == sorted(r[2] for r in rows)
            assert sorted(r["b"] for r in part) == [r[3] for r in rows]
            # the other column still belongs to its label
            own = [int(r["b"]) if other == "b" else int(r["a"][1:]) for r in part]
            assert all(r["y"] == i % 2 for r, i in zip(part, own))
            moved = {i: (r["a"] if column == "a" else r["b"]) for r, i in zip(part, own)}
            assert sum(str(v).strip("t").removesuffix(".0") != str(i) for i, v in moved.items()) > 250
            orders.add(tuple(str(moved[i]).strip("t").removesuffix(".0") for i in range(300)))
    # both columns share the order of a repeat, repeats differ
    assert len(orders) == 3
