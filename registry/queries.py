"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from faultline import storage
from faultline.functions.numeric import last_of_vector_text, thousands_text, vector_element
from faultline.functions.risk import machine_number
from faultline.functions.text import spoken_form, strip_markup
from faultline.models import calibrate, features, importance, score, train
from faultline.operators import (
    alerts,
    cleaning,
    curves,
    fieldlog,
    metrics,
    policy,
    profile,
    quality,
    ranking,
    reports,
    risk,
    splitting,
)
from faultline.plans import medallion
from faultline.schemas import CLEAN_COLUMNS, RAW_COLUMNS, URGENCY_LEVELS
from faultline.sources import readers, tables, writers
from faultline.storage import materialize, new_path
from registry import views

LABEL, PROB, PRED, KEY = "machine_failure", "prob_failure", "prediction", "udi"
SWEEP = [10, 20, 30, 40, 50, 75, 100]

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of doubles depend on summation order in the last digits."""
    return df.withColumns({c: F.round(c, 10) for c in columns})


# ---- risk view ----------------------------------------------------------------


@query
def topk_alerts(spark, sf_dir):
    return risk.top_alerts(views.scored(spark, sf_dir), 10)


@query
def machine_options(spark, sf_dir):
    return risk.machine_options(views.scored(spark, sf_dir), 20)


@query
def risk_flags(spark, sf_dir):
    return risk.risk_frame(views.scored(spark, sf_dir)).select(
        KEY, PROB, "at_risk", "correct", "risk_tier", "score_band"
    )


@query
def kpi_status(spark, sf_dir):
    return metrics.kpi_status(views.scored(spark, sf_dir), PROB, LABEL, PRED, 0.45)


@query
def tier_counts(spark, sf_dir):
    return risk.tier_counts(views.scored(spark, sf_dir))


@query
def tier_failure_rate(spark, sf_dir):
    return risk.tier_failure_rate(views.scored(spark, sf_dir))


@query
def threshold_counts(spark, sf_dir):
    return risk.counts_above(views.scored(spark, sf_dir))


@query
def fleet_summary(spark, sf_dir):
    out = risk.fleet_summary(views.scored(spark, sf_dir))
    return rounded(out, "mean_probability").withColumn(
        "machines_text", thousands_text("machines")
    )


@query
def score_histogram_30(spark, sf_dir):
    return risk.histogram(views.scored(spark, sf_dir), PROB, 30)


@query
def score_histogram_40(spark, sf_dir):
    return risk.histogram(views.scored(spark, sf_dir), PROB, 40, 0.0, 1.0)


@query
def point_lookup(spark, sf_dir):
    return risk.lookup(views.scored(spark, sf_dir), 17, KEY)


# ---- evaluation ---------------------------------------------------------------


@query
def confusion_grouped(spark, sf_dir):
    return metrics.confusion_grouped(views.scored(spark, sf_dir), LABEL, PRED)


@query
def confusion_cells(spark, sf_dir):
    return metrics.confusion_cells(views.scored(spark, sf_dir), LABEL, PRED)


@query
def binary_metrics(spark, sf_dir):
    return metrics.binary_metrics(views.scored(spark, sf_dir), LABEL, PRED)


@query
def classification_report(spark, sf_dir):
    out = metrics.classification_report(views.scored(spark, sf_dir), LABEL, PRED)
    return rounded(out, "precision", "recall", "f1_score")


@query
def classification_report_labels(spark, sf_dir):
    labels = views.table(spark, sf_dir, "labels")
    out = metrics.classification_report(labels, "quality", "toxic")
    return rounded(out, "precision", "recall", "f1_score")


@query
def report_at_threshold(spark, sf_dir):
    out = metrics.report_at_threshold(views.scored(spark, sf_dir), PROB, LABEL, 0.6)
    return rounded(out, "precision", "recall", "f1_score")


@query
def confusion_at_threshold(spark, sf_dir):
    return metrics.confusion_at_threshold(views.scored(spark, sf_dir), PROB, LABEL, 0.6)


@query
def roc_auc(spark, sf_dir):
    return rounded(curves.roc_auc(views.scored(spark, sf_dir), PROB, LABEL), "roc_auc")


@query
def average_precision(spark, sf_dir):
    out = curves.average_precision(views.scored(spark, sf_dir), PROB, LABEL)
    return rounded(out, "average_precision")


@query
def pr_curve(spark, sf_dir):
    return curves.pr_curve(views.scored(spark, sf_dir), PROB, LABEL)


@query
def best_f1_threshold(spark, sf_dir):
    return curves.best_f1_threshold(views.scored(spark, sf_dir), PROB, LABEL)


@query
def best_f1_threshold_offset(spark, sf_dir):
    return curves.best_f1_threshold(
        views.scored(spark, sf_dir), PROB, LABEL, reference_offset=True
    )


@query
def isotonic_curve(spark, sf_dir):
    return calibrate.isotonic_blocks(views.scored(spark, sf_dir), PROB, LABEL)


# ---- capacity policies --------------------------------------------------------


@query
def k_sweep(spark, sf_dir):
    return policy.k_sweep(views.scored(spark, sf_dir), PROB, LABEL, KEY, SWEEP)


@query
def precision_recall_at_k(spark, sf_dir):
    return policy.precision_recall_at_k(
        views.scored(spark, sf_dir), PROB, LABEL, KEY, [10, 20, 50, 100]
    )


@query
def capacity_threshold(spark, sf_dir):
    return policy.capacity_threshold(views.scored(spark, sf_dir), PROB, KEY, 20)


@query
def decision_report(spark, sf_dir):
    return policy.decision_report(views.scored(spark, sf_dir), PROB, LABEL, KEY, 50)


# ---- ranked alert table -------------------------------------------------------


def alert_table(spark, sf_dir, k=50):
    return alerts.rank_and_flag(features.engineered(views.labelled(spark, sf_dir)), k)


@query
def score_rank_alerts(spark, sf_dir):
    return ranking.in_rank_order(alert_table(spark, sf_dir))


def unranked(spark, sf_dir):
    return features.engineered(views.labelled(spark, sf_dir))


@query
def alerts_preview(spark, sf_dir):
    return alerts.alerts_preview(alerts.ranked_alerts(unranked(spark, sf_dir), 50))


@query
def scoring_summary(spark, sf_dir):
    return alerts.scoring_summary(alerts.flag_only(unranked(spark, sf_dir), 50))


@query
def filter_scored(spark, sf_dir):
    df = features.engineered(views.labelled(spark, sf_dir))
    kept = alerts.filter_scored(
        df,
        min_score=0.2,
        categories=["error", "view"],
        ranges={
            "tool_wear_min": (20, 200),
            "torque_nm": (5.0, 45.0),
            "rotational_speed_rpm": (1200, 1700),
            "TempDiff": (8.0, 11.0),
        },
    )
    return kept.select(KEY, "type", "p_failure", "tool_wear_min", "torque_nm", "TempDiff")


@query
def filter_alerts_only(spark, sf_dir):
    first = alerts.ranked_alerts(unranked(spark, sf_dir), 50)
    kept = alerts.filter_scored(first, min_score=0.9, alerts_only=True)
    return kept.select(KEY, "type", "p_failure", "rank", "alert_topk")


@query
def filter_domain_categories(spark, sf_dir):
    return alerts.category_domain(views.labelled(spark, sf_dir))


@query
def filter_domain_ranges(spark, sf_dir):
    return alerts.range_domain(features.engineered(views.labelled(spark, sf_dir)))


# ---- cleaning, profile, quality -----------------------------------------------


@query
def sanitize_columns(spark, sf_dir):
    return cleaning.sanitize_columns(views.raw_text(spark, sf_dir))


@query
def enforce_types(spark, sf_dir):
    return cleaning.enforce_types(cleaning.sanitize_columns(views.raw_text(spark, sf_dir)))


@query
def cast_losses(spark, sf_dir):
    return cleaning.cast_losses(cleaning.sanitize_columns(views.raw_text(spark, sf_dir)))


@query
def column_check(spark, sf_dir):
    raw = views.raw_text(spark, sf_dir).drop("RNF")
    raw = raw.withColumn("Line", F.when(F.col("UDI").cast("bigint") % 10 > 0, F.lit("A")))
    return cleaning.column_check(raw, [name for name, _ in RAW_COLUMNS])


@query
def null_profile(spark, sf_dir):
    return profile.null_profile(views.documents_with_labels(spark, sf_dir))


@query
def label_distribution(spark, sf_dir):
    return profile.label_distribution(views.scored(spark, sf_dir), LABEL)


@query
def sensor_range(spark, sf_dir):
    return profile.sensor_range(views.sensors(spark, sf_dir), features.SENSORS)


@query
def duplicate_keys(spark, sf_dir):
    lineitem = views.table(spark, sf_dir, "lineitem")
    return profile.duplicate_keys(lineitem, "l_orderkey", "l_linenumber")


@query
def quality_report(spark, sf_dir):
    bronze = cleaning.sanitize_columns(views.raw_text(spark, sf_dir))
    rules = quality.Rules(
        expected_rows=10_000,
        not_null=("udi", "type", "machine_failure", "torque_nm"),
        unique=("udi",),
        classes={"machine_failure": (0, 1)},
        ranges={"air_temperature_k": (200.0, 400.0), "torque_nm": (1.0, 40.0)},
    )
    return quality.typed_report(bronze, rules)


@query
def quality_duplicates(spark, sf_dir):
    lineitem = views.table(spark, sf_dir, "lineitem")
    rules = quality.Rules(unique=("l_orderkey", "l_linenumber"), not_empty=True)
    return quality.quality_report(lineitem, rules)


# ---- features and splits ------------------------------------------------------


@query
def engineered_features(spark, sf_dir):
    df = features.label_as_int(features.engineered(views.labelled(spark, sf_dir)))
    return features.model_inputs(df, keep=(KEY, LABEL))


@query
def class_weights(spark, sf_dir):
    weighted = train.with_class_weights(views.scored(spark, sf_dir))
    return weighted.groupBy(LABEL).agg(
        F.count("*").alias("rows"), F.max("class_weight").alias("class_weight")
    )


@query
def hash_split(spark, sf_dir):
    return splitting.hash_split(views.scored(spark, sf_dir), KEY).select(KEY, "is_test")


@query
def stratified_split(spark, sf_dir):
    out = splitting.stratified_split(views.scored(spark, sf_dir), LABEL, KEY)
    return out.select(KEY, LABEL, "is_test")


@query
def stratified_folds(spark, sf_dir):
    out = splitting.stratified_folds(views.scored(spark, sf_dir), LABEL, KEY, 3)
    return out.select(KEY, LABEL, "fold")


@query
def parse_probability(spark, sf_dir):
    p = F.col(PROB).cast("string")
    q = (F.lit(1.0) - F.col(PROB)).cast("string")
    spaced = F.concat(F.lit("["), q, F.lit("  "), p, F.lit("]"))
    comma = F.concat(F.lit("["), q, F.lit(","), p, F.lit("]"))
    text = F.when(F.col(KEY) % 2 == 0, spaced).otherwise(comma)
    return views.scored(spark, sf_dir).select(KEY, last_of_vector_text(text).alias(PROB))


# ---- field log and reports ----------------------------------------------------


@query
def log_kpis(spark, sf_dir):
    return fieldlog.log_kpis(views.field_log(spark, sf_dir))


@query
def urgency_breakdown(spark, sf_dir):
    return fieldlog.urgency_breakdown(views.field_log(spark, sf_dir))


@query
def latest_log(spark, sf_dir):
    return fieldlog.latest_log(views.field_log(spark, sf_dir), "conv_id", "turn")


@query
def log_tail(spark, sf_dir):
    return fieldlog.log_tail(views.field_log(spark, sf_dir), 10, "conv_id", "turn")


@query
def log_defaults(spark, sf_dir):
    entries = views.reports(spark, sf_dir).withColumn("timestamp", F.col("report_date"))
    entries = entries.withColumn("technician", F.regexp_replace("technician", "^user$", "  "))
    return fieldlog.with_defaults(fieldlog.valid_entries(entries))


@query
def shift_summary(spark, sf_dir):
    return reports.shift_summary(
        views.scored(spark, sf_dir), views.field_log(spark, sf_dir), ["conv_id", "turn"]
    )


@query
def fleet_brief(spark, sf_dir):
    out = reports.fleet_brief(
        views.scored(spark, sf_dir), views.field_log(spark, sf_dir), ["conv_id", "turn"]
    )
    return rounded(out, "mean_probability")


def machines(spark, sf_dir):
    return views.scored(spark, sf_dir).select(KEY, PROB, LABEL)


LOG_KEYS = ("conv_id", "turn", "urgency")


@query
def machine_reports_exact(spark, sf_dir):
    log = views.field_log(spark, sf_dir)
    return fieldlog.machine_reports(machines(spark, sf_dir), log, LOG_KEYS)


@query
def machine_reports_contains(spark, sf_dir):
    log = views.field_log(spark, sf_dir)
    return fieldlog.machine_reports(machines(spark, sf_dir), log, LOG_KEYS, "contains")


@query
def machine_facts(spark, sf_dir):
    out = fieldlog.machine_facts(
        views.scored(spark, sf_dir),
        views.field_log(spark, sf_dir),
        20,
        log_columns=LOG_KEYS,
        mode="contains",
    )
    return rounded(out, "fleet_mean")


@query
def machine_label_parse(spark, sf_dir):
    rows = views.reports(spark, sf_dir)
    return rows.select("conv_id", "turn", machine_number("machine_id").alias("unit"))


@query
def report_rows(spark, sf_dir):
    valid = reports.valid_reports(views.reports(spark, sf_dir))
    risky = reports.with_machine_risk(valid, views.scored(spark, sf_dir))
    return reports.report_rows(risky, "shift_report").drop("shift_report")


@query
def report_sections(spark, sf_dir):
    valid = reports.valid_reports(views.reports(spark, sf_dir))
    risky = reports.with_machine_risk(valid, views.scored(spark, sf_dir))
    rows = reports.report_rows(risky, "shift_report")
    return reports.report_sections(rows, "conv_id", "turn")


@query
def report_rejects(spark, sf_dir):
    rejected = reports.rejected_reports(views.reports(spark, sf_dir))
    return rejected.select("conv_id", "turn", "machine_id", "reason")


OPTIONS = [*URGENCY_LEVELS, *[f"M-{i}" for i in range(20)]]


@query
def option_match(spark, sf_dir):
    log = views.field_log(spark, sf_dir)
    spoken = (
        F.when(F.col("turn") % 3 == 0, F.concat(F.lit("  the UDI "), F.col("machine_id")))
        .when(F.col("turn") % 3 == 1, F.col("urgency"))
        .otherwise(F.col("transcript"))
    )
    return fieldlog.match_option(log, spoken, OPTIONS).select("conv_id", "turn", "choice")


@query
def spoken_forms(spark, sf_dir):
    log = views.field_log(spark, sf_dir)
    return log.select("conv_id", "turn", spoken_form("transcript").alias("spoken"))


@query
def markup_scrub(spark, sf_dir):
    marked = F.concat(F.lit("## **Note** "), F.col("text"), F.lit("```"))
    documents = views.table(spark, sf_dir, "documents")
    return documents.select("doc_id", strip_markup(marked).alias("shown"))


@query
def extract_report_fields(spark, sf_dir):
    rows = views.extracted_json(spark, sf_dir)
    return fieldlog.extract_report_fields(rows, "extracted", "transcript").drop(
        "extracted", "transcript"
    )


# ---- sources and sinks --------------------------------------------------------


@query
def csv_round_trip(spark, sf_dir):
    path = new_path(spark, "predictions-csv")
    writers.write_csv(views.scored(spark, sf_dir).select(KEY, LABEL, PRED, PROB), path)
    return readers.read_predictions(spark, path)


@query
def log_round_trip(spark, sf_dir):
    path = new_path(spark, "field-log")
    log = views.field_log(spark, sf_dir)
    entries = log.withColumn("source", F.concat_ws("/", "conv_id", "turn"))
    from_user = F.col("technician") == "user"
    writers.append_log(entries.filter(from_user), path)
    writers.append_log(entries.filter(~from_user), path)
    return readers.read_log(spark, path)


@query
def table_round_trip(spark, sf_dir):
    place = new_path(spark, "namespace")
    name = "faultline_" + place.rsplit("-", 1)[-1]
    current = spark.catalog.currentDatabase()
    tables.use_namespace(spark, name, place)
    spark.catalog.setCurrentDatabase(current)
    rows = views.sensors(spark, sf_dir)
    return tables.ensure_table(spark, f"{name}.sensors", lambda: rows)


@query
def table_legs(spark, sf_dir):
    """Every way a table comes to its rows: one row for each, with the number of
    builds so far and what the table then holds."""
    place = new_path(spark, "legs")
    namespace = "faultline_" + place.rsplit("-", 1)[-1]
    current = spark.catalog.currentDatabase()
    tables.use_namespace(spark, namespace, place)
    spark.catalog.setCurrentDatabase(current)
    name = f"{namespace}.sensors"
    sensors = views.sensors(spark, sf_dir)
    builds, legs = [], []

    def build(rows):
        return lambda: builds.append(1) or rows

    def note(leg):
        seen = (0, None)
        if tables.table_exists(spark, name):
            seen = spark.table(name).agg(F.count("*"), F.sum("udi")).first()
        legs.append((leg, len(builds), *seen))

    tables.ensure_table(spark, name, build(sensors))
    note("build")
    tables.ensure_table(spark, name, build(sensors), legs[0][2])
    note("skip")
    halved = sensors.filter("udi % 2 = 0")
    tables.ensure_table(spark, name, build(halved), halved.count())
    note("rebuild")
    tables.write_checked(spark.table(name).filter("udi % 3 = 0").withColumn("line", F.lit("A")), name)
    note("overwrite_itself")
    tables.append_table(spark.table(name).withColumn("line", F.lit("B")), name)
    note("append")
    tables.drop_table(spark, name)
    note("drop")
    return spark.createDataFrame(legs, "leg string, builds int, rows long, udi_sum long")


# ---- models: rows only --------------------------------------------------------

# Fewer boosting rounds than the library default, which is the reference's 300.
ROUNDS = 20

_fitted: dict = {}


def prepared(spark, sf_dir):
    df = features.label_as_int(features.engineered(views.labelled(spark, sf_dir)))
    inputs = features.model_inputs(df, keep=(KEY, LABEL))
    return splitting.stratified_split(inputs, LABEL, KEY)


def parts(spark, sf_dir):
    """(train, test), written once per application and table folder."""
    cache_key = (storage.releases, spark.sparkContext.applicationId, sf_dir, "parts")
    if cache_key not in _fitted:
        written = materialize(prepared(spark, sf_dir), "model-input")
        _fitted[cache_key] = splitting.split_frames(written)
    return _fitted[cache_key]


def model(spark, sf_dir, kind):
    """A model is fitted once per application and shared by the queries."""
    cache_key = (storage.releases, spark.sparkContext.applicationId, sf_dir, kind)
    if cache_key not in _fitted:
        fit = {
            "forest": lambda rows: train.fit_forest(rows),
            "logistic": lambda rows: train.fit_logistic(rows),
            "boosting": lambda rows: train.fit_boosting(rows, maxIter=ROUNDS),
            "calibrated": lambda rows: calibrate.fit_calibrated(rows, KEY, maxIter=ROUNDS),
        }[kind]
        _fitted[cache_key] = fit(parts(spark, sf_dir)[0])
    return _fitted[cache_key]


def test_scores(spark, sf_dir, kind):
    test = parts(spark, sf_dir)[1]
    scored = score.with_failure_probability(test, model(spark, sf_dir, kind))
    return scored.select(KEY, LABEL, "p_failure")


@query
def feature_vectors(spark, sf_dir):
    _, vectors = features.feature_vectors(views.labelled(spark, sf_dir), include_flags=True)
    return vectors.withColumn("features", vector_to_array("features"))


@query
def feature_slots(spark, sf_dir):
    """The vectors of ``feature_vectors`` slot by slot, under the slots' names."""
    _, vectors = features.feature_vectors(views.labelled(spark, sf_dir), include_flags=True)
    names = F.array(*[F.lit(name) for name in importance.slot_names(vectors)])
    slots = vectors.select(KEY, LABEL, F.posexplode(vector_to_array("features")).alias("slot", "value"))
    return slots.withColumn("name", F.get(names, F.col("slot")))


@query
def split_inputs(spark, sf_dir):
    """Membership and inputs of the model split, as the fits read them."""
    train_rows, test_rows = parts(spark, sf_dir)
    return train_rows.withColumn("is_test", F.lit(False)).unionByName(
        test_rows.withColumn("is_test", F.lit(True))
    )


@query
def train_forest_score(spark, sf_dir):
    return test_scores(spark, sf_dir, "forest")


@query
def train_logistic_score(spark, sf_dir):
    return test_scores(spark, sf_dir, "logistic")


@query
def train_gbt_score(spark, sf_dir):
    return test_scores(spark, sf_dir, "boosting")


@query
def calibrated_score(spark, sf_dir):
    return test_scores(spark, sf_dir, "calibrated")


@query
def feature_importance(spark, sf_dir):
    fitted = model(spark, sf_dir, "forest")
    return importance.feature_importance(fitted, fitted.transform(parts(spark, sf_dir)[1]))


@query
def permutation_importance(spark, sf_dir):
    return importance.permutation_importance(
        parts(spark, sf_dir)[1], model(spark, sf_dir, "calibrated")
    )


@query
def inspect_list(spark, sf_dir):
    return score.inspect_list(parts(spark, sf_dir)[1], model(spark, sf_dir, "calibrated"))


@query
def score_and_alert(spark, sf_dir):
    rows = views.labelled(spark, sf_dir).drop("p_failure")
    return score.score_and_alert(rows, model(spark, sf_dir, "calibrated"), 50)


@query
def medallion_predictions(spark, sf_dir):
    path, place = new_path(spark, "raw-csv"), new_path(spark, "medallion")
    writers.write_csv(views.raw_text(spark, sf_dir, damaged=False), path)
    name = "faultline_" + place.rsplit("-", 1)[-1]
    current = spark.catalog.currentDatabase()
    done = medallion.run(spark, path, name, place, export_path=new_path(spark, "exported"))
    spark.catalog.setCurrentDatabase(current)
    return done.predictions.withColumn("prob_failure", vector_element("probability")).drop(
        "probability"
    )
