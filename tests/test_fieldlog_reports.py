import pytest
from pyspark.sql import functions as F

from faultline.operators import fieldlog, reports, risk
from faultline.schemas import LOG_COLUMNS, URGENCY_LEVELS

LOG = [
    ("2024-01-01 10:00:00", "M-12", "ann", "High — stop immediately", "noise"),
    ("2024-01-02 10:00:00", "M-123", "bob", "Low — schedule next maintenance", "heat"),
    ("2024-01-03 10:00:00", "AGP-7", "ann", "Unknown", "belt"),
    ("2024-01-04 10:00:00", None, "cat", "Medium — fix within shift", "oil"),
]


def log(spark):
    return spark.createDataFrame(
        LOG, "timestamp string, machine_id string, technician string, urgency string, transcript string"
    )


def machines(spark, *units):
    return spark.createDataFrame([(u, 0.5) for u in units], "udi long, prob_failure double")


def pairs(df):
    return sorted(((r["udi"], r["transcript"]) for r in df.collect()), key=str)


def test_exact_match_keeps_unmatched_machines(spark):
    out = fieldlog.machine_reports(machines(spark, 12, 3, 99), log(spark))
    assert pairs(out) == [(12, "noise"), (3, None), (99, None)]


def test_contains_match(spark):
    out = fieldlog.machine_reports(machines(spark, 12, 3, 99, 7), log(spark), mode="contains")
    assert pairs(out) == [(12, "heat"), (12, "noise"), (3, "heat"), (7, "belt"), (99, None)]
    with pytest.raises(ValueError):
        fieldlog.machine_reports(spark.range(1).withColumnRenamed("id", "udi"), log(spark), mode="other")


@pytest.mark.parametrize(
    "text", ["M-123", "M--12", "007", "a1b22c", "", "12345678901234567890123", "-0", "M-12/M-12"]
)
def test_numbers_inside_equals_substring_search(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    got = set(df.select(fieldlog.numbers_inside("t")).first()[0])
    limit = 1 << 63
    expected = set()
    for i in range(len(text)):
        for j in range(i + 1, len(text) + 1):
            piece = text[i:j]
            try:
                n = int(piece)
            except ValueError:
                continue
            if str(n) == piece and -limit <= n < limit:
                expected.add(n)
    # 19 digits after the first cover every bigint; the lowest one has a sign too
    assert got == {n for n in expected if len(str(abs(n))) <= 19}


def test_machine_facts(spark):
    scored = spark.createDataFrame(
        [(12, 0.9, 1), (3, 0.1, 0), (4, 0.5, 0)], "udi long, prob_failure double, machine_failure int"
    )
    rows = fieldlog.machine_facts(scored, log(spark), 2).collect()
    got = {r["machine"]: r for r in rows}
    assert set(got) == {"M-12", "M-4"}
    assert got["M-12"]["transcript"] == "noise" and got["M-4"]["transcript"] is None
    assert (got["M-12"]["probability_text"], got["M-12"]["failure_recorded"]) == ("90.0%", "YES")
    assert got["M-12"]["fleet_mean"] == pytest.approx(0.5)


def test_log_defaults_and_validity(spark):
    entries = spark.createDataFrame(
        [(" M-1 ", "  "), ("   ", "ann"), (None, "bob"), ("M-2", "cat")],
        "machine_id string, technician string",
    )
    out = fieldlog.with_defaults(fieldlog.valid_entries(entries))
    assert out.columns == LOG_COLUMNS
    rows = {r["machine_id"]: r for r in out.collect()}
    assert set(rows) == {"M-1", "M-2"}
    assert rows["M-1"]["technician"] == "Unknown" and rows["M-2"]["urgency"] == ""
    assert len(rows["M-1"]["timestamp"]) == 19


def test_kpis_urgency_history(spark):
    assert tuple(fieldlog.log_kpis(log(spark)).first()) == (4, 3, 3)
    status = {r["urgency"]: r["status"] for r in fieldlog.urgency_breakdown(log(spark)).collect()}
    assert [status[u] for u in URGENCY_LEVELS] == ["red", "amber", "green", "neutral"]
    latest = fieldlog.latest_log(log(spark), n=2).collect()
    assert [r["transcript"] for r in latest] == ["oil", "belt"]
    assert fieldlog.latest_log(log(spark).drop("urgency")).columns == [
        "timestamp", "machine_id", "technician", "transcript",
    ]


def test_option_match(spark):
    said = ["high", "the UDI m 12", "medium", "", "-m-", "zzz", None]
    df = spark.createDataFrame([(s,) for s in said], "t string").coalesce(1)
    options = ["M-1", "M-12", *URGENCY_LEVELS]
    got = [r["choice"] for r in fieldlog.match_option(df, "t", options).collect()]
    # 'the  12' contains '1', so the first machine wins; blank phrases match nothing
    assert got == [URGENCY_LEVELS[0], "M-1", URGENCY_LEVELS[1], None, None, None, None]


def test_extract_report_fields(spark):
    texts = [
        '{"fault_description": "leak", "downtime_hours": 2.5, "next_maintenance_date": "2024-03-01"}',
        '```json\n{"fault_description": "hum", "downtime_hours": "3", "next_maintenance_date": "soon"}\n```',
        "not json",
        '{"fault_description": "cut',
        "[1, 2]",
        "{}",
        "{'fault_description': 'single quotes'}",
        None,
    ]
    df = spark.createDataFrame([(t, "said") for t in texts], "j string, t string").coalesce(1)
    rows = fieldlog.extract_report_fields(df, "j", "t").collect()
    assert [r["fault_description"] for r in rows] == [
        "leak", "hum", "said", "said", "said", "", "said", "said",
    ]
    assert [r["downtime_hours"] for r in rows] == [2.5, 3.0, 0, 0, 0, 0, 0, 0]
    assert str(rows[0]["next_date"]) == "2024-03-01" and rows[1]["next_date"] is None
    assert rows[1]["next_maintenance_date"] == "soon" and rows[2]["root_cause"] == ""


def one_report(**fields):
    base = {"machine_id": "M-1", "report_date": "2024-01-05", "fault_description": "f"}
    return {**base, **fields}


def display(spark, scored=None, shift=None, **fields):
    fields = one_report(**fields)
    df = spark.createDataFrame(
        [tuple(fields.values())], ", ".join(f"{n} string" for n in fields)
    )
    if scored is None:
        scored = spark.createDataFrame([(1, 0.0)], "udi long, prob_failure double")
    risky = reports.with_machine_risk(reports.valid_reports(df), scored)
    return reports.report_rows(risky, None if shift is None else F.lit(shift))


def test_zero_probability_is_shown(spark):
    row = display(spark).first()
    assert (row["probability_text"], row["risk_tier"]) == ("0.0%", "Low")
    assert (row["technician"], row["location"]) == ("Unknown", "—")


def test_unknown_machine_and_blank_sections(spark):
    out = display(spark, machine_id=" LINE 3 ", parts_used="  ", downtime_hours="0", root_cause="r")
    row = out.first()
    assert (row["probability_text"], row["risk_tier"]) == ("N/A", "N/A")
    assert row["document_name"] == "maint_report_LINE_3_2024-01-05.pdf"
    sections = reports.report_sections(out, "machine_id").orderBy("position").collect()
    assert [r["heading"] for r in sections] == ["Fault Description", "Root Cause Analysis"]


def test_downtime_and_linked_report(spark):
    row = display(spark, downtime_hours="2.5", shift="s" * 400).first()
    assert row["downtime_hours"] == "2.5 hours"
    assert row["linked_shift_report"] == "s" * 300 + "…"


def test_duplicate_scores_do_not_multiply_reports(spark):
    scored = spark.createDataFrame([(1, 0.6, 5), (1, 0.2, 4)], "udi long, prob_failure double, n int")
    df = spark.createDataFrame([("M-1", "f")], "machine_id string, fault_description string")
    out = reports.with_machine_risk(reports.with_report_defaults(df), scored, order="n").collect()
    assert [(r["prob_failure"], r["risk_tier"]) for r in out] == [(0.2, "Low")]


def test_rejects(spark):
    df = spark.createDataFrame(
        [("  ", "f"), ("M-1", ""), ("M-2", "f")], "machine_id string, fault_description string"
    )
    reasons = {r["machine_id"]: r["reason"] for r in reports.rejected_reports(df).collect()}
    assert reasons == {"": "machine id missing", "M-1": "no fault, cause or recommendation"}
    assert [r["machine_id"] for r in reports.valid_reports(df).collect()] == ["M-2"]


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(0.5,)] * 3, "p double")
    rows = risk.histogram(df, "p", 10).orderBy("bin").collect()
    assert rows[0]["lower"] == 0.0 and rows[-1]["upper"] == 1.0
    assert [r["count"] for r in rows] == [0, 0, 0, 0, 0, 3, 0, 0, 0, 0]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.25,), (1.0,), (1.5,), (None,), (float("nan"),)], "p double")
    fixed = risk.histogram(df, "p", 4, 0.0, 1.0).orderBy("bin").collect()
    assert [r["count"] for r in fixed] == [1, 1, 0, 1]
    free = risk.histogram(df, "p", 3).orderBy("bin").collect()
    assert [r["count"] for r in free] == [2, 0, 2]


def test_tier_counts_name_every_tier(spark):
    df = spark.createDataFrame([(0.9,), (0.1,), (2.0,)], "prob_failure double")
    rows = [tuple(r) for r in risk.tier_counts(df).orderBy("tier_order").collect()]
    assert rows == [(1, "Low", 1), (2, "Medium", 0), (3, "High", 1)]
