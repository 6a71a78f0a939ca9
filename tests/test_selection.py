"""The k-th row by counting, against sorting."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from faultline.operators import alerts, ranking, selection


def frame(spark, rows, kind="long", layout=3):
    return spark.createDataFrame(rows, f"udi {kind}, p_failure double").repartition(layout)


def first_keys(rows, k):
    """Sorted list of scored rows: falling score, ascending key, nulls first."""
    scored = [r for r in rows if r[1] is not None and r[1] == r[1]]
    order = sorted(scored, key=lambda r: (-r[1], r[0] is not None, r[0] if r[0] is not None else 0))
    return [r[0] for r in order[:k]]


def skewed(n, seed=3):
    """A third of all rows share a score, most others lie close together."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind = rng.random()
        score = 0.5 if kind < 0.34 else 0.5 + rng.random() * 1e-12 if kind < 0.7 else rng.random()
        rows.append((i, None if kind > 0.98 else float("nan") if kind > 0.97 else score))
    return rows


@pytest.fixture
def small(monkeypatch):
    """Rounds that a large table would take."""
    monkeypatch.setattr(selection, "GRID", 20)
    monkeypatch.setattr(selection, "FEW", 30)
    monkeypatch.setattr(ranking, "HEAD_LIMIT", 5)


@pytest.mark.parametrize("k", [3, 300, 1500, 5000])
def test_flagged_rows_equal_sorting(spark, small, k):
    rows = skewed(2000)
    out = ranking.flag_first(frame(spark, rows), "p_failure", "udi", k).collect()
    assert len(out) == 2000
    assert sorted(r["udi"] for r in out if r["alert_topk"]) == sorted(first_keys(rows, k))


def test_both_ways_agree(spark, monkeypatch):
    df = frame(spark, skewed(3000))
    way = lambda: {r["udi"] for r in ranking.flag_first(df, "p_failure", "udi", 800).filter("alert_topk").collect()}
    merged = way()
    monkeypatch.setattr(ranking, "HEAD_LIMIT", 10)
    assert len(merged) == 800 and way() == merged


@pytest.mark.parametrize(
    "kind,key",
    [
        ("string", lambda i: f"M-{i % 7}{'é' if i % 3 else '語'}{i}"),
        ("string", lambda i: "a" * (i % 5 + 1) + str(i)),
        ("long", lambda i: 2**62 + i),
        ("double", lambda i: i / 7),
        ("date", lambda i: datetime.date(2000, 1, 1) + datetime.timedelta(days=i)),
    ],
)
def test_ties_are_cut_by_keys_of_any_type(spark, small, kind, key):
    rows = [(key(i), 0.5) for i in random.Random(1).sample(range(600), 600)]
    df = frame(spark, rows, kind)
    for k in (251,):
        got = ranking.flag_first(df, "p_failure", "udi", k).filter("alert_topk").collect()
        assert sorted(r["udi"] for r in got) == sorted(r[0] for r in rows)[:k]


def test_null_keys_come_first_among_equals(spark, small):
    rows = [(None, 0.5)] * 4 + [(i, 0.5) for i in range(20)] + [(99, 0.9)]
    keys = lambda k: [
        r["udi"] for r in ranking.flag_first(frame(spark, rows), "p_failure", "udi", k).filter("alert_topk").collect()
    ]
    assert sorted(keys(10), key=str) == sorted(first_keys(rows, 10), key=str)
    # null keys cannot be told apart: all or none
    assert sorted(keys(6), key=str) == [0, 99, None, None, None, None]


def test_ends(spark, small):
    empty = frame(spark, [])
    assert ranking.flag_first(empty, "p_failure", "udi", 9).count() == 0
    missing = frame(spark, [(1, None), (2, float("nan"))])
    assert {r["alert_topk"] for r in ranking.flag_first(missing, "p_failure", "udi", 9).collect()} == {False}
    with pytest.raises(ValueError, match="at least 1"):
        selection.cut_of(empty, "p_failure", "udi", 0)
    assert selection.nth_value(empty.select("udi"), "udi", 1) is None
    assert selection.nth_text(spark.createDataFrame([], "s string"), "s", 1) is None


@pytest.mark.parametrize("values", [[0] * 90 + [1] * 10, [0] * 10 + [1] * 90, list(range(100)), [5] * 100])
def test_nth_value(spark, small, values):
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(3)
    for n in (1, 10, 11, 91):
        place = selection.nth_value(df, "v", n)
        want = sorted(values)[n - 1]
        assert place == selection.Place(want, sum(v < want for v in values), values.count(want))
    assert selection.nth_value(df, "v", 101) is None


def test_few_scans_find_the_cut(spark, monkeypatch):
    df = spark.range(400_000).select("id", (F.pmod(F.xxhash64("id"), F.lit(10**9)) / 1e9).alias("s"))
    scans = []
    agg = type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *a: scans.append(1) or agg(self, *a))
    place = selection.nth_value(df, "s", 123_456)
    assert len(scans) <= 3
    monkeypatch.undo()
    assert df.filter(F.col("s") < place.value).count() == place.below == 123_455


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_rows_are_not_sorted(spark):
    df = frame(spark, skewed(500)).withColumn("wide", F.lit("x"))
    summary = alerts.scoring_summary(alerts.flag_only(df, 50))
    first = alerts.ranked_alerts(df, 50)
    preview = alerts.alerts_preview(first)
    for out in (summary, first, preview):
        # a merge of the tasks' first rows, and a window over them; no sort by range
        assert "rangepartitioning" not in plan(out)
        assert "TakeOrderedAndProject" in plan(out)


def test_alert_rows_equal_the_ranked_table(spark, small):
    rows = skewed(900)
    df = frame(spark, rows).withColumns({"type": F.lit("L"), "TempDiff": F.lit(1.0)})
    for k in (4, 250):
        whole = alerts.rank_and_flag(df, k)
        first = alerts.ranked_alerts(df, k)
        assert first.columns == whole.columns
        want = {tuple(r) for r in whole.filter("alert_topk").collect()}
        assert {tuple(r) for r in first.collect()} == want and len(want) == k
        totals = alerts.scoring_summary(alerts.flag_only(df, k)).first()
        assert totals == alerts.scoring_summary(whole).first()
        assert alerts.alerts_preview(first).collect() == alerts.alerts_preview(whole).collect()


def test_top_k_beyond_the_scored_rows(spark, small):
    rows = [(i, float(i % 5)) for i in range(40)] + [(100 + i, None) for i in range(20)]
    df = frame(spark, rows)
    got = [r["udi"] for r in ranking.top_k(df, "p_failure", "udi", 50).collect()]
    assert got == first_keys(rows, 40) + list(range(100, 110))
