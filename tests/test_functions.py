import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from faultline.functions import hashing, numeric, risk, text


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("Air temperature [K]", "air_temperature_k"),
        (" UDI ", "udi"),
        ("a--b__c", "a_b_c"),
        ("[x]", "x"),
    ],
)
def test_clean_name(raw, clean):
    assert text.clean_name(raw) == clean


def test_tier_edges(spark):
    scores = [-0.01, 0.0, 0.2999, 0.30, 0.55, 1.0, 1.01, None, float("nan")]
    df = spark.createDataFrame([(s,) for s in scores], "p double")
    assert values(df.coalesce(1), risk.risk_tier("p")) == [
        None, "Low", "Low", "Medium", "High", "High", None, None, None,
    ]


def test_nan_is_never_at_risk(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (0.45,), (0.44,)], "p double")
    assert values(df.coalesce(1), risk.at_risk("p")) == [False, False, True, False]


def test_band_is_strict_when_asked(spark):
    df = spark.createDataFrame([(21,), (20,), (6,), (5,)], "n int").coalesce(1)
    status = risk.band("n", risk.AT_RISK_CUTS, risk.BAD_HIGH, strict=True)
    assert values(df, status) == ["red", "amber", "amber", "green"]


def test_vector_text_in_both_forms(spark):
    df = spark.createDataFrame(
        [("[0.9 0.1]",), ("[0.9,0.1]",), ("[ 0.9   0.1 ]",), ("[1.0,5.0E-5]",), ("x",)], "v string"
    ).coalesce(1)
    assert values(df, numeric.last_of_vector_text("v")) == [0.1, 0.1, 0.1, 5e-5, None]


def test_vector_element(spark):
    df = spark.createDataFrame([(Vectors.dense([0.7, 0.3]),)], ["v"])
    assert values(df, numeric.vector_element("v")) == [0.3]


@pytest.mark.parametrize("p", [0.0, 0.1445, 0.0025, 0.5, 0.99949, 0.9995, 1.0, 0.2895])
def test_percent_rounds_like_python(spark, p):
    assert values(spark.range(1), numeric.percent_text(F.lit(p))) == [f"{p:.1%}"]


def test_ratio_of_zero(spark):
    df = spark.range(1)
    assert values(df, numeric.ratio(F.lit(1), F.lit(0))) == [0.0]
    assert values(df, numeric.harmonic_mean(F.lit(0.0), F.lit(0.0))) == [0.0]


def test_machine_label_and_number(spark):
    df = spark.createDataFrame([("M-12",), ("M-",), ("LINE-1",), ("M-1x",), (None,)], "m string")
    assert values(df.coalesce(1), risk.machine_number("m")) == [12, None, None, None, None]
    assert values(spark.range(7, 8), risk.machine_label("id")) == ["M-7"]


def test_spoken_form_deletes_every_m(spark):
    df = spark.createDataFrame([("Medium",), (" M-12 ",), ("the UDI 5",), (None,)], "t string")
    assert values(df.coalesce(1), text.spoken_form("t")) == ["ediu", "12", "the  5", None]


def test_markup_and_shortening(spark):
    df = spark.createDataFrame([("## **a** ```b```",)], "t string")
    assert values(df, text.strip_markup("t")) == [" a b"]
    long = spark.createDataFrame([("x" * 301,), ("y" * 300,)], "t string").coalesce(1)
    assert values(long, text.shortened("t")) == ["x" * 300 + "…", "y" * 300]


def test_key_hash_ignores_layout(spark):
    rows = [
        spark.range(500).repartition(n).select("id", hashing.key_hash("id", 42).alias("h"))
        for n in (1, 4, 17)
    ]
    seen = [{r["id"]: r["h"] for r in df.collect()} for df in rows]
    assert seen[0] == seen[1] == seen[2]
    assert all(len(h) == 32 for h in seen[0].values())
    assert 0.47 < sum(values(spark.range(4000), hashing.hash_below("id", 1, 0.5))) / 4000 < 0.53
    assert not any(values(spark.range(100), hashing.hash_below("id", 1, 0.0)))
    assert all(values(spark.range(100), hashing.hash_below("id", 1, 1.0)))
