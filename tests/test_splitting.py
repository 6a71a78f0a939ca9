import hashlib

import pytest

from faultline.operators import splitting


def rows(n=4000):
    """One class holds 97 of 100 rows."""
    return [(i, int(i % 100 < 3)) for i in range(n)]


def place(i, seed):
    return (int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), 16), i)


def brute_parts(data, cumulative, seed):
    out = {}
    for label in {y for _, y in data}:
        ids = sorted((i for i, y in data if y == label), key=lambda i: place(i, seed))
        ends = [int(len(ids) * c + 0.5) for c in cumulative]
        for n, i in enumerate(ids):
            out[i] = sum(n >= end for end in ends)
    return out


@pytest.mark.parametrize("layout", [1, 4, 17])
def test_stratified_split_equals_brute_force(spark, layout):
    df = spark.createDataFrame(rows(), "udi long, y int").repartition(layout)
    split = splitting.stratified_split(df, "y", "udi", 0.2, seed=7)
    got = {r["udi"]: r["is_test"] for r in split.collect()}
    expected = brute_parts(rows(), [0.2], 7)
    assert got == {i: part == 0 for i, part in expected.items()}


def test_a_class_of_all_rows_is_cut_in_small_buckets(spark, monkeypatch):
    """Digits divide the bucket of a cut until few rows are left to order."""
    monkeypatch.setattr(splitting, "BUCKET_DIGITS", 1)
    monkeypatch.setattr(splitting, "FEW", 6)
    data = [(i, 0) for i in range(3000)] + [(-1, 1), (-2, None)]
    df = spark.createDataFrame(data, "udi long, y int").repartition(4)
    hashed = df.select(
        splitting.F.col("y").alias("_y"), splitting.key_hash("udi", 5).alias("_hash")
    )
    edges, digits = splitting.cut_buckets(hashed, [0.2, 0.7])
    edges = edges.collect()
    assert 2 <= digits <= 4 and len(edges) == 6
    assert max(e["_n"] for e in edges if e["_need"]) <= 6
    assert all(e["_need"] <= e["_n"] and len(e["_bucket"]) in (1, digits) for e in edges)
    parts = splitting.stratified_parts(df, "y", "udi", [0.2, 0.5], 5).collect()
    want = brute_parts(data, [0.2, 0.7], 5)
    assert {r["udi"]: r["part"] for r in parts} == want


def test_rows_of_one_key_cannot_be_divided(spark, monkeypatch):
    monkeypatch.setattr(splitting, "BUCKET_DIGITS", 16)
    monkeypatch.setattr(splitting, "FEW", 6)
    df = spark.createDataFrame([(7, 0)] * 500 + [(8, 0)], "udi long, y int")
    parts = splitting.stratified_split(df, "y", "udi", 0.5).collect()
    assert len(parts) == 501 and len({(r["udi"], r["is_test"]) for r in parts}) == 2


def test_folds_equal_brute_force(spark):
    df = spark.createDataFrame(rows(1000), "udi long, y int")
    folds = splitting.stratified_folds(df, "y", "udi", 3, seed=1)
    got = {r["udi"]: r["fold"] for r in folds.collect()}
    assert got == brute_parts(rows(1000), [1 / 3, 1 / 3 + 1 / 3], 1)


def test_tiny_and_missing_classes(spark):
    data = [(1, 0), (2, 0), (3, 1), (4, None), (5, None), (6, None), (7, None), (8, None)]
    df = spark.createDataFrame(data, "udi long, y int")
    split = splitting.stratified_split(df, "y", "udi", 0.2).collect()
    test = [r["y"] for r in split if r["is_test"]]
    # quotas round(2 * .2) = 0, round(1 * .2) = 0, round(5 * .2) = 1
    assert len(split) == 8 and test == [None]


def test_repeated_key_stays_together(spark):
    """One key owns half of all rows; its rows share a part, nothing is lost."""
    data = [(7 if i % 2 else i, 0) for i in range(2000)]
    df = spark.createDataFrame(data, "udi long, y int")
    for seed in range(4):
        rows = splitting.stratified_split(df, "y", "udi", 0.2, seed).collect()
        parts = {r["is_test"] for r in rows if r["udi"] == 7}
        assert len(rows) == 2000 and len(parts) == 1
        order = sorted({u for u, _ in data}, key=lambda u: place(u, seed))
        sizes = {u: 1000 if u == 7 else 1 for u in order}
        taken, test = 0, set()
        for u in order:
            if taken >= 400:
                break
            taken += sizes[u]
            test.add(u)
        assert {r["udi"] for r in rows if r["is_test"]} == test


def test_text_keys(spark):
    df = spark.createDataFrame([(f"k{i}", i % 2) for i in range(200)], "udi string, y int")
    split = splitting.stratified_split(df, "y", "udi", 0.25)
    counts = {r["y"]: r["count"] for r in split.filter("is_test").groupBy("y").count().collect()}
    assert counts == {0: 25, 1: 25}


def test_hash_split_share_and_layout(spark):
    df = spark.range(5000)
    seen = [
        {r["id"] for r in splitting.hash_split(df.repartition(n), "id").filter("is_test").collect()}
        for n in (1, 4, 17)
    ]
    assert seen[0] == seen[1] == seen[2]
    assert 0.18 < len(seen[0]) / 5000 < 0.22


def test_empty_part_raises(spark):
    df = spark.range(10).selectExpr("id", "false as is_test")
    with pytest.raises(ValueError, match="empty"):
        splitting.split_frames(df)
