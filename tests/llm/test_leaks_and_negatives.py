"""Decontamination and hard negatives against brute force, odd rows, hot keys."""

import math
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import decontaminate, hard_negatives

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(ASCII_LOWER))


def leaks(docs, items, window=10, shingle=5, containment=1.0):
    """(id, n_words, n_hit, item ids) by comparing every place with every window."""
    owners = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if w else 0):
            owners[tuple(w[i : i + n])].add(item)
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for target, who in owners.items():
            n = len(target)
            s = min(shingle, n)
            for i in range(len(w) - n + 1):
                same = [a == b for a, b in zip(target, w[i : i + n])]
                agree = sum(all(same[j : j + s]) for j in range(n - s + 1))
                if agree >= max(math.ceil(containment * (n - s + 1)), 1):
                    hit |= set(range(i, i + n))
                    found |= who
        ids = sorted(str(x) for x in found if x is not None) + [None] * (None in found)
        out.append((doc, len(w), len(hit), ids))
    return out


def fixture(seed, n_docs=60, n_items=25):
    """Texts of few words, so that windows and shingles repeat, with planted items."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(6)] + ["Été", "日本", "x"]
    say = lambda n: [vocabulary[i] for i in rng.integers(0, len(vocabulary), n)]
    items = [(int(i), " ".join(say(int(rng.integers(0, 30))))) for i in range(n_items)]
    items += [(900, "the common words of every single item here now again"), (901, "w1, W2!"), (902, None), (903, "--")]
    items += [(i, "please read the common words of every single item here now again and " + t) for i, t in items[:8]]
    items += [(None, " ".join(say(14))), (None, " ".join(say(12))), (901, " ".join(say(11)))]
    docs = []
    for i in range(n_docs):
        text = say(int(rng.integers(0, 80)))
        if i % 3 == 0:
            _, planted = items[int(rng.integers(0, len(items)))]
            text = text[:20] + (planted or "").upper().split() + text[20:]
        docs.append((i, "; ".join(text)))
    docs += [(5, None), (5, ""), (None, docs[0][1]), (None, None), (2**62 + 3, docs[3][1]), (7, docs[3][1])]
    return docs, items


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, 0, 1) for i, t in docs], "doc_id long, text string, n_words int, `a.b` int")
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    found = decontaminate.find_leaks(d, b, **options).collect()
    for r in found:
        assert r.n_hit == sum(s["last"] - s["first"] + 1 for s in r.spans)
        assert all(0 <= s["first"] <= s["last"] < r.n_words for s in r.spans)
    return [(r.doc_id, r.n_words, r.n_hit, list(r.item_ids)) for r in found]


def sorted_rows(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize(
    "options",
    [{}, {"block_bytes": 200}, {"containment": 0.5}, {"containment": 0.7, "window": 6, "shingle": 2}, {"shingle": 1}],
)
def test_finds_equal_brute_force(spark, options):
    docs, items = fixture(3)
    plain = {k: v for k, v in options.items() if k != "block_bytes"}
    want = leaks(docs, items, **plain)
    assert sum(h > 0 for _, _, h, _ in want) > 10 and any(h == 0 and n > 0 for _, n, h, _ in want)
    assert sorted_rows(run(spark, docs, items, **options)) == sorted_rows(want)


def test_long_items_are_cut_without_losing_a_window(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "CHUNK_BYTES", 64)
    monkeypatch.setattr(decontaminate, "SEARCH_WORDS", 50)
    monkeypatch.setattr(decontaminate, "PIECE_BYTES", 16)
    monkeypatch.setattr(decontaminate, "VERIFY_PAIRS", 3)
    text = " ".join(f"t{i % 40}" for i in range(200))
    docs = [(i, "a b " + " ".join(text.split()[i : i + 12]) + " c") for i in range(0, 180, 3)]
    items = [(1, text), (2, " ".join(text.split()[50:60]))]
    assert sorted_rows(run(spark, docs, items)) == sorted_rows(leaks(docs, items))


def test_a_very_long_word_and_a_very_long_text(spark):
    long = "語" * 400_000
    many = " ".join(f"k{i}" for i in range(300_000))
    items = [(1, "one two three four five six seven eight nine ten"), (2, long)]
    docs = [(1, many + " One-two three.four five six seven eight nine TEN " + many), (2, "x " + long + " y")]
    assert sorted_rows(run(spark, docs, items)) == [(1, 600_010, 10, ["1"]), (2, 3, 1, ["2"])]


def test_no_items_and_no_documents(spark):
    assert run(spark, [(1, "a b")], []) == [(1, 2, 0, [])]
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, [(1, "a b"), (2, None)], [(1, None), (2, "..")]) == [(1, 2, 0, []), (2, 0, 0, [])]


def test_the_rarest_shingle_leads():
    texts = [("1", "a b c d e f g h i j k")]
    index = decontaminate.Index(texts, 10, 5)
    size = index.sizes[0]
    window, offset, h = index.shingles(size)
    counts = {(size, int(k)): 9 for k in h.view(np.int64)}
    rare = h[(window == 0) & (offset == 3)][0]
    counts[size, int(rare.view(np.int64))] = 1
    index.keep_prefixes(counts, 1.0)
    keys, _, windows, offsets = index.prefix[size]
    assert keys.tolist() == [int(rare)]
    assert sorted(zip(windows.tolist(), offsets.tolist())) == [(0, 3), (1, 2)]


# -- hard negatives ---------------------------------------------------------


def negatives(rows, positives=5, k=5, every=100):
    """Rows of (id, label, vector) by sorting each anchor's whole list."""
    rows = [
        (i, y, tuple(math.floor(256 * float(np.float32(c))) for c in x))
        for i, y, x in rows
        if i is not None and y is not None and x and all(c is not None and math.isfinite(c) for c in x)
    ]
    rows = sorted(set(rows))
    anchors = {}
    for i, y, x in rows:
        if i % every == 0:
            anchors.setdefault(i, (y, x))
    out = []
    for a, (y, x) in anchors.items():
        scored = sorted(
            (-sum(p * q for p, q in zip(x, v)), i, label) for i, label, v in rows if len(v) == len(x)
        )
        tops = [(-s, i) for s, i, label in scored if label == y and i != a][:positives]
        for ps, p in tops:
            fit = [(-s, i) for s, i, label in scored if label != y and 80 * ps <= -100 * s <= 100 * ps]
            out += [(a, p, r, i, ps, s) for r, (s, i) in enumerate(fit[:k], 1)]
    return sorted(out)


def vectors(seed, n, d=8, labels=3):
    """Crowded vectors, so that scores tie and windows fill."""
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal(d)
    x = (centre + rng.standard_normal((n, d)) * 0.4).round(1)
    return [(i, int(rng.integers(0, labels)), [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]


def mined(spark, rows, partitions=5, **options):
    df = spark.createDataFrame(
        [(i, x, y, 3, 1) for i, y, x in rows],
        "vec_id long, embedding array<float>, label int, score int, `a.b` int",
    )
    got = hard_negatives.mine(df.repartition(partitions), **options).collect()
    return sorted(tuple(r) for r in got)


def test_negatives_equal_brute_force(spark, monkeypatch):
    rows = vectors(1, 900)
    want = negatives(rows)
    assert len(want) > 100 and {r[2] for r in want} == {1, 2, 3, 4, 5}
    assert mined(spark, rows) == want
    # many passes of few anchors, small tiles, cuts in between
    monkeypatch.setattr(hard_negatives, "GATHER", 40)
    monkeypatch.setattr(hard_negatives, "TILE", 500)
    assert mined(spark, rows, block_bytes=200) == want


def test_negatives_beside_nulls_repeats_and_other_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(2, 300)
    x = rows[7][2]
    odd = [
        (None, 1, x), (301, None, x), (302, 1, None), (303, 1, []), (304, 1, [1.0, None]),
        (305, 1, [*x[:-1], nan]), (306, 2, [*x[:-1], inf]), (307, 2, [*x[:-1], -inf]),
        # repeated rows, an id with several vectors, another length
        rows[100], rows[100], rows[5], (9, 0, x), (9, 1, x), (400, 1, [1.0, 2.0]), (500, 1, [1.0, 2.0]), (601, 2, [1.0, 2.0]),
    ]
    assert mined(spark, rows + odd) == negatives(rows + odd)


def test_a_vector_and_a_label_that_most_rows_share(spark):
    rows = vectors(3, 400)
    x = rows[100][2]
    rows += [(1000 + i, 0 if i % 5 else 1, x) for i in range(1500)]
    assert mined(spark, rows) == negatives(rows)


def test_scores_beyond_doubles(spark):
    rng = np.random.default_rng(4)
    big = [(i, int(i % 2), [float(np.float32(c)) for c in rng.uniform(2e5, 5e5, 4)]) for i in range(120)]
    got = mined(spark, big)
    assert got == negatives(big) and max(r[4] for r in got) > 2**53


def test_relabelled_rows(spark):
    rows = vectors(6, 350, labels=10)
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    want = negatives([(i, (y + 1) % 10 if i % 7 == 0 else y, x) for i, y, x in rows])
    assert mined(spark, rows, relabel=shifted) == want


def test_no_anchor_no_positive_no_rows(spark):
    rows = vectors(7, 99)[1:]
    assert mined(spark, rows) == []
    assert mined(spark, [(100, 1, [1.0]), (101, 2, [1.0])]) == []
    assert mined(spark, []) == []


def test_the_window_iterator_streams():
    def rows():
        yield 1, 10, False, 4
        yield 1, 10, True, 2
        yield 1, 9, False, 8
        yield 1, 8, True, 3
        yield 1, 7, True, 1
        raise AssertionError("read further than the rows given")

    found = hard_negatives.windows(rows(), 2, 80)
    assert [next(found) for _ in range(3)] == [(1, 4, 1, 2, 10, 10), (1, 4, 2, 3, 10, 8), (1, 8, 1, 3, 9, 8)]
