"""Ids that doubles cannot hold, texts that once ended an executor."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from faultline.llm import surrogates, syncmers

DOCS = "doc_id long, text string"


@pytest.mark.parametrize("low", [2**62, -(2**62), 2**63 - 1000, 0])
def test_every_document_meets_the_next(spark, low):
    rng = random.Random(low % 97)
    ids = sorted(rng.sample(range(low, low + 999), 400))
    texts = {i: f"text {n} " + " ".join(rng.choice("abcdefgh") * 3 for _ in range(n % 23)) for n, i in enumerate(ids)}
    rows = list(texts.items())
    rng.shuffle(rows)
    got = {r.doc_id: r for r in syncmers.fingerprints(spark.createDataFrame(rows, DOCS).repartition(5)).collect()}
    assert len(got) == 400
    for n, i in enumerate(ids):
        text, after = texts[i], texts[ids[(n + 1) % 400]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if text == after:
            assert r.near_next == 1


def test_texts_of_hosts_letters_and_digits_end(spark):
    """2,000 labels once overflowed the stack; runs of letters took quadratic time."""
    texts = [
        "x@" + "a." * 2000,
        "x@" + "a." * 500_000 + " me@here.org",
        "b" * 1_000_000 + " me@here.org",
        "1" * 1_000_000,
        "c." * 500_000,
        "x@" * 300_000,
        ("d" * 62 + ".") * 16_000,
        "y@" + "-" * 1_000_000,
    ]
    start = time.time()
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = {r.doc_id: r for r in surrogates.replace_private(docs, "key").collect()}
    assert time.time() - start < 120
    for i in (1, 2):
        assert got[i].n_replaced >= 1 and not got[i].text.endswith("me@here.org")
    assert got[2].text.startswith("b" * 1_000_000) and got[3].text == texts[3] and got[4].text == texts[4]


def test_addresses_are_found_whole(spark):
    good = [
        "a@b.co", "first.last+tag@mail.example.org", "x_y%z@a-b.c-d.museum", "A1@9.example.com",
        "n@" + ".".join(["s"] * 100) + ".net", "q" * 64 + "@long.example.com",
    ]
    none = ["a@b", "@b.com", "a@-b.com x", "a@b.c", "a b.com"]
    find = re.compile(surrogates.EMAIL)
    for text in good:
        assert find.search(f"mail {text}, please").group() == text
        assert find.search(f"<{text}>").group() == text
    assert not any(find.search(text) for text in none)
    found = spark.createDataFrame([(t,) for t in good + none], "t string").select(
        "t", F.regexp_extract_all("t", F.lit(f"({surrogates.EMAIL})"), F.lit(1)).alias("m")
    )
    assert {r.t: r.m for r in found.collect()} == {t: [t] for t in good} | {t: [] for t in none}
    docs = spark.createDataFrame([(i, f"to {t} now") for i, t in enumerate(good)], DOCS)
    for r in surrogates.replace_private(docs, "key").collect():
        assert r.kinds == ["email"] and good[r.doc_id] not in r.text and r.text.startswith("to ")
