"""The whole pipeline on odd rows, dotted names and no rows."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from faultline.llm import curriculum
from faultline.llm.common import materialize

#: All stages but the last, which returns pieces.
KEEPING = corpus_pipeline.STAGES[:-1]


def stages(spark, docs):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, ""), f"test-{name}")
        out.append((name, docs))
    return out


def test_odd_rows_and_dotted_names(spark, odd_docs):
    docs = odd_docs.withColumns(
        {"meta.url": F.concat(F.lit("u"), "doc_id"), "a`b": F.lit(1), "_row": F.lit("r"), "at": F.lit("x")}
    )
    done = stages(spark, docs)
    for name, frame in done[:-1]:
        assert frame.columns == docs.columns, name
    mixed = done[-2][1].collect()
    assert mixed and all(r["a`b"] == 1 and r["_row"] == "r" for r in mixed)
    assert {r["meta.url"] for r in mixed} <= {None, *(f"u{i}" for i in range(1, 10))}
    # a document that only holds another's lines loses them; one of the near copies stays
    assert len({r["doc_id"] for r in mixed} & {1, 2, 3}) == 1
    assert done[-1][1].count() >= len(mixed)


def test_no_rows(spark, no_docs):
    for name, frame in stages(spark, no_docs):
        assert frame.count() == 0, name


def test_the_mix_sorts_each_text_once(spark, odd_docs):
    mixed = curriculum.mix(odd_docs)
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    sort = plan.index("Sort [at#")
    below = plan[sort:].splitlines()[1]
    # the old row, its text included, stays behind: only its other fields are named
    assert "AS row#" in below and not re.search(r"_row#\d+(?:\.text)?[,\]]", below)
    places = [r.position for r in curriculum.each_copy(curriculum.place(odd_docs)).collect()]
    assert mixed.count() == len(places)


@pytest.mark.parametrize("seed", [1, 2])
def test_order_follows_the_positions(spark, seed):
    rows = [(i, " ".join(["w"] * (i % 9 + 1)), "abc"[i % 3]) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    copies = curriculum.each_copy(curriculum.place(docs)).collect()
    copies.sort(key=lambda r: (r.position, r.doc_id, r.text_hash, r.source, r.epoch))
    got = [(r.doc_id, r.source, len(r.text.split())) for r in curriculum.mix(docs.repartition(seed)).collect()]
    assert got == [(r.doc_id, r.source, r.words) for r in copies]
