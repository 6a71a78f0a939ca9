"""Rows that an operator once lost, or could not end on."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import curriculum, grammar_tokens, line_runs, main_text, near_dups, surrogates, syncmers

DOCS = "doc_id long, text string, source string"


def sentence(word, n=30):
    return " ".join(f"{word}{i}" for i in range(n))


def test_one_document_of_each_component_stays(spark):
    rows = [(None, sentence(w), "s") for w in ("ant", "bee", "cat", "dog")]
    rows += [(None, sentence("cat"), "s"), (None, None, "s"), (None, " \t", "s"), (None, " \t", "s")]
    rows += [(7, sentence(w), "s") for w in ("elk", "fox", "gnu")]
    # linked across ids, and rows alike in doc_id and text
    rows += [(8, sentence("elk") + " more", "s"), (None, sentence("fox"), "s")]
    rows += [(9, sentence("hen"), "t"), (9, sentence("hen"), "s"), (9, sentence("hen"), None)]
    left = near_dups.drop_near_duplicates(spark.createDataFrame(rows, DOCS))
    got = Counter((r.doc_id, r.text) for r in left.collect())
    want = [(None, sentence(w)) for w in ("ant", "bee", "cat", "dog")]
    want += [(None, None), (None, " \t"), (None, " \t")]
    want += [(7, sentence(w)) for w in ("elk", "fox", "gnu")] + [(9, sentence("hen"))]
    assert got == Counter(want)
    # two linked texts under one doc_id are one component
    two = [(3, sentence("ibis")), (3, sentence("ibis") + " more"), (3, sentence("jay"))]
    left = near_dups.drop_near_duplicates(spark.createDataFrame(two, "doc_id long, text string"))
    assert sorted(r.text[:3] for r in left.collect()) == ["ibi", "jay"]


def test_a_source_without_words_takes_no_copy(spark):
    rows = [(1, "a b c d", "full"), (2, "e f", "full"), (3, None, "none"), (4, "", "none")]
    rows += [(5, " \t", "blank"), (6, None, None), (7, "g h i", "other")]
    docs = spark.createDataFrame(rows, DOCS)
    by = {r.doc_id: r for r in curriculum.place(docs).collect()}
    assert len(by) == 7
    for i in (3, 4, 5, 6):
        assert (by[i].source_size, by[i].target, by[i].taken, by[i].copies) == (0, 0.0, 0, [])
    assert sum(r.taken for r in by.values()) == 9
    mixed = curriculum.mix(docs).collect()
    assert {r.source for r in mixed} == {"full", "other"}
    assert curriculum.mix(docs.where("source = 'none'")).count() == 0


def test_secrets_that_leave_little_to_draw_find_a_surrogate(spark):
    secrets = ["password=****", "secret=???", "token=...", "passwd=密码", "api_key=hunter2hunter2"]
    secrets += [f"token={i}" for i in range(10)]
    docs = spark.createDataFrame([(i, f"its {x} here") for i, x in enumerate(secrets)], "doc_id long, text string")
    got = {r.doc_id: r.text.split()[1] for r in surrogates.replace_private(docs, "key").collect()}
    assert len(set(got.values())) == len(secrets) == len(got) and not set(secrets) & set(got.values())
    for i, x in enumerate(secrets):
        assert got[i].startswith(x[: x.index("=") + 1])
        assert sum(c.isascii() and c.isalnum() for c in got[i][x.index("=") :]) >= 4
    assert "密" not in got[3] and len(got[4]) == len(secrets[4])


def test_words_of_names_keep_their_surrogates(spark):
    texts = [
        "Mr Smith met Mr. Smith",
        "Mr. John Smith and Mr. Smith",
        "Mrs. Smith with Frau Anna Maria Kern, Frau Maria Kern",
        "Herr John Kern",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = surrogates.replace_private(docs, "key").collect()
    got = {r.doc_id: r.text.replace(",", "").split() for r in rows}
    smith = got[0][1]
    assert smith != "Smith" and got[0] == ["Mr", smith, "met", "Mr.", smith]
    john = got[1][1]
    assert got[1] == ["Mr.", john, smith, "and", "Mr.", smith]
    title, other, _, _, anna, maria, kern, *rest = got[2]
    assert (title, other) == ("Mrs.", smith) and rest == ["Frau", maria, kern]
    assert got[3] == ["Herr", john, kern]
    assert len({smith, john, anna, maria, kern}) == 5
    assert {r.n_replaced for r in rows} == {1, 2, 3} and all(r.kinds == ["name"] for r in rows)


def test_more_given_names_than_the_list_has(spark):
    rows = [("given_m", f"name{i}") for i in range(40)] + [("family", "adam"), ("given_f", "adam")]
    table = surrogates.surrogate_table(spark.createDataFrame(rows, "kind string, canon string"), "k").collect()
    assert len(table) == 42 == len({(r.kind, r.new) for r in table})
    assert not {r.new for r in table} & {x for _, x in rows}


def test_words_of_lines_part_at_white_space(spark):
    tabbed = "\t".join(f"t{i}" for i in range(60))
    han = "春眠不觉晓处处闻啼鸟夜来风雨声花落知多少"
    thai = "ภาษาไทยเป็นภาษาที่มีระดับเสียงของคำแน่นอนหรือวรรณยุกต์"
    spaced = " ".join(f"s{i}" for i in range(12))
    doubled = "five  words  with  double  blanks"
    url = "https://example.org/a-long-path/that-is-one-word/and-no-more.html"
    lines = [tabbed, han, thai, spaced, f"\t{spaced}", f"{spaced}\r", doubled, url, "短い行"]
    docs = [(i, f"own line {i}\n{line}\nlast one {i}") for i, line in enumerate(lines)]
    docs += [(10 + i, text.replace("own", "other").replace("last", "end")) for i, text in docs]
    got = line_runs.drop_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    deleted = {r.doc_id: r.n_deleted for r in got.collect()}
    assert [deleted[i] for i in range(9)] == [0, 0, 0, 0, 1, 1, 0, 0, 0]
    assert [deleted[10 + i] for i in range(9)] == [1, 1, 1, 1, 1, 1, 0, 0, 0]


def test_a_passage_is_seen_in_long_texts(spark):
    passage = sentence("shared", 60)
    one = f"{sentence('a', 9000)} {passage} {sentence('b', 9000)}"
    two = f"{sentence('c', 3000)} {passage} {sentence('d', 14000)}"
    torn = f"{sentence('c', 3000)} {' '.join(f'{w} x{i}' for i, w in enumerate(passage.split()))}"
    twice = f"{passage} {sentence('e', 100)} {passage}"
    frame = spark.createDataFrame([(one, two, torn, passage, twice)], "a string, b string, c string, d string, e string")
    a, b, c, d, e = (syncmers.sketch(F.col(x)) for x in "abcde")
    row = frame.select(
        syncmers.matches(syncmers.steps(a), syncmers.steps(b)).alias("passage"),
        syncmers.matches(syncmers.steps(a), syncmers.steps(c)).alias("torn"),
        syncmers.matches(syncmers.steps(d), syncmers.steps(e)).alias("twice"),
        F.size(syncmers.anchors(F.col("d"))).alias("anchors"),
        F.size(a).alias("kept"),
        F.size(syncmers.anchors(F.col("a"))).alias("all"),
        syncmers.likeness(a, b).alias("near"),
        syncmers.likeness(a, a).alias("same"),
        syncmers.as_text(a).alias("fingerprint"),
        syncmers.anchors(F.col("a")).alias("list"),
    ).first()
    assert row["kept"] == row["all"] > 5000
    assert row["passage"] == row["twice"] == row["anchors"] - 1 > 10 and row["torn"] == 0
    assert row["near"] > 0 and row["same"] == 1
    pairs = [row["fingerprint"][i : i + 16] for i in range(0, len(row["fingerprint"]), 16)]
    assert [(int(x[:8], 16), x[8:]) for x in pairs] == [
        (x["pos"], f"{(x['hash'] % 2**64) >> 32:08x}") for x in row["list"]
    ]


def test_half_edited_texts_without_blanks_or_with_few_words(spark):
    han = "".join(chr(0x4E00 + 37 * i % 5000) for i in range(120))
    texts = [han, sentence("w", 60), "internationalization considerations", "a b c d e f g h i j k l m n o p q r s t u v w x y z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in syncmers.fingerprints(docs).collect()}
    for r in got.values():
        assert 0.15 < r.near_edited < 0.9 and r.fingerprint
        assert r.near_next < 0.1


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p class='ad'>buy<p>one<p>two", "one\ntwo"),
        ("<ul><li class=share>share<li>one</ul><p>two", "one\ntwo"),
        ("<div><p class=ad>buy</div>one", "one"),
        ("<table><tr><td class=ad>buy<td>one<tr><td>two</table>", "one\ntwo"),
        ("<div class=ad>buy <div>now</div><p>a<ul><li>b</ul>more</div><p>one", "one"),
        ("<p>one <span class=ad>buy</span> two", "one two"),
        ("<p>one<aside><p>more<ul><li>a<li>b</ul></aside><p>two", "one\ntwo"),
        ("<h2 id='related-work'>one</h2><section id='social-impact'><p>two</section>", "one\ntwo"),
        ("<div class='has-sidebar no-comments'>one</div>", "one"),
        ("<p title='a hidden class=ad thing'>one</p><p title=\"x\" hidden>no</p>", "one"),
        ("<a class=share href=/x/>no</a><p>one", "one"),
        ("<div class='cookie-notice'>no</div><div id='comment-12'>no</div><div class='comments__list'>no</div><p>one", "one"),
    ],
)
def test_main_text_behind_marked_elements(page, want):
    assert main_text.main_text(f"<body><p>out</p><article>{page}</article><p>out</p>") == want
    assert main_text.main_text("<head><title>T</title><body><article class='no-comments'>one") == "one"


def test_no_frequent_pair_stays_in_a_block():
    rng = np.random.default_rng(4)
    passage = rng.integers(2, 40_000, 700)
    parts = [x for _ in range(60) for x in (passage, rng.integers(2, 900, 300), [grammar_tokens.END_ID])]
    ids = np.concatenate(parts).astype(np.uint32)
    symbols, rules, base = grammar_tokens.compress(ids)
    keys = (symbols[:-1].astype(np.uint64) << np.uint64(32)) | symbols[1:]
    n = np.unique(keys[symbols[:-1] != grammar_tokens.END_ID], return_counts=True)[1]
    assert n.max() < grammar_tokens.LEAST_COUNT
    lengths = grammar_tokens.expansion_lengths(rules, base)
    assert lengths.max() > 64
    assert (grammar_tokens.expand(symbols, rules, lengths, base) == ids).all()
