import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from faultline.llm import curriculum, grammar_tokens

FILE = public_tokenizers.path("word_bpe_49k.json")


def test_grammar_round_trip():
    rng = np.random.default_rng(3)
    words = [rng.integers(2, 500, rng.integers(1, 6)) for _ in range(40)]
    docs = [
        np.r_[np.concatenate([words[i] for i in rng.integers(0, 40, n)]), 1].astype(np.uint32)
        for n in rng.integers(1, 400, 30)
    ]
    ids = np.concatenate(docs)
    data = grammar_tokens.pack(ids, [len(d) for d in docs])
    block = grammar_tokens.Block(data)
    assert len(block.rules) and len(data) < 4 * len(ids)
    assert (block.all_ids() == ids).all()
    for i, d in enumerate(docs):
        assert (block.document(i) == d).all()
    assert not (block.rules[:, 0] == grammar_tokens.END_ID).any()


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(5)
    ids = rng.zipf(1.3, 60_000).clip(2, 4000).astype(np.uint32)
    ids[rng.integers(0, len(ids), 300)] = 1
    ids = np.r_[ids, np.tile(np.array([9, 9, 9, 8], np.uint32), 500), 1].astype(np.uint32)
    symbols, rules, base = grammar_tokens.compress(ids)
    lengths = grammar_tokens.expansion_lengths(rules, base)
    assert (grammar_tokens.expand(symbols, rules, lengths, base) == ids).all()
    # pairs of equal symbols overlap, and none goes on behind the end of a document
    pairs, n = np.unique(np.stack([symbols[:-1], symbols[1:]], 1), axis=0, return_counts=True)
    last = [grammar_tokens.expand(pairs[i, :1], rules, lengths, base)[-1] for i in range(len(pairs))]
    free = (np.array(last) != 1) & (pairs[:, 0] != pairs[:, 1])
    assert n[free].max() < grammar_tokens.LEAST_COUNT


def test_a_document_needs_only_its_own_rules():
    docs = [[5, 6, 5, 6, 7, 1]] * 40 + [[8, 9, 8, 9, 1]] * 40
    ids = np.array([x for d in docs for x in d], np.uint32)
    block = grammar_tokens.Block(grammar_tokens.pack(ids, [len(d) for d in docs]))
    wanted = set(block.symbols[block.first[0] : block.first[1]].tolist())
    todo = list(wanted)
    while todo:
        x = todo.pop()
        if x >= block.base:
            todo += set(block.rules[x - block.base].tolist()) - wanted
            wanted |= set(block.rules[x - block.base].tolist())
    spoilt = block.rules.copy()
    for r in range(len(spoilt)):
        if r + block.base not in wanted:
            spoilt[r] = 1 << 30
    assert [block.document(i).tolist() for i in range(len(docs))] == docs
    block.rules = spoilt
    assert block.document(0).tolist() == docs[0]


def test_added_tokens_keep_their_case():
    tokenizer = Tokenizer.from_file(FILE)
    words = grammar_tokens.word_ids(FILE)
    for token in ("<|endoftext|>", "<|startoftext|>"):
        for shown in (token, token.upper(), token.title(), "A" + token, "B" + token.upper() + "x,"):
            words.learn({shown.encode()})
            expected = tokenizer.encode(shown, add_special_tokens=False).ids
            assert np.frombuffer(words[shown.encode()], "<u4").tolist() == expected


def test_learning_words_does_not_go_through_the_whole_table():
    class Table(grammar_tokens.WordIds):
        def __iter__(self):
            raise AssertionError("went through the table")

    asked = []

    def encode(words):
        asked.extend(words)
        return [w.encode() for w in words]

    words = Table(encode)
    words.learn({b"the", b"The,", b"x1"})
    words.learn({b"THE", b"X1", b"the.", b"new"})
    assert sorted(asked) == [",", ".", "new", "the", "x1"]
    assert words[b"THE"] == b"the" and words[b"X1"] == b"x1" and words[b"the."] == b"the."


def test_words_of_letters_have_the_ids_of_the_tokenizer():
    tokenizer = Tokenizer.from_file(FILE)
    words = grammar_tokens.word_ids(FILE)
    letters = [chr(c) for c in range(256) if chr(c).isalpha()]
    mixed = ["".join(letters[i : i + 7]) for i in range(0, len(letters), 3)]
    shown = [*letters, *mixed, "THE", "Straße!", "l'été", "aª", "µm", "don't", "x²", "Ärger's,"]
    # one call for all, as in a block of documents
    words.learn({w.encode() for w in shown})
    for word in shown:
        expected = tokenizer.encode(word, add_special_tokens=False).ids
        assert np.frombuffer(words[word.encode()], "<u4").tolist() == expected, word
    plain = sorted({w.lower() for w in (*letters, *mixed) if w.lower() == w})
    joined = b"".join(words.encode_letters(plain))
    assert np.frombuffer(joined, "<u4").tolist() == tokenizer.encode(
        " ".join(plain), add_special_tokens=False
    ).ids


@pytest.mark.parametrize("ids", [[], [1], [5, 5, 5, 5, 1], [7] * 500 + [1]])
def test_grammar_edges(ids):
    ids = np.array(ids, np.uint32)
    block = grammar_tokens.Block(grammar_tokens.pack(ids, [len(ids)]))
    assert (block.all_ids() == ids).all()


def test_token_files_match_the_tokenizer(spark, odd_docs):
    tokenizer = Tokenizer.from_file(FILE)
    extra = spark.createDataFrame(
        [(20, "A\x1cB don't É, é. <|endoftext|>x <|ENDOFTEXT|> <|EndOfText|> İ Σ ﬁ 12,5  y"), (21, "THE the, the. The!")],
        "doc_id long, text string",
    )
    docs = odd_docs.select("doc_id", "text").union(extra)
    found = grammar_tokens.token_ids(docs, FILE).orderBy("start").collect()
    rows = sorted(
        docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or "")
    )
    start = 0
    assert len(found) == len(rows)
    for got, row in zip(found, rows, strict=True):
        ids = tokenizer.encode(row.text or "", add_special_tokens=False).ids + [1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(got) == (row.doc_id, start, len(ids), crc)
        start += len(ids)


def test_no_documents(spark, no_docs):
    assert grammar_tokens.token_ids(no_docs, FILE).count() == 0
    assert curriculum.place(no_docs).count() == 0


def filled(sizes):
    """Targets by repeated sharing, sources in order."""
    weights = [i % 3 + 1 for i in range(len(sizes))]
    target, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(sum(sizes))
    while left > 1e-9 and open_:
        whole = sum(weights[i] for i in open_)
        share = {i: left * weights[i] / whole for i in open_}
        left = 0.0
        for i, x in share.items():
            target[i] += x
            if target[i] >= 3 * sizes[i]:
                left += target[i] - 3 * sizes[i]
                target[i] = 3.0 * sizes[i]
                open_.discard(i)
    return target


@pytest.mark.parametrize("sizes", [[10, 20, 30], [1, 1, 1000], [0, 5, 1, 700], [7], [3, 0, 2, 900, 1]])
def test_source_targets(spark, sizes):
    frame = spark.createDataFrame(
        [(None if i == len(sizes) - 1 else f"s{i}", n) for i, n in enumerate(sizes)],
        "source string, source_size long",
    )
    rows = curriculum.source_targets(frame).collect()
    got = [r.target for r in sorted(rows, key=lambda r: (r.source is None, r.source or ""))]
    assert got == pytest.approx(filled(sizes))


def test_mix_takes_the_targets(spark, odd_docs):
    rows = curriculum.place(odd_docs).collect()
    assert len(rows) == 11
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        by.setdefault(r.source, [0, r.target])[0] += r.taken
    for taken, target in by.values():
        assert abs(taken - target) <= 1
    assert sorted(map(str, rows)) == sorted(map(str, curriculum.place(odd_docs.repartition(5)).collect()))
    copies = curriculum.in_training_order(curriculum.place(odd_docs)).collect()
    positions = [c.position for c in copies]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] <= 1


def test_mixed_documents(odd_docs):
    out = curriculum.mix(odd_docs)
    assert out.columns == odd_docs.columns
    total = sum(r.taken for r in curriculum.place(odd_docs).collect())
    assert sum(len(r.text.split()) for r in out.collect()) == total
