"""Language by cross-parsing entropy.

Each language has the suffix automaton of a labelled text. A text is parsed
against it: the longest match from here is a phrase, the next phrase starts
behind it. The fewer phrases a text needs, the closer it is to the language.
With n characters behind an automaton a phrase costs log2(n) bits, so

    normalised phrases = phrases * log2(n) / characters

compares languages with labelled texts of any length; the smallest wins.

Phrases end with their word: parsing starts anew at white space, so that the
parse of a word can be remembered. Words are lower-cased and closed by a
blank, in the labelled texts too.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log2

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from faultline.llm.common import columns_of, materialize, ship

ship(__name__)

UNKNOWN = "und"
#: Bounds of the labelled sample: rows and distinct words of each language.
SAMPLE_ROWS = 400
SAMPLE_WORDS = 8000
#: Folds held out: crc32 of the id modulo FOLDS is 0.
FOLDS = 5
CACHE_WORDS = 300_000
#: Bits for each language in a packed sum of phrases.
FIELD = 48


def automaton(words: list[str]) -> list[dict[str, int]]:
    """Transitions of the suffix automaton of ``words``, each closed by a blank.

    Every path from state 0 spells a substring of a closed word.
    """
    moves: list[dict[str, int]] = [{}]
    link, length = [-1], [0]
    for word in words:
        last = 0
        for c in word + " ":
            q = moves[last].get(c)
            if q is not None and length[q] == length[last] + 1:
                last = q
                continue
            state = -1
            if q is None:
                state = len(moves)
                moves.append({})
                length.append(length[last] + 1)
                link.append(0)
            p = last
            while p >= 0 and c not in moves[p]:
                moves[p][c] = state
                p = link[p]
            if p >= 0:
                q = moves[p][c]
                if length[p] + 1 == length[q]:
                    target = q
                else:
                    target = len(moves)
                    moves.append(dict(moves[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    link[q] = target
                    while p >= 0 and moves[p].get(c) == q:
                        moves[p][c] = target
                        p = link[p]
                if state >= 0:
                    link[state] = target
                else:
                    state = target
            last = state
    return moves


def phrases(word: str, moves: list[dict[str, int]]) -> int:
    """Longest matches that spell ``word`` and its blank; unknown characters count one each."""
    n = state = 0
    for c in word + " ":
        to = moves[state].get(c)
        if to is None:
            n += state > 0
            to = moves[0].get(c, 0)
            n += to == 0
        state = to
    return n + (state > 0)


class Phrases(dict):
    """Phrases of a word in all languages, one field of bits for each."""

    def __init__(self, automata: list[list[dict[str, int]]]):
        super().__init__()
        self.automata = automata

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        packed = 0
        for i, moves in enumerate(self.automata):
            packed |= phrases(word, moves) << (FIELD * i)
        self[word] = packed
        return packed


def classify(text: str | None, langs: list[str], costs: list[float], known: Phrases) -> tuple[str, float]:
    """(language, score); score is the runner-up's share of the two best totals."""
    words = (text or "").lower().split()
    if not langs or not any(c.isalpha() for w in words for c in w):
        return UNKNOWN, 0.0
    packed = sum(map(known.__getitem__, words))
    mask = (1 << FIELD) - 1
    totals = sorted(
        (cost * (packed >> (FIELD * i) & mask), lang)
        for i, (lang, cost) in enumerate(zip(langs, costs, strict=True))
    )
    if len(totals) == 1:
        return totals[0][1], 1.0
    return totals[0][1], totals[1][0] / (totals[0][0] + totals[1][0])


def labelled_words(
    docs: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_words: int = SAMPLE_WORDS
) -> dict[str, list[str]]:
    """The labelled text of each language: its sample's most frequent words.

    The sample has, of each language, the ``sample_rows`` labelled documents
    outside the held-out fold whose ids hash lowest. At most
    ``sample_words`` words of a language come to the driver.
    """
    rank = F.row_number().over(W.partitionBy("lang").orderBy("_hash", "doc_id"))
    ids = (
        docs.where("lang is not null and text is not null")
        .select(F.col("doc_id").cast("long"), F.col("lang").cast("string"))
        .where(F.coalesce(fold(), F.lit(1)) != 0)
        .withColumn("_hash", F.xxhash64("doc_id"))
        .withColumn("_rank", rank)
        .where(F.col("_rank") <= sample_rows)
        .select("doc_id", "lang")
        .distinct()
    )
    chosen = materialize(ids, "lang-sample")
    keyed = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), "text")
    words = (
        keyed.join(chosen, ["doc_id", "lang"])
        .select("lang", F.explode(F.split(F.lower("text"), r"\s+")).alias("word"))
        .where("word <> ''")
        .groupBy("lang", "word")
        .count()
    )
    order = W.partitionBy("lang").orderBy(F.col("count").desc(), "word")
    top = words.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= sample_words)
    out: dict[str, list[str]] = {}
    for row in top.orderBy("lang", "_n").collect():
        out.setdefault(row["lang"], []).append(row["word"])
    return out


def fold() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, held_out, lang_pred, score of every row.

    Text without a letter, null or empty, is ``und`` with score 0, as is every
    text when there is no labelled row. A null doc_id is not held out and is never in the
    sample. Equal totals go to the first language by name. Repeated rows get
    equal answers; an empty table gives no row; other columns are not read.
    """
    spark = docs.sparkSession
    learned = labelled_words(docs)
    langs = sorted(learned)
    # a few MB for each language, whatever the corpus: the sample is bounded
    model = spark.sparkContext.broadcast([automaton(learned[x]) for x in langs])
    costs = [log2(2 + sum(len(w) + 1 for w in learned[x])) for x in langs]

    def predict(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Phrases(model.value)
        for part in parts:
            found = [classify(t, langs, costs, known) for t in part.pop("text")]
            part["lang_pred"] = [x for x, _ in found]
            part["score"] = [x for _, x in found]
            yield part

    read = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )
    found = read.mapInPandas(
        predict, "doc_id string, text_hash long, lang_pred string, score double"
    )
    return found.select(
        F.col("doc_id").cast("long"),
        "text_hash",
        F.coalesce(fold() == 0, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )


def keep_known(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents whose language is ``und``.

    The answer is joined back by (doc_id, text hash), equal for equal rows.
    """
    rejected = (
        identify(docs)
        .where(F.col("lang_pred") == UNKNOWN)
        .select(F.struct("doc_id", "text_hash").alias("_key"))
        .distinct()
    )
    rows = docs.select(
        F.struct(*columns_of(docs)).alias("_row"),
        F.struct(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        ).alias("_key"),
    )
    left = rows.join(materialize(rejected, "lang-rejected"), "_key", "left_anti")
    return left.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
