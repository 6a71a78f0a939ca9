"""Repeated runs of lines: suffixes of line sequences by prefix doubling.

Each document is a sequence of line ids. Doubling sorts the suffixes by their
first 1, 2, 4, ... lines: round k ranks the pairs (rank of the first half,
rank of the second half) that occur more than once; a suffix whose pair
occurs once shares no longer prefix with any other and drops out. Suffixes of
one rank are an interval of the suffix array with a common prefix of 2^k
lines, and the two overlapping halves (rank_k(i), rank_k(i + l - 2^k)) name
the interval of any common prefix of l lines.

A run is a row of lines with ``min_words`` words or more that occurs before.
Every line of every such run is deleted: all but the first copy of each
maximal repeated run. It is enough to look, for each line, at the shortest
run of that many words that starts with it and the shortest that ends with
it. If a run covers line p, then either its part up to p has enough words, and the
shortest run that ends at p lies inside it, or it has not, and the shortest run
from its first line goes beyond p inside it; and any part of a run that
occurs before occurs before.

So runs of up to ``min_words`` lines have to be told apart (a line that counts
has a word), and doubling ends there. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from faultline.llm.common import WORD, bind, columns_of, materialize, partitions

MIN_WORDS = 10
#: ASCII white space, which parts words and is trimmed from lines.
BLANKS = " \t\n\x0b\f\r"
#: Characters of scripts that part no words by blanks, and how many of them count as a word.
#: All come from U+0E00 on; the range rules out most others before their script is looked up.
UNSPACED = (
    r"[\x{0E00}-\x{10FFFF}&&"
    r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]]"
)
CHARS_PER_WORD = 2
#: Bits that hold the place of a class in its sort partition.
PLACE_BITS = 40


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def spaced_words(line: Column) -> Column:
    """Words between white space of a trimmed line.

    Where nothing but single spaces parts them, their number follows from the
    bytes; other lines are counted by pattern, which takes several times as long.
    """
    uneven = F.contains(line, F.lit("  "))
    for blank in "\t\x0b\f\r":
        uneven = uneven | F.contains(line, F.lit(blank))
    spaces = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
    return (
        F.when(line == "", 0)
        .when(uneven, F.regexp_count(line, F.lit(WORD)))
        .otherwise(spaces + 1)
    )


def words_in(line: Column) -> Column:
    """Words of a trimmed line, or by characters of unspaced scripts, if these give more."""

    def more(words: Column) -> Column:
        unspaced = F.length(line) - F.length(F.regexp_replace(line, f"{UNSPACED}+", ""))
        # such characters have three bytes or more
        some = F.octet_length(line) - F.length(line) >= 2 * CHARS_PER_WORD * (words + 1)
        return F.when(
            some, F.greatest(words, F.floor(unspaced / CHARS_PER_WORD).cast("int"))
        ).otherwise(words)

    return bind(spaced_words(line), more)


def doc_key() -> Column:
    """(doc_id, text hash) as one struct, whose equality holds for nulls too."""
    return F.struct(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
    ).alias("doc")


def sequences(docs: DataFrame) -> DataFrame:
    """doc, lines: array of (pos, a, b, words) of lines with words.

    Rows alike in doc_id and text are one document. A line is known by two
    64-bit hashes of its text less white space at its ends; lines without words take no part, so
    blank lines neither break nor make a run.
    """

    def entries(lines: Column) -> Column:
        return F.filter(
            F.transform(
                lines,
                lambda line, i: bind(
                    F.trim(line, F.lit(BLANKS)),
                    lambda t: F.struct(
                        i.alias("pos"),
                        F.xxhash64(t).alias("a"),
                        F.xxhash64(F.lit(7), t).alias("b"),
                        words_in(t).alias("words"),
                    ),
                ),
            ),
            lambda x: x["words"] > 0,
        )

    return (
        docs.select(
            doc_key(),
            entries(lines_of(F.col("text"))).alias("lines"),
        )
        .groupBy("doc")
        .agg(F.first("lines").alias("lines"))
        # behind the grouping, as a filter before it would compute the lines twice
        .where(F.size("lines") > 0)
    )


def with_windows(seqs: DataFrame, min_words: int) -> DataFrame:
    """One row per line: doc, at, pos, a, b, ahead, back.

    ``at`` counts the lines with words; ``ahead`` is the length of the shortest
    run from the line with ``min_words`` words, ``back`` that of the shortest run
    that ends with it, null where the document has too few.
    """

    def shortest(words: Column) -> Column:
        """Length of the shortest prefix with enough words, null without one."""
        total = F.aggregate(
            words,
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("sum")),
            lambda s, w: F.struct(
                F.when(s["sum"] >= min_words, s["n"]).otherwise(s["n"] + 1).alias("n"),
                F.when(s["sum"] >= min_words, s["sum"]).otherwise(s["sum"] + w).alias("sum"),
            ),
        )
        return bind(total, lambda t: F.when(t["sum"] >= min_words, t["n"]))

    def each(lines: Column) -> Column:
        words = F.transform(lines, lambda x: x["words"])
        return bind(
            words,
            lambda w: F.transform(
                lines,
                lambda x, i: F.struct(
                    i.alias("at"),
                    x["pos"].alias("pos"),
                    x["a"].alias("a"),
                    x["b"].alias("b"),
                    shortest(F.slice(w, i + 1, F.lit(min_words))).alias("ahead"),
                    shortest(
                        F.reverse(
                            F.slice(
                                w,
                                F.greatest(i + 2 - min_words, F.lit(1)),
                                F.least(i + 1, F.lit(min_words)),
                            )
                        )
                    ).alias("back"),
                ),
            ),
        )

    return seqs.select("doc", F.explode(bind(F.col("lines"), each)).alias("_x")).select(
        "doc", "_x.*"
    )


def ranked(classes: DataFrame, key: list[str]) -> DataFrame:
    """(key..., rank): classes numbered in the order of their key.

    Each class is one row. A rank is the sort partition and the place in it,
    so it needs no count over all partitions; the rows are written.
    """
    n = partitions(classes.sparkSession)
    sorted_ = classes.repartitionByRange(n, *key).withColumn("_part", F.spark_partition_id())
    place = F.row_number().over(W.partitionBy("_part").orderBy(*key))
    rank = F.shiftleft(F.col("_part").cast("long"), PLACE_BITS) + place
    return materialize(sorted_.withColumn("rank", rank).select(*key, "rank"), "line-ranks")


def repeated_prefixes(lines: DataFrame, min_words: int) -> DataFrame:
    """(k, doc, at, rank): the suffixes that share their first 2^k lines with others."""
    classes = lines.groupBy("a", "b").count().where("count > 1").select("a", "b")
    level = materialize(
        lines.select("doc", "at", "a", "b")
        .join(ranked(classes, ["a", "b"]), ["a", "b"])
        .select("doc", "at", "rank"),
        "line-level",
    )
    levels, length = level.withColumn("k", F.lit(0)), 1
    while 2 * length <= min_words:
        ahead = W.partitionBy("doc").orderBy("at").rangeBetween(length, length)
        pairs = materialize(
            level.withColumn("next", F.first("rank").over(ahead)).where("next is not null"),
            "line-pairs",
        ).withColumnRenamed("rank", "own")
        classes = pairs.groupBy("own", "next").count().where("count > 1").select("own", "next")
        level = materialize(
            pairs.join(ranked(classes, ["own", "next"]), ["own", "next"]).select(
                "doc", "at", "rank"
            ),
            "line-level",
        )
        length *= 2
        levels = levels.union(level.withColumn("k", F.lit(length.bit_length() - 1)))
    return levels


def later_runs(lines: DataFrame, levels: DataFrame) -> DataFrame:
    """(doc, start, length) of the shortest runs, either way, that occur before."""
    runs = lines.select(
        "doc",
        F.explode(
            F.array(
                F.struct(F.col("at").alias("start"), F.col("ahead").alias("length")),
                F.struct(
                    (F.col("at") - F.col("back") + 1).alias("start"), F.col("back").alias("length")
                ),
            )
        ).alias("_run"),
    ).select("doc", "_run.*")
    halves = runs.where("length is not null").withColumn(
        "k", F.length(F.bin("length")) - 1
    ).withColumn("tail_at", F.col("start") + F.col("length") - F.expr("shiftleft(1, k)"))
    head = levels.select("k", "doc", F.col("at").alias("start"), F.col("rank").alias("head"))
    tail = levels.select("k", "doc", F.col("at").alias("tail_at"), F.col("rank").alias("tail"))
    named = materialize(
        halves.join(head, ["k", "doc", "start"])
        .join(tail, ["k", "doc", "tail_at"])
        .select("doc", "start", "length", "head", "tail"),
        "line-runs",
    )
    where = F.struct("doc", "start")
    interval = ["length", "head", "tail"]
    firsts = materialize(named.groupBy(*interval).agg(F.min(where).alias("first")), "line-firsts")
    return (
        named.join(firsts, interval)
        .where(where > F.col("first"))
        .select("doc", "start", "length")
    )


def deleted_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, gone): sorted numbers of the lines that go, from 0.

    Occurrences are ordered by doc_id (nulls first), text hash and line.
    """
    lines = materialize(with_windows(sequences(docs), min_words), "line-lines")
    covered = later_runs(lines, repeated_prefixes(lines, min_words))
    marks = (
        covered.withColumn(
            "at", F.explode(F.expr("sequence(start, start + length - 1)"))
        )
        .select("doc", "at")
        .distinct()
    )
    gone = lines.select("doc", "at", "pos").join(marks, ["doc", "at"])
    return materialize(
        gone.groupBy("doc").agg(F.sort_array(F.collect_list("pos")).alias("gone")), "line-gone"
    )


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``text`` less its repeated lines, plus n_lines and n_deleted.

    Null text stays null. A text that loses all its lines becomes empty; the
    row stays. Rows alike in doc_id and text count once and share the result.
    ``n_chars``, if there, counts the new text. An empty table stays empty.
    """
    gone = deleted_lines(docs, min_words).toDF("_key", "_gone")
    rows = docs.select(
        F.struct(*columns_of(docs)).alias("_row"), doc_key().alias("_key")
    ).join(gone, "_key", "left")
    text = F.col("_row.text")
    left = bind(
        lines_of(text),
        lambda lines: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone")),
                lambda i: F.get(lines, i),
            ),
            "\n",
        ),
    )
    rows = rows.withColumn("_text", F.when(F.col("_gone").isNull(), text).otherwise(left))
    kept = [
        F.col("_text").alias(c)
        if c == "text"
        else F.length("_text").cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars"
        else F.col("_row")[c].alias(c)
        for c in docs.columns
    ]
    counts = [
        F.when(text.isNull(), 0).otherwise(F.size(lines_of(text))).alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).alias("n_deleted"),
    ]
    # counts of that name in the input give way
    return rows.select(
        *[c for c, n in zip(kept, docs.columns, strict=True) if n not in ("n_lines", "n_deleted")],
        *counts,
    )
