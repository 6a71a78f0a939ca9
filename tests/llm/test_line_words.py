"""Words of a line, counted by bytes where that suffices, against a count in Python."""

import random

import regex
from pyspark.sql import functions as F

from faultline.llm import line_runs

PIECES = [
    "a", "bc", "é", "пример", " ", "  ", "\t", "\r", "\x0b", "\f", "\x1c", " ", "　",
    "漢字仮名", "カナ", "ไทย", "ລາວ", "ខ្មែរ", "မြန်မာ", "𠀀𠀁",
]
UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")


def counted(line: str) -> int:
    words = len(regex.findall(r"[^\x20\x09-\x0D]+", line))
    return max(words, len(UNSPACED.findall(line)) // 2) if words else 0


def test_words_of_lines_equal_a_count_in_python(spark):
    rng = random.Random(7)
    lines = {"", "one", "one two", "one  two", "a\tb c", "é è ê", "ก" * 9, "漢" * 1000, "a " * 5000 + "b"}
    lines |= {"".join(rng.choices(PIECES, k=rng.randint(0, 60))).strip(line_runs.BLANKS) for _ in range(2000)}
    df = spark.createDataFrame([(x,) for x in sorted(lines)], "line string")
    got = {r["line"]: r["n"] for r in df.select("line", line_runs.words_in(F.col("line")).alias("n")).collect()}
    assert got == {x: counted(x) for x in lines}
    assert any(n > len(x.split()) for x, n in got.items())


def test_documents_without_words_have_no_lines(spark):
    rows = [(1, None), (2, ""), (3, " \n\t\n"), (None, None), (4, "x y\n\nz")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc"]["doc_id"], [(x["pos"], x["words"]) for x in r["lines"]]) for r in line_runs.sequences(df).collect()]
    assert got == [(4, [(0, 2), (2, 1)])]
