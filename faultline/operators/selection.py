"""The row at a place of a global order, found by counting instead of sorting.

"The first k of all rows" needs one thing about the whole table: the k-th row.
Its score is bracketed by the quantiles of one scan and counted exactly in the
next, which also takes the quantiles inside the bracket; each scan reads two
columns and leaves about one row in ``GRID`` as candidates. Rows that tie with it are cut by the key
in the same way. Every row is then compared with the cut on its own: no row
moves, and wide rows are never sorted.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType, StringType

from faultline.functions.numeric import nan_to_null

#: Quantiles of one scan and their accuracy; candidates few enough to list by value.
GRID = 500
ACCURACY = 20 * GRID
FEW = 10_000


@dataclass(frozen=True)
class Place:
    """A value, the rows below it and the rows that share it."""

    value: Any
    below: int
    equal: int


@dataclass(frozen=True)
class Cut:
    """The last selected score, and which of the rows that share it are selected:
    all of them, or those with a null key and those with a key up to ``key``."""

    score: float
    all_equal: bool
    key: Any = None

    def selects(self, score: Column, key: Column) -> Column:
        """True for selected rows, false for all others."""
        level = score == F.lit(self.score)
        if not self.all_equal:
            within = key.isNull()
            level &= within if self.key is None else within | (key <= F.lit(self.key))
        return F.coalesce((score > F.lit(self.score)) | level, F.lit(False))


def nth_value(rows: DataFrame, name: str, n: int) -> Place | None:
    """The n-th smallest value (from 1) of a column without nulls and NaN; None
    if there are fewer rows. For numbers, dates and times."""
    value = F.col(name)
    whole = isinstance(rows.schema[name].dataType, IntegralType)
    active, below, base = rows, 0, 0
    guess: tuple | None = None
    while True:
        low, high = guess or (None, None)
        inside = F.lit(True) if guess is None else value.between(F.lit(low), F.lit(high))
        held = F.when(inside, value)
        # quantiles are doubles inside: whole numbers count from the bracket's end
        offset = held - F.lit(base) if whole else held
        seen = active.agg(
            F.count_if(value < F.lit(low) if guess else F.lit(False)).alias("under"),
            F.count(held).alias("rows"),
            F.min(held).alias("low"),
            F.max(held).alias("high"),
            F.percentile_approx(offset, [i / GRID for i in range(GRID + 1)], ACCURACY).alias("grid"),
        ).first()
        if n <= below + seen["under"]:
            active, guess = active.filter(value < F.lit(low)), None
            continue
        if n > below + seen["under"] + seen["rows"]:
            if guess is None:
                return None
            below += seen["under"] + seen["rows"]
            active, guess = active.filter(value > F.lit(high)), None
            continue
        below += seen["under"]
        low, high, size = seen["low"], seen["high"], seen["rows"]
        active = active.filter(value.between(F.lit(low), F.lit(high)))
        if low == high:
            return Place(low, below, size)
        if size <= FEW:
            return listed(active, name, n, below)
        # neighbours of the wanted quantile, whose exact counts the next scan takes
        grid = [base + v for v in seen["grid"]] if whole else seen["grid"]
        at = (n - below) * GRID // size
        guess = (max(grid[max(at - 1, 0)], low), min(grid[min(at + 2, GRID)], high))
        if guess == (low, high):
            # one value holds most rows: count it alone and leave it on one side
            middle = min(max(grid[at], low), high)
            guess = (middle, middle)
        if whole and high - low < 2**63:
            base = low


def nth_text(rows: DataFrame, name: str, n: int) -> Place | None:
    """``nth_value`` of a text column: one more character in each scan."""
    active, below, prefix = rows, 0, ""
    while True:
        size = len(prefix) + 1
        # a row for each character that follows the prefix, as far as any does
        counts = active.groupBy(F.substring(name, 1, size).alias("value")).agg(F.count("*").alias("rows"))
        found = step(counts.orderBy("value").collect(), n, below)
        if found is None:
            return None
        if len(found.value) < size:
            # the whole text: nothing follows it
            return found
        active, below, prefix = active.filter(F.col(name).startswith(F.lit(found.value))), found.below, found.value
        if found.equal <= FEW:
            return listed(active, name, n, below)


def listed(rows: DataFrame, name: str, n: int, below: int) -> Place | None:
    """``nth_value`` of rows that are few."""
    counts = rows.groupBy(F.col(name).alias("value")).agg(F.count("*").alias("rows"))
    return step(counts.orderBy("value").collect(), n, below)


def step(counts: list, n: int, below: int) -> Place | None:
    for row in counts:
        if n <= below + row["rows"]:
            return Place(row["value"], below, row["rows"])
        below += row["rows"]
    return None


def nth(rows: DataFrame, name: str) -> Callable[[int], Place | None]:
    finder = nth_text if isinstance(rows.schema[name].dataType, StringType) else nth_value
    return lambda n: finder(rows, name, n)


def cut_of(df: DataFrame, score: str, key: str, k: int) -> Cut | None:
    """Cut behind the first k rows by falling score, ties by ascending key.

    Rows without a score are never selected. None means that no more than k
    rows have one: all of them are selected. Rows that share score and key
    with the last selected row cannot be told apart and are all selected; a
    unique key gives exactly k.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    narrow = df.select(nan_to_null(score).cast("double").alias("_score"), F.col(key).alias("_key"))
    narrow = narrow.filter("_score is not null")
    scored = narrow.count()
    if scored <= k:
        return None
    last = nth_value(narrow, "_score", scored - k + 1)
    left = k - (scored - last.below - last.equal)
    if left == last.equal:
        return Cut(last.value, True)
    ties = narrow.filter(F.col("_score") == F.lit(last.value)).select("_key")
    left -= ties.filter("_key is null").count()
    if left <= 0:
        return Cut(last.value, False)
    return Cut(last.value, False, nth(ties.filter("_key is not null"), "_key")(left).value)


def selected(df: DataFrame, score: str, key: str, k: int, head: int) -> Column:
    """Condition that is true for the first k rows of ``df`` (see ``cut_of``).

    Up to ``head`` rows the cut is a merge of the tasks' first rows, which stays in the
    plan; beyond it, the counted one.
    """
    value = nan_to_null(score)
    if k > head:
        cut = cut_of(df, score, key, k)
        return value.isNotNull() if cut is None else cut.selects(value, F.col(key))
    place = F.struct((-value.cast("double")).alias("fall"), F.col(key).alias("key"))
    first = df.filter(value.isNotNull()).select(place.alias("place")).orderBy("place").limit(k)
    last = first.agg(F.max("place")).scalar()
    return F.coalesce(value.isNotNull() & (place <= last), F.lit(False))
