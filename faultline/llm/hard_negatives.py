"""Hard negatives by a secondary-sort shuffle of scored pairs.

A pair's key is (anchor, descending score, positive before negative, id).
Pairs are dealt to partitions by anchor and sorted within them, so one
forward pass sees each anchor's rows best first: a positive opens a window
that reaches down to a share of its score, and each negative behind it goes to the open
windows until they are full. The pass holds a few open windows, never an anchor's rows.

The scores come from blocks of anchors of bounded size, each broadcast to one
scan of all rows. A scan only sends on what may be among the first rows of an
anchor or of one of its windows within its own task, so a task sends a fixed
number of rows per anchor, whatever shares a label, a vector or a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import materialize, ship

ship(__name__)

POSITIVES = 5
NEGATIVES = 5
#: A negative's score is at least this share (in per cent) of its positive's.
PERCENT = 80
SCALE = 256

#: Bytes of anchor vectors in one pass, and scores computed at once.
BLOCK_BYTES = 8 << 20
TILE = 1 << 21
#: Pairs a task gathers before it keeps only the first of them again.
GATHER = 1 << 20

PAIR = "anchor_id long, score long, vec_id long"


# -- within a task ----------------------------------------------------------


def products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Integer inner products, (anchors, rows); doubles where those are exact."""
    if not rows.size or not anchors.size:
        return np.zeros((len(anchors), len(rows)), np.int64)
    bound = float(np.abs(rows).max()) * float(np.abs(anchors).max()) * rows.shape[1]
    if bound < 2**53:
        return anchors.astype(np.float64) @ rows.astype(np.float64).T
    return anchors @ rows.T


def best_per_line(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Marks the k highest allowed scores of each line; the first columns win ties."""
    if scores.shape[1] <= k:
        return allowed
    least = -np.inf if scores.dtype.kind == "f" else np.iinfo(scores.dtype).min
    held = np.where(allowed, scores, least)
    edge = np.partition(held, -k, axis=1)[:, -k][:, None]
    above, level = held > edge, (held == edge) & allowed
    left = k - above.sum(axis=1, keepdims=True)
    return above | (level & (np.cumsum(level, axis=1) <= left))


def in_order(pairs: np.ndarray) -> np.ndarray:
    """Pairs (anchor number, score, id) by anchor, falling score, id."""
    return pairs[:, np.lexsort((pairs[2], -pairs[1], pairs[0]))]


def first_of_anchors(pairs: np.ndarray, k: int) -> np.ndarray:
    """The first k pairs of each anchor."""
    pairs = in_order(pairs)
    starts = np.flatnonzero(np.r_[True, pairs[0, 1:] != pairs[0, :-1]][: pairs.shape[1]])
    place = np.arange(pairs.shape[1]) - np.repeat(starts, np.diff(np.r_[starts, pairs.shape[1]]))
    return pairs[:, place < k]


def first_of_windows(pairs: np.ndarray, tops: list[np.ndarray], k: int) -> np.ndarray:
    """Of each anchor the pairs that are among the first k below one of its ``tops``."""
    pairs = in_order(pairs)
    keep = np.zeros(pairs.shape[1], bool)
    who, starts = np.unique(pairs[0], return_index=True)
    ends = np.r_[starts[1:], pairs.shape[1]]
    for a, s, e in zip(who.tolist(), starts.tolist(), ends.tolist(), strict=True):
        # falling scores: a window's pairs are the k from its first one on
        for at in np.searchsorted(-pairs[1, s:e], -tops[a], "left"):
            keep[s + at : min(e, s + at + k)] = True
    return pairs[:, keep]


def floor_of(score: np.ndarray | int, percent: int):
    """The least integer score that is ``percent`` per cent of ``score`` or more."""
    return -((-percent * score) // 100)


class Block:
    """The anchors of one pass, vectors of one width as one matrix."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values("anchor_id", ignore_index=True)
        self.ids = rows["anchor_id"].to_numpy(np.int64)
        self.labels = rows["label"].to_numpy(np.int64)
        widths = rows["x"].map(len).to_numpy(np.int64)
        self.parts = {}
        for w in np.unique(widths).tolist():
            which = np.flatnonzero(widths == w)
            self.parts[w] = (which, np.stack([np.asarray(x, np.int64) for x in rows["x"].iloc[which]]))
        self.tops: list[np.ndarray] = [np.zeros(0, np.int64)] * len(rows)

    def with_tops(self, positives: pd.DataFrame) -> Block:
        """With the distinct scores of each anchor's positives, falling."""
        at = np.searchsorted(self.ids, positives["anchor_id"].to_numpy(np.int64))
        scores = positives["score"].to_numpy(np.int64)
        by = np.argsort(at, kind="stable")
        at, scores = at[by], scores[by]
        for a in np.unique(at).tolist():
            s, e = np.searchsorted(at, [a, a + 1])
            self.tops[a] = -np.unique(-scores[s:e])
        return self

    def same_label(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, k: int) -> Iterator:
        """Pairs that may be among the first k other rows of an anchor's label."""
        which, vectors = self.parts.get(x.shape[1], (np.zeros(0, np.int64), None))
        for label in np.unique(labels):
            mine, rows = which[self.labels[which] == label], np.flatnonzero(labels == label)
            at = np.searchsorted(which, mine)
            step = max(1, TILE // len(rows))
            for i in range(0, len(mine), step):
                a = mine[i : i + step]
                scores = products(x[rows], vectors[at[i : i + step]])
                other = ids[rows][None, :] != self.ids[a][:, None]
                line, column = np.nonzero(best_per_line(scores, other, k))
                yield np.stack([a[line], scores[line, column].astype(np.int64), ids[rows[column]]])

    def other_label(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, percent: int) -> Iterator:
        """Pairs of different labels within the reach of an anchor's windows."""
        which, vectors = self.parts.get(x.shape[1], (np.zeros(0, np.int64), None))
        has = np.array([len(self.tops[a]) > 0 for a in which.tolist()], bool)
        which, vectors = which[has], vectors[has] if vectors is not None else vectors
        step = max(1, TILE // len(ids))
        for i in range(0, len(which), step):
            a = which[i : i + step]
            scores = products(x, vectors[i : i + step])
            high = np.array([self.tops[j][0] for j in a.tolist()])[:, None]
            low = np.array([floor_of(int(self.tops[j][-1]), percent) for j in a.tolist()])[:, None]
            near = (scores <= high) & (scores >= low)
            near &= labels[None, :] != self.labels[a][:, None]
            line, column = np.nonzero(near)
            yield np.stack([a[line], scores[line, column].astype(np.int64), ids[column]])


def batches(parts: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors) by rising id, rows of one width at a time."""
    for part in parts:
        part = part.sort_values("vec_id", kind="stable", ignore_index=True)
        widths = part["x"].map(len)
        for w in widths.unique():
            rows = part[widths == w]
            x = np.stack([np.asarray(v, np.int64) for v in rows["x"]])
            yield rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), x


def kept(found: Iterator[np.ndarray], cut) -> Iterator[np.ndarray]:
    """All pairs of a task, cut down whenever many have gathered, and at the end."""
    held, total = [], 0
    for pairs in found:
        held.append(pairs)
        total += pairs.shape[1]
        if total >= GATHER:
            held = [cut(np.concatenate(held, axis=1))]
            # after a cut the rest must double before it is cut again
            total = min(held[0].shape[1], GATHER // 2)
    if held:
        yield cut(np.concatenate(held, axis=1))


def windows(rows: Iterator[tuple], k: int, percent: int) -> Iterator[tuple]:
    """Negatives of each positive, from rows sorted by the pair key.

    ``rows`` are (anchor, score, is negative, id); yields (anchor, positive,
    rank, negative, positive score, negative score).
    """
    anchor, opened = None, []
    for a, score, negative, vec_id in rows:
        if a != anchor:
            anchor, opened = a, []
        if not negative:
            # id, score, least score, negatives so far
            opened.append([vec_id, score, floor_of(score, percent), 0])
            continue
        full = False
        for window in opened:
            if score >= window[2]:
                window[3] += 1
                yield anchor, window[0], window[3], vec_id, window[1], score
            full |= window[3] >= k or score < window[2]
        if full:
            opened = [w for w in opened if w[3] < k and score >= w[2]]


# -- jobs -------------------------------------------------------------------


def usable(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(vec_id, label, x): rows that take part, each once."""
    x = F.col(f"`{embedding}`").cast("array<double>")
    # products of two such vectors, times 100, stay below 2^63
    most = F.floor(F.sqrt(F.lit(float(2**56)) / F.greatest(F.size(x), F.lit(1))))
    scaled = F.transform(x, lambda v: F.floor(v * F.lit(float(SCALE))))
    finite = F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) * F.lit(float(SCALE)) < most)
    )
    named = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
        F.col(f"`{label}`").cast("long").alias("label"),
        F.when(finite & (F.size(x) > 0), scaled).alias("x"),
    )
    return named.where("vec_id is not null and label is not null and x is not null").distinct()


def mine(
    vectors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percent: int = PERCENT,
    anchor_every: int = 100,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    relabel: F.Column | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor is a row whose id is divisible by ``anchor_every``; its positives
    are the first ``positives`` other rows of its label, by falling score and
    rising id. For each, the first ``negatives`` rows of another label whose score is at most the
    positive's and at least ``percent`` per cent of it, in the same order.
    ``relabel`` is an expression over (vec_id, label) that replaces the label.

    Rows with a null id, a null label, a null or empty vector, or a null,
    NaN or infinite component take no part, nor do components of 2^28 /
    sqrt(length) / 256 and beyond, whose products leave 64 bits. Rows alike in id, label and vector
    are one row; an id with several is a candidate with each, and as an anchor it asks
    with the smallest (label, vector). Vectors of another length than the
    anchor's are not compared with it. Ties of score go to the smaller id. An
    anchor without positives, a positive without negatives and an empty table
    give no row; other columns do not matter, whatever their names.
    """
    rows = usable(vectors, vec_id, embedding, label)
    if relabel is not None:
        rows = rows.withColumn("label", relabel.cast("long")).distinct()
    rows = materialize(rows, "negatives-rows")
    least = F.min(F.struct("label", "x"))
    anchors = (
        rows.where(F.col("vec_id") % anchor_every == 0)
        .groupBy(F.col("vec_id").alias("anchor_id"))
        .agg(least["label"].alias("label"), least["x"].alias("x"))
    )
    anchors = materialize(anchors, "negatives-anchors")
    size = anchors.agg(F.sum(F.size("x") * 8 + 16)).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    spark = vectors.sparkSession
    stream = None
    for number in range(n_blocks):
        of_block = F.pmod(F.xxhash64("anchor_id"), F.lit(n_blocks)) == number
        # about block_bytes, whatever the number of anchors
        block = Block(anchors.where(of_block).toPandas())
        firsts = materialize(first_positives(rows, block, positives), "negatives-positives")
        # at most ``positives`` rows for each anchor of the block
        block.with_tops(firsts.select("anchor_id", "score").toPandas())
        held = spark.sparkContext.broadcast(block)
        found = rows.mapInPandas(negative_pairs(held, negatives, percent), PAIR)
        pairs = firsts.withColumn("negative", F.lit(False)).unionByName(
            found.withColumn("negative", F.lit(True))
        )
        stream = pairs if stream is None else stream.unionByName(pairs)

    def emit(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = windows(pair_rows(parts), negatives, percent)
        yield from framed(found, ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return by_key(stream).mapInPandas(
        emit,
        "anchor_id long, positive_id long, rank int, negative_id long,"
        " positive_score long, negative_score long",
    )


def by_key(pairs: DataFrame) -> DataFrame:
    """Pairs dealt by anchor and sorted by (anchor, falling score, kind, id)."""
    return pairs.repartition("anchor_id").sortWithinPartitions(
        "anchor_id", F.desc("score"), "negative", "vec_id"
    )


def pair_rows(parts: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    for part in parts:
        columns = [part[c].tolist() for c in ("anchor_id", "score", "negative", "vec_id")]
        yield from zip(*columns, strict=True)


def framed(rows: Iterator[tuple], names: list[str], size: int = 10_000) -> Iterator[pd.DataFrame]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pd.DataFrame(held, columns=names)
            held = []
    if held:
        yield pd.DataFrame(held, columns=names)


def pair_frame(block: Block, pairs: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"anchor_id": block.ids[pairs[0]], "score": pairs[1], "vec_id": pairs[2]})


def first_positives(rows: DataFrame, block: Block, k: int) -> DataFrame:
    """(anchor_id, score, vec_id): the first k other rows of each anchor's label."""
    held = rows.sparkSession.sparkContext.broadcast(block)

    def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = held.value
        found = (p for b in batches(parts) for p in block.same_label(*b, k))
        for pairs in kept(found, lambda p: first_of_anchors(p, k)):
            yield pair_frame(block, pairs)

    def first(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def cut() -> Iterator[tuple]:
            anchor, n = None, 0
            for a, score, _, vec_id in pair_rows(parts):
                anchor, n = a, n + 1 if a == anchor else 1
                if n <= k:
                    yield a, score, vec_id

        yield from framed(cut(), ["anchor_id", "score", "vec_id"])

    scored = rows.mapInPandas(score, PAIR).withColumn("negative", F.lit(False))
    return by_key(scored).mapInPandas(first, PAIR)


def negative_pairs(held, k: int, percent: int):
    def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = held.value
        found = (p for b in batches(parts) for p in block.other_label(*b, percent))
        for pairs in kept(found, lambda p: first_of_windows(p, block.tops, k)):
            yield pair_frame(block, pairs)

    return score
