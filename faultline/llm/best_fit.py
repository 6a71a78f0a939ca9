"""Best-fit packing of documents into fixed windows, with conflicts.

A bin holds up to ``capacity`` words. It carries a bitmap of the sources and
one of the duplicate clusters it holds: no two pieces of one cluster share a
bin, nor do more documents of one source than its limit: ``per_source``, or
twice its share of the fewest bins that hold all words, if that is more. Pieces go in
order of size, largest first, each to the tightest bin that is compatible:
bins lie by residual, and the search goes on to the next larger residual
until one fits without conflict.

Shards of about ``shard_rows`` documents, dealt by a hash, are packed apart,
so a task holds a bounded number of narrow rows whatever the sources are.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import WORD, materialize, ship
from faultline.llm.curriculum import n_words

ship(__name__)

CAPACITY = 2048
SHARD_ROWS = 8192
PER_SOURCE = 4


def pack(
    sizes: list[int],
    sources: list[int],
    clusters: list[int],
    capacity: int = CAPACITY,
    per_source: int | list[int] = PER_SOURCE,
) -> list[int]:
    """Bin of each piece, given in the order of packing; equal residuals: oldest bin.

    ``per_source`` is the limit of all sources or of each. A source has as
    many bits in a bin's bitmap, filled from the lowest.
    """
    if isinstance(per_source, int):
        per_source = [per_source] * (max(sources, default=-1) + 1)
    lows = list(accumulate(per_source, initial=0))
    by_residual: dict[int, list[int]] = {}
    residuals: list[int] = []
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    out = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        low = lows[source]
        full = ((1 << per_source[source]) - 1) << low
        mark = 1 << cluster
        chosen = residual = -1
        for at in range(bisect_left(residuals, size), len(residuals)):
            residual = residuals[at]
            for b in by_residual[residual]:
                if not cluster_bits[b] & mark and source_bits[b] & full != full:
                    chosen = b
                    break
            if chosen >= 0:
                held = by_residual[residual]
                held.remove(chosen)
                if not held:
                    del by_residual[residual], residuals[at]
                break
        if chosen < 0:
            chosen, residual = len(source_bits), capacity
            source_bits.append(0)
            cluster_bits.append(0)
        used = (source_bits[chosen] & full) >> low
        source_bits[chosen] |= (used + 1) << low
        cluster_bits[chosen] |= mark
        left = residual - size
        if left:
            if left not in by_residual:
                by_residual[left] = []
                insort(residuals, left)
            insort(by_residual[left], chosen)
        out.append(chosen)
    return out


def source_limits(words: int, counts: list[int], capacity: int, per_source: int) -> list[int]:
    """Pieces of each source that a bin may hold.

    A source of many short pieces would else fill bins with nothing but air:
    at twice its mean in a full packing, half of the bins can hold them all.
    """
    bins = max(1, -(-words // capacity))
    return [max(per_source, -(-2 * n // bins)) for n in counts]


def pieces(sized: DataFrame, capacity: int) -> DataFrame:
    """A row for each ``capacity`` words of a document; an empty one has none."""
    n = F.ceil(F.col("size") / capacity).cast("int")
    return (
        sized.where("size > 0")
        .withColumn("piece", F.explode(F.sequence(F.lit(0), n - 1)))
        .withColumn(
            "words",
            F.least(F.lit(capacity).cast("long"), F.col("size") - F.col("piece") * capacity),
        )
    )


def pack_documents(
    docs: DataFrame,
    capacity: int = CAPACITY,
    per_source: int = PER_SOURCE,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """doc_id, nth, piece, source, words, bin, slot, offset of every piece.

    Sizes are words; a document larger than a bin is cut into whole bins and
    a rest. Documents alike after folding case and white space are one
    duplicate cluster. Null and wordless texts have no piece, a null source is
    a source. Rows that repeat a doc_id are documents of their own, numbered
    by ``nth``. ``bin`` is "shard-number", ``offset`` the words before the
    piece in its bin. An empty table gives no row; other columns are not read.
    """
    narrow = docs.select(
        F.col("doc_id").cast("long"),
        F.col("source").cast("string"),
        n_words(F.col("text")).alias("size"),
        F.md5(
            F.array_join(F.regexp_extract_all(F.lower("text"), F.lit(WORD), 0), " ").cast("binary")
        ).alias("cluster"),
    )
    return place_pieces(materialize(narrow, "pack-sizes"), capacity, per_source, shard_rows)


def place_pieces(
    sized: DataFrame,
    capacity: int = CAPACITY,
    per_source: int = PER_SOURCE,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Pack (doc_id, source, size, cluster), a written table; see pack_documents."""
    shards = max(1, -(-sized.count() // shard_rows))
    dealt = pieces(sized, capacity).withColumn(
        "shard", F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(shards)).cast("int")
    )

    def fill(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc_id", "cluster", "piece"], na_position="first")
        twins = part.groupby(["doc_id", "cluster", "source", "piece"], dropna=False, sort=False)
        part["nth"] = twins.cumcount()
        part = part.sort_values(
            ["words", "doc_id", "cluster", "source", "nth", "piece"],
            ascending=[False, True, True, True, True, True],
            na_position="first",
        )
        source = pd.factorize(part["source"], use_na_sentinel=False)[0]
        cluster = pd.factorize(part["cluster"])[0]
        limits = source_limits(
            int(part["words"].sum()), np.bincount(source).tolist(), capacity, per_source
        )
        part["b"] = pack(
            part["words"].tolist(), source.tolist(), cluster.tolist(), capacity, limits
        )
        in_bin = part.groupby("b", sort=False)
        part["slot"] = in_bin.cumcount()
        part["offset"] = in_bin["words"].cumsum() - part["words"]
        part["bin"] = f"{key[0]}-" + part["b"].astype(str)
        return part[["doc_id", "nth", "piece", "source", "words", "bin", "slot", "offset"]].astype(
            {"doc_id": "Int64", "nth": np.int64, "slot": np.int64}
        )

    return dealt.groupBy("shard").applyInPandas(
        fill,
        "doc_id long, nth long, piece int, source string, words long, bin string, "
        "slot long, offset long",
    )


def packed_windows(placed: DataFrame) -> DataFrame:
    """bin, n_pieces, n_words, doc_ids of every bin, doc_ids in slot order."""
    slots = F.array_sort(F.collect_list(F.struct("slot", "doc_id")))
    return placed.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n_pieces"),
        F.sum("words").alias("n_words"),
        F.transform(slots, lambda s: s["doc_id"]).alias("doc_ids"),
    )
