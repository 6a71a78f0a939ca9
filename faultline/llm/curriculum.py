"""Mixing sources to target weights along a time-varying curriculum.

Training time runs from 0 to 1. Source s asks for tokens at a rate that
changes linearly from ``start`` to ``end``; the integral of the rate up to t,
scaled to the source's target, is its cumulative demand

    demand_s(t) = target_s * (start * t + (end - start) * t^2 / 2) / ((start + end) / 2)

A source's documents lie in an order fixed by a hash, repeated up to
``max_epochs`` times. The copy that begins ``o`` words into that stream is due
when the demand reaches o, so its position is demand_s^-1(o), and the mix is
all copies due before time 1 in order of position. The copy that crosses the
target gives only the words up to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from faultline.llm.common import WORD, columns_of, materialize, partitions

MAX_EPOCHS = 3
#: Rates at the start and the end of training, dealt to the sources in turn.
RAMPS = ((1.0, 1.0), (0.5, 1.5), (1.5, 0.5))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, weight, target, start, end from (source, source_size).

    One row per source comes in, and the running sums below go over these
    rows alone. Weights 1, 2, 3 go in turn to the sources by code point, null
    last. The targets share the sum of all sizes by weight, none over
    ``max_epochs`` times its source: the level L at which the sum of
    min(cap, weight * L) is the whole is found behind the sources, in order of
    cap / weight, that stay at their cap.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    ramps = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in RAMPS])
    named = (
        sizes.withColumn("_rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", (F.col("_rank") % 3 + 1).cast("double"))
        .withColumn("_ramp", F.get(ramps, (F.col("_rank") % len(RAMPS)).cast("int")))
        .withColumn("_cap", F.col("source_size") * float(max_epochs))
        .withColumn("_fill", F.struct(F.col("_cap") / F.col("weight"), "_rank"))
        .withColumn("_whole", F.sum("source_size").over(W.partitionBy()).cast("double"))
    )
    filling = W.orderBy("_fill")
    capped = F.coalesce(
        F.sum("_cap").over(filling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)
    )
    sharing = F.sum("weight").over(filling.rowsBetween(0, W.unboundedFollowing))
    leveled = named.withColumn("_level", (F.col("_whole") - capped) / sharing)
    # the level is set by the first source in this order that it does not cap
    is_open = F.col("_level") * F.col("weight") <= F.col("_cap")
    level = F.min_by("_level", F.when(is_open, F.col("_fill"))).over(W.partitionBy())
    return leveled.withColumn("_found", level).select(
        "source",
        "source_size",
        "weight",
        F.least("_cap", F.col("weight") * F.col("_found")).alias("target"),
        F.col("_ramp.start").alias("start"),
        F.col("_ramp.end").alias("end"),
    )


def due(offset: Column, target: Column, start: Column, end: Column) -> Column:
    """The time at which a source's demand reaches ``offset`` words; 1 for a target of 0."""
    share = F.least(offset / F.nullif(target, F.lit(0.0)), F.lit(1.0)) * (start + end) / 2
    slope = end - start
    # the root of slope/2 t^2 + start t - share that lies in 0..1
    return F.when(slope == 0, share / start).otherwise(
        2 * share / (start + F.sqrt(F.greatest(start * start + 2 * slope * share, F.lit(0.0))))
    )


def place(docs: DataFrame, max_epochs: int = MAX_EPOCHS, seed: int = 17) -> DataFrame:
    """Every document with the copies the mix takes of it.

    Returns doc_id, text_hash, source, size, source_size, target, taken,
    copies, where copies is an array of (epoch, words, position), empty for a
    document that is not taken. Null text has size 0, null source is a source,
    rows without words are never taken, repeated rows are documents of their
    own. An empty table gives an empty result.

    The words before a document in its source's order come from range
    partitions: sums per partition and source, then a running sum within
    each, so a source with a third of all rows is spread like any other.
    """
    spark = docs.sparkSession
    narrow = docs.select(
        F.col("doc_id").cast("long"),
        F.col("source").cast("string"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        n_words(F.col("text")).alias("size"),
    ).withColumn("_order", F.xxhash64(F.lit(seed), "doc_id", "text_hash"))
    narrow = materialize(narrow, "mix-sizes")
    order = ["source", "_order", "doc_id", "size"]
    laid = materialize(
        narrow.repartitionByRange(partitions(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id()),
        "mix-order",
    )
    parts = laid.groupBy("source", "_part").agg(F.sum("size").alias("_n"))
    targets = source_targets(parts.groupBy("source").agg(F.sum("_n").alias("source_size")))
    starts = parts.withColumn(
        "_start",
        F.sum("_n").over(W.partitionBy("source").orderBy("_part")) - F.col("_n"),
    ).drop("_n")
    facts = materialize(
        starts.alias("p")
        .join(targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")))
        .select("p.source", "p._part", "p._start", "t.source_size", "t.target", "t.start", "t.end"),
        "mix-facts",
    )
    running = F.sum("size").over(
        W.partitionBy("_part", "source")
        .orderBy("_order", "doc_id", "size")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    placed = laid.withColumn("_before", F.coalesce(running, F.lit(0)))
    placed = (
        placed.alias("d")
        .join(
            facts.alias("f"),
            (F.col("d._part") == F.col("f._part"))
            & F.col("d.source").eqNullSafe(F.col("f.source")),
        )
        .select("d.*", "f._start", "f.source_size", "f.target", "f.start", "f.end")
    )
    offset = lambda epoch: (
        F.col("_start") + F.col("_before") + epoch.cast("long") * F.col("source_size")
    )
    words = lambda epoch: F.greatest(
        F.lit(0).cast("long"),
        F.least(F.col("size"), F.round(F.col("target")).cast("long") - offset(epoch)),
    )
    copies = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.lit(max_epochs - 1)),
            lambda e: F.struct(
                e.alias("epoch"),
                words(e).alias("words"),
                due(
                    offset(e).cast("double"), F.col("target"), F.col("start"), F.col("end")
                ).alias("position"),
            ),
        ),
        lambda c: c["words"] > 0,
    )
    return placed.withColumn("copies", copies).select(
        "doc_id",
        "text_hash",
        "source",
        "size",
        "source_size",
        "target",
        F.aggregate("copies", F.lit(0).cast("long"), lambda n, c: n + c["words"]).alias("taken"),
        "copies",
    )


def each_copy(placed: DataFrame) -> DataFrame:
    """One row per copy taken, in no order."""
    return placed.withColumn("copy", F.explode("copies")).select(
        "doc_id",
        "text_hash",
        "source",
        "size",
        F.col("copy.epoch").alias("epoch"),
        F.col("copy.words").alias("words"),
        F.col("copy.position").alias("position"),
    )


def in_training_order(placed: DataFrame) -> DataFrame:
    """One row per copy, range-sorted by position (ties by doc_id, epoch)."""
    return each_copy(placed).orderBy("position", "doc_id", "epoch", "text_hash")


def mix(docs: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The documents of the mix in training order, columns as in ``docs``.

    A document comes once for each copy taken; the copy at a source's target
    keeps only its first words (and ``n_chars`` counts those). Rows alike in
    doc_id, text and source are told apart by a row number; each has copies
    of its own.
    """
    key = F.struct("doc_id", F.col("text_hash"), "source")
    taken = (
        each_copy(place(docs, max_epochs))
        .withColumn("_key", key)
        .withColumn("_nth", F.row_number().over(W.partitionBy("_key", "epoch").orderBy("position")))
        .select("_key", "_nth", "epoch", "words", "size", "position")
        .alias("t")
    )
    own_key = F.struct(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        F.col("source").cast("string").alias("source"),
    )
    own = (
        docs.select(F.struct(*columns_of(docs)).alias("_row"), own_key.alias("_key"))
        .withColumn("_nth", F.row_number().over(W.partitionBy("_key").orderBy(F.lit(0))))
        .alias("o")
    )
    text = F.col("_row.text")
    pieces = F.regexp_extract_all(text, F.lit(f"[\\x20\\x09-\\x0D]*{WORD}"), 0)
    kept = F.when(F.col("words") >= F.col("size"), text).otherwise(
        F.array_join(F.slice(pieces, 1, F.col("words").cast("int")), "")
    )
    rows = own.join(
        taken, (F.col("o._key") == F.col("t._key")) & (F.col("o._nth") == F.col("t._nth"))
    ).withColumn("_text", kept)
    # only what is returned goes through the sort, and what it sorts by
    columns = [
        F.col("_text").alias("text")
        if c == "text"
        else F.length("_text").cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars"
        else F.col("_row")[c].alias(c)
        for c in docs.columns
    ]
    at = F.struct("position", "t._key", "epoch").alias("at")
    ordered = rows.select(at, F.struct(*columns).alias("row")).orderBy("at")
    return ordered.select(*[F.col("row")[c].alias(c) for c in docs.columns])
