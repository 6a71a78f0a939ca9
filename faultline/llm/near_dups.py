"""MinHash near-duplicates with sequential Bayesian verification.

A document's set is its distinct shingles of five words. Documents with equal
sets are one class from the start. Classes meet in the buckets of banded
MinHash signatures; a pair that meets is compared on more and more of the
signature, and dropped as soon as the posterior probability that its
similarity reaches the threshold falls below ``MISS``. What is left is
verified exactly, on the full sets of the texts.

Links are sought in two passes, so that no bucket is spelled out in pairs:

1. Each bucket has a hub: the member that shares most bucket places with
   others, which in a group of copies is their common origin. Every other
   member is compared with it, and links found are merged into components.
2. Pairs that share a bucket but no component yet are compared on their
   signatures inside tasks, block by block of the bucket. A task passes on a
   forest that joins what outlives the signatures, not the pairs, so it sends
   fewer rows than it reads. The trees of all forests together are crowds;
   the texts of a crowd meet, block by block, where the pairs that outlive the
   signatures are verified until those left are known to be connected.

Every pair that shares a bucket is therefore verified, dropped by the bound,
or known to be connected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import WORD, columns_of, materialize, partitions, ship

ship(__name__)

WORDS = 5
#: Similarity in hundredths.
THRESHOLD = 75
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Hashes compared at a time, and the chance at which a pair is dropped.
BATCH = 32
MISS = 1e-6
#: Rows of a block in which a bucket is compared, and texts of one in which pairs are verified.
BLOCK = 256
TEXT_BLOCK = 1024
CACHE_WORDS = 400_000

SETS = "doc_id long, text_hash long, n_shingles long, set_id binary, signature binary"
#: Stands for a missing doc_id in join keys.
NO_ID = -(2**63)


# -- shingles ---------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordNumbers(dict):
    """64-bit number of each lower-cased word, the recent ones remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHE_WORDS:
            self.clear()
        number = self[word] = xxhash.xxh3_64_intdigest(word)
        return number


def shingles(text: str | None, numbers: WordNumbers) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles.

    A-Z are lowered and words part at ASCII white space. A text with fewer
    than five words is one shingle, without words none.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    n = np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(n))
    h = np.full(len(n) - width + 1, width, np.uint64)
    for j in range(width):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + n[j : len(n) - width + 1 + j])
    return np.unique(h)


def multipliers() -> np.ndarray:
    seeds = np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(seeds) | np.uint64(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Upper halves of the smallest products, a row for each set, none empty."""
    flat = np.concatenate(sets)
    starts = np.r_[0, np.cumsum([len(x) for x in sets])][:-1]
    out = np.empty((len(sets), HASHES), np.uint32)
    for i, a in enumerate(multipliers()):
        out[:, i] = np.minimum.reduceat(flat * a, starts) >> np.uint64(32)
    return out


def set_ids(sets: list[np.ndarray]) -> list[bytes]:
    import xxhash

    return [xxhash.xxh3_128_digest(x.tobytes()) for x in sets]


def sets_of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    numbers = WordNumbers()
    for part in parts:
        for at in range(0, len(part), 256):
            few = part.iloc[at : at + 256]
            sets = [shingles(t, numbers) for t in few["text"]]
            full = [x for x in sets if len(x)]
            rows = iter(signatures(full)) if full else iter(())
            ids = iter(set_ids(full))
            yield pd.DataFrame(
                {
                    "doc_id": few["doc_id"].astype("Int64").values,
                    "text_hash": few["text_hash"].values,
                    "n_shingles": [len(x) for x in sets],
                    "set_id": [next(ids) if len(x) else None for x in sets],
                    "signature": [next(rows).tobytes() if len(x) else None for x in sets],
                }
            )


# -- verification -----------------------------------------------------------


def least_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """(hashes compared, fewest matches that keep a pair) after each batch.

    With a uniform prior, m matches of n hashes give the similarity a
    Beta(m + 1, n - m + 1) distribution; the chance that it is ``threshold``
    or more is the chance of at most m successes in n + 1 trials at it.
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        chance, kept = 0.0, n + 1
        for m in range(n + 1):
            chance += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if chance >= miss:
                kept = m
                break
        out.append((n, kept))
    return out


def outliving(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of signature rows no batch rules out."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for n, kept in least_matches(THRESHOLD / 100):
        batch = slice(n - BATCH, n)
        matches[alive] += (left[alive, batch] == right[alive, batch]).sum(axis=1)
        alive = alive[matches[alive] >= kept]
    return alive


def posterior_filter(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs (a, b, sa, sb) that no batch of their signatures rules out."""
    for part in parts:
        if len(part):
            sa = np.frombuffer(b"".join(part["sa"]), np.uint32).reshape(-1, HASHES)
            sb = np.frombuffer(b"".join(part["sb"]), np.uint32).reshape(-1, HASHES)
            yield part.iloc[outliving(sa, sb)][["a", "b"]]


def by_place(
    parts: Iterator[pd.DataFrame],
    keys: list[str],
    compare: Callable[[pd.DataFrame], Iterator[pd.DataFrame]],
) -> Iterator[pd.DataFrame]:
    """What ``compare`` gives for the rows of each place; rows come sorted by ``keys``."""
    held: pd.DataFrame | None = None
    for part in parts:
        rows = part if held is None else pd.concat([held, part], ignore_index=True)
        if not len(rows):
            continue
        key = rows[keys].to_numpy()
        edges = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
        held = rows.iloc[edges[-1] :].reset_index(drop=True)
        for start, end in zip(edges, edges[1:], strict=False):
            yield from compare(rows.iloc[start:end])
    if held is not None:
        yield from compare(held)


def alive_pairs(rows: pd.DataFrame, apart: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of the rows of one place that outlive their signatures.

    A place is one block, or two whose members meet. ``apart`` numbers the
    components; pairs of one component are left out.
    """
    n = rows["n"].to_numpy()
    block = rows["block"].to_numpy()
    if len(rows) < 2 or (apart == apart[0]).all():
        return
    sig = np.frombuffer(b"".join(rows["signature"]), np.uint32).reshape(-1, HASHES)
    crossing = bool(rows["lo"].iloc[0] != rows["hi"].iloc[0])
    step = max(1, (1 << 15) // len(rows))
    for at in range(0, len(rows), step):
        i, j = np.meshgrid(np.arange(at, min(at + step, len(rows))), np.arange(len(rows)), indexing="ij")
        i, j = i.ravel(), j.ravel()
        fits = (i < j) & (apart[i] != apart[j])
        fits &= 100 * np.minimum(n[i], n[j]) >= THRESHOLD * np.maximum(n[i], n[j])
        if crossing:
            fits &= block[i] != block[j]
        i, j = i[fits], j[fits]
        if len(i):
            alive = outliving(sig[i], sig[j])
            yield i[alive], j[alive]


class Roots(list):
    """Roots of merged numbers 0 .. n - 1."""

    def __init__(self, n: int):
        super().__init__(range(n))

    def of(self, i: int) -> int:
        while self[i] != i:
            self[i] = i = self[self[i]]
        return i


def joined_in_bucket(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """A forest (a, b) over the pairs of a bucket that outlive their signatures.

    A pair counts in the first band it shares only, and pairs with the hub
    have been compared.
    """
    label = pd.factorize(rows["label"])[0]
    hub = rows["is_hub"].to_numpy()
    band = int(rows["band"].iloc[0])
    ids = rows["set_id"].to_numpy()
    roots, links = Roots(len(rows)), []
    sig = None
    for i, j in alive_pairs(rows, label):
        i, j = i[~(hub[i] | hub[j])], j[~(hub[i] | hub[j])]
        if not len(i):
            continue
        if sig is None:
            sig = np.frombuffer(b"".join(rows["signature"]), np.uint32).reshape(-1, HASHES)
        same = (sig[i] == sig[j]).reshape(len(i), BANDS, ROWS).all(axis=2)
        first = same.argmax(axis=1) == band
        for x, y in zip(i[first].tolist(), j[first].tolist(), strict=True):
            p, q = roots.of(x), roots.of(y)
            if p != q:
                roots[p] = q
                links.append((x, y))
    if links:
        at = np.array(links)
        yield pd.DataFrame({"a": ids[at[:, 0]], "b": ids[at[:, 1]]})


def verified_in_crowd(rows: pd.DataFrame, numbers: WordNumbers) -> Iterator[pd.DataFrame]:
    """Links (a, b) that connect what the exact links of a place connect."""
    label = pd.factorize(rows["label"])[0]
    texts, ids = rows["text"].to_numpy(), rows["set_id"].to_numpy()
    sets: dict[int, np.ndarray] = {}
    roots, links = Roots(int(label.max()) + 1), []
    for i, j in alive_pairs(rows, label):
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            p, q = roots.of(label[x]), roots.of(label[y])
            if p == q:
                continue
            for z in (x, y):
                if z not in sets:
                    sets[z] = shingles(texts[z], numbers)
            if similar(sets[x], sets[y]):
                roots[p] = q
                links.append((x, y))
    if links:
        at = np.array(links)
        yield pd.DataFrame({"a": ids[at[:, 0]], "b": ids[at[:, 1]]})


def join_buckets(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    return by_place(parts, ["bucket", "lo", "hi"], joined_in_bucket)


def verify_crowds(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    numbers = WordNumbers()
    return by_place(parts, ["crowd", "lo", "hi"], lambda rows: verified_in_crowd(rows, numbers))


def similar(one: np.ndarray, other: np.ndarray) -> bool:
    """Whether two full sets reach the threshold."""
    common = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * common >= THRESHOLD * (len(one) + len(other) - common)


def verify(key: tuple, pairs: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
    """The pairs (a, b) of one place whose full sets are similar enough."""
    numbers = WordNumbers()
    sets = {
        bytes(i): shingles(t, numbers)
        for i, t in zip(texts["set_id"], texts["text"], strict=True)
    }
    kept = [
        similar(sets[bytes(a)], sets[bytes(b)])
        for a, b in zip(pairs["a"], pairs["b"], strict=True)
    ]
    return pairs.loc[kept, ["a", "b"]]


# -- links and components ---------------------------------------------------


def texts_of(docs: DataFrame, carriers: DataFrame) -> DataFrame:
    """(set_id, text), one row for each class of ``carriers`` (set_id, carrier).

    A carrier is the doc_id and text hash of one row of the class. Rows alike
    in both become one before they are shuffled, so neither an id that repeats
    nor rows without one meet more than their own class.
    """
    keyed = docs.select(
        doc_key(F.col("doc_id").cast("long")),
        F.col("text").cast("string").alias("text"),
        text_hash(),
    ).dropDuplicates(["doc_id", "text_hash"])
    wanted = carriers.select(
        "set_id", doc_key(F.col("carrier.doc_id")), F.col("carrier.text_hash").alias("text_hash")
    )
    return keyed.join(wanted, ["doc_id", "text_hash"]).select("set_id", "text")


def hub_places(pairs: DataFrame, blocks: int) -> DataFrame:
    """``pairs`` (hub a, member b) with the place x, y of their comparison.

    The hubs of a block x meet their members in one place, or in several if
    there are many, so a hub's text is sent once and not with each member.
    """
    placed = pairs.withColumn("x", F.pmod(F.xxhash64("a"), F.lit(blocks)))
    load = placed.groupBy("x").agg(F.count(F.lit(1)).alias("load"))
    deal = F.pmod(F.xxhash64("b"), F.ceil(F.col("load") / TEXT_BLOCK))
    return placed.join(load, "x").withColumn("y", deal).drop("load")


def verified(pairs: DataFrame, docs: DataFrame, carriers: DataFrame) -> DataFrame:
    """The pairs (hub a, member b) of set ids that are links, as a written table.

    Texts are fetched once each and sent to the places of their pairs, so
    a text goes to a place once and not with each of its pairs.
    """
    needed = materialize(
        pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct(), "near-needed"
    )
    met = hub_places(pairs, max(1, -(-needed.count() // TEXT_BLOCK)))
    ends = met.select("x", "y", F.col("a").alias("set_id")).union(met.select("x", "y", "b"))
    texts = texts_of(docs, carriers.join(needed, "set_id"))
    sent = ends.toDF("u", "v", "set_id").distinct().join(texts, "set_id")
    links = (
        met.groupBy("x", "y")
        .cogroup(sent.groupBy("u", "v"))
        .applyInPandas(verify, "a binary, b binary")
    )
    return materialize(links, "near-links")


def hub_links(
    members: DataFrame, classes: DataFrame, docs: DataFrame, carriers: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(hub of each bucket, links found between the members of buckets and their hubs)."""
    popular = members.groupBy("set_id").agg(F.sum("c").alias("pop"))
    hubs = materialize(
        members.join(popular, "set_id")
        .groupBy("bucket")
        .agg(F.max(F.struct("pop", "set_id", "n")).alias("hub")),
        "near-hubs",
    )
    pairs = materialize(
        members.join(hubs, "bucket")
        .select(F.col("hub.set_id").alias("a"), F.col("hub.n").alias("m"), F.col("set_id").alias("b"), "n")
        .where("a <> b")
        .where(could_link("n", "m"))
        .select("a", "b")
        .distinct(),
        "near-star",
    )
    sig = classes.select("set_id", "signature")
    posed = pairs.join(sig.toDF("b", "sb"), "b").join(sig.toDF("a", "sa"), "a")
    survivors = materialize(
        posed.select("a", "b", "sa", "sb").mapInPandas(posterior_filter, "a binary, b binary"),
        "near-survivors",
    )
    return hubs, verified(survivors, docs, carriers)


def dealt_to_places(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` with their block of ``c`` and a row for each place lo, hi of it."""
    blocks = F.ceil(F.col("c") / size).cast("int")
    return (
        rows.withColumn("block", F.pmod(F.xxhash64("set_id"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("lo", F.least("block", "other"))
        .withColumn("hi", F.greatest("block", "other"))
    )


def candidate_links(
    members: DataFrame, hubs: DataFrame, labels: DataFrame, classes: DataFrame
) -> DataFrame:
    """Links (a, b) that join all sets which share a bucket, but no component,
    and outlive the signatures, as a written table."""
    named = materialize(
        members.join(labels, "set_id", "left").select(
            "bucket", "band", "set_id", "n", "c", F.coalesce("label", "set_id").alias("label")
        ),
        "near-named",
    )
    several = (
        named.groupBy("bucket")
        .agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        .where("lo <> hi")
        .select("bucket")
        .join(hubs.select("bucket", F.col("hub.set_id").alias("hub_id")), "bucket")
    )
    mixed_buckets = materialize(several, "near-mixed")
    left = dealt_to_places(
        named.join(mixed_buckets, "bucket").withColumn("is_hub", F.expr("set_id = hub_id")), BLOCK
    )
    key = ["bucket", "lo", "hi"]
    posed = left.join(classes.select("set_id", "signature"), "set_id").select(
        *key, "band", "block", "set_id", "n", "label", "is_hub", "signature"
    )
    return materialize(
        posed.repartition(partitions(posed.sparkSession), *key)
        .sortWithinPartitions(*key)
        .mapInPandas(join_buckets, "a binary, b binary")
        .distinct(),
        "near-candidates",
    )


def crowd_links(
    candidates: DataFrame, labels: DataFrame, classes: DataFrame, docs: DataFrame, carriers: DataFrame
) -> DataFrame:
    """Links (a, b) within the crowds that ``candidates`` join, as a written table.

    They connect whatever the links of a crowd connect.
    """
    crowds = components(candidates).select("set_id", F.xxhash64("label").alias("crowd"))
    sizes = crowds.groupBy("crowd").agg(F.count(F.lit(1)).alias("c"))
    # narrow rows first: the texts join what is known to need them
    posed = materialize(
        crowds.join(sizes, "crowd")
        .join(labels, "set_id", "left")
        .join(classes, "set_id")
        .select(
            "crowd",
            "c",
            "set_id",
            F.col("n_shingles").alias("n"),
            F.coalesce("label", "set_id").alias("label"),
            "signature",
        ),
        "near-crowds",
    )
    texts = texts_of(docs, carriers.join(posed.select("set_id"), "set_id"))
    key = ["crowd", "lo", "hi"]
    met = dealt_to_places(posed.join(texts, "set_id"), TEXT_BLOCK).select(
        *key, "block", "set_id", "n", "label", "signature", "text"
    )
    return materialize(
        met.repartition(partitions(met.sparkSession), *key)
        .sortWithinPartitions(*key)
        .mapInPandas(verify_crowds, "a binary, b binary"),
        "near-crowd-links",
    )


def settled(edges: DataFrame) -> bool:
    """Whether every lower node has one edge and none below it, so that both steps change nothing."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    seen = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(set_id, label) of all linked ids; label is the component's smallest id.

    Alternates two steps on edges that point down: every larger neighbour of
    a node is linked to the smallest one, then every smaller neighbour and
    the node itself. It ends when each edge leads to a root, after a number
    of rounds like the logarithm of the longest chain; each is written.
    """
    edges = materialize(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        "near-edges",
    )
    while not settled(edges):
        both = edges.union(edges.select("v", "u"))
        low = materialize(
            both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")),
            "near-low",
        )
        large = materialize(
            both.join(low, "u")
            .where("v > u and v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct(),
            "near-large",
        )
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "near-low")
        small = large.join(low, "u")
        edges = materialize(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", "m"))
            .where("u <> v")
            .distinct(),
            "near-edges",
        )
    roots = edges.select(F.col("v").alias("set_id"), F.col("v").alias("label")).distinct()
    return materialize(
        edges.select(F.col("u").alias("set_id"), F.col("v").alias("label")).union(roots),
        "near-labels",
    )


def band_keys(classes: DataFrame) -> DataFrame:
    """(bucket, band, set_id, n) for each band of each class."""

    def keys(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if not len(part):
                continue
            sig = np.frombuffer(b"".join(part["signature"]), np.uint32).reshape(-1, BANDS, ROWS)
            h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), sig.shape[:2]).copy()
            for j in range(ROWS):
                h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, j])
            yield pd.DataFrame(
                {
                    "bucket": h.astype(np.int64).ravel(),
                    "band": np.tile(np.arange(BANDS, dtype=np.int32), len(part)),
                    "set_id": np.repeat(part["set_id"].values, BANDS),
                    "n": np.repeat(part["n_shingles"].values, BANDS),
                }
            )

    return classes.select("set_id", "n_shingles", "signature").mapInPandas(
        keys, "bucket long, band int, set_id binary, n long"
    )


def could_link(n: str, m: str) -> str:
    """Sizes that allow the threshold."""
    return f"100 * least({n}, {m}) >= {THRESHOLD} * greatest({n}, {m})"


def doc_key(doc_id: Column) -> Column:
    """``doc_id`` with one key for all rows without it."""
    return F.coalesce(doc_id, F.lit(NO_ID)).alias("doc_id")


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")


def document_sets(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_id, signature of every row, written."""
    return materialize(
        docs.select(
            F.col("doc_id").cast("long"),
            F.col("text").cast("string"),
            text_hash(),
        ).mapInPandas(sets_of, SETS),
        "near-sets",
    )


def labelled(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, label, component_id of every row.

    Rows of one label are linked, whatever their doc_ids; label and
    component_id of a row without words are null.
    """
    sets = document_sets(docs)
    full = sets.where("n_shingles > 0")
    first = materialize(
        full.groupBy("set_id").agg(
            F.min("doc_id").alias("first"),
            F.min(F.struct("doc_id", "text_hash")).alias("carrier"),
        ),
        "near-first",
    )
    # one row per class: any of its rows has its signature
    classes = materialize(
        full.groupBy("set_id").agg(
            F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
        ),
        "near-classes",
    )
    bands = band_keys(classes)
    met = materialize(
        bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "near-buckets"
    )
    members = materialize(bands.join(met, "bucket"), "near-members")
    carriers = first.select("set_id", "carrier")
    hubs, links = hub_links(members, classes, docs, carriers)
    labels = components(links)
    candidates = candidate_links(members, hubs, labels, classes)
    # what the first links join is a star already
    stars = labels.select(F.col("set_id").alias("a"), F.col("label").alias("b"))
    labels = components(stars.union(crowd_links(candidates, labels, classes, docs, carriers)))

    groups = first.join(labels, "set_id", "left").select(
        "set_id", "first", F.coalesce("label", "set_id").alias("label")
    )
    smallest = groups.groupBy("label").agg(F.min("first").alias("component_id"))
    named = materialize(
        groups.join(smallest, "label").select("set_id", "label", "component_id"), "near-components"
    )
    return (
        sets.select("doc_id", "text_hash", "n_shingles", "set_id")
        .join(named, "set_id", "left")
        .select("doc_id", "text_hash", "n_shingles", "label", "component_id")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept of every row.

    component_id is the smallest doc_id that links reach. Null and wordless
    texts have an empty set, are linked with nothing and are kept. Rows that
    repeat a doc_id are nodes of their own set; a row without doc_id takes
    part and is kept only if no row of its component has one. Other columns
    are not read, and an empty table gives no row.
    """
    return (
        labelled(docs)
        .withColumn(
            "component_id",
            F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id")),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .drop("label")
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, that of smallest doc_id.

    Wordless documents all stay. A component is what links reach, so texts
    that share a doc_id, or have none, stay apart unless they are linked. Where
    several texts of a component carry its smallest doc_id, the one with the
    smallest hash stays; of rows alike in both, the one whose other columns
    come first.
    """
    doc_key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id")
    counts = (
        labelled(docs)
        .where("label is not null")
        .groupBy("label", "doc_id", F.col("text_hash").alias("_hash"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_hash", "n")
    stay = materialize(
        counts.groupBy("label")
        .agg(F.min(place).alias("_at"))
        .select("_at.*")
        .select(doc_key, "_hash", "n"),
        "near-stay",
    )
    has_words = F.coalesce(F.col("_row.text").rlike(WORD), F.lit(False))
    rows = docs.select(
        F.struct(*columns_of(docs)).alias("_row"),
        doc_key,
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"),
    )
    worded = rows.where(has_words)
    key = ["_id", "_hash"]
    others = F.to_json(F.struct(*[F.col("_row")[c].alias(c) for c in docs.columns if c != "text"]))
    kept = (
        rows.where(~has_words)
        .select("_row")
        .union(worded.join(stay.where("n = 1"), key, "left_semi").select("_row"))
        .union(
            worded.join(stay.where("n > 1"), key, "left_semi")
            .groupBy(*key)
            .agg(F.min_by("_row", others).alias("_row"))
            .select("_row")
        )
    )
    return kept.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
