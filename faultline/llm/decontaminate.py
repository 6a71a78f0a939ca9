"""Benchmark passages in documents, by a prefix-filtered set join.

An item is cut into windows of ``window`` consecutive words (an item of fewer
words is one window), a window is a set of word shingles with their places,
and a document holds a window where an equally long stretch of its words has
at least the share ``containment`` of them in the same places; 1 means the very words.

The join, as set joins do it:

1. Every shingle of the items is counted over all documents, so each window
   can order its shingles by rarity.
2. If c of s shingles must agree, one of the s - c + 1 rarest must: only these,
   the prefix, are looked up. At containment 1 that is a single shingle.
3. A found shingle fixes where the window would begin. Length and position
   bound it: it must begin and end inside the document.
4. What is left is verified word by word.

The items travel to the documents, in blocks of bounded size: a document is
never shuffled for the search. Several blocks are several passes, whose finds
meet by a hash of the text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import materialize, ship

ship(__name__)

WINDOW = 10
SHINGLE = 5
CONTAINMENT = 1.0

#: Bytes of item words in one broadcast index, and in one chunk of an item.
BLOCK_BYTES = 8 << 20
CHUNK_BYTES = 64 << 10
#: Bytes of text turned into word ids at once, words searched at once, and
#: candidate places verified at once.
PIECE_BYTES = 4 << 20
SEARCH_WORDS = 1 << 20
VERIFY_PAIRS = 1 << 18

# A word byte stays (A-Z as a-z), any other ASCII byte is a blank. All bytes
# of a code point above ASCII are word bytes.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)

FOUND = "n_words long, n_hit long, item_ids array<string>, spans array<struct<first:long,last:long>>"


def words(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, a bounded piece at a time."""
    data = (text or "").encode().translate(WORD_BYTES)
    start = 0
    while start < len(data):
        end = start + PIECE_BYTES
        end = len(data) if end >= len(data) else data.find(b" ", end)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def shingle_hashes(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose next ``size`` ids are all known (not 0), and their hashes."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    known = np.r_[0, np.cumsum(ids != 0)]
    at = np.flatnonzero(known[size:] - known[:-size] == size)
    h = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(size):
            h = (h ^ ids[at + j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return at, h


class Index:
    """The windows of one block of items.

    ``ids`` holds the items' words as numbers from 1, window w is
    ``ids[first[w] : first[w] + length[w]]``, equal windows are one, and
    ``owners`` lists the items of each.
    """

    def __init__(self, chunks: Iterable[tuple[str | None, str]], window: int, shingle: int):
        self.window, self.shingle = window, shingle
        self.vocabulary: dict[bytes, int] = {}
        names: dict[str | None, int] = {}
        seen: dict[bytes, int] = {}
        ids, first, length, owned = [], [], [], set()
        total = 0
        for item, text in chunks:
            owner = names.setdefault(item, len(names))
            mine = np.array(
                [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in text.encode().split()],
                np.int32,
            )
            n = min(len(mine), window)
            for p in range(len(mine) - n + 1):
                w = seen.setdefault(mine[p : p + n].tobytes(), len(seen))
                if w == len(first):
                    first.append(total + p)
                    length.append(n)
                owned.add((w, owner))
            ids.append(mine)
            total += len(mine)
        self.items = list(names)
        self.ids = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        self.first, self.length = np.array(first, np.int64), np.array(length, np.int64)
        pairs = np.array(sorted(owned), np.int64).reshape(-1, 2)
        self.owners = pairs[:, 1]
        self.owner_from = np.searchsorted(pairs[:, 0], np.arange(len(first) + 1))
        self.sizes = sorted({min(shingle, n) for n in length})
        self.prefix: dict[int, tuple] = {}

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, offset, hash) of the shingles of all windows of this shingle size."""
        which = np.flatnonzero(np.minimum(self.length, self.shingle) == size)
        count = self.length[which] - size + 1
        window = np.repeat(which, count)
        offset = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
        at, h = shingle_hashes(self.ids, size)
        # every id of an item is known, so place and row of ``at`` are the same
        return window, offset, h[self.first[window] + offset]

    def keys(self, size: int) -> np.ndarray:
        return np.unique(self.shingles(size)[2])

    def keep_prefixes(self, counts: dict[tuple[int, int], int], containment: float) -> None:
        """Choose the rarest shingles of each window, given all counts."""
        for size in self.sizes:
            window, offset, h = self.shingles(size)
            keys = self.keys(size)
            rarity = np.array([counts.get((size, k), 0) for k in keys.view(np.int64).tolist()], np.int64)
            by = np.lexsort((h, rarity[np.searchsorted(keys, h)], window))
            window, offset, h = window[by], offset[by], h[by]
            _, starts, count = np.unique(window, return_index=True, return_counts=True)
            place = np.arange(len(window)) - np.repeat(starts, count)
            # one of the rarest count - needed + 1 agrees if ``needed`` do
            needed = self.needed(count, containment)
            kept = place < np.repeat(count - needed + 1, count)
            by = np.argsort(h[kept], kind="stable")
            window, offset, h = window[kept][by], offset[kept][by], h[kept][by]
            unique, starts = np.unique(h, return_index=True)
            self.prefix[size] = (unique, np.r_[starts, len(h)], window, offset)

    @staticmethod
    def needed(count: np.ndarray, containment: float) -> np.ndarray:
        return np.maximum(np.ceil(containment * count - 1e-9).astype(np.int64), 1)

    def numbers(self, text: str | None) -> np.ndarray:
        """The words of a text as the items' numbers, 0 for any other word."""
        get = self.vocabulary.get
        parts = [np.array([get(w, 0) for w in piece], np.int32) for piece in words(text)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def find(self, ids: np.ndarray, bounds: np.ndarray, containment: float) -> tuple:
        """(start, window) wherever a window lies in the texts laid end to end.

        Text t is ``ids[bounds[t] : bounds[t + 1]]``, its last id being 0.
        """
        starts, windows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for size, (keys, row, window, offset) in self.prefix.items():
            at, h = shingle_hashes(ids, size)
            k = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            same = keys[k] == h
            at, k = at[same], k[same]
            count = row[k + 1] - row[k]
            # as many places at once as have a bounded number of candidates
            upto = np.cumsum(count)
            begin = 0
            while begin < len(at):
                before = upto[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(upto, before + VERIFY_PAIRS, "right")))
                n = count[begin:end]
                entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                entry += np.repeat(row[k[begin:end]], n)
                w = window[entry]
                start = np.repeat(at[begin:end], n) - offset[entry]
                s, w = self.verified(ids, bounds, start, w, size, containment)
                starts.append(s)
                windows.append(w)
                begin = end
        start, window = np.concatenate(starts), np.concatenate(windows)
        if containment < 1 and len(start):
            # several prefix shingles may have led to one place
            both = np.unique(np.stack([start, window], axis=1), axis=0)
            start, window = both[:, 0], both[:, 1]
        return start, window

    def verified(self, ids, bounds, start, window, size, containment) -> tuple:
        length = self.length[window]
        # length and position: the window begins and ends inside one text
        fits = (start >= 0) & (start + length <= len(ids))
        start, window, length = start[fits], window[fits], length[fits]
        fits = start + length < bounds[np.searchsorted(bounds, start, "right")]
        start, window, length = start[fits], window[fits], length[fits]
        first = self.first[window]
        if containment >= 1:
            for j in range(self.window):
                same = j >= length
                inside = ~same
                same[inside] = ids[start[inside] + j] == self.ids[first[inside] + j]
                start, window, length, first = start[same], window[same], length[same], first[same]
            return start, window
        equal = np.zeros((len(start), self.window + 1), np.int64)
        for j in range(self.window):
            inside = j < length
            equal[inside, j + 1] = ids[start[inside] + j] == self.ids[first[inside] + j]
        run = np.cumsum(equal, axis=1)
        agree = (run[:, size:] - run[:, :-size] == size).sum(axis=1)
        good = agree >= self.needed(length - size + 1, containment)
        return start[good], window[good]

    def item_names(self, window: np.ndarray) -> list:
        """Ids of the items that own a window, sorted; an item without id is last."""
        count = self.owner_from[window + 1] - self.owner_from[window]
        entry = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        owners = np.unique(self.owners[entry + np.repeat(self.owner_from[window], count)])
        names = [self.items[o] for o in owners.tolist()]
        return sorted((x for x in names if x is not None)) + [None] * (None in names)


def groups(texts: Iterable[str | None], index: Index) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts laid end to end as word ids, each with a 0 behind it, some at a time."""
    parts, total = [], 0
    for text in texts:
        ids = np.r_[index.numbers(text), np.int32(0)].astype(np.int32)
        parts.append(ids)
        total += len(ids)
        if total >= SEARCH_WORDS:
            yield np.concatenate(parts), np.cumsum([0, *map(len, parts)])
            parts, total = [], 0
    if parts:
        yield np.concatenate(parts), np.cumsum([0, *map(len, parts)])


def merged(spans: np.ndarray) -> list[tuple[int, int]]:
    """Touching or overlapping (first, last) word ranges as one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(map(tuple, spans.tolist())):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def search(texts: Iterable[str | None], index: Index, containment: float) -> Iterator[tuple]:
    """(n_words, n_hit, item_ids, spans) of each text."""
    for ids, bounds in groups(texts, index):
        start, window = index.find(ids, bounds, containment)
        text = np.searchsorted(bounds, start, "right") - 1
        by = np.argsort(text, kind="stable")
        start, window, text = start[by], window[by], text[by]
        edge = np.searchsorted(text, np.arange(len(bounds)))
        for t in range(len(bounds) - 1):
            n, (a, b) = int(bounds[t + 1] - bounds[t] - 1), edge[t : t + 2]
            if a == b:
                yield n, 0, [], []
                continue
            first = start[a:b] - bounds[t]
            spans = merged(np.unique(np.stack([first, first + index.length[window[a:b]] - 1], 1), axis=0))
            hit = sum(last - first + 1 for first, last in spans)
            yield n, hit, index.item_names(np.unique(window[a:b])), spans


# -- jobs -------------------------------------------------------------------


def item_chunks(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(item, words): stretches of the items' words that share window - 1 words,
    so that each window lies in one; equal ones once."""

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for item, value in zip(part["item"], part["text"], strict=True):
                held: list[bytes] = []
                size = fresh = 0
                for piece in words(value):
                    for w in piece:
                        held.append(w)
                        size += len(w) + 1
                        fresh += 1
                        if size >= CHUNK_BYTES and len(held) >= window:
                            out.append((item, b" ".join(held).decode()))
                            held = held[len(held) - window + 1 :]
                            size, fresh = sum(len(w) + 1 for w in held), 0
                if fresh:
                    out.append((item, b" ".join(held).decode()))
            yield pd.DataFrame(out, columns=["item", "words"])

    named = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    return named.mapInPandas(cut, "item string, words string").distinct()


def count_shingles(docs: DataFrame, text: str, index: Index) -> dict[tuple[int, int], int]:
    """(size, hash) -> occurrences in all documents, of the index' shingles only."""
    if not index.sizes:
        return {}
    held = docs.sparkSession.sparkContext.broadcast(index)

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = held.value
        keys = {size: index.keys(size) for size in index.sizes}
        seen = {size: np.zeros(len(k), np.int64) for size, k in keys.items()}
        for part in parts:
            for ids, _ in groups(part["text"], index):
                for size, k in keys.items():
                    h = shingle_hashes(ids, size)[1]
                    at = np.minimum(np.searchsorted(k, h), len(k) - 1)
                    seen[size] += np.bincount(at[k[at] == h], minlength=len(k))
        for size, n in seen.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"size": size, "key": keys[size][at].view(np.int64), "n": n[at]})

    partial = docs.select(F.col(text).alias("text")).mapInPandas(count, "size int, key long, n long")
    # no more rows than the index has shingles
    rows = partial.groupBy("size", "key").agg(F.sum("n").alias("n")).collect()
    return {(r["size"], r["key"]): r["n"] for r in rows}


def found_by(docs: DataFrame, text: str, index: Index, containment: float, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and what ``search`` finds in each row's text."""
    held = docs.sparkSession.sparkContext.broadcast(index)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = list(search(part["_text"], held.value, containment))
            out = pd.DataFrame(rows, columns=["n_words", "n_hit", "item_ids", "spans"])
            out["spans"] = [[{"first": a, "last": b} for a, b in s] for s in out["spans"]]
            yield pd.concat([part.drop(columns="_text").reset_index(drop=True), out], axis=1)

    named = docs.select(*keep, F.col(text).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema[:-1])
    return named.mapInPandas(run, f"{kinds}, {FOUND}")


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    containment: float = CONTAINMENT,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, n_words, n_hit, item_ids, spans) of each document row.

    ``item_ids`` are the ids, as strings in order, of items with a window in the
    document; ``spans`` the word ranges that windows cover, ``n_hit`` their words.

    Null and empty texts and texts without words have no words, as document
    and as item. A null doc_id is a row like any other, repeated rows are
    rows of their own. Item rows that share an id, or have none, are one
    item; the one without id is a null at the end of the list. Other columns do
    not matter, whatever their names. No items leave every document clean; no documents give no row.
    """
    id_type = docs.schema[doc_id].dataType
    # as text: a null would turn the numbers of its batch into doubles
    docs = docs.select(
        F.col(f"`{doc_id}`").cast("string").alias("doc_id"), F.col(f"`{text}`").alias("text")
    )
    items = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").alias("text"))
    chunks = materialize(item_chunks(items, "item_id", "text", window), "leak-items")
    size = chunks.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    chunks = chunks.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(n_blocks)))

    def index_of(block: int) -> Index:
        # about block_bytes, whatever the items' number
        rows = chunks.where(F.col("block") == block).select("item", "words").collect()
        made = Index([(r["item"], r["words"]) for r in rows], window, shingle)
        made.keep_prefixes(count_shingles(docs, "text", made), containment)
        return made

    if n_blocks == 1:
        found = found_by(docs, "text", index_of(0), containment, ["doc_id"])
        return found.withColumn("doc_id", F.col("doc_id").cast(id_type))

    # finds depend on the text alone: they meet by its hash
    hashed = docs.withColumn("hash", F.sha2(F.coalesce("text", F.lit("")), 256))
    finds = None
    for block in range(n_blocks):
        part = found_by(hashed, "text", index_of(block), containment, ["hash"])
        part = part.where("n_hit > 0").withColumn("block", F.lit(block)).dropDuplicates(["hash"])
        finds = part if finds is None else finds.unionByName(part)

    def join_finds(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            spans = [merged(np.array([(s["first"], s["last"]) for s in row])) for row in part["spans"]]
            part["n_hit"] = [sum(b - a + 1 for a, b in row) for row in spans]
            part["spans"] = [[{"first": a, "last": b} for a, b in row] for row in spans]
            yield part

    # a text has a row a block at most; nulls sort last, as from one block
    per_text = finds.groupBy("hash").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
    )
    joined = per_text.mapInPandas(
        join_finds,
        "hash string, spans array<struct<first:long,last:long>>, item_ids array<string>, n_hit long",
    )
    joined = materialize(joined, "leak-finds")
    empty = Index([], window, shingle)
    counted = found_by(hashed, "text", empty, containment, ["doc_id", "hash"])
    return (
        counted.select("doc_id", "hash", "n_words")
        .join(joined, "hash", "left")
        .select(
            F.col("doc_id").cast(id_type).alias("doc_id"),
            "n_words",
            F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
            F.coalesce(
                "spans", F.array().cast("array<struct<first:bigint,last:bigint>>")
            ).alias("spans"),
        )
    )


def items_digest(item_ids) -> F.Column:
    """sha256 of the ids, comma-joined in their order; nulls are left out."""
    return F.sha2(F.concat_ws(",", item_ids), 256)
