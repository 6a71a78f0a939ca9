"""Token ids of documents in files compressed by a pair grammar.

A file is a table of blocks. A block holds the ids of some documents in a
row as a Re-Pair grammar: frequent pairs of symbols are replaced by a new
symbol, again and again, and the rules are stored with the number of ids each
one expands to. No rule goes on behind an end id, so every document begins at
a symbol of its own and can be decoded without its neighbours.

``payload`` of a block, all little endian:

    8 bytes   magic b"PAIRGRM1"
    5 x u32   documents, rules, symbols, base (rule r is symbol base + r),
              width of a stored symbol in bytes (2 or 4)
    u32[]     left and right symbol of each rule, in turn
    u32[]     number of ids each rule expands to
    u32[]     ids of each document
    u32[]     first symbol of each document
    u16/u32[] symbols
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import count
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm.common import new_path, partitions, ship

ship(__name__)

MAGIC = b"PAIRGRM1"
END_ID = 1
BLOCK_IDS = 1 << 20
#: Rounds of a block; None: until no pair reaches the least count.
ROUNDS = None
RULES_PER_ROUND = 4096
LEAST_COUNT = 32
#: Words whose ids a Python worker remembers from task to task (about 200 bytes each).
CACHE_WORDS = 1_400_000
#: Documents whose new words are encoded together.
TOGETHER = 256
SLOT_BITS = 16
#: Steps of a normaliser that change no lower-case Latin letters parted by single blanks.
SPARE_LETTERS = (
    {"type": "NFC"},
    {"type": "Lowercase"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
)

BLOCKS = (
    "shard int, block int, n_docs int, n_tokens long, tokens_before long, "
    "doc_ids array<long>, payload binary"
)


# -- grammar ----------------------------------------------------------------


def compress(
    ids: np.ndarray, end_id: int = END_ID, rounds: int | None = ROUNDS
) -> tuple[np.ndarray, np.ndarray, int]:
    """(symbols, rules as rows of two symbols, base) of one block.

    Each round counts the pairs, makes rules of the most frequent ones that
    occur at least LEAST_COUNT times and replaces their occurrences from left
    to right. Pairs that overlap wait for the next round. It ends when no pair
    occurs so often, or after ``rounds``.

    A pair that occurs too seldom never becomes frequent again, as new places
    hold new symbols. So a round looks only at the places that the last one
    left frequent and at those beside what it replaced.
    """
    symbols = ids.astype(np.uint32)
    base = int(symbols.max()) + 1 if len(symbols) else 0
    rules: list[np.ndarray] = []
    made = 0
    #: Symbols whose last id ends a document; no pair starts with one.
    last = np.arange(base) == end_id
    live = np.flatnonzero(~last[symbols[:-1]])
    for turn in count() if rounds is None else range(rounds):
        if len(live) < LEAST_COUNT:
            break
        left, right = symbols[live], symbols[live + 1]
        # pairs are counted by slot; in each slot one pair stands for it, and
        # pairs that share its slot have their chance under the next round's hash
        slot = (left * np.uint32(2654435761 + 2 * turn)) ^ (right * np.uint32(2246822519))
        slot >>= np.uint32(32 - SLOT_BITS)
        slot = slot.astype(np.int64)
        counts = np.bincount(slot, minlength=1 << SLOT_BITS)
        frequent = hot = counts >= LEAST_COUNT
        n_frequent = np.count_nonzero(frequent)
        if not n_frequent:
            break
        often = np.flatnonzero(frequent[slot])
        likely = 2 * RULES_PER_ROUND
        if n_frequent > likely:
            hot = np.zeros(1 << SLOT_BITS, bool)
            hot[np.argpartition(counts, -likely)[-likely:]] = True
        chosen = np.flatnonzero(hot[slot])
        at, place = live[chosen], slot[chosen]
        keys = (left[chosen].astype(np.uint64) << np.uint64(32)) | right[chosen]
        pair_of = np.zeros(1 << SLOT_BITS, np.uint64)
        pair_of[place] = keys
        same = pair_of[place] == keys
        at, place = at[same], place[same]
        n = np.bincount(place, minlength=1 << SLOT_BITS)
        order = np.flatnonzero(n >= LEAST_COUNT)
        order = order[np.argsort(-n[order], kind="stable")][:RULES_PER_ROUND]
        if not len(order):
            # no pair that stands for its slot; the others are counted one by one
            at = live[often]
            keys = (left[often].astype(np.uint64) << np.uint64(32)) | right[often]
            pair_of, place, n = np.unique(keys, return_inverse=True, return_counts=True)
            order = np.flatnonzero(n >= LEAST_COUNT)
            order = order[np.argsort(-n[order], kind="stable")][:RULES_PER_ROUND]
            if not len(order):
                break
        number = np.full(len(pair_of), -1, np.int64)
        number[order] = np.arange(len(order))
        rule = number[place]
        at, rule = at[rule >= 0], rule[rule >= 0]
        # every second position of a run of overlapping occurrences
        starts = np.r_[True, np.diff(at) != 1]
        run = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
        taken = (np.arange(len(at)) - run) % 2 == 0
        at, rule = at[taken], rule[taken]
        symbols[at] = (base + made + rule).astype(np.uint32)
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        look = np.zeros(len(symbols), bool)
        look[live[often]] = look[at] = look[np.maximum(at - 1, 0)] = True
        symbols, look = symbols[keep], look[keep]
        pairs = pair_of[order]
        last = np.r_[last, last[pairs & np.uint64(0xFFFFFFFF)]]
        live = np.flatnonzero(look[:-1])
        live = live[~last[symbols[live]]]
        rules.append(
            np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
        )
        made += len(order)
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    return symbols, table, base


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Ids that each rule stands for; a rule only uses earlier ones."""
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((out[a - base] if a >= base else 1) + (out[b - base] if b >= base else 1))
    return np.array(out, np.uint32)


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """The ids behind ``symbols``; rules that they do not reach are not expanded.

    Each step replaces all rules of the row by their two sides, and the stored
    lengths say where a rule's right side begins; a row of ids is filled, so
    the cost grows with the ids wanted and the depth of their rules.
    """
    symbols = symbols.astype(np.int64)
    size = np.ones(len(symbols), np.int64)
    is_rule = symbols >= base
    size[is_rule] = lengths[symbols[is_rule] - base]
    at = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint32)
    while len(symbols):
        plain = symbols < base
        out[at[plain]] = symbols[plain]
        at, used = at[~plain], symbols[~plain] - base
        left, right = rules[used, 0].astype(np.int64), rules[used, 1].astype(np.int64)
        ahead = np.ones(len(left), np.int64)
        deep = left >= base
        ahead[deep] = lengths[left[deep] - base]
        symbols, at = np.r_[left, right], np.r_[at, at + ahead]
    return out


def pack(ids: np.ndarray, sizes: list[int], end_id: int = END_ID, rounds: int | None = ROUNDS) -> bytes:
    """The payload of documents with ``sizes`` ids each, ``ids`` in a row."""
    symbols, rules, base = compress(ids, end_id, rounds)
    lengths = expansion_lengths(rules, base)
    ids_of = np.ones(len(symbols), np.int64)
    ids_of[symbols >= base] = lengths[symbols[symbols >= base] - base]
    begins = np.cumsum(ids_of) - ids_of
    first = np.searchsorted(begins, np.cumsum(sizes) - np.array(sizes, np.int64))
    width = 2 if base + len(rules) <= 1 << 16 else 4
    head = MAGIC + struct.pack("<5I", len(sizes), len(rules), len(symbols), base, width)
    parts = [rules.astype("<u4"), lengths.astype("<u4"), np.array(sizes, "<u4"), first.astype("<u4")]
    return head + b"".join(x.tobytes() for x in parts) + symbols.astype(f"<u{width}").tobytes()


class Block:
    """A payload, opened for reading whole or by document."""

    def __init__(self, payload: bytes):
        if payload[:8] != MAGIC:
            raise ValueError("not a block of grammar-compressed ids")
        docs, rules, symbols, self.base, width = struct.unpack_from("<5I", payload, 8)
        at = 28

        def take(n: int, kind: str) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        self.rules = take(2 * rules, "<u4").reshape(-1, 2)
        self.lengths = take(rules, "<u4")
        self.sizes = take(docs, "<u4").astype(np.int64)
        self.first = take(docs, "<u4").astype(np.int64)
        self.symbols = take(symbols, f"<u{width}")

    def all_ids(self) -> np.ndarray:
        return expand(self.symbols, self.rules, self.lengths, self.base)

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document, from its own symbols alone."""
        end = self.first[i + 1] if i + 1 < len(self.first) else len(self.symbols)
        return expand(self.symbols[self.first[i] : end], self.rules, self.lengths, self.base)


# -- encoding ---------------------------------------------------------------


class WordIds(dict):
    """Ids of each chunk between ASCII white space, as u32 bytes.

    The tokenizer drops white space, and its normaliser and splitter never
    join what white space parts, so a text's ids are those of its chunks in a
    row. A chunk of Latin letters with one mark at its end is two pieces for
    the tokenizer, and case is folded, so those share their entry. The
    tokenizer's ``added`` tokens are found by their case, before it is folded,
    so a chunk that holds one in any case stays as it is.

    Pieces of lower-case Latin letters alone go to ``encode_letters``, if there
    is one, and all others to ``encode``.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], list[bytes]],
        added: Iterable[str] = (),
        limit: int = CACHE_WORDS,
        encode_letters: Callable[[list[str]], list[bytes]] | None = None,
    ):
        super().__init__()
        self.encode, self.limit = encode, limit
        self.encode_letters = encode_letters or encode
        added = [token.lower() for token in added]
        #: What every added token begins with; no word holds it if there are none.
        self.mark = os.path.commonprefix(added) if added else "\n"

    def learn(self, chunks: set[bytes]) -> None:
        """Make sure that all ``chunks`` are known."""
        if len(self) > self.limit:
            self.clear()
        # a set's difference with a dict of another class goes through that whole dict
        new = [chunk for chunk in chunks if chunk not in self]
        if not new:
            return
        letters: dict[str, bytes] = {}
        others: dict[str, bytes] = {}
        #: Chunks that are not a piece themselves, with the one or two that they stand for.
        words: list[tuple[bytes, str]] = []
        marked: list[tuple[bytes, str, str]] = []
        # no chunk holds a line feed
        for chunk, text in zip(new, b"\n".join(new).decode().split("\n"), strict=True):
            if text.isascii() or max(text) < "Ā":
                folded = text.lower()
                if self.mark in folded:
                    others[text] = b""
                elif folded.isalpha():
                    letters[folded] = b""
                    if folded != text:
                        words.append((chunk, folded))
                elif folded[-1] in ".,!?" and folded[:-1].isalpha():
                    letters[folded[:-1]] = others[folded[-1]] = b""
                    marked.append((chunk, folded[:-1], folded[-1]))
                else:
                    others[folded] = b""
                    if folded != text:
                        words.append((chunk, folded))
            else:
                others[text] = b""
        for pieces, encode in ((letters, self.encode_letters), (others, self.encode)):
            unseen = []
            for word in pieces:
                known = self.get(word.encode())
                if known is None:
                    unseen.append(word)
                else:
                    pieces[word] = known
            for word, ids in zip(unseen, encode(unseen), strict=True):
                pieces[word] = self[word.encode()] = ids
        for chunk, word in words:
            self[chunk] = letters[word] if word in letters else others[word]
        for chunk, word, mark in marked:
            self[chunk] = letters[word] + others[mark]


def word_ids(tokenizer_file: str) -> WordIds:
    """Ids of words, as u32 bytes, from one call for all new ones together.

    The words are encoded with blanks between them and parted by the offsets
    of their ids. Words of lower-case Latin letters alone are one piece each for
    the tokenizer, so where its model marks the last id of a piece they are
    parted by that mark, and no offsets are asked for. A normaliser that leaves
    such letters as they are is not asked either.
    """
    # a call holds one text, so threads for several have nothing to do
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file)

    def encode(words: list[str]) -> list[bytes]:
        if not words:
            return []
        found = tokenizer.encode(" ".join(words), add_special_tokens=False)
        ids = np.array(found.ids, "<u4").tobytes()
        begins = np.cumsum([0] + [len(w) + 1 for w in words])
        starts = list(map(itemgetter(0), found.offsets))
        edges = (4 * np.searchsorted(starts, begins)).tolist()
        return [ids[a:b] for a, b in zip(edges, edges[1:], strict=False)]

    config = json.loads(tokenizer.to_str())
    suffix = config["model"].get("end_of_word_suffix")
    vocab = tokenizer.get_vocab()
    is_last = np.zeros(max(vocab.values()) + 1, bool)
    is_last[[i for token, i in vocab.items() if suffix and token.endswith(suffix)]] = True

    of_letters = Tokenizer.from_file(tokenizer_file)
    steps = config["normalizer"] or {}
    if all(step in SPARE_LETTERS for step in steps.get("normalizers", [steps])):
        of_letters.normalizer = None

    def encode_letters(words: list[str]) -> list[bytes]:
        if not words:
            return []
        (found,) = of_letters.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        ends = np.flatnonzero(is_last[ids]) + 1
        # each word must end with a mark of its own, and nothing may follow the last
        if len(ends) != len(words) or ends[-1] != len(ids):
            return encode(words)
        edges = [0, *(4 * ends).tolist()]
        row = ids.tobytes()
        return [row[a:b] for a, b in zip(edges, edges[1:], strict=False)]

    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    return WordIds(encode, added, encode_letters=encode_letters if suffix else None)


def blocks_of(
    parts: Iterable[pd.DataFrame], ids_of_word: WordIds, end_id: int, block_ids: int, rounds: int | None
) -> Iterator[pd.DataFrame]:
    """Rows of BLOCKS for the documents of one shard, in their order."""
    end = np.array([end_id], "<u4").tobytes()
    docs: list = []
    sizes: list[int] = []
    held: list[bytes] = []
    shard = block = before = total = 0

    def flush() -> pd.DataFrame:
        nonlocal block, before, total
        ids = np.frombuffer(b"".join(held), "<u4")
        row = {
            "shard": shard,
            "block": block,
            "n_docs": len(docs),
            "n_tokens": total,
            "tokens_before": before,
            "doc_ids": list(docs),
            "payload": pack(ids, sizes, end_id, rounds),
        }
        block, before, total = block + 1, before + total, 0
        docs.clear(), sizes.clear(), held.clear()
        return pd.DataFrame([row])

    for part in (x.iloc[i : i + TOGETHER] for x in parts for i in range(0, len(x), TOGETHER)):
        chunks = [(text or "").encode().split() for text in part["text"]]
        ids_of_word.learn(set().union(*chunks))
        for shard, doc, words in zip(part["shard"], part["doc_id"], chunks, strict=True):
            ids = b"".join(map(ids_of_word.__getitem__, words)) + end
            docs.append(None if doc is None or doc != doc else int(doc))
            sizes.append(len(ids) // 4)
            held.append(ids)
            total += sizes[-1]
            if total >= block_ids:
                yield flush()
    if docs:
        yield flush()


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
    rounds: int | None = ROUNDS,
) -> None:
    """Encode ``text`` of every document and write the blocks below ``path``.

    Documents lie in ascending (doc_id, text), null ids first; one file per
    sort partition. Null text is an empty document: just the end id. Repeated
    rows are encoded as often as they occur; other columns are not read; an
    empty table writes no block. A block ends with the document that fills
    it, so a document is never cut.
    """
    spark = docs.sparkSession
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(partitions(spark), "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .withColumn("shard", F.spark_partition_id())
    )

    # a worker's own copy of the broadcast keeps its word table between tasks
    kept = spark.sparkContext.broadcast({})

    def encode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if "words" not in kept.value:
            kept.value["words"] = word_ids(tokenizer_file)
        words = kept.value["words"]
        return blocks_of(
            (x.astype({"doc_id": object}) for x in parts), words, end_id, block_ids, rounds
        )

    ordered.mapInPandas(encode, BLOCKS).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path)


def decode_documents(blocks: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, start of every document in the files.

    ``start`` counts the ids of all documents before it: those in earlier
    shards (one row per shard), in earlier blocks of its shard (stored) and
    before it in its block.
    """

    def decode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for shard, before, ids, payload in zip(
                part["shard"], part["tokens_before"], part["doc_ids"], part["payload"], strict=True
            ):
                block = Block(payload)
                tokens = block.all_ids().astype("<u4")
                ends = np.cumsum(block.sizes)
                yield pd.DataFrame(
                    {
                        "shard": np.full(len(ends), shard, np.int32),
                        "doc_id": pd.array(
                            [None if x is None or x != x else int(x) for x in ids], "Int64"
                        ),
                        "begin": before + ends - block.sizes,
                        "n_tokens": block.sizes,
                        "ids_crc32": np.array(
                            [
                                zlib.crc32(tokens[b:e])
                                for b, e in zip(ends - block.sizes, ends, strict=True)
                            ],
                            np.int64,
                        ),
                    }
                )

    found = blocks.select("shard", "tokens_before", "doc_ids", "payload").mapInPandas(
        decode, "shard int, doc_id long, begin long, n_tokens long, ids_crc32 long"
    )
    # one row per shard: as many as sort partitions
    starts = (
        blocks.groupBy("shard")
        .agg(F.sum("n_tokens").alias("n"))
        .selectExpr("shard", "sum(n) over (order by shard) - n as shard_start")
    )
    return found.join(F.broadcast(starts), "shard").select(
        "doc_id",
        (F.col("shard_start") + F.col("begin")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def token_ids(docs: DataFrame, tokenizer_file: str, path: str | None = None) -> DataFrame:
    """Write the files of all documents and read them back, one row each."""
    spark = docs.sparkSession
    path = path or new_path(spark, "token-files")
    write_token_files(docs, path, tokenizer_file)
    return decode_documents(read_blocks(spark, path))
