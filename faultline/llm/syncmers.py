"""Document fingerprints of closed syncmers.

The units of a text are its words, and each character of scripts that part
no words by blanks; a text with fewer than FEW_WORDS units is taken by its
characters. A k-mer is K units in a row; it is a closed syncmer if the
smallest of its inner S-mers (by hash) is the first or the last. Whether a
k-mer is chosen depends on its own units alone, so an edit only changes the
anchors it touches, and two texts that share a passage share the anchors
inside it, with the distance between them.

The fingerprint is every anchor in order, its position and hash in eight hex
digits each. Two fingerprints are compared by steps: an anchor, the distance
to the next one, and that one. A step in both texts is two anchors that match
at one offset, so a shared passage counts wherever it lies, and anchors that
agree by chance do not. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from faultline.llm.common import bind, partitions

K = 4
S = 1
#: Texts with fewer units than this are taken by characters.
FEW_WORDS = 16
#: Characters of scripts that part no words by blanks.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
#: Bits of a packed anchor that hold its hash.
HASH_BITS = 32
#: Range buckets for each shuffle partition, so that a bucket stays small.
BUCKETS_PER_PARTITION = 4


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def character_hashes(text: Column) -> Column:
    """Hashes of all characters but white space."""
    marks = F.split(F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", ""), "")
    return F.transform(F.filter(marks, lambda c: c != ""), lambda c: F.xxhash64(c))


def parted(text: Column) -> Column:
    """``text`` with blanks around each character of unspaced scripts."""
    # such characters have three bytes or more
    return F.when(
        F.octet_length(text) > F.length(text) + 1,
        F.regexp_replace(text, f"({UNSPACED})", " $1 "),
    ).otherwise(text)


def few_words(text: Column) -> Column:
    """Whether a text is taken by its characters."""
    trimmed = F.trim(parted(text), F.lit(" \t\n\x0b\f\r"))
    return F.size(F.split(trimmed, "[\\x20\\x09-\\x0D]+", FEW_WORDS)) < FEW_WORDS


def anchors(text: Column, k: int = K, s: int = S, by_characters: bool = False) -> Column:
    """Array of (pos, hash) of a text's closed syncmers, pos in units.

    A text in which no k-mer is one is a single anchor; without words there is
    none (null and empty alike). ``by_characters`` takes any text so.
    """

    def of(h: Column) -> Column:
        n = F.size(h)
        smer = (
            (lambda i: F.get(h, i))
            if s == 1
            else (lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(s)]))
        )
        inner = lambda i: [smer(i + j) for j in range(k - s + 1)]

        def closed(i: Column) -> Column:
            first, *middle, last = inner(i)
            if not middle:
                return F.lit(True)
            return F.least(first, last) <= F.least(*middle) if len(middle) > 1 else (
                F.least(first, last) <= middle[0]
            )

        starts = F.filter(F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))), closed)
        chosen = F.transform(
            starts,
            lambda i: F.struct(
                i.alias("pos"), F.xxhash64(*[F.get(h, i + j) for j in range(k)]).alias("hash")
            ),
        )
        whole = F.transform(
            F.array(F.lit(0)),
            lambda i: F.struct(
                i.alias("pos"),
                F.aggregate(h, F.lit(0).cast("long"), lambda a, x: F.xxhash64(a, x)).alias("hash"),
            ),
        )
        return F.when(n == 0, F.slice(whole, 1, 0)).when(n < k, whole).otherwise(
            bind(chosen, lambda c: F.when(F.size(c) > 0, c).otherwise(whole))
        )

    read = F.coalesce(text, F.lit(""))
    if by_characters:
        return bind(character_hashes(read), of)
    units = bind(
        word_hashes(parted(read)),
        lambda h: F.when(F.size(h) < FEW_WORDS, character_hashes(read)).otherwise(h),
    )
    return bind(units, of)


def sketch(text: Column, k: int = K, s: int = S, by_characters: bool = False) -> Column:
    """The fingerprint as an array of numbers, position before hash, in order."""
    return F.transform(
        anchors(text, k, s, by_characters),
        lambda a: F.shiftleft(a["pos"].cast("long"), HASH_BITS)
        + F.shiftrightunsigned(a["hash"], 64 - HASH_BITS),
    )


def as_text(numbers: Column) -> Column:
    return F.lower(F.array_join(F.transform(numbers, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def hash_of(anchor: Column) -> Column:
    return anchor.bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def steps(numbers: Column) -> Column:
    """A number for each anchor but the last: its hash, the next one's, and their distance."""
    return bind(
        numbers,
        lambda x: F.transform(
            F.slice(x, F.lit(1), F.greatest(F.size(x) - 1, F.lit(0))),
            lambda a, i: F.xxhash64(hash_of(a), F.get(x, i + 1) - a + hash_of(a)),
        ),
    )


def matches(a: Column, b: Column) -> Column:
    """How many numbers of ``a`` have one of their own, equal, in ``b``."""
    tagged = F.concat(
        F.transform(a, lambda x: F.shiftleft(x, 1)),
        F.transform(b, lambda x: F.shiftleft(x, 1).bitwiseOR(F.lit(1).cast("long"))),
    )

    def step(s: Column, x: Column) -> Column:
        # those of a come first among equals
        free = F.when(F.shiftright(x, 1).eqNullSafe(s["last"]), s["free"]).otherwise(0)
        own = x.bitwiseAND(F.lit(1).cast("long")) == 0
        return F.struct(
            F.shiftright(x, 1).alias("last"),
            F.when(own, free + 1).otherwise(F.greatest(free - 1, F.lit(0))).alias("free"),
            F.when(~own & (free > 0), s["common"] + 1).otherwise(s["common"]).alias("common"),
        )

    start = F.struct(
        F.lit(None).cast("long").alias("last"), F.lit(0).alias("free"), F.lit(0).alias("common")
    )
    return F.aggregate(F.sort_array(tagged), start, step, lambda s: s["common"])


def likeness(a: Column, b: Column) -> Column:
    """Share of common steps, 0 to 1, as twice the common by the sum.

    A fingerprint with a single anchor has no step; then anchors are compared.
    Two empty ones are alike.
    """

    def of(x: Column, y: Column) -> Column:
        total = F.size(x) + F.size(y)
        return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * matches(x, y) / total)

    single = (F.size(a) < 2) | (F.size(b) < 2)
    terms = lambda x: F.when(single, F.transform(x, hash_of)).otherwise(steps(x))
    return bind(F.struct(terms(a).alias("a"), terms(b).alias("b")), lambda t: of(t["a"], t["b"]))


def bucket_bounds(docs: DataFrame, buckets: int) -> list[int]:
    """Ascending doc_ids that open the buckets; at most ``buckets`` numbers.

    Quantiles are doubles and may fall between ids, so a bucket opens with the
    smallest id that lies in it.
    """
    ids = docs.select(F.col("doc_id").cast("long"))
    found = ids.approxQuantile(
        "doc_id", [i / buckets for i in range(1, buckets)], 0.2 / buckets
    )
    rough = sorted({min(int(x), 2**63 - 1) for x in found})
    opens = ids.groupBy(bucket_of(F.col("doc_id"), rough).alias("bucket")).agg(F.min("doc_id").alias("least"))
    return sorted(r["least"] for r in opens.collect() if r["bucket"] and r["least"] is not None)


def bounds_array(bounds: list[int]) -> Column:
    """The bounds as one literal (folded before the query runs)."""
    return F.from_json(F.lit(str(bounds)), "array<bigint>")


def bucket_of(doc_id: Column, bounds: list[int]) -> Column:
    """Number of bounds at or below the id, by binary search; null ids: 0."""
    if not bounds:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    array = bounds_array(bounds)
    return F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda low, step: F.when(
            (low + step <= len(bounds)) & (F.get(array, low + step - 1) <= doc_id), low + step
        ).otherwise(low),
    )


def in_buckets(docs: DataFrame) -> DataFrame:
    """bucket, guest, doc_id, text: rows with their neighbours in id order.

    Rows are dealt once, to buckets of doc_id ranges. A bucket's first
    documents are guests (1) of the bucket before it as well, and the very
    first of all are guests (2) of the last bucket, so every row finds the
    next document in its own bucket. Null texts become empty.
    """
    spark = docs.sparkSession
    doc_id = F.col("doc_id")
    own = docs.select(doc_id.cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = bucket_bounds(docs, BUCKETS_PER_PARTITION * partitions(spark))
    low = own.agg(
        F.min("doc_id").alias("low"), F.count_if(doc_id.isNull()).alias("nulls")
    ).first()
    leads_all = doc_id.isNull() if low["nulls"] else doc_id == F.lit(low["low"])
    bucket = bucket_of(doc_id, bounds)
    leads = F.get(bounds_array(bounds), bucket - 1) == doc_id
    places = F.array_compact(
        F.array(
            F.struct(bucket.alias("bucket"), F.lit(0).alias("guest")),
            F.when(leads, F.struct((bucket - 1).alias("bucket"), F.lit(1).alias("guest"))),
            F.when(leads_all, F.struct(F.lit(len(bounds)).alias("bucket"), F.lit(2).alias("guest"))),
        )
    )
    return own.withColumn("_place", F.explode(places)).select("_place.*", "doc_id", "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts.

    The edited text has its last floor(n_chars / 2) code points replaced by
    the first as many of the next document's, in ascending (doc_id, text),
    null ids first, the first after the last. Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    Null text is empty; an empty text has an empty fingerprint, and two empty
    ones are alike (1.0). Where only one of a text and its edited text is taken
    by characters, both are for near_edited. Repeated rows follow each other, a
    single document follows itself, and an empty table gives no row.
    """
    order = W.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - half),
        F.substring("_next", F.lit(1), half),
    )
    marked = (
        in_buckets(docs)
        .withColumn("_next", F.coalesce(F.lead("text").over(order), F.lit("")))
        .withColumn("_edited", edited)
        .select(
            "bucket",
            "guest",
            "doc_id",
            "text",
            F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
            sketch(F.col("text")).alias("_own"),
            sketch(F.col("_edited")).alias("_theirs"),
            F.when(
                few_words(F.col("text")) != few_words(F.col("_edited")),
                F.struct(
                    sketch(F.col("text"), by_characters=True).alias("own"),
                    sketch(F.col("_edited"), by_characters=True).alias("theirs"),
                ),
            ).alias("_characters"),
        )
        .withColumn("_after", F.lead("_own").over(order))
    )
    return marked.where("guest = 0").select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "edited_sha256",
        as_text(F.col("_own")).alias("fingerprint"),
        as_text(F.col("_theirs")).alias("edited_fingerprint"),
        likeness(
            F.coalesce("_characters.own", "_own"), F.coalesce("_characters.theirs", "_theirs")
        ).alias("near_edited"),
        likeness(F.col("_own"), F.col("_after")).alias("near_next"),
    )
