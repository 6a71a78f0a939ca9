"""Train / test and fold assignment that does not depend on file layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from faultline.functions.hashing import HEX_DIGITS, hash_below, key_hash
from faultline.storage import materialize

# hex digits by which a bucket is divided: into 65536 buckets
BUCKET_DIGITS = 4

# rows of a bucket that one task may order
FEW = 100_000


def hash_split(
    df: DataFrame, key: str, test_fraction: float = 0.2, seed: int = 42, out: str = "is_test"
) -> DataFrame:
    """Independent assignment per row; row-local, no shuffle."""
    return df.withColumn(out, hash_below(key, seed, test_fraction))


def cut_buckets(hashed: DataFrame, cumulative: Sequence[float]) -> tuple[DataFrame, int]:
    """The bucket that holds each cut of each class, and the digits that name it.

    Rows (_y, _cut, _bucket, _need, _n): the cut is the ``_need``-th of the
    bucket's ``_n`` rows; a cut in front of all rows has ``_need`` 0.
    """
    digits = BUCKET_DIGITS
    # at most classes x 65536 rows
    sizes = hashed.groupBy("_y", F.substring("_hash", 1, digits).alias("_bucket")).agg(
        F.count("*").alias("_n")
    )
    of_class = Window.partitionBy("_y")
    upto = F.sum("_n").over(of_class.orderBy("_bucket"))
    sized = sizes.select(
        "_y",
        "_bucket",
        "_n",
        (upto - F.col("_n")).alias("_before"),
        upto.alias("_upto"),
        F.sum("_n").over(of_class).alias("_class_rows"),
    )
    # a select of its own: in one select Spark would explode before the windows
    shares = F.array(
        *[
            F.struct(F.lit(i).alias("_cut"), F.lit(share).alias("_share"))
            for i, share in enumerate(cumulative)
        ]
    )
    sized = sized.select("*", F.inline(shares))
    quota = F.floor(F.col("_class_rows") * F.col("_share") + F.lit(0.5))
    holds_cut = (F.col("_before") < quota) & (quota <= F.col("_upto"))
    empty_part = (quota == 0) & (F.col("_before") == 0)
    edges = sized.filter(holds_cut | empty_part).select(
        "_y", "_cut", "_bucket", (quota - F.col("_before")).alias("_need"), "_n"
    )
    # one row per class and cut; written, so the joins with it know its real size
    edges = materialize(edges, "split-edges")
    while digits < HEX_DIGITS:
        most = edges.filter("_need > 0").agg(F.max("_n")).first()[0] or 0
        if most <= FEW:
            break
        divided = divided_buckets(hashed, edges.filter("_need > 0"), digits)
        edges = materialize(divided.unionByName(edges.filter("_need = 0")), "split-edges")
        digits += BUCKET_DIGITS
    return edges, digits


def divided_buckets(hashed: DataFrame, edges: DataFrame, digits: int) -> DataFrame:
    """``edges`` with buckets of ``BUCKET_DIGITS`` more digits."""
    inside = (
        hashed.withColumn("_prefix", F.substring("_hash", 1, digits))
        .alias("h")
        .join(
            edges.drop("_n").alias("e"),
            F.col("h._y").eqNullSafe(F.col("e._y")) & (F.col("h._prefix") == F.col("e._bucket")),
        )
    )
    sizes = inside.groupBy(
        "e._y", "e._cut", "e._need", F.substring("h._hash", 1, digits + BUCKET_DIGITS).alias("_bucket")
    ).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_y", "_cut").orderBy("_bucket"))
    return (
        sizes.withColumn("_upto", upto)
        .filter((F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("_n") < F.col("_need")))
        .select(
            "_y", "_cut", "_bucket", (F.col("_need") - F.col("_upto") + F.col("_n")).alias("_need"), "_n"
        )
    )


def stratified_parts(
    df: DataFrame,
    label: str,
    key: str,
    fractions: Sequence[float],
    seed: int = 42,
    out: str = "part",
) -> DataFrame:
    """Split every class into consecutive parts with exact quotas.

    Within a class, rows are ordered by ``(hash(seed:key), key)``. Part i ends
    at row round(n_class * cumulative fraction i). Only the cut rows are
    searched, not the whole order: a histogram over hash prefixes finds the
    bucket holding each cut, further digits divide it until it has at most
    ``FEW`` rows, and those alone are ordered. The data is never shuffled,
    however unequal the classes are; each division is a scan of label and key.
    Rows that share a key always share a part.
    """
    cumulative, total = [], 0.0
    for fraction in fractions:
        total += fraction
        cumulative.append(total)
    hashed = df.select(
        F.col(label).alias("_y"), F.col(key).alias("_key"), key_hash(key, seed).alias("_hash")
    )
    edges, digits = cut_buckets(hashed, cumulative)
    hashed = hashed.withColumn("_bucket", F.substring("_hash", 1, digits))

    reached = F.sum("_n").over(Window.partitionBy("_y", "_cut").orderBy("_hash", "_key"))
    at_cut = (
        hashed.alias("h")
        .join(
            edges.filter("_need > 0").alias("e"),
            F.col("h._y").eqNullSafe(F.col("e._y")) & (F.col("h._bucket") == F.col("e._bucket")),
        )
        # rows of a repeated key cannot be told apart: counted before they are ordered
        .groupBy("e._y", "e._cut", "e._need", "h._hash", "h._key")
        .agg(F.count("*").alias("_n"))
        .withColumn("_reached", reached)
        .filter("_reached >= _need and _reached - _n < _need")
        .select("_y", "_cut", "_hash", "_key")
    )
    before_all = edges.filter("_need = 0").select(
        "_y",
        "_cut",
        F.lit("").alias("_hash"),  # below every hash
        F.lit(None).cast(hashed.schema["_key"].dataType).alias("_key"),
    )
    numbers = range(len(cumulative))
    cuts = materialize(
        at_cut.unionByName(before_all)
        .groupBy(F.col("_y").alias("_cut_y"))
        .agg(
            *[F.max(F.when(F.col("_cut") == i, F.col("_hash"))).alias(f"_hash_{i}") for i in numbers],
            *[F.max(F.when(F.col("_cut") == i, F.col("_key"))).alias(f"_key_{i}") for i in numbers],
        ),
        "split-cuts",
    )

    def after(i: int):
        """1 for rows behind cut i of their class."""
        mine, cut = F.col("_row_hash"), F.col(f"_hash_{i}")
        behind = (mine > cut) | ((mine == cut) & (F.col(key) > F.col(f"_key_{i}")))
        return F.when(behind, 1).otherwise(0)

    return (
        df.withColumn("_row_hash", key_hash(key, seed))
        .join(cuts, F.col(label).eqNullSafe(F.col("_cut_y")), "left")
        .withColumn(out, sum((after(i) for i in numbers), F.lit(0)))
        .select(*df.columns, out)
    )


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    test_fraction: float = 0.2,
    seed: int = 42,
    out: str = "is_test",
) -> DataFrame:
    """Exact per-class test quota round(n_class * test_fraction)."""
    parts = stratified_parts(df, label, key, [test_fraction], seed, "_part")
    return parts.withColumn(out, F.col("_part") == 0).drop("_part")


def stratified_folds(
    df: DataFrame, label: str, key: str, folds: int = 3, seed: int = 42, out: str = "fold"
) -> DataFrame:
    """Fold number 0..folds-1 with equal class shares in each fold."""
    return stratified_parts(df, label, key, [1.0 / folds] * (folds - 1), seed, out)


def split_frames(df: DataFrame, flag: str = "is_test") -> tuple[DataFrame, DataFrame]:
    """(train, test) frames; raises when either is empty."""
    return split_counted(df, flag)[:2]


def split_counted(
    df: DataFrame, flag: str = "is_test"
) -> tuple[DataFrame, DataFrame, int, int]:
    """(train, test, train rows, test rows), both counted in one scan."""
    sides = df.agg(
        F.count_if(~F.col(flag)).alias("train"), F.count_if(F.col(flag)).alias("test")
    ).first()
    if not sides["train"] or not sides["test"]:
        raise ValueError("train or test part is empty")
    train, test = df.filter(~F.col(flag)).drop(flag), df.filter(F.col(flag)).drop(flag)
    return train, test, sides["train"], sides["test"]
