"""Layout-independent pseudo-random order derived from a row key.

``randomSplit`` and ``rand`` depend on how rows fall into partitions; a hash of
``seed:key`` gives the same answer on any cluster and in any file layout. The
hash stays the hex text of md5: text of one length compares like the number it
spells, so no conversion is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HEX_DIGITS = 32


def key_hash(key, seed: int) -> Column:
    """Uniform 32-digit hex text from a seed and a key column.

    A missing key hashes like an empty text, so every row has a hash.
    """
    key = F.col(key) if isinstance(key, str) else key
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), text).cast("binary"))


def hash_below(key, seed: int, fraction: float) -> Column:
    """True for the given fraction of all keys."""
    if fraction >= 1.0:
        return F.lit(True)
    bound = format(int(fraction * 16**HEX_DIGITS), f"0{HEX_DIGITS}x")
    return key_hash(key, seed) < F.lit(bound)
