"""Reproducible orders, folds and samples.

All of them are functions of the key alone, so partitioning, retries and recomputation
cannot change a result, as they can with rand() or sample().
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_hash(key: Column, method: str = "xxhash64") -> Column:
    """Pseudo-random sort value of a key."""
    text = key.cast("string")
    return F.md5(text) if method == "md5" else F.xxhash64(text)


def order_slice(hashed: Column, method: str = "xxhash64") -> Column:
    """One of 4,096 consecutive ranges of the hash order; slices sort as their hashes do."""
    return F.substring(hashed, 1, 3) if method == "md5" else F.shiftright(hashed, 52)


def hash_bucket(key: Column, buckets: int, seed: int, method: str = "xxhash64") -> Column:
    """Uniform bucket 0..buckets-1 of a key."""
    text = key.cast("string")
    if method == "md5":
        digest = F.md5(F.concat(text, F.lit(f":{seed}")))
        number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    else:
        number = F.xxhash64(text, F.lit(seed))
    return F.pmod(number, F.lit(buckets)).cast("int")


def sampled(key: Column, fraction: float, seed: int, method: str = "xxhash64") -> Column:
    """Keep a key with probability `fraction`, to the full width of the hash (60 bits)."""
    text = key.cast("string")
    if method == "md5":
        digest = F.md5(F.concat(text, F.lit(f":{seed}")))
        number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    else:
        number = F.shiftrightunsigned(F.xxhash64(text, F.lit(seed)), 4)
    return number < F.lit(int(fraction * 2**60))
