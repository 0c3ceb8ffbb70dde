"""Seeded hash that replaces a random generator.

The value depends on the key alone, so a sample or a fold does not change with the number of
partitions, the cluster size or a retried task.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SEED = 42
HASH_BITS = 60


def seeded_hash(key: Column, seed: int = SEED) -> Column:
    """Non-negative 60-bit number from the md5 of `seed:key`."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def hash_bucket(hashed: Column, bits: int) -> Column:
    """Leading bits of a seeded hash: buckets are equally full and follow the hash order."""
    return F.shiftright(hashed, HASH_BITS - bits)
