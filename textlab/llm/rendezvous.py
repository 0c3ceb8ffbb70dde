"""Shards by rendezvous hashing, with built-in functions only.

Each shard has a weight. A record's score for a shard is weight / -ln(u), where u is in (0, 1) and comes from the
XXH64 (seed 42) of the text `shard:key`. The shard with the highest score takes the record, the smaller number at a
tie. A score depends on key and shard alone: one more shard takes records into itself and moves no others, and a
change of one weight moves records only to or from that shard.

Equal keys go to one shard, equal texts under different keys need not: the key decides. A null key is the text
`null`. A null text has size 8 and the checksum of no bytes. Slots number the rows of a shard without gaps, from 0:
rows are counted in buckets of the hash and ranked inside a bucket only, so no task gets a whole shard. Rows
given twice get a slot each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_UNIT = float(1 << 53)


def score(key: Column, shard: int, weight: float) -> Column:
    hashed = F.xxhash64(F.concat(F.lit(f"{shard}:"), key))
    unit = (F.shiftrightunsigned(hashed, 11).cast("double") + 0.5) / F.lit(_UNIT)
    return F.lit(float(weight)) / -F.log(unit)


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard with the highest score; a weight of 0 takes nothing."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    candidates = [F.struct(score(text, i, w).alias("score"), F.lit(-i).alias("shard")) for i, w in enumerate(weights) if w > 0]
    if not candidates:
        raise ValueError("no shard has a weight")
    best = candidates[0] if len(candidates) == 1 else F.greatest(*candidates)
    return -best["shard"]


def with_slots(rows: DataFrame, shard: str, key: str, rows_per_bucket: int = 100_000) -> DataFrame:
    """Add `slot`: the position in the shard, by bucket of the key's hash, then by hash and key."""
    total = rows.count()
    buckets = max(1, -(-total // rows_per_bucket))
    placed = rows.withColumn("_hash", F.xxhash64(F.lit("slot"), F.col(key))).withColumn("_bucket", F.pmod("_hash", F.lit(buckets)))
    counts = placed.groupBy(shard, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    ranked = placed.withColumn("_rank", F.row_number().over(Window.partitionBy(shard, "_bucket").orderBy("_hash", key)) - 1)
    return ranked.join(offsets, [shard, "_bucket"]).withColumn("slot", F.col("_before") + F.col("_rank")).drop("_hash", "_bucket", "_before", "_rank")


def sharded(
    documents: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text", grown: Sequence[float] | None = None
) -> DataFrame:
    """`(key, size, text_crc32, shard, slot)` and, for other weights, `grown_shard`."""
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    columns = [
        F.col(f"`{key}`").alias("_key"),
        (F.octet_length(content) + 8).cast("bigint").alias("size"),
        F.crc32(content).alias("text_crc32"),
        shard_of(F.col(f"`{key}`"), weights).cast("int").alias("shard"),
        (shard_of(F.col(f"`{key}`"), grown).cast("int") if grown else F.lit(None).cast("int")).alias("grown_shard"),
    ]
    return with_slots(documents.select(*columns), "shard", "_key").withColumnRenamed("_key", key)
