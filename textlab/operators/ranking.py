"""Exact positions without a window over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from textlab.functions.hashing import SEED, hash_bucket, seeded_hash
from textlab.session import stage

BUCKET_BITS = 16
_POSITION_MASK = (1 << 33) - 1


def global_rank(df: DataFrame, keys: Sequence[str], out: str = "index") -> DataFrame:
    """0-based position of each row in the order of `keys`, which must be unique together.

    One range shuffle and one write; the write pins the range boundaries. What is broadcast
    afterwards has one row per range partition.
    """
    placed = stage(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK))),
        "ranked",
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_before") + F.col("_pos")).alias(out)
    )


def with_row_index(df: DataFrame, keys: Sequence[str], out: str = "index") -> DataFrame:
    """Stable 0-based row position over a unique key."""
    return global_rank(df, keys, out)


def hashed(df: DataFrame, key: str, seed: int = SEED, bits: int = BUCKET_BITS) -> DataFrame:
    """Add the seeded hash of `key` and its bucket."""
    return df.withColumn("_hash", seeded_hash(F.col(key), seed)).withColumn(
        "_bucket", hash_bucket(F.col("_hash"), bits)
    )


def bucket_offsets(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows in the buckets before each one, within `by`. At most classes x 2^bits rows."""
    counts = rows.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))


def shuffled_position(
    df: DataFrame, key: str, within: str, seed: int = SEED, bits: int = BUCKET_BITS
) -> tuple[DataFrame, Column]:
    """Rows with their 0-based position in the order (`within`, seeded hash of `key`).

    Rows are ranked inside hash buckets, which stay small whatever the class sizes are; the bucket
    offsets give the rest, and joining them by the buckets the rows are placed by moves no row again.
    Ties of the hash go by `key`.
    """
    rows = hashed(df, key, seed, bits)
    counts = rows.groupBy(within, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    per_class = counts.groupBy(within).agg(F.sum("_rows").alias("_class_rows"))
    in_class = Window.partitionBy(within).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    class_order = Window.orderBy(within).rowsBetween(Window.unboundedPreceding, -1)
    class_start = per_class.select(
        within, F.coalesce(F.sum("_class_rows").over(class_order), F.lit(0)).alias("_class_before")
    )
    offsets = (
        counts.withColumn("_in_class", F.coalesce(F.sum("_rows").over(in_class), F.lit(0)))
        .join(F.broadcast(class_start), within)
        .select(within, "_bucket", (F.col("_class_before") + F.col("_in_class")).alias("_before"))
    )
    in_bucket = Window.partitionBy(within, "_bucket").orderBy("_hash", key)
    ranked = rows.withColumn("_rank", F.row_number().over(in_bucket) - 1).join(offsets, [within, "_bucket"])
    return ranked, F.col("_before") + F.col("_rank")
