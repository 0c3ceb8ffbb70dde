"""Joins of large rows with a table that has one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

BROADCAST_BYTES = 256 << 20
HOT_KEYS = 1000
_SPREAD = 1024


def fits_broadcast(table: DataFrame, row_bytes: int, rows: int | None = None) -> bool:
    """Whether the table, counted now unless `rows` is known, stays below the broadcast limit."""
    return (table.count() if rows is None else rows) * row_bytes <= BROADCAST_BYTES


def lookup_join(
    left: DataFrame,
    table: DataFrame,
    key: str,
    spread: Sequence[str],
    how: str = "inner",
    row_bytes: int = 128,
    rows: int | None = None,
    frequency: str | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Join `left` with the row that `table` has for its key; `how` is inner, left or left_semi.

    A small table (size checked) is broadcast and `left` keeps its partitioning. With a large one
    the most frequent keys are broadcast, and only the others meet the table in a shuffle: each of
    those is a small share of the rows. `frequency` is a column of the table that tells how often a
    key comes; without it the keys of `left` are counted. Rows that are served already are spread
    over the shuffle by `spread`, columns of `left` that vary inside one key. `tasks`: how many share the shuffle, if not as many
    as the session says; a task then holds its part of the table, so that nothing is sorted.
    """
    if fits_broadcast(table, row_bytes, rows):
        return left.join(F.broadcast(table), key, how)
    payload = [c for c in table.columns if c != key]
    if frequency is None:
        often = left.groupBy(key).agg(F.count(F.lit(1)).alias("_often")).orderBy(F.desc("_often")).limit(HOT_KEYS)
        often = often.filter(F.col(key).isNotNull()).select(key)
        of_table = table.withColumn("_hit", F.lit(True)).join(F.broadcast(often), key, "left_semi")
        hot = often.join(of_table, key, "left")  # a frequent key that the table lacks is served as well: with nothing
    else:
        hot = table.orderBy(F.desc(frequency)).limit(HOT_KEYS).withColumn("_hit", F.lit(True))
    hot = hot.select(key, *[F.col(c).alias(f"_hot_{c}") for c in payload], "_hit", F.lit(True).alias("_served"))
    # Always 0, but no literal: the optimizer would take a literal out of the join keys, and served rows would meet by key alone.
    zero = F.pmod(F.xxhash64(key), F.lit(1)).cast("int").alias("_place")
    rest = table.select(key, *[F.col(c).alias(f"_rest_{c}") for c in payload], zero, F.lit(True).alias("_found"))
    place = F.when(F.col("_served") | F.col(key).isNull(), F.pmod(F.xxhash64(*spread), F.lit(_SPREAD)).cast("int") + 1).otherwise(0)
    placed = left.join(F.broadcast(hot), key, "left").withColumn("_place", place)
    if tasks is not None:
        placed, rest = placed.repartition(tasks, key, "_place"), rest.repartition(tasks, key, "_place").hint("shuffle_hash")
    both = placed.join(rest, [key, "_place"], "left")
    if how != "left":
        both = both.filter(F.coalesce("_hit", "_found"))
    if how == "left_semi":
        return both.select(*left.columns)
    others = [c for c in left.columns if c != key]
    return both.select(key, *others, *[F.coalesce(f"_hot_{c}", f"_rest_{c}").alias(c) for c in payload])
