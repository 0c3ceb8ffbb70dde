"""Connected components of a table of links, by alternating star contractions on the links themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textlab.session import stage


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _to_least(rows: DataFrame, larger_only: bool) -> DataFrame:
    """Link the neighbours `b` of each `a` to the least of them and `a`; the least comes from a plain aggregate."""
    least = rows.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("_a"), F.least("a", "m").alias("m"))
    least = stage(least, "least")  # read back, so that the join is of plain shuffles and a node with most links can be split
    joined = rows.join(least, F.col("a") == F.col("_a"))
    if larger_only:
        return joined.filter("b > a").select(F.col("b").alias("x"), F.col("m").alias("y"))
    return joined.select(F.col("b").alias("x"), F.col("m").alias("y")).unionAll(least.select(F.col("_a").alias("x"), F.col("m").alias("y")))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """`(node, root)` for each node of the links `(a, b)`; the root is the least node of its component.

    Links are bigints without nulls, in either direction, repeated or not. Each round is written to the
    shared folder. It ends when a round changes no link: every node is then linked to its root alone.
    """
    current = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    mark = None
    for _ in range(rounds):
        large = _to_least(_both(current), True).select(F.col("x").alias("a"), F.col("y").alias("b")).filter("a <> b").distinct()
        small = _to_least(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), False)
        current = stage(small.filter("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "links")
        now = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").bitwiseAND(0xFFFFFFFF))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
