"""Exact top-k by inner product as a Voronoi join.

Vectors are integers, floor(scale * x). Pivots split the data and the queries into cells; there are about as many as the root of the number
of vectors. A cell of the data is summarised by the distances of its k + 1 members nearest to the pivot; a cell of the queries by
its radius, the greatest angle to its pivot, and the range of its lengths. For a query q in the cell of pivot p with radius r, and a
member x at distance d of pivot c, q.x >= p.c - r|c| - (|p| + r) d, so the summaries give a score that the k best of each query in the cell
reach. No query of the cell has more with x than p.x + r|x|, nor more than |q||x| cos of what is left of the angle between p and x
after the cell's own, so a vector below that score is not needed in the cell. Query cells are merged into groups; a vector
is sent once to each group of which some cell needs it. A group is solved in blocks of bounded size, and the k best of the blocks are merged.

A row is a vector of its own, whatever its id: rows with one id are all found, and each asks. Rows whose vector is null or holds null or not
finite values take no part. Vectors meet those of their own length only, empty ones with scores of 0. Ties go to the smaller id, a null
id last. Of equal vectors only the k + 1 rows with the least ids can be in a result, so the others are left out before
anything is sent; as queries all remain.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from textlab.llm.workers import ship
from textlab.session import stage

_CELLS = 1 << 19


def integer_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 64) -> DataFrame:
    """`(id, x)` of the rows that take part."""
    broken = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    valid = rows.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    valid = valid.filter(F.col("v").isNotNull()).filter(~F.exists("v", broken))
    return valid.select("id", F.transform("v", lambda v: F.floor(v * scale).cast("bigint")).alias("x"))


@dataclass(frozen=True)
class Cells:
    pivots: np.ndarray
    members: list[np.ndarray]  # least distances of the data of each cell, ascending
    radius: np.ndarray  # of the queries of each cell; below 0 if it has none
    angle: np.ndarray  # greatest one between a query and the pivot
    shortest: np.ndarray  # lengths of the queries
    longest: np.ndarray
    group: np.ndarray  # of each cell

    def thresholds(self, k: int) -> np.ndarray:
        """Per cell of queries a score that k + 1 vectors reach for every query in it."""
        c = np.repeat(self.pivots, [len(m) for m in self.members], axis=0)
        d = np.concatenate(self.members)
        size_c, size_p = np.linalg.norm(c, axis=1), np.linalg.norm(self.pivots, axis=1)
        out = np.full(len(self.pivots), -np.inf)
        for i in np.flatnonzero(self.radius >= 0):
            r = self.radius[i]
            low = c @ self.pivots[i] - r * size_c - (size_p[i] + r) * d
            if len(low) > k:
                out[i] = np.partition(low, len(low) - k - 1)[len(low) - k - 1]
        return out - 1e-6 * (1 + np.abs(out, where=np.isfinite(out), out=np.zeros(len(out))))  # more than rounding can lose


    def bounds(self, x: np.ndarray, used: np.ndarray) -> np.ndarray:
        """The most that a query of each used cell can score with each vector."""
        size, pivot = np.linalg.norm(x, axis=1)[:, None], self.pivots[used]
        products = x @ pivot.T
        ball = products + self.radius[used] * size
        lengths = size * np.linalg.norm(pivot, axis=1)
        between = np.arccos(np.clip(np.divide(products, lengths, out=np.ones_like(products), where=lengths > 0), -1, 1))
        cosine = np.cos(np.maximum(0, between - self.angle[used] - 1e-6))
        cone = np.where(cosine > 0, self.longest[used], self.shortest[used]) * size * cosine
        return np.where(np.linalg.norm(pivot, axis=1) > 0, np.minimum(ball, cone), ball)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1 if len(column.flatten()) else 0).astype(np.float64)


def _few(batches: Iterator[pa.RecordBatch], pivots: int) -> Iterator[pa.RecordBatch]:
    """Batches whose products with all pivots fit a few megabytes."""
    step = max(1, _CELLS // max(pivots, 1))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def _assign(pivots: np.ndarray):
    squares = (pivots**2).sum(axis=1)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches, len(pivots)):
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                cell = np.argmin(squares - 2 * x @ pivots.T, axis=1)
                own = pivots[cell]
                distance, length = np.linalg.norm(x - own, axis=1), np.linalg.norm(x, axis=1)
                both = length * np.linalg.norm(own, axis=1)
                angle = np.arccos(np.clip(np.divide((x * own).sum(axis=1), both, out=np.ones(len(x)), where=both > 0), -1, 1))
                found = [pa.array(cell.astype(np.int32)), *map(pa.array, (distance, angle, length))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, "cell", "distance", "angle", "length"])

    return apply


def _needed(cells: Cells, thresholds: np.ndarray, groups: int):
    """A row per group of queries that may need the vector."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = np.flatnonzero(cells.radius >= 0)
        for batch in _few(batches, len(used)):
            x = _matrix(batch.column("x"))
            bound = cells.bounds(x, used)
            wanted = bound + 1e-6 * (1 + np.abs(bound)) >= thresholds[used]
            need = np.zeros((batch.num_rows, groups), bool)
            for place, cell in enumerate(used):
                need[:, cells.group[cell]] |= wanted[:, place]
            row, group = np.nonzero(need)
            yield pa.RecordBatch.from_arrays([pa.array(group.astype(np.int32)), *[batch.column(c).take(pa.array(row)) for c in ("row", "id", "x")]], ["group", "row", "id", "x"])

    return apply


def _best(k: int):
    def solve(queries: pa.Table, data: pa.Table) -> pa.Table:
        found = {"row": [np.zeros(0, np.int64)], "vec_row": [np.zeros(0, np.int64)], "score": [np.zeros(0, np.int64)]}
        if queries.num_rows and data.num_rows:
            data = data.take(pc.sort_indices(data, [("id", "ascending"), ("row", "ascending")], null_placement="at_end"))
            rows, asking = data.column("row").to_numpy(), queries.column("row").to_numpy()
            q, x = (_matrix(t.column("x").combine_chunks()) for t in (queries, data))
            safe = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1] < 2**53
            kind = np.float64 if safe else np.int64  # doubles are exact there, and fast
            if not safe:
                q, x = (np.array(t.column("x").to_pylist(), np.int64) for t in (queries, data))
            for at in range(0, len(q), 256):
                scores = (q[at : at + 256].astype(kind) @ x.astype(kind).T).astype(np.int64)
                for own, row in zip(asking[at : at + 256].tolist(), scores):
                    if len(row) > k + 1:
                        limit = np.partition(row, len(row) - k - 1)[len(row) - k - 1]
                        places = np.flatnonzero(row >= limit)
                    else:
                        places = np.arange(len(row))
                    places = places[rows[places] != own]
                    places = places[np.argsort(-row[places], kind="stable")[:k]]
                    found["row"].append(np.full(len(places), own))
                    found["vec_row"].append(rows[places])
                    found["score"].append(row[places])
        return pa.table({name: pa.array(np.concatenate(parts)) for name, parts in found.items()})

    return solve


def _matches(staged: DataFrame, k: int, pivots: int, groups: int, block: int, query_block: int) -> tuple[DataFrame | None, int]:
    """`(row, vec_row, score)`: the k best and perhaps more of each query, and how many rows were sent, for `(row, id, x, is_query)` of one length."""
    counted = staged.count()
    pivots = max(pivots, int(counted**0.5))
    centres = staged.select("x").distinct().orderBy(F.xxhash64("x"), "x").limit(pivots).toArrow()  # the root of the rows
    if not centres.num_rows:
        return None, 0
    centre = _matrix(centres.column("x").combine_chunks())
    placed = staged.mapInArrow(_assign(centre), "row bigint, id bigint, x array<bigint>, is_query boolean, cell int, distance double, angle double, length double")
    placed = stage(placed, "cells")
    copies = Window.partitionBy("x").orderBy(F.asc_nulls_last("id"), "row")
    data = placed.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1)
    data = stage(data.select("row", "id", "x", "cell", "distance"), "data")
    near = Window.partitionBy("cell").orderBy("distance", "row")
    nearest = data.select("cell", "distance", "row").withColumn("n", F.row_number().over(near)).filter(F.col("n") <= k + 1)
    summary = nearest.groupBy("cell").agg(F.collect_list("distance").alias("d")).toArrow().to_pydict()  # k + 1 numbers per pivot
    members = [np.zeros(0)] * len(centre)
    for cell, found in zip(summary["cell"], summary["d"]):
        members[cell] = np.sort(found)
    ranges = {name: np.full(len(centre), -1.0) for name in ("radius", "angle", "shortest", "longest")}
    of_cell = [F.max("distance").alias("radius"), F.max("angle").alias("angle"), F.min("length").alias("shortest"), F.max("length").alias("longest")]
    for row in placed.filter("is_query").groupBy("cell").agg(*of_cell).collect():  # one per pivot
        for name in ranges:
            ranges[name][row["cell"]] = row[name]
    leaders = centre[: min(max(groups, len(centre) // 16), len(centre))]
    group = np.argmin((leaders**2).sum(axis=1) - 2 * centre @ leaders.T, axis=1)
    cells = Cells(centre, members, **ranges, group=group)
    sent = stage(data.select("row", "id", "x").mapInArrow(_needed(cells, cells.thresholds(k), len(leaders)), "group int, row bigint, id bigint, x array<bigint>"), "sent")
    number = F.array(*[F.lit(int(g)) for g in group])
    asked = placed.filter("is_query").select(F.get(number, F.col("cell")).alias("group"), "row", "id", "x")
    blocks = sent.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))  # one row per group
    query_blocks = asked.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / query_block).cast("int").alias("query_blocks"))
    sizes = F.broadcast(blocks.join(query_blocks, "group"))
    data_side = sent.join(sizes, "group").select(
        "group", F.pmod(F.xxhash64("row"), "blocks").cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("query_block"), "row", "id", "x"
    )
    query_side = asked.join(sizes, "group").select(
        "group", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("row"), "query_blocks").cast("int").alias("query_block"), "row", "id", "x"
    )
    keys = ["group", "block", "query_block"]
    found = query_side.groupBy(*keys).cogroup(data_side.groupBy(*keys)).applyInArrow(_best(k), "row bigint, vec_row bigint, score bigint")
    return found, sent.count()


def top_k(
    vectors: DataFrame, query: Column, k: int = 20, pivots: int = 256, groups: int = 16, block: int = 20_000, query_block: int = 2_000, sent: list | None = None
) -> DataFrame:
    """`(query_id, rank, vec_id, score)`: for each query among `(id, x)` the k best others. `sent` gets the number of vectors sent per length."""
    spark = vectors.sparkSession
    ship(spark)
    numbered = vectors.select(F.monotonically_increasing_id().alias("row"), "id", "x", F.coalesce(query, F.lit(False)).alias("is_query"))
    staged = stage(numbered, "vectors")
    sizes = sorted(r["n"] for r in staged.select(F.size("x").alias("n")).distinct().collect())  # few lengths
    parts = []
    for size in sizes:
        found, count = _matches(staged.filter(F.size("x") == size), k, pivots, groups, block, query_block)
        if sent is not None:
            sent.append(count)
        if found is not None:
            parts.append(found)
    if not parts:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionAll(more)
    names = staged.select("row", "id")
    named = whole.join(names.select(F.col("row").alias("vec_row"), F.col("id").alias("vec_id")), "vec_row")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "vec_row")
    best = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(names, "row").select(F.col("id").alias("query_id"), "rank", "vec_id", "score")
