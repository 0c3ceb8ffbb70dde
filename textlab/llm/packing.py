"""Best-fit packing of documents into sequences of at most `capacity` tokens, in rounds over a tree of tasks.

A document is its ids and one end id. One longer than a sequence is cut into pieces of `capacity` tokens, the
first of which may be shorter; full pieces are sequences of their own. The other pieces go to tasks by hash, and
each task packs its own, the longest first, into the fullest bin they fit. Nearly full bins are done. The
others are items of the next round, which has as many tasks as there are items for; a bin far from full is taken apart again, so that a
task of the next round may fill its items up with what this one had not. The last round is the one that fits one task, or that
follows a round which left nearly as many items as it got; then every bin is done. So no task gets more than about
`items_per_task` items, and no bin is closed because there are too many.

A null text is empty and has the end id only. Rows given twice are packed twice. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from textlab.llm.tokens import Vocabulary, library_encoder
from textlab.llm.workers import ship, slices
from textlab.session import stage


def pieces(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text", end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """`(key, piece, start, length, ids_crc32)` of all pieces of whole texts."""
    ship(documents.sparkSession)
    vocabulary = Vocabulary.read(documents.sparkSession, path)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(vocabulary)
        for batch in slices(batches):
            ids, first = encoder.encode_batch(batch.column("text"), end_id)
            sizes = np.diff(first)
            counts = -(-sizes // capacity)
            row = np.repeat(np.arange(batch.num_rows), counts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            short = sizes - (counts - 1) * capacity  # the first piece
            start = np.where(piece == 0, 0, short[row] + (piece - 1) * capacity)
            length = np.where(piece == 0, short[row], capacity)
            at = first[row] + start
            flat = memoryview(ids.tobytes())
            crc = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                ["key", "piece", "start", "length", "ids_crc32"],
            )

    rows = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(apply, f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint").withColumnRenamed("key", key)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each item and the fill of each bin: the longest first, each into the fullest bin that takes it."""
    order = np.argsort(-sizes, kind="stable")
    bins = np.zeros(len(sizes), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    rooms, fill = 0, []  # bit r of `rooms`: some bin has room r
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, chosen = capacity, len(fill)
            fill.append(0)
        bins[i] = chosen
        fill[chosen] += size
        left = room - size
        if left:
            open_bins[left].append(chosen)
            rooms |= 1 << left
    return bins, np.array(fill, np.int64)


def _round(capacity: int, full_from: int, apart_below: int, number: int):
    """Bins `(fill, members)` of a task, best-fit into larger ones; `sequence_id` is set on those that are done."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]  # about items_per_task bins
        if not held:
            return
        table = pa.Table.from_batches(held)
        sizes, members = table.column("fill").to_numpy(), table.column("members").combine_chunks()
        bins, fill = best_fit(sizes, capacity)
        apart = np.flatnonzero(fill[bins] < apart_below)
        if len(apart):  # its items as they came
            yield pa.RecordBatch.from_arrays([pa.nulls(len(apart), pa.int64()), pa.array(sizes[apart]), members.take(pa.array(apart))], ["sequence_id", "fill", "members"])
        kept = np.flatnonzero(fill[bins] >= apart_below)
        order = kept[np.argsort(bins[kept], kind="stable")]
        members = members.take(pa.array(order))
        own, counts = np.unique(bins[order], return_counts=True)
        ends = np.concatenate([[0], np.cumsum(np.add.reduceat(np.diff(members.offsets.to_numpy()), np.cumsum(counts) - counts))]) if len(own) else [0]
        merged = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), members.flatten())
        ids = (np.int64(number) << 56) | (np.int64(TaskContext.get().partitionId()) << 32) | np.arange(len(own))
        yield pa.RecordBatch.from_arrays([pa.array(ids, mask=fill[own] < full_from), pa.array(fill[own]), merged], ["sequence_id", "fill", "members"])

    return apply


def pack(
    items: DataFrame,
    capacity: int = 1024,
    size: str = "length",
    items_per_task: int = 50_000,
    full_from: float = 0.995,
    apart_below: float = 0.875,
    least_gain: float = 0.1,
) -> DataFrame:
    """The rows of `items` with `sequence_id` and `offset`, their place in the sequence."""
    ship(items.sparkSession)
    full = stage(items.filter(F.col(size) >= capacity).withColumn("sequence_id", F.monotonically_increasing_id()), "full")
    rest = items.filter(F.col(size) < capacity)
    member = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(items.columns)])
    place = items.columns.index(size)
    bins = rest.select(F.col(size).cast("bigint").alias("fill"), F.array(member).alias("members"))
    bins = stage(bins, "items")
    left, number, results, last, last_round = bins.count(), 1, [], False, False
    schema = f"sequence_id bigint, fill bigint, members {bins.schema['members'].dataType.simpleString()}"
    while not last:
        tasks = max(1, -(-left // items_per_task))
        last = last_round or tasks == 1
        spread = bins.repartition(tasks, F.xxhash64("members", F.lit(number))) if tasks > 1 else bins.coalesce(1)
        limits = (0, 0) if last else (int(capacity * full_from), int(capacity * apart_below))
        packed_bins = stage(spread.mapInArrow(_round(capacity, *limits, number), schema), "bins")
        results.append(packed_bins.filter("sequence_id IS NOT NULL").select("sequence_id", "members"))
        bins = packed_bins.filter("sequence_id IS NULL").select("fill", "members")
        before, left, number = left, 0 if last else bins.count(), number + 1
        last_round = left > before * (1 - least_gain)
    sequences = results[0]
    for more in results[1:]:
        sequences = sequences.unionAll(more)
    before = F.transform("members", lambda m, i: F.aggregate(F.slice("members", 1, i), F.lit(0).cast("bigint"), lambda s, x: s + x[f"c{place}"]))
    flat = sequences.select("sequence_id", F.explode(F.arrays_zip(F.col("members").alias("m"), before.alias("o"))).alias("x"))
    columns = [F.col(f"x.m.c{i}").alias(c) for i, c in enumerate(items.columns)]
    return flat.select(*columns, "sequence_id", F.col("x.o").alias("offset")).unionAll(
        full.select(*items.columns, "sequence_id", F.lit(0).cast("bigint").alias("offset"))
    )


def packed_documents(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """`(key, piece, start, length, ids_crc32, sequence_id, offset)` of all pieces of all documents."""
    return pack(stage(pieces(documents, path, key, text, end_id, capacity), "pieces"), capacity)
