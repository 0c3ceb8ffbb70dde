"""Repeated passages by a sparse suffix array.

A passage of `length` words that comes twice, in two texts or in one, is repeated. Words are runs without ASCII
white space and compare exactly.

Of all suffixes only those at minimisers are retained: for each window of `length` words the place of the
least hash of `gram` words among the first `window` places, so that equal windows choose equal places. A suffix
is ordered by the hash of its first length - window + 1 words, which lie inside each window that chose it;
rows of the same key are neighbours. A suffix without an equal neighbour has no repeated window and goes.
The others are extended left and right to the stretch of all windows that chose them. Stretches that are equal
as a whole are repeated as a whole; of each such class one, and all stretches without an equal, are
compared window by window. A repeated window is removed unless it is its first occurrence by (id, text, place).

Spans are word places [start, end), those that touch or overlap are one. Counts combine before each
shuffle, equal keys meet only in joins and aggregates, and texts move once, for the second step. A row with
a null id takes part as id null, before all others. A row given twice, with the same id and text, repeats
itself but neither copy is the later one. Texts below `length` words, empty or null have no spans.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from textlab.llm.word_hash import Runs, find_words, sliding_min
from textlab.llm.workers import flat_bytes, ship, slices
from textlab.session import stage

_PLACE_BITS = 28  # of a packed hash; the rest orders the minimisers


def minimisers(first: np.ndarray, hashes: np.ndarray, runs: Runs, length: int, window: int, gram: int):
    """(text, least start, greatest start, place) of each stretch of windows that chose the same place."""
    counts = np.diff(first)
    windows = np.maximum(counts - length + 1, 0)
    total = int(windows.sum())
    if not total:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    text = np.repeat(np.arange(len(counts)), windows)
    start = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows) + first[text]
    grams = np.arange(len(hashes) - gram + 1)
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    packed = (runs.of(grams, grams + gram) & ~mask) | grams.astype(np.uint64)
    place = (sliding_min(packed, window)[start] & mask).astype(np.int64)
    change = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])]))
    last = np.concatenate([change[1:], [total]]) - 1
    return text[change], start[change], start[last], place[change]


def _suffixes(length: int, window: int, gram: int):
    keyed = length - window + 1

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = find_words(batch.column("text"))
            runs = Runs(words.hashes)
            text, low, high, place = minimisers(words.first, words.hashes, runs, length, window, gram)
            stretch = runs.of(low, high + length) ^ (place - low).astype(np.uint64)
            begin = words.first[text]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(runs.of(place, place + keyed).view(np.int64)),
                    pa.array(stretch.view(np.int64)),
                    batch.column("id").take(pa.array(text)),
                    batch.column("content").take(pa.array(text)),
                    pa.array((low - begin).astype(np.int32)),
                    pa.array((high - begin).astype(np.int32)),
                ],
                ["suffix", "stretch", "id", "content", "low", "high"],
            )

    return apply


def _windows(length: int):
    """Window hashes of the stretches `todo` of each text."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = find_words(batch.column("text"))
            runs = Runs(words.hashes)
            todo = batch.column("todo")
            rows = np.repeat(np.arange(batch.num_rows), np.diff(todo.offsets.to_numpy()))
            parts = todo.flatten()
            low, high, copies = (parts.field(c).to_numpy().astype(np.int64) for c in ("low", "high", "copies"))
            sizes = high - low + 1
            which = np.repeat(np.arange(len(low)), sizes)
            start = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[which]
            at = start + words.first[rows[which]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(runs.of(at, at + length).view(np.int64)),
                    batch.column("id").take(pa.array(rows[which])),
                    batch.column("content").take(pa.array(rows[which])),
                    pa.array(start.astype(np.int32)),
                    pa.array(copies[which]),
                ],
                ["window", "id", "content", "start", "copies"],
            )

    return apply


def _joined(length: int):
    """Merge the starts of repeated windows of each text into spans, all of them and those to remove."""

    def merge(low: np.ndarray, high: np.ndarray) -> list[list[int]]:
        if not len(low):
            return []
        order = np.argsort(low, kind="stable")
        low, high = low[order], np.maximum.accumulate(high[order] + length)
        cut = np.flatnonzero(np.concatenate([[True], low[1:] > high[:-1]]))
        return np.stack([low[cut], high[np.concatenate([cut[1:], [len(low)]]) - 1]], axis=1).tolist()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("found")
            offsets = found.offsets.to_numpy()
            parts = found.flatten()
            low, high = (parts.field(c).to_numpy().astype(np.int64) for c in ("low", "high"))
            later = parts.field("later").to_numpy(zero_copy_only=False)
            base = offsets[0]
            spans, removed = [], []
            for a, b in zip(offsets[:-1] - base, offsets[1:] - base):
                spans.append(merge(low[a:b], high[a:b]))
                removed.append(merge(low[a:b][later[a:b]], high[a:b][later[a:b]]))
            kind = pa.list_(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("content"), pa.array(spans, kind), pa.array(removed, kind)], ["id", "content", "spans", "removed"])

    return apply


def repeated_passages(documents: DataFrame, key: str = "doc_id", text: str = "text", length: int = 50, window: int = 24, gram: int = 5) -> DataFrame:
    """`(key, content, spans, removed)` of the texts with a repeated passage; `content` is the XXH64 of the text."""
    ship(documents.sparkSession)
    rows = documents.select(F.col(f"`{key}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("content"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    suffixes = stage(
        rows.mapInArrow(_suffixes(length, window, gram), f"suffix bigint, stretch bigint, id {kind}, content bigint, low int, high int"),
        "suffixes",
    )
    seeds = suffixes.groupBy("suffix").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("suffix")
    seeds = stage(seeds, "seed-keys")  # aggregates are read back, so that the joins can split a frequent key
    found = stage(suffixes.join(seeds, "suffix", "left_semi").drop("suffix"), "seeds")
    place = F.struct("id", "content", "low")
    classes = found.groupBy("stretch").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("first"))
    classes = stage(classes, "classes")
    members = found.join(classes, "stretch").withColumn("is_first", place.eqNullSafe(F.col("first")))
    members = stage(members.select("id", "content", "low", "high", "copies", "is_first"), "stretches")
    again = members.filter("copies > 1").select("id", "content", "low", "high", F.expr("NOT is_first").alias("later"))
    todo = members.filter("is_first").groupBy("id", "content").agg(F.collect_set(F.struct("low", "high", "copies")).alias("todo"))
    texts = rows.join(todo, [rows["id"].eqNullSafe(todo["id"]), rows["content"] == todo["content"]])
    texts = texts.select(rows["id"], rows["content"], "text", "todo")
    windows = stage(texts.mapInArrow(_windows(length), f"window bigint, id {kind}, content bigint, start int, copies bigint"), "windows")
    start = F.struct("id", "content", "start")
    counted = windows.groupBy("window").agg(F.sum("copies").alias("n"), F.min(start).alias("first")).filter("n > 1")
    counted = stage(counted, "window-counts")
    repeated = windows.join(counted, "window").select("id", "content", F.col("start").alias("low"), F.col("start").alias("high"), (~start.eqNullSafe(F.col("first"))).alias("later"))
    per_text = again.unionAll(repeated).groupBy("id", "content").agg(F.collect_list(F.struct("low", "high", "later")).alias("found"))
    spans = per_text.mapInArrow(_joined(length), f"id {kind}, content bigint, spans array<array<bigint>>, removed array<array<bigint>>")
    return spans.withColumnRenamed("id", key)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        data, offsets = flat_bytes(batch.column("text"))
        words = find_words(batch.column("text"), hashes=False)
        out, left = [], []
        for row, removed in enumerate(batch.column("removed").to_pylist()):
            if not removed:
                left.append(row)
                out.append(batch.column("text")[row].as_py())
                continue
            first, last = int(words.first[row]), int(words.first[row + 1])
            parts, at = [], int(offsets[row])
            for start, end in removed:
                parts.append(data[at : words.starts[first + start]].tobytes())
                at = int(words.starts[first + end]) if first + end < last else int(offsets[row + 1])
            parts.append(data[at : offsets[row + 1]].tobytes())
            if sum(end - start for start, end in removed) < last - first:
                left.append(row)
                out.append(b"".join(parts).decode("utf-8"))
        rows = pa.array(left, pa.int64())
        yield pa.RecordBatch.from_arrays([*[c.take(rows) for c in batch.columns[:-2]], pa.array(out, pa.string())], [*batch.schema.names[:-2], "text"])


def without_repeats(documents: DataFrame, keep: Sequence[str], key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows with the columns in `keep`, their text without passages that came before; a row of nothing else goes."""
    found = repeated_passages(documents, key, text, **options)
    found = found.select(F.col(f"`{key}`").alias("of_id"), F.col("content").alias("of_content"), "removed")
    found = stage(found.filter(F.size("removed") > 0).dropDuplicates(["of_id", "of_content"]), "removed")
    others = [c for c in keep if c != text]
    own = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]) if others else F.struct(F.lit(0).alias("c0"))
    rows = documents.select(own.alias("row"), F.col(f"`{key}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("content"), F.col(f"`{text}`").alias("text"))
    joined = rows.join(found, [F.col("id").eqNullSafe(F.col("of_id")), F.col("content") == F.col("of_content")], "left").select("row", "text", "removed")
    whole = joined.mapInArrow(_cut, f"row {joined.schema['row'].dataType.simpleString()}, text string")
    names = {c: F.col(f"row.c{i}").alias(c) for i, c in enumerate(others)} | {text: F.col("text").alias(text)}
    return whole.select(*[names[c] for c in keep])
