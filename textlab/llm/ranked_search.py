"""Ranked lexical search by dense blocked matrix products: vocabulary tiles of the items times impact tiles of the documents.

Terms are the runs of ASCII letters, digits and characters beyond ASCII; only A-Z are lower-cased. N documents have a term, L terms in
all. With tf occurrences in a document of n terms, and df documents holding the term,
    weight = floor(1000 ln((2N + 2) / (2 df + 1))),   m = 50 + 50 n N div L,   impact = 10^9 tf div (1000 tf + 20 m),
and a score sums weight * impact over the distinct terms of an item. All but the logarithm is in whole numbers.

One pass finds the terms of each text, keeps its length and how often it has the terms that items ask for, and writes these aside. A
second pass builds, for a block of documents, the impacts of the vocabulary columns that the block has, and multiplies them by the
weights of the items (BLAS, float64). A weight is below 2^16 and an impact below 2^20, so the sum over a tile of at most 2^16 columns stays
below 2^52 and is exact; the tiles are added as 64-bit integers. Of each block and item the `k` best and all that tie with the last go on, and
a task keeps the best so far, so it gives at most k rows an item. Ties go to the smaller key, rows without a key last.

Items with the same id are one: their terms together. Items and documents without terms are in no result. Each document row is a document
of its own, whatever its key. Null texts have no terms. An empty table of either kind gives no rows. Only the key and
the text of either are read. The vocabulary is sent to the tasks; items whose terms exceed `vocabulary_bytes` together are dealt
to several passes, each below the limit (one item alone may be above it).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from textlab.llm.workers import flat_bytes, ship, slices
from textlab.session import stage

_INSIDE = np.ones(256, bool)
_INSIDE[:128] = [chr(b).isalnum() for b in range(128)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_MOST_COLUMNS = 1 << 16
_CELLS = 1 << 20  # of a tile
_SLICE_BYTES = 1 << 20  # of text at a time


def terms_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts in their order, and the index of the first term of each text with the number of all."""
    data, offsets = flat_bytes(column)
    inside = _INSIDE[data]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    cuts = offsets[1:-1]
    before[cuts[cuts < len(inside)]] = False
    starts = np.flatnonzero(inside & ~before)
    first = np.searchsorted(starts, offsets)
    letters = _LOWER[data[inside]]
    sizes = np.add.reduceat(inside, starts, dtype=np.int64) if len(starts) else starts  # what is inside from a start to the next
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)]), first


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        terms, first = terms_of(batch.column("text"))
        item = np.repeat(np.arange(batch.num_rows), np.diff(first))
        yield pa.RecordBatch.from_arrays([batch.column("item").take(pa.array(item)), terms.cast(pa.string())], ["item", "term"])


def _term_counts(vocabulary: Broadcast):
    """Length of each text with a term, and its vocabulary terms with their occurrences."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary.value, pa.large_string())
        for batch in slices(batches, limit=_SLICE_BYTES):
            terms, first = terms_of(batch.column("text"))
            sizes = np.diff(first)
            found = pc.index_in(terms, value_set=known)
            at = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
            term = found.take(pa.array(at)).to_numpy().astype(np.int64)
            text = np.searchsorted(first, at, side="right") - 1
            pairs, tf = np.unique(text << 32 | term, return_counts=True)
            ends = np.searchsorted(pairs >> 32, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32))) for v in (pairs & 0xFFFFFFFF, tf)]
            rows = pa.array(np.flatnonzero(sizes))
            yield pa.RecordBatch.from_arrays([c.take(rows) for c in (batch.column("key"), pa.array(sizes.astype(np.int64)), *lists)], ["key", "n", "terms", "tf"])

    return apply


@dataclass(frozen=True)
class Index:
    """The items as rows of term weights, in compressed rows."""

    ends: np.ndarray  # of each item in `terms`
    terms: np.ndarray
    weights: np.ndarray  # float64, by term
    documents: int
    words: int

    def impact(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        if 50 * int(n.max(initial=0)) * self.documents < 1 << 63:
            m = 50 + 50 * n * self.documents // self.words
        else:
            m = np.array([50 + 50 * int(x) * self.documents // self.words for x in n], np.int64)
        return 1_000_000_000 * tf // (1000 * tf + 20 * m)

    def dense(self, low: int, high: int, columns: np.ndarray) -> np.ndarray:
        """Weights of the items [low, high) for some terms, in ascending order."""
        part = self.terms[self.ends[low] : self.ends[high]]
        item = np.repeat(np.arange(high - low), np.diff(self.ends[low : high + 1]))
        place = np.searchsorted(columns, part)
        held = (place < len(columns)) & (columns[np.minimum(place, len(columns) - 1)] == part)
        out = np.zeros((high - low, len(columns)))
        out[item[held], place[held]] = self.weights[part[held]]
        return out

    def scores(self, rows: np.ndarray, terms: np.ndarray, impacts: np.ndarray, count: int, low: int, high: int, columns: int) -> np.ndarray:
        """Scores of the items [low, high) for `count` documents, tile by tile of the vocabulary."""
        total = np.zeros((high - low, count), np.int64)
        there = np.unique(terms)
        for at in range(0, len(there), columns):
            tile = there[at : at + columns]
            place = np.searchsorted(tile, terms)
            held = (place < len(tile)) & (tile[np.minimum(place, len(tile) - 1)] == terms)
            dense = np.zeros((len(tile), count))
            dense[place[held], rows[held]] = impacts[held]
            total += (self.dense(low, high, tile) @ dense).astype(np.int64)
        return total


def _best(table: pa.Table, k: int) -> pa.Table:
    """The k first rows of each item: highest score, least key, rows without a key last."""
    order = pc.sort_indices(table, [("item", "ascending"), ("score", "descending"), ("key", "ascending")], null_placement="at_end")
    table = table.take(order)
    item = table.column("item").to_numpy()
    begin = np.searchsorted(item, item)  # of the own item
    return table.take(pa.array(np.flatnonzero(np.arange(len(item)) - begin < k)))


def _ranked(index: Broadcast, items: int, k: int, columns: int, block: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: pa.Table | None = None
        least = np.ones(items, np.int64)  # what a score has to reach
        for whole in batches:
            for batch in (whole.slice(i, block) for i in range(0, whole.num_rows, block)):
                terms = batch.column("terms")
                sizes = np.diff(terms.offsets.to_numpy())
                rows = np.repeat(np.arange(batch.num_rows), sizes)
                flat, tf = terms.flatten().to_numpy(), batch.column("tf").flatten().to_numpy().astype(np.int64)
                impacts = index.value.impact(tf, batch.column("n").to_numpy()[rows])
                step, parts = max(1, _CELLS // max(batch.num_rows, columns)), []
                for low in range(0, items, step):
                    high = min(items, low + step)
                    scores = index.value.scores(rows, flat, impacts, batch.num_rows, low, high, columns)
                    floor = least[low:high]
                    if batch.num_rows > k:
                        floor = np.maximum(floor, np.partition(scores, batch.num_rows - k, axis=1)[:, batch.num_rows - k])
                    item, row = np.nonzero(scores >= floor[:, None])
                    columns_ = [pa.array(item + low), pa.array(scores[item, row]), batch.column("key").take(pa.array(row))]
                    parts.append(pa.table(columns_, ["item", "score", "key"]))
                found = _best(pa.concat_tables([*([found] if found is not None else []), *parts]), k)
                item, score = found.column("item").to_numpy(), found.column("score").to_numpy()
                full = np.flatnonzero(np.bincount(item, minlength=items) == k)
                least[full] = score[np.searchsorted(item, full, side="right") - 1]
        if found is not None:
            yield from found.combine_chunks().to_batches()

    return apply


def top_documents(
    documents: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    k: int = 50,
    columns: int = 4096,
    block: int = 256,
    vocabulary_bytes: int = 64 << 20,
) -> DataFrame:
    """`(item, rank, key, score)`: for each item the k documents with the highest score above 0."""
    if not 0 < columns <= _MOST_COLUMNS:
        raise ValueError(f"a tile has 1 to {_MOST_COLUMNS} columns")
    spark = documents.sparkSession
    ship(spark)
    asked = items.select(F.col(f"`{item}`").alias("item"), F.col(f"`{item_text}`").alias("text"))
    kind = asked.schema["item"].dataType.simpleString()
    asked = stage(asked.mapInArrow(_item_terms, f"item {kind}, term string").distinct(), "item-terms")
    size = asked.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0
    passes = max(1, -(-size // vocabulary_bytes))
    rows = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    found = [_one_pass(rows, asked.filter(F.pmod(F.xxhash64("item"), F.lit(passes)) == i), k, columns, block) for i in range(passes)]
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionAll(more)
    return whole.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")


def _one_pass(rows: DataFrame, asked: DataFrame, k: int, columns: int, block: int) -> DataFrame:
    spark = rows.sparkSession
    by_item = asked.groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms")).toArrow()  # below vocabulary_bytes, or one item
    flat = by_item.column("terms").combine_chunks()
    vocabulary = pc.unique(flat.flatten()).to_pylist()
    kind = rows.schema["key"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(vocabulary)
    counted = stage(rows.mapInArrow(_term_counts(shared), f"key {kind}, n bigint, terms array<int>, tf array<int>"), "term-counts")
    total = counted.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("words")).first()  # two numbers
    holding = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weighted = holding.select("term", F.floor(1000 * F.log((2 * F.lit(total["documents"]) + 2) / (2 * F.col("df") + 1))).alias("w")).toArrow()  # a row per vocabulary term
    weights = np.zeros(len(vocabulary))
    weights[weighted.column("term").to_numpy()] = weighted.column("w").to_numpy()
    terms = pc.index_in(flat.flatten(), value_set=pa.array(vocabulary, pa.string())).to_numpy().astype(np.int64)
    lengths = pc.list_value_length(flat).to_numpy()
    index = Index(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), terms, weights, total["documents"], total["words"] or 1)
    ranked = counted.filter(F.size("terms") > 0).mapInArrow(
        _ranked(spark.sparkContext.broadcast(index), by_item.num_rows, k, columns, block), f"item bigint, score bigint, key {kind}"
    )
    order = [F.desc("score"), F.asc_nulls_last("key")]
    salted = ranked.withColumn("part", F.pmod(F.xxhash64("key", "score"), F.lit(64)))  # many tasks' best of one item never meet in one
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).filter(F.col("rank") <= k).drop("rank")
    best = first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
    names = spark.createDataFrame(pa.table({"place": pa.array(np.arange(by_item.num_rows)), "name": by_item.column("item")}))
    return best.join(F.broadcast(names), best["item"] == names["place"]).select(F.col("name").alias("item"), "rank", "key", "score")
