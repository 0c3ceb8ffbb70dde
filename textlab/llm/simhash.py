"""Near duplicates by SimHash, with candidates pruned by the pigeonring principle.

Fingerprint: lower-case A-Z, words as runs without ASCII white space, shingles of `width` words joined by a
blank (all words if there are fewer); bit i is 1 if it is set in more than half of the XXH64 values of
the shingles, repeats included. Without words it is zero.

Links: two fingerprints link if at most `budget` of 64 bits differ. The bits are cut into budget + 1
segments on a ring. If the total is within the budget, some segment starts a chain all of whose
prefixes of l segments differ in at most floor(l * budget / segments) bits: the first segment not at all, the first
two in at most one bit, and so on. So the first segment and one half of the second are equal; these bits
are the key of a bucket. Inside a bucket the chain is tested segment by segment before the full distance.

Nothing is lost to skew: equal fingerprints are one row, a bucket of more than `block` fingerprints is
dealt to pairs of blocks, and a task gives a spanning forest of its links instead of the pairs.

Null texts count as empty. Empty texts link to each other as any others do. A component has the smallest
id among its rows, null if none has an id. Rows given twice come out twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from textlab.llm.components import components
from textlab.llm.word_hash import find_words
from textlab.llm.workers import ship, slices
from textlab.session import stage

BITS = 64


def fingerprints_of(batch: pa.RecordBatch, width: int, seed: int) -> np.ndarray:
    column = pc.ascii_lower(pc.fill_null(batch.column("text"), ""))
    words = find_words(column, hashes=False)
    whole = pc.fill_null(column, "")
    out = np.zeros(batch.num_rows, np.uint64)
    lengths = words.ends - words.starts
    counts = np.diff(words.first)
    joined_first = np.cumsum(lengths + 1) - (lengths + 1)  # places once words are joined by one blank
    digest = xxhash.xxh64_intdigest
    for row in range(batch.num_rows):
        n = int(counts[row])
        if not n:
            continue
        low, high = int(words.first[row]), int(words.first[row + 1])
        text = b" ".join(whole[row].as_buffer().to_pybytes().split())
        at = joined_first[low:high] - joined_first[low]
        to = at + lengths[low:high]
        k = min(width, n)
        values = np.fromiter((digest(text[s:e], seed) for s, e in zip(at[: n - k + 1].tolist(), to[k - 1 :].tolist())), np.uint64, n - k + 1)
        out[row] = majority(values)
    return out


def majority(values: np.ndarray, step: int = 1 << 16) -> np.uint64:
    """Bits set in more than half of the values."""
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(values), step):
        ones += np.unpackbits(values[i : i + step].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > len(values), bitorder="little").view("<u8")[0]


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, seed: int = 42) -> DataFrame:
    """`(key, fingerprint)`, the latter as a signed bigint."""
    ship(documents.sparkSession)
    rows = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = fingerprints_of(batch, width, seed)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found.view(np.int64))], ["key", "fingerprint"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(apply, f"key {kind}, fingerprint bigint").withColumnRenamed("key", key)


def segments(budget: int) -> list[tuple[int, int]]:
    """(first bit, width) of budget + 1 segments of about equal width."""
    cuts = [BITS * i // (budget + 1) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def bucket_keys(fingerprint: Column, budget: int) -> Column:
    """Keys of the buckets: a start segment with either half of the next one, and the number of the choice."""
    parts = segments(budget)

    def bits(first: int, width: int) -> Column:
        return F.shiftrightunsigned(fingerprint, first).bitwiseAND(F.lit((1 << width) - 1))

    keys = []
    for i, (first, width) in enumerate(parts):
        after, wide = parts[(i + 1) % len(parts)]
        for half, (a, w) in enumerate(((after, wide // 2), (after + wide // 2, wide - wide // 2))):
            joined = F.shiftleft(bits(first, width), w).bitwiseOR(bits(a, w))
            keys.append(F.shiftleft(joined, 5).bitwiseOR(F.lit(2 * i + half)))
    return F.array(*keys)


def _chain_holds(difference: np.ndarray, start: np.ndarray, budget: int) -> np.ndarray:
    parts = segments(budget)
    counts = np.stack([np.bitwise_count((difference >> np.uint64(a)) & np.uint64((1 << w) - 1)) for a, w in parts]).astype(np.int64)
    n, total = len(parts), np.zeros(len(difference), np.int64)
    holds = np.ones(len(difference), bool)
    for length in range(1, n + 1):
        total += counts[(start + length - 1) % n, np.arange(len(difference))]
        holds &= total <= length * budget // n
    return holds


def _spanning(a: np.ndarray, b: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Places of pairs that connect all that the pairs connect, the closest first: fewer than there are nodes."""
    order = np.argsort(distance, kind="stable")
    nodes, flat = np.unique(np.concatenate([a[order], b[order]]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root, taken = np.arange(len(nodes)), np.zeros(len(a), bool)
    open_pairs = np.arange(len(a))
    while True:
        open_pairs = open_pairs[root[x[open_pairs]] != root[y[open_pairs]]]
        if not len(open_pairs):
            return order[taken]
        best = np.full(len(nodes), len(a))
        np.minimum.at(best, root[x[open_pairs]], open_pairs)
        np.minimum.at(best, root[y[open_pairs]], open_pairs)
        chosen = np.unique(best[best < len(a)])
        taken[chosen] = True
        while True:
            u, v = root[x[chosen]], root[y[chosen]]
            if np.array_equal(u, v):
                break
            np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
            while not np.array_equal(root, root[root]):
                root = root[root]


def _link_sorted(budget: int, pairs_at_once: int = 1 << 20):
    """Links of the rows `(bucket, left, right, side, node, value)` that share (bucket, left, right), sorted by these."""

    def run(group, side, bucket, node, value):
        found, held = [], 0
        bounds = np.concatenate([np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])), [len(group)]])
        ends = np.repeat(bounds[1:], np.diff(bounds))
        here, step = np.arange(len(group)), 1
        while True:
            here = here[here + step < ends[here]]
            if not len(here):
                break
            for i in range(0, len(here), pairs_at_once):
                at = here[i : i + pairs_at_once]
                at = at[(side[at] == 2) | (side[at] != side[at + step])]
                difference = value[at] ^ value[at + step]
                place = bucket[at] & 31
                ok = _chain_holds(difference, (place >> 1).astype(np.int64), budget)
                at, difference = at[ok], difference[ok]
                distance = np.bitwise_count(difference)
                ok = distance <= budget
                at, distance = at[ok], distance[ok].astype(np.int64)
                found.append((node[at], node[at + step], distance))
                held += int(ok.sum())
                if held > 4 * pairs_at_once:
                    a, b, d = (np.concatenate(c) for c in zip(*found))
                    kept = _spanning(a, b, d)
                    found, held = [(a[kept], b[kept], d[kept])], len(kept)
            step += 1
        a, b, d = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        kept = _spanning(a, b, d)
        return a[kept], b[kept]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _and_end(batches):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                rest = table if rest is None else pa.concat_tables([rest, table])
            if rest is None or not rest.num_rows:
                continue
            bucket, left, right, side, node, value = (rest.column(c).to_numpy() for c in ("bucket", "left", "right", "side", "node", "value"))
            change = (bucket[1:] != bucket[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])
            group = np.cumsum(np.concatenate([[True], change]))
            whole = len(group) if batch is None else int(np.searchsorted(group, group[-1]))
            a, b = run(group[:whole], side[:whole], bucket[:whole], node[:whole], value[:whole].view(np.uint64))
            rest = rest.slice(whole).combine_chunks()
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return apply


def _and_end(batches):
    yield from batches
    yield None


def near_links(prints: DataFrame, budget: int = 4, block: int = 2048) -> DataFrame:
    """Links `(a, b)` of distinct nodes `(node, value)` that connect all pairs within the budget; each link is such a pair."""
    if not 0 <= budget < 16:
        raise ValueError("two keys for each of at most 16 segments have numbers below 32")
    return _bucket_links(prints.select("node", "value", F.explode(bucket_keys(F.col("value"), budget)).alias("bucket")), budget, block)


def _bucket_links(keyed: DataFrame, budget: int, block: int) -> DataFrame:
    """Links inside the buckets of `(node, value, bucket)`; the low bits of a bucket tell where its chains start.

    A bucket is sized by a count that combines before its shuffle. Its rows fall into blocks by hash; a row goes to one
    task for each pair of blocks it is in.
    """
    ship(keyed.sparkSession)
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    sizes = stage(sizes, "buckets")  # aggregates are read back, so that the joins can split a frequent key
    blocks = F.ceil(F.col("size") / block).cast("int")
    rows = _pairs_of_blocks(keyed.join(sizes, "bucket").withColumn("blocks", blocks), "value")
    return rows.mapInArrow(_link_sorted(budget), "a bigint, b bigint").distinct()


def _pairs_of_blocks(placed: DataFrame, carried: str) -> DataFrame:
    """`(bucket, left, right, side, node, carried)` sorted by the first three: the rows of each pair of blocks of a bucket."""
    own = placed.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = other.select(
        "bucket",
        F.least("own", "other").alias("left"),
        F.greatest("own", "other").alias("right"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
        "node",
        carried,
    )
    return rows.repartition("bucket", "left", "right").sortWithinPartitions("bucket", "left", "right")


def near_components(prints: DataFrame, key: str = "doc_id", budget: int = 4) -> DataFrame:
    """`(key, fingerprint, component_id)`: the smallest id that links reach, a row's own included."""
    staged = stage(prints.select(F.col(key).alias("key"), "fingerprint"), "fingerprints")
    distinct = stage(staged.groupBy("fingerprint").agg(F.min("key").alias("least")), "distinct")
    roots = components(near_links(distinct.select(F.col("fingerprint").alias("node"), F.col("fingerprint").alias("value")), budget))
    linked = distinct.join(roots, F.col("fingerprint") == F.col("node"), "left").select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    named = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stage(linked.select("fingerprint", "root").join(named, "root").select("fingerprint", "component_id"), "classes")
    return staged.join(classes, "fingerprint").select(F.col("key").alias(key), "fingerprint", "component_id")
