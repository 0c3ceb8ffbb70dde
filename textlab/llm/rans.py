"""Token ids in files, coded by a static range asymmetric numeral system.

Layout of a file set: a folder `blocks` with one row per block and a folder `table` with the frequency of each
id, shared by all blocks. The frequencies sum to 2^bits, come from the counts over all documents, and are at
least 1 for each id that occurs. A block holds whole documents in ascending order of their key, about
`block_tokens` ids, and decodes on its own. Its ids are dealt to lanes by turns; each lane is a 64-bit state
that gives off 32-bit words. `checkpoints` keeps the states and the place in the words at every
`checkpoint_steps` steps, so that a reader can start inside a block. `payload_crc32` and `ids_crc32` guard a block.

Null texts are empty: the end id alone. Rows given twice are written twice, side by side; rows without a key come first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from textlab.llm.tokens import Vocabulary, library_encoder
from textlab.llm.workers import ship, slices
from textlab.session import new_folder, stage

BLOCK = "part int, first bigint, keys array<{kind}>, lengths binary, n_tokens bigint, lanes int, states binary, words binary, checkpoints binary, payload_crc32 bigint, ids_crc32 bigint"
_LOW = np.uint64(31)  # a state stays in [2^31, 2^63)
_WORD = np.uint64(32)


@dataclass(frozen=True)
class FrequencyTable:
    bits: int
    frequency: np.ndarray  # uint64, by id
    start: np.ndarray
    symbol: np.ndarray  # by slot

    @classmethod
    def of(cls, frequency: np.ndarray) -> FrequencyTable:
        total = int(frequency.sum())
        start = np.cumsum(frequency) - frequency
        return cls(total.bit_length() - 1, frequency.astype(np.uint64), start.astype(np.uint64), np.repeat(np.arange(len(frequency), dtype=np.uint32), frequency))


def scaled(counts: np.ndarray, bits: int = 20) -> np.ndarray:
    """Frequencies that sum to a power of two, 2^bits or what two slots for each used id need, each used id at least 1."""
    counts = counts.astype(np.int64)
    used = np.flatnonzero(counts)
    bits = max(bits, int(2 * max(len(used), 1) - 1).bit_length())
    size = 1 << bits
    out = np.zeros(len(counts), np.int64)
    if not len(used):
        return out
    share = counts[used] * (size / counts.sum())
    out[used] = np.maximum(1, np.floor(share).astype(np.int64))
    over = int(out.sum()) - size
    order = used[np.argsort(-counts[used], kind="stable")]
    if over < 0:
        out[order[0]] -= over
    for i in order:  # a few of the most frequent ids give back what the rounding up took
        if over <= 0:
            break
        take = min(over, int(out[i]) // 2)
        out[i] -= take
        over -= take
    return out


def encode_block(ids: np.ndarray, table: FrequencyTable, lanes: int, checkpoint_steps: int) -> tuple[bytes, bytes, bytes]:
    """(states, words, checkpoints); written backwards, so that a reader goes forwards."""
    bits = np.uint64(table.bits)
    steps = -(-len(ids) // lanes)
    state = np.full(lanes, 1 << 31, np.uint64)
    given, sizes, marks = [], np.zeros(steps, np.int64), {}
    for step in range(steps - 1, -1, -1):
        symbols = ids[step * lanes : (step + 1) * lanes]
        f, c = table.frequency[symbols], table.start[symbols]
        x = state[: len(symbols)]
        # the next state stays below 2^63 if this one is below f * 2^(63 - bits)
        over = (x >> (np.uint64(63) - bits)) >= f
        words = x[over].astype(np.uint32)
        x = np.where(over, x >> _WORD, x)
        quotient = x // f
        state[: len(symbols)] = (quotient << bits) + (x - quotient * f) + c
        given.append(words)
        sizes[step] = len(words)
        if step and step % checkpoint_steps == 0:
            marks[step] = state.copy()
    begins = np.cumsum(sizes) - sizes
    marked = b"".join(np.array([s, begins[s]], "<u8").tobytes() + marks[s].astype("<u8").tobytes() for s in sorted(marks))
    words = np.concatenate(given[::-1]) if given else np.zeros(0, np.uint32)
    return state.astype("<u8").tobytes(), words.astype("<u4").tobytes(), marked


def decode_block(count: int, lanes: int, states: bytes, words: bytes, table: FrequencyTable, checkpoints: bytes = b"", first: int = 0) -> np.ndarray:
    """The ids from place `first` on, from the last checkpoint before it."""
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    state, given, at, begin = np.frombuffer(states, "<u8").copy(), np.frombuffer(words, "<u4"), 0, 0
    marks = np.frombuffer(checkpoints, "<u8").reshape(-1, lanes + 2) if checkpoints else np.zeros((0, lanes + 2), np.uint64)
    for mark in marks:
        if int(mark[0]) * lanes <= first:
            begin, at, state = int(mark[0]), int(mark[1]), mark[2:].copy()
    out = np.zeros(count - begin * lanes, np.uint32)
    for step in range(begin, -(-count // lanes)):
        width = min(lanes, count - step * lanes)
        x = state[:width]
        slot = x & mask
        symbols = table.symbol[slot]
        x = table.frequency[symbols] * (x >> bits) + slot - table.start[symbols]
        under = np.flatnonzero(x >> _LOW == 0)
        if len(under):
            x[under] = (x[under] << _WORD) | given[at : at + len(under)]
            at += len(under)
        state[:width] = x
        out[(step - begin) * lanes : (step - begin) * lanes + width] = symbols
    return out[first - begin * lanes :]


def lanes_for(count: int, most: int) -> int:
    return max(1, min(most, count // 64))


def _planes(ids: np.ndarray, first: np.ndarray, byte: int) -> pa.Array:
    """One byte of each id, as a binary value for each text."""
    data = np.ascontiguousarray(ids.view(np.uint8).reshape(-1, 4)[:, byte])
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer(first.astype(np.int32)), pa.py_buffer(data)])


def _tokenised(vocabulary: Vocabulary, end: int, size: int):
    """Ids of each text as two planes of bytes, the low and the high one, or four-byte ids for a larger vocabulary.

    After its texts a task gives one row at place -1, the ids it has seen (`low`) and how often (`high`), so that nothing is read again to count.
    """
    narrow = size <= 1 << 16
    names = ["part", "place", "key", "low", "high"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, rows, totals, kind = library_encoder(vocabulary), TaskContext.get().partitionId(), 0, np.zeros(size, np.int64), None
        for batch in slices(batches):
            kind = batch.schema.field("key").type
            ids, first = encoder.encode_batch(batch.column("text"), end)
            totals += np.bincount(ids, minlength=size)
            if narrow:
                low, high = _planes(ids, first, 0), _planes(ids, first, 1)
            else:
                low = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((4 * first).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids))])
                high = pa.nulls(batch.num_rows, pa.binary())
            place = np.arange(rows, rows + batch.num_rows)
            rows += batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(place), batch.column("key"), low, high], names)
        if rows:
            seen = np.flatnonzero(totals)
            values = [pa.array([part], pa.int32()), pa.array([-1], pa.int64()), pa.nulls(1, kind), pa.array([seen.astype("<u4").tobytes()]), pa.array([totals[seen].astype("<i8").tobytes()])]
            yield pa.RecordBatch.from_arrays(values, names)

    return apply


def _ids(low: bytes, high: bytes | None) -> np.ndarray:
    if high is None:
        return np.frombuffer(low, "<u4")
    return np.frombuffer(low, np.uint8).astype(np.uint32) | (np.frombuffer(high, np.uint8).astype(np.uint32) << 8)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for seen, counts in zip(batch.column("low").to_pylist(), batch.column("high").to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(seen, "<u4").astype(np.int64)), pa.array(np.frombuffer(counts, "<i8"))], ["id", "n"])


def _blocks(shared: Broadcast, block_tokens: int, lanes: int, checkpoint_steps: int):
    """Documents that follow each other in a part to blocks; a block is known by the place of its first document."""

    def block(part: int, first: int, keys: list, texts: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
        ids = np.concatenate(texts)
        width = lanes_for(len(ids), lanes)
        states, words, marks = encode_block(ids, shared.value, width, checkpoint_steps)
        lengths = np.array([len(t) for t in texts], "<u4").tobytes()
        checks = payload_check(states, words, marks, lengths), zlib.crc32(ids.astype("<u4").tobytes())
        values = [part, first, keys, lengths, len(ids), width, states, words, marks, *checks]
        kinds = [pa.int32(), pa.int64(), pa.list_(kind), pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        names = [field.split(" ")[0] for field in BLOCK.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, keys, texts, held, kind = -1, 0, [], [], 0, pa.int64()
        for batch in slices(batches, "low"):
            kind = batch.schema.field("key").type
            for own, place, key, low, high in zip(*[batch.column(c).to_pylist() for c in ("part", "place", "key", "low", "high")]):
                if texts and (own != part or place != first + len(texts) or held >= block_tokens):
                    yield block(part, first, keys, texts, kind)
                    keys, texts, held = [], [], 0
                if not texts:
                    part, first = own, place
                keys.append(key)
                texts.append(_ids(low, high))
                held += len(texts[-1])
        if texts:
            yield block(part, first, keys, texts, kind)

    return apply


def payload_check(states: bytes, words: bytes, checkpoints: bytes, lengths: bytes) -> int:
    return zlib.crc32(lengths, zlib.crc32(checkpoints, zlib.crc32(words, zlib.crc32(states))))


def write_ids(
    documents: DataFrame,
    vocabulary_path: str,
    folder: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    bits: int = 20,
    block_tokens: int = 1 << 18,
    lanes: int = 2048,
    checkpoint_steps: int = 64,
) -> None:
    """Encode all documents into the file set `folder`, in ascending order of the key.

    Texts are placed by ranges of the key once; the ids are written aside, counted, and coded with the shared table.
    """
    spark = documents.sparkSession
    ship(spark)
    vocabulary = Vocabulary.read(spark, vocabulary_path)
    rows = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    ordered = rows.repartitionByRange("key").sortWithinPartitions("key")
    aside = new_folder(spark, "ids")
    size = max(vocabulary.size, end_id + 1)
    ordered.mapInArrow(_tokenised(vocabulary, end_id, size), f"part int, place bigint, key {kind}, low binary, high binary").write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "1").parquet(aside)
    staged = spark.read.parquet(aside)
    counted = staged.filter("place < 0").select("low", "high").mapInArrow(_counts, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size, np.int64)  # as many as the vocabulary has
    counts[counted.column("id").to_numpy()] = counted.column("n").to_numpy()
    frequency = scaled(counts, bits)
    spark.createDataFrame(pa.table({"id": np.flatnonzero(frequency), "frequency": frequency[frequency > 0]})).coalesce(1).write.parquet(f"{folder}/table")
    shared = spark.sparkContext.broadcast(FrequencyTable.of(frequency))  # 2^bits slots
    coded = staged.filter("place >= 0").mapInArrow(_blocks(shared, block_tokens, lanes, checkpoint_steps), BLOCK.format(kind=kind))
    coded.write.option("compression", "none").parquet(f"{folder}/blocks")


def read_table(spark: SparkSession, folder: str) -> FrequencyTable:
    """The shared table: one row for each id that occurs."""
    rows = spark.read.parquet(f"{folder}/table").toArrow()
    ids = rows.column("id").to_numpy()
    frequency = np.zeros(int(ids.max()) + 1 if len(ids) else 0, np.int64)
    frequency[ids] = rows.column("frequency").to_numpy()
    return FrequencyTable.of(frequency)


def _decoded(shared: Broadcast, whole: bool):
    """Documents of each block: their ids, or only how many there are and their checksum."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "words"):
            for row in batch.to_pylist():
                if payload_check(row["states"], row["words"], row["checkpoints"], row["lengths"]) != row["payload_crc32"]:
                    raise ValueError(f"block {row['part']}:{row['first']} is damaged")
                ids = decode_block(row["n_tokens"], row["lanes"], row["states"], row["words"], shared.value)
                flat = memoryview(ids.astype("<u4").tobytes())
                if zlib.crc32(flat) != row["ids_crc32"]:
                    raise ValueError(f"block {row['part']}:{row['first']} does not decode to what was coded")
                ends = np.cumsum(np.frombuffer(row["lengths"], "<u4").astype(np.int64))
                starts = np.concatenate([[0], ends[:-1]])
                docs = [flat[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                count, kind = len(docs), batch.schema.field("keys").type.value_type
                place = [pa.array([row["before"]] * count, pa.int64()), pa.array(row["keys"], kind), pa.array(starts)]
                found = [pa.array([bytes(d) for d in docs], pa.binary())] if whole else [pa.array(ends - starts), pa.array([zlib.crc32(d) for d in docs], pa.int64())]
                yield pa.RecordBatch.from_arrays([*place, *found], ["before", "key", "start", *(["ids"] if whole else ["n_tokens", "ids_crc32"])])

    return apply


def _read(spark: SparkSession, folder: str, key: str, whole: bool) -> DataFrame:
    """The ids before a block are those of the parts before its own and of the blocks before it in its part."""
    ship(spark)
    blocks = spark.read.parquet(f"{folder}/blocks")
    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    shared = spark.sparkContext.broadcast(read_table(spark, folder))
    sizes = blocks.select("part", "first", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("of_parts"))  # a row per range of keys
    inside = Window.partitionBy("part").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("in_part", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts, "part")
    before = stage(before.select("part", "first", (F.col("of_parts") + F.col("in_part")).alias("before")), "block-places")
    found = "ids binary" if whole else "n_tokens bigint, ids_crc32 bigint"
    rows = blocks.join(before, ["part", "first"]).mapInArrow(_decoded(shared, whole), f"before bigint, key {kind}, start bigint, {found}")
    return rows.select(F.col("key").alias(key), (F.col("before") + F.col("start")).alias("start"), *[c.split(" ")[0] for c in found.split(", ")])


def read_ids(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """`(key, start, ids)` of all documents of a file set: every block is checked and decodes on its own."""
    return _read(spark, folder, key, True)


def read_checksums(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """`(key, start, n_tokens, ids_crc32)`, the same of decoded ids that stay in their task."""
    return _read(spark, folder, key, False)
