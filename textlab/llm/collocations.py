"""Collocations: phrases whose words come together more often than they would apart, found by Rabin-Karp fingerprints.

Texts are lower-cased (A-Z), cut into pieces at `.,;:!?` and line ends, and pieces into words at blanks and tabs. All counts
are per language. A candidate is a phrase of 2 to `longest` words with f(phrase) >= `least`. Cut after its first k words, it scores
floor(1 000 000 a a / (l r)) with a = f(phrase), l = f(first part), r = f(rest); its lowest cut counts. A candidate goes if a
longer candidate that holds it has at least `inside_percent` of its occurrences.

In a task, the words of many texts lie in one stream. A word has a polynomial over its letters, and prefix sums of a polynomial over
the words of the stream give the fingerprint of any n-gram in constant time. Level by level a shuffle adds up fingerprints alone: those that can still be frequent, since an
n-gram cannot be if one of its two (n-1)-grams is not. They are sent in packed rows, one for each slice of texts and range of fingerprints, and added up
range by range. Frequent fingerprints of a level are kept as a bit map of a fixed size
(2^`bits` bits); one that is in it by chance costs work and no result. In the last pass, a task groups the occurrences of
fingerprints in the map, takes the first of each group as pointer, compares the words of all others with the text there, and splits
what differs; so equal fingerprints of different phrases do not mix. Only these phrases become text, and a second shuffle adds up
the counts of texts. Pointers stay in their task: place, start and length would take more bytes than the text of a phrase.

A null text is empty, a null language is `und`. Rows given twice count twice. Empty tables and texts give no phrases. Only the text and
the language are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from textlab.llm.word_hash import Runs, mixed, powers
from textlab.llm.workers import flat_bytes, ship, slices
from textlab.session import stage

_BREAK, _INSIDE, _LOWER = np.zeros(256, bool), np.ones(256, bool), np.arange(256, dtype=np.uint8)
_BREAK[[*b".,;:!?\n\x0b\x0c\r"]] = True
_INSIDE[[*b" \t"]] = False
_INSIDE &= ~_BREAK
_LOWER[ord("A") : ord("Z") + 1] += 32
_LETTER_BASE = 0x9E3779B97F4A7C15
_BLOCK = 15  # bits of a place inside a row of a bit map
_SLICE_BYTES = 2 << 20  # of text at a time
_MOST_SENT = 1 << 21  # fingerprints in a batch of packed rows


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lengths = ends - starts
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


@dataclass
class Stream:
    """Words of many texts in a row."""

    letters: np.ndarray  # of all words, nothing between them
    first: np.ndarray  # place of the first letter of each word, and the number of all letters
    piece: np.ndarray  # of each word; ascending over all texts
    language: np.ndarray  # of each word, a place in `languages`
    languages: list[str]
    runs: Runs

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Stream:
        data, offsets = flat_bytes(batch.column("text"))
        inside = _INSIDE[data]
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(inside))]
        before[cuts], after[cuts - 1] = False, False
        starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        text = np.searchsorted(offsets, starts, side="right") - 1
        piece = np.cumsum(_BREAK[data], dtype=np.int32)[starts] + text if len(starts) else starts
        letters, lengths = _LOWER[data[inside]], ends - starts
        named = pc.fill_null(batch.column("lang"), "und").dictionary_encode()
        language = named.indices.to_numpy().astype(np.int64)[text]
        return cls(letters, np.concatenate([[0], np.cumsum(lengths)]), piece, language, named.dictionary.to_pylist(), Runs(_word_hashes(letters, lengths)))

    def grams(self, n: int) -> np.ndarray:
        """Places of the words that start an n-gram."""
        count = len(self.piece) - n + 1
        return np.flatnonzero(self.piece[:count] == self.piece[n - 1 :]) if count > 0 else np.zeros(0, np.int64)

    def fingerprints(self, at: np.ndarray, n: int) -> np.ndarray:
        salts = np.array([xxhash.xxh64_intdigest(name.encode(), n) for name in self.languages], np.uint64)
        return mixed(self.runs.of(at, at + n) ^ salts[self.language[at]]) if len(at) else np.zeros(0, np.uint64)

    def possible(self, n: int, maps: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Places and fingerprints of the n-grams both of whose (n-1)-grams may be frequent."""
        at = self.grams(n)
        if n > 1:
            shorter = np.zeros(len(self.piece), bool)
            places = self.grams(n - 1)
            shorter[places] = has(maps[n - 1], self.fingerprints(places, n - 1))
            at = at[shorter[at] & shorter[at + 1]]
        return at, self.fingerprints(at, n)

    def codes(self) -> np.ndarray:
        """A number for each word, the same for equal words and only for these."""
        words = pa.Array.from_buffers(pa.large_binary(), len(self.piece), [None, pa.py_buffer(self.first), pa.py_buffer(self.letters)])
        return words.dictionary_encode().indices.to_numpy()

    def texts(self, at: np.ndarray, n: int) -> pa.Array:
        """The n-grams at these places, their words with a blank between."""
        words = ranges(at, at + n)
        lengths = self.first[words + 1] - self.first[words]
        blanks = np.ones(len(words), np.int64)
        blanks[n - 1 :: n] = 0
        begins = np.cumsum(lengths + blanks) - (lengths + blanks)
        out = np.full(int((lengths + blanks).sum()), ord(" "), np.uint8)
        out[ranges(begins, begins + lengths)] = self.letters[ranges(self.first[words], self.first[words + 1])]
        bounds = np.concatenate([begins[::n], [len(out)]]).astype(np.int32)
        return pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(out)])


def _word_hashes(letters: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A polynomial over the letters of each word, modulo 2^64; equal for equal words, and for some others."""
    if not len(lengths):
        return np.zeros(0, np.uint64)
    at = np.cumsum(lengths) - lengths
    place = np.arange(len(letters), dtype=np.int32) - np.repeat(at.astype(np.int32), lengths)
    summands = powers(_LETTER_BASE, int(lengths.max()))[place]
    summands *= letters + np.uint64(1)
    return mixed(np.add.reduceat(summands, at))


def probes(fingerprints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return fingerprints & np.uint64((1 << bits) - 1), fingerprints >> np.uint64(64 - bits)


def has(bitmap: np.ndarray, fingerprints: np.ndarray) -> np.ndarray:
    found = np.ones(len(fingerprints), bool)
    for place in probes(fingerprints, int(len(bitmap) * 8).bit_length() - 1):
        found &= (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
    return found


def verified(stream: Stream, codes: np.ndarray, at: np.ndarray, fingerprints: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first occurrence of each phrase and how many it has; occurrences count if their words are those at the first."""
    firsts, counts = [], []
    while len(at):
        _, first, own = np.unique(fingerprints, return_index=True, return_inverse=True)
        pointer = at[first][own]
        same = stream.language[at] == stream.language[pointer]
        for i in range(n):
            same &= codes[at + i] == codes[pointer + i]
        firsts.append(at[first])
        counts.append(np.bincount(own[same], minlength=len(first)))
        at, fingerprints = at[~same], fingerprints[~same]  # collisions: other phrases with the fingerprint of an earlier one
    return (np.concatenate(firsts), np.concatenate(counts)) if firsts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def summed(fingerprints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint once, in ascending order, with the sum of its counts."""
    if not len(fingerprints):
        return fingerprints, counts
    order = np.argsort(fingerprints)
    fingerprints, counts = fingerprints[order], counts[order]
    cuts = np.flatnonzero(np.concatenate([[True], fingerprints[1:] != fingerprints[:-1]]))
    return fingerprints[cuts], np.add.reduceat(counts, cuts)


def _counted(n: int, maps: Broadcast, buckets: int):
    """Fingerprints of each slice and their counts, a row for each bucket: buckets are ranges of fingerprints."""
    bounds = np.arange(buckets, dtype=np.uint64) << np.uint64(65 - buckets.bit_length())

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=_SLICE_BYTES):
            found, counts = np.unique(Stream.of(batch).possible(n, maps.value)[1], return_counts=True)
            for low in range(0, len(found), _MOST_SENT):
                prints, ns = found[low : low + _MOST_SENT], counts[low : low + _MOST_SENT].astype(np.uint32)
                edges = np.append(np.searchsorted(prints, bounds), len(prints))
                there = np.flatnonzero(np.diff(edges))
                ends = np.append(edges[there], len(prints)).astype(np.int32)
                packed = [pa.Array.from_buffers(pa.binary(), len(there), [None, pa.py_buffer(ends * x.itemsize), pa.py_buffer(x)]) for x in (prints, ns)]
                yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), *packed], ["bucket", "fingerprints", "counts"])

    return apply


def _frequent(least: int):
    """Fingerprints with `least` occurrences or more, from rows in order of buckets; a task holds the fingerprints of one bucket."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, prints, counts, waiting = None, [], [], 0

        def ended() -> pa.RecordBatch:
            found, ns = summed(np.concatenate(prints), np.concatenate(counts))
            return pa.RecordBatch.from_arrays([pa.array(found[ns >= least].view(np.int64))], ["fingerprint"])

        for batch in batches:
            numbers = batch.column("bucket").to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]])) if len(numbers) else []
            for low, high in zip(cuts, [*cuts[1:], len(numbers)]):
                if numbers[low] != bucket:
                    if prints:
                        yield ended()
                    bucket, prints, counts, waiting = numbers[low], [], [], 0
                flat = [flat_bytes(batch.column(c).slice(low, high - low))[0] for c in ("fingerprints", "counts")]
                prints.append(np.frombuffer(flat[0].tobytes(), np.uint64))
                counts.append(np.frombuffer(flat[1].tobytes(), np.uint32).astype(np.int64))
                waiting += len(prints[-1])
                if waiting > max(_MOST_SENT, len(prints[0])):
                    found, ns = summed(np.concatenate(prints), np.concatenate(counts))
                    prints, counts, waiting = [found], [ns], 0
        if prints:
            yield ended()

    return apply


def _materialised(longest: int, maps: Broadcast):
    """Phrases that may be frequent as text, and a row of no words with the number of all words of each language."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=_SLICE_BYTES // 2):
            stream = Stream.of(batch)
            names, codes = pa.array(stream.languages, pa.string()), stream.codes()
            totals = np.bincount(stream.language, minlength=len(stream.languages))
            yield _rows(names, 0, pa.array([""] * len(totals), pa.string()), totals)
            for n in range(1, longest + 1):
                at, fingerprints = stream.possible(n, maps.value)
                there = has(maps.value[n], fingerprints)
                first, counts = verified(stream, codes, at[there], fingerprints[there], n)
                yield _rows(names.take(pa.array(stream.language[first])), n, stream.texts(first, n), counts)

    return apply


def _rows(languages: pa.Array, words: int, phrases: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([languages, pa.array(np.full(len(phrases), words, np.int32)), phrases, pa.array(counts.astype(np.int64))], ["lang", "words", "phrase", "n"])


def _packed_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of 2^15 bits from the places of set bits; a task holds no more than its part of the map."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        block, place = batch.column("block").to_numpy(), batch.column("place").to_numpy()
        order = np.argsort(block, kind="stable")
        block, place = block[order], place[order]
        cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else []
        for low, high in zip(cuts, [*cuts[1:], len(block)]):
            number, places = int(block[low]), place[low:high]
            if number not in held:
                held[number] = np.zeros(1 << (_BLOCK - 3), np.uint8)
            np.bitwise_or.at(held[number], places >> 3, np.uint8(1) << (places & 7).astype(np.uint8))
    for number, bits in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([bits.tobytes()])], ["block", "bits"])


def _bitmap(frequent: DataFrame, bits: int) -> np.ndarray:
    """A bit map of 2^bits bits, whatever the number of fingerprints."""
    low, high = F.col("fingerprint").bitwiseAND(F.lit((1 << bits) - 1)), F.shiftrightunsigned("fingerprint", 64 - bits)
    places = frequent.select(F.explode(F.array(low, high)).alias("p")).select(F.shiftright("p", _BLOCK).alias("block"), F.col("p").bitwiseAND(F.lit((1 << _BLOCK) - 1)).cast("int").alias("place"))
    rows = places.repartition("block").mapInArrow(_packed_blocks, "block bigint, bits binary").toArrow()  # 2^bits / 8 bytes
    out = np.zeros((max(1, 1 << (bits - _BLOCK)), 1 << (_BLOCK - 3)), np.uint8)
    for block, packed in zip(rows.column("block").to_pylist(), rows.column("bits").to_pylist()):
        out[block] = np.frombuffer(packed, np.uint8)
    return out.reshape(-1)


def phrase_counts(documents: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, least: int = 10, bits: int = 27, buckets: int = 1024) -> DataFrame:
    """`(lang, words, phrase, f)` of all phrases of 1 to `longest` words with f >= least, and of the empty phrase, f being all words."""
    if not _BLOCK <= bits <= 32:
        raise ValueError(f"a bit map has 2^{_BLOCK} to 2^32 bits")
    if buckets < 2 or buckets & (buckets - 1):
        raise ValueError("the number of buckets is a power of two, 2 or more")
    spark = documents.sparkSession
    ship(spark)
    rows = documents.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    maps: dict[int, np.ndarray] = {}
    for n in range(1, longest + 1):
        below = spark.sparkContext.broadcast({n - 1: maps.get(n - 1)})
        counted = rows.mapInArrow(_counted(n, below, buckets), "bucket int, fingerprints binary, counts binary")
        frequent = counted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_frequent(least), "fingerprint bigint")
        maps[n] = _bitmap(frequent, bits)
    shared = spark.sparkContext.broadcast(maps)
    found = rows.mapInArrow(_materialised(longest, shared), "lang string, words int, phrase string, n bigint")
    summed = found.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f"))
    return summed.filter((F.col("f") >= least) | (F.col("words") == 0))


def scored(phrases: DataFrame) -> DataFrame:
    """`(lang, words, phrase, a, score, k, l, r)` of the phrases of two words or more, by their lowest cut; ties to the smallest k."""
    counts = phrases.select("lang", "phrase", "f")
    part = lambda start, length: F.array_join(F.slice(F.split("phrase", " "), start, length), " ")
    cuts = phrases.filter("words >= 2").select("lang", "words", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": part(F.lit(1), F.col("k")), "rest": part(F.col("k") + 1, F.col("words") - F.col("k"))})
    with_l = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    both = with_l.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    wide = {c: F.col(c).cast("decimal(15,0)") for c in "alr"}  # counts below 10^15; the products fit 38 digits
    both = both.select("*", *[column.alias(f"wide_{c}") for c, column in wide.items()])
    score = F.expr("(cast(1000000 AS decimal(7,0)) * wide_a * wide_a) div (wide_l * wide_r)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return both.groupBy("lang", "words", "phrase", "a").agg(lowest).select("lang", "words", "phrase", "a", "cut.*")


def without_contained(candidates: DataFrame, inside_percent: int = 50) -> DataFrame:
    """The rows whose phrase is in no longer one, dropped or not, with that share of its occurrences."""
    widths = F.sequence(F.lit(2), F.col("words") - 1)
    longer = candidates.filter("words >= 3").select("lang", "words", "a", F.split("phrase", " ").alias("w"), F.explode(widths).alias("width"))
    placed = longer.select("lang", "a", "w", "width", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("width") + 1)).alias("start"))
    inner = placed.select("lang", F.array_join(F.slice("w", F.col("start"), F.col("width")), " ").alias("phrase"), "a")
    most = inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    both = candidates.join(most, ["lang", "phrase"], "left")
    return both.filter(F.col("most").isNull() | (100 * F.col("most") < inside_percent * F.col("a"))).drop("most")


def collocations(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = 3,
    least: int = 10,
    inside_percent: int = 50,
    best: int = 2000,
    bits: int = 27,
    parts: int = 64,
) -> DataFrame:
    """`(lang, rank, phrase, a, l, r, n, score)`: the `best` candidates of each language, n being its number of words."""
    phrases = stage(phrase_counts(documents, text, lang, longest, least, bits), "phrases")
    kept = without_contained(stage(scored(phrases), "scored"), inside_percent)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))  # the candidates of a language never meet in one task
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= best).drop("rank")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= best)
    totals = phrases.filter("words = 0").select("lang", F.col("f").alias("n"))
    numbers = [F.col(c).cast("bigint").alias(c) for c in ("a", "l", "r", "n", "score")]
    return ranked.join(totals, "lang").select(F.col("lang").alias(lang), F.col("rank").cast("bigint").alias("rank"), "phrase", *numbers)
