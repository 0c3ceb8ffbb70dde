"""Exact byte-pair encoding by a dynamic programme over prefixes, and decoding.

For each prefix of a word there is one last token of its encoding. The tokens that end at a place are the
matches of an automaton over the vocabulary. A match is the last token if the token before it, the last one of
the prefix it leaves, may stand before it: merging the bytes of both must not join anything across
their border. The back-pointers give the ids. The work per word is linear in its length, however long it is.

Null and empty texts have no ids and decode to the empty text. Rows given twice come out twice.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from textlab.llm.tokens import TextEncoder, Vocabulary, byte_letters, packed
from textlab.llm.workers import ship, slices

PAIRS_KEPT = 400_000


class Merges:
    """Vocabulary as words over its letters, and the merge that makes each token."""

    def __init__(self, model: dict) -> None:
        self.ids: dict[str, int] = model["vocab"]
        self.rank_of_pair: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made_at: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = (self.ids[left], self.ids[right])
            self.rank_of_pair.setdefault(pair, rank)
            token = self.ids[left + right]
            if token not in self.parts:
                self.parts[token] = pair
                self.made_at[token] = rank
        self._compatible: dict[tuple[int, int], bool] = {}
        self.whole: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton()
        for word, token in self.ids.items():
            if self._reachable(word, token):
                self.automaton.add_word(word, (token, len(word)))
                self.whole[word] = token
        self.automaton.make_automaton()

    def _reachable(self, word: str, token: int) -> bool:
        """Whether the merges make the token out of its own letters."""
        if len(word) == 1:
            return True
        return token in self.parts and self.compatible(*self.parts[token], below=self.made_at[token])

    def compatible(self, left: int, right: int, below: int | None = None) -> bool:
        """Whether merging keeps a border between two tokens (up to the merge `below`, if given).

        Seen backwards in time: the two tokens at the border come apart, the one made last first. While
        two tokens lie at the border their pair is merged unless one of them is taken by a merge of its
        own before that; of equal merges the left one goes first.
        """
        limit = len(self.rank_of_pair) if below is None else below
        made = self.made_at
        while True:
            if self.rank_of_pair.get((left, right), limit) < limit:
                return False
            a, b = made.get(left, -1), made.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = a, self.parts[left][1]
            else:
                limit, right = b + 1, self.parts[right][0]

    def may_follow(self, left: int, right: int) -> bool:
        known = self._compatible.get((left, right))
        if known is None:
            if len(self._compatible) >= PAIRS_KEPT:
                self._compatible.clear()
            known = self._compatible[(left, right)] = self.compatible(left, right)
        return known

    def encode(self, word: str) -> list[int]:
        whole = self.whole.get(word)
        if whole is not None:
            return [whole]
        size = len(word)
        last = [0] * (size + 1)
        width = [0] * (size + 1)
        for end, (token, length) in self.automaton.iter(word):
            if width[end + 1]:
                continue
            start = end + 1 - length
            if start == 0 or width[start] and self.may_follow(last[start], token):
                last[end + 1], width[end + 1] = token, length
        ids, at = [], size
        while at:
            if not width[at]:
                raise ValueError(f"no token ends at {at} of a word of {size} letters")
            ids.append(last[at])
            at -= width[at]
        return ids[::-1]


class Decoder:
    """Ids to text: the bytes of all tokens, with broken UTF-8 replaced as usual."""

    def __init__(self, tokenizer: dict, letters: dict[int, str]) -> None:
        back = {c: b for b, c in letters.items()}
        words = tokenizer["model"]["vocab"] | {a["content"]: a["id"] for a in tokenizer["added_tokens"]}
        self.bytes = [b""] * (max(words.values()) + 1)
        for word, token in words.items():
            self.bytes[token] = bytes(back[c] for c in word) if all(c in back for c in word) else word.encode()

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", errors="replace")


@functools.lru_cache(maxsize=2)
def _coder(digest: str, text: str) -> tuple[TextEncoder, Decoder]:
    merges = Merges(json.loads(text)["model"])
    encoder = TextEncoder(Tokenizer.from_str(text), lambda word: packed(merges.encode(word)))
    return encoder, Decoder(json.loads(text), byte_letters())


def coder(vocabulary: Vocabulary) -> tuple[TextEncoder, Decoder]:
    return _coder(vocabulary.digest, vocabulary.source.value)


def encode_texts(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`(key, ids)` with the ids as little-endian unsigned 32-bit integers."""
    ship(documents.sparkSession)
    vocabulary = Vocabulary.read(documents.sparkSession, path)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = coder(vocabulary)
        for batch in slices(batches):
            ids = [encoder.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(ids, pa.binary())], ["key", "ids"])

    rows = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(apply, f"key {rows.schema['key'].dataType.simpleString()}, ids binary").withColumnRenamed("key", key)


def decode_ids(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """The rows of `(key, ids)` with the decoded text."""
    ship(encoded.sparkSession)
    vocabulary = Vocabulary.read(encoded.sparkSession, path)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = coder(vocabulary)
        for batch in slices(batches, "ids"):
            texts = [decoder.decode(i or b"") for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("ids"), pa.array(texts, pa.string())], ["key", "ids", "text"])

    rows = encoded.select(F.col(f"`{key}`").alias("key"), "ids")
    return rows.mapInArrow(apply, f"key {rows.schema['key'].dataType.simpleString()}, ids binary, text string").withColumnRenamed("key", key)


def digests(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`(key, n_tokens, ids_sha256, decoded_sha256)` of the ids and of what they decode to.

    Both steps run in one task, so that an executor has one Python worker, with its memos, per core.
    """
    ship(documents.sparkSession)
    vocabulary = Vocabulary.read(documents.sparkSession, path)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = coder(vocabulary)
        for batch in slices(batches):
            ids = [encoder.encode(t) for t in batch.column("text").to_pylist()]
            texts = [decoder.decode(i) for i in ids]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(ids, pa.binary()), pa.array(texts, pa.string())], ["key", "ids", "text"])

    rows = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    both = rows.mapInArrow(apply, f"key {rows.schema['key'].dataType.simpleString()}, ids binary, text string")
    size = (F.octet_length("ids") / 4).cast("bigint")
    return both.select(F.col("key").alias(key), size.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
