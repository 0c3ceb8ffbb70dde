"""Whole texts to token ids, with the pieces between blanks encoded once per worker.

A byte-level vocabulary splits a text before it merges, and always before a blank that stands between two
characters other than white space. So a text is cut there, and a piece gets the same ids wherever it
stands. Each worker keeps the ids of the pieces it has met, up to a number of entries, and lets the
`tokenizers` library (or another encoder of words) see the new ones.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import sys
from array import array
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import SparkSession
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

MEMO_PIECES = 600_000
LONGEST_KEPT = 48  # characters of a piece that is worth keeping
_NOT_SIMPLE = re.compile(r" (?=\s|\Z)")
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
# The same as `_NOT_SIMPLE` for a library whose `\s` is ASCII only.
_NOT_SIMPLE_ASCII = r" (?:[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|\z)"


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


_LETTERS = byte_letters()
# Letters, then signs that are neither letter, number, white space nor apostrophe, then perhaps the same
# after one line feed: a byte-level vocabulary always splits after the letters, whatever follows.
_LETTER, _SIGN = r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]", r"[!-&(-/:-@\[-`{-~]"
_MARKS = frozenset(".,;:!?")
_SIMPLE = re.compile(f"({_LETTER}+)?{_SIGN}*(?:\n{_LETTER}*{_SIGN}*)?")


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer file of the `tokenizers` library, sent to the tasks: its size is that of the vocabulary."""

    source: Broadcast
    digest: str
    size: int

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            text = file.read()
        return cls(spark.sparkContext.broadcast(text), hashlib.sha256(text.encode()).hexdigest(), Tokenizer.from_str(text).get_vocab_size())


def packed(ids: list[int]) -> bytes:
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


class _Memo(dict):
    """Ids of pieces as little-endian 32-bit integers; a missing piece is encoded.

    `lead` is what stands before each piece. The memo takes pieces until it is full: frequent ones come early.
    """

    def __init__(self, encode_word: Callable[[str], bytes], split: Callable, lead: str, simple: bool) -> None:
        self.encode_word, self.split, self.lead, self.simple = encode_word, split, lead, simple
        self.letter_lead = "".join(_LETTERS[b] for b in lead.encode())

    def __missing__(self, piece: str) -> bytes:
        if self.simple and piece[-1:] in _MARKS and piece[:-1].isalpha() and piece.isascii():
            return self[piece[:-1]] + self.rest[piece[-1]]  # not kept: the memo is for words
        parts = _SIMPLE.fullmatch(piece) if self.simple else None
        if parts is None:
            ids = b"".join([self.encode_word(word) for word, _ in self.split(self.lead + piece)])
        elif parts[1] == piece and piece:
            if piece.isascii():  # letters stand for themselves
                ids = self.encode_word(self.letter_lead + piece)
            else:
                ids = self.encode_word((self.lead + piece).encode().decode("latin-1").translate(_LETTERS))
        elif parts[1]:
            ids = self[parts[1]] + self.rest[piece[len(parts[1]) :]]
        else:
            ids = b"".join([self.encode_word(word) for word, _ in self.split(self.lead + piece)])
        if len(piece) <= LONGEST_KEPT and len(self) < MEMO_PIECES:
            self[piece] = ids
        return ids


class TextEncoder:
    def __init__(self, tokenizer: Tokenizer, encode_word: Callable[[str], bytes]) -> None:
        """`encode_word` gets one word in the letters of the vocabulary and gives its ids."""
        added = json.loads(tokenizer.to_str())["added_tokens"]
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] for a in added):
            raise ValueError("added tokens with options are not supported")
        self.added = {a["content"]: packed([a["id"]]) for a in added}
        self.cut = re.compile("(" + "|".join(re.escape(c) for c in sorted(self.added, key=len, reverse=True)) + ")") if added else None
        split = tokenizer.pre_tokenizer.pre_tokenize_str
        simple = isinstance(tokenizer.pre_tokenizer, ByteLevel) and tokenizer.normalizer is None and not tokenizer.pre_tokenizer.add_prefix_space
        self.first, self.later = (_Memo(encode_word, split, lead, simple) for lead in ("", " "))
        self.first.rest = self.later.rest = self.first

    def _plain(self, text: str) -> bytes:
        pieces = _BETWEEN.split(text) if _NOT_SIMPLE.search(text) else text.split(" ")
        later = iter(pieces)
        head = self.first[next(later)]
        return head + b"".join(map(self.later.__getitem__, later))

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers; a null text is empty."""
        if not text:
            return b""
        if self.cut is None or not any(c in text for c in self.added):
            return self._plain(text)
        return b"".join(self.added.get(part) or self._plain(part) for part in self.cut.split(text) if part)


    def encode_batch(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many texts in a row, each with the id `end` after it, and the place of the first id of each and the number of all.

        Pieces are numbered by the batch's own dictionary, so that a piece that comes often is looked up once.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, _NOT_SIMPLE_ASCII)
        for content in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, content))
        odd = odd.to_numpy(zero_copy_only=False) | (pc.binary_length(texts).to_numpy() == 0)
        plain = np.flatnonzero(~odd)
        pieces = pc.split_pattern(texts.take(pa.array(plain)), " ")
        offsets = pieces.offsets.to_numpy()
        counts = np.ones(len(texts), np.int64)
        counts[plain] = np.diff(offsets)
        counts += end is not None
        first = np.concatenate([[0], np.cumsum(counts)])
        known = pieces.flatten().dictionary_encode()
        table = list(map(self.later.__getitem__, known.dictionary.to_pylist()))
        heads = pieces.flatten().take(pa.array(offsets[:-1])).to_pylist()
        size = len(table)
        table += [self.first[head] for head in heads]
        table += [self.encode(text) for text in texts.take(pa.array(np.flatnonzero(odd))).to_pylist()]
        table.append(packed([end]) if end is not None else b"")
        code = np.full(int(first[-1]), len(table) - 1, np.int64)
        inner = counts[plain] - (end is not None)
        code[np.repeat(first[plain] - offsets[:-1], inner) + np.arange(offsets[-1] - offsets[0])] = known.indices.to_numpy()
        code[first[plain]] = size + np.arange(len(plain))
        code[first[:-1][odd]] = size + len(plain) + np.arange(int(odd.sum()))
        lengths = np.fromiter(map(len, table), np.int64, len(table)) // 4
        flat, begin, own = np.frombuffer(b"".join(table), "<u4"), np.cumsum(lengths) - lengths, lengths[code]
        ends = np.concatenate([[0], np.cumsum(own)])
        ids = flat[np.repeat(begin[code] - ends[:-1], own) + np.arange(ends[-1])]
        return ids, ends[first]


@functools.lru_cache(maxsize=2)
def _library_encoder(digest: str, text: str) -> TextEncoder:
    tokenizer = Tokenizer.from_str(text)
    tokenize = tokenizer.model.tokenize
    return TextEncoder(tokenizer, lambda word: packed([t.id for t in tokenize(word)]))


def library_encoder(vocabulary: Vocabulary) -> TextEncoder:
    """In a task: the worker's encoder that asks the library for the ids of a word."""
    return _library_encoder(vocabulary.digest, vocabulary.source.value)
