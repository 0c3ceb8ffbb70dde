"""Token lists. Each function takes and returns a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from textlab.functions import patterns as P
from textlab.functions.words import STOP_WORDS


def tokenize_words(text: Column) -> Column:
    """Words, clitics (`n't`, `'s`, ...) and single punctuation marks, by rule instead of a language model."""
    apart = F.regexp_replace(text, F.lit("(?i)(n't)"), F.lit(" $1"))
    apart = F.regexp_replace(apart, F.lit(f"(?i)({P.CLITIC})"), F.lit(" $1"))
    return F.regexp_extract_all(apart, F.lit(P.WORD_TOKEN), F.lit(0))


def remove_stopwords(
    tokens: Column, stop_words: Sequence[str] = STOP_WORDS, negators: Sequence[str] = ()
) -> Column:
    """Drop stop words in any case; `negators` stay."""
    dropped = sorted({word.lower() for word in stop_words} - set(negators))
    return F.filter(tokens, lambda token: ~F.lower(token).isin(dropped))


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def vector_tokens(text: Column) -> Column:
    """Vectoriser analysis: lower case, then every run of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(P.VECTOR_TOKEN), F.lit(0))


def ngrams(tokens: Column, lo: int, hi: int) -> Column:
    """All n-grams with lo <= n <= hi, joined by one blank, shorter ones first."""
    if not 1 <= lo <= hi:
        raise ValueError(f"n-gram range ({lo}, {hi}) is not valid")

    def of_length(words: Column, n: int) -> Column:
        if n == 1:
            return words
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(words, i + step) for step in range(n)]))

    if lo == hi == 1:
        return tokens
    # The one-element array binds the token list, so that it is computed once per row.
    bound = F.transform(F.array(tokens), lambda words: F.concat(*[of_length(words, n) for n in range(lo, hi + 1)]))
    return F.get(bound, F.lit(0))
