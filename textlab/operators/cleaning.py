"""Configured text cleaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from textlab.functions import text as X, tokens as K
from textlab.functions.words import STOP_WORDS
from textlab.operators.lookup import fits_broadcast, lookup_join
from textlab.session import ship, stage


def lemmatize(df: DataFrame, lemma_table: DataFrame, key: str = "index", tokens: str = "tokens") -> DataFrame:
    """Replace each token by its lemma from `(form, lemma)`; unknown tokens and empty rows stay.

    A table below the broadcast limit goes to the tasks, which look up the tokens of a batch of texts at once: no token becomes a row and
    nothing is shuffled or sorted. Rows that share a key are put together, so they are taken apart and joined, as are all rows
    with a larger table or one that repeats a form.
    """
    if not fits_broadcast(lemma_table, 128):
        return _lemmatize_by_join(df, lemma_table, key, tokens)
    table = lemma_table.select("form", "lemma").filter("form IS NOT NULL AND lemma IS NOT NULL").toArrow()
    if len(pc.unique(table["form"])) < len(table):
        return _lemmatize_by_join(df, lemma_table, key, tokens)
    again = stage(df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter(f"_rows > 1 AND {key} IS NOT NULL").select(key), "repeated-keys")
    repeated = again.count()
    if not repeated:
        return _lemmatize_in_place(df, table, key, tokens)
    marked = lookup_join(df, again.withColumn("_again", F.lit(True)), key, [tokens], how="left", rows=repeated)
    alone = _lemmatize_in_place(marked.filter("_again IS NULL"), table, key, tokens)
    return alone.unionByName(_lemmatize_by_join(marked.filter("_again"), lemma_table, key, tokens)).select(df.columns)


def _lemmatize_in_place(df: DataFrame, table: pa.Table, key: str, tokens: str) -> DataFrame:
    ship(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast((table["form"].combine_chunks(), table["lemma"].combine_chunks()))

    @F.arrow_udf("array<string>")
    def spelled(lists: pa.Array) -> pa.Array:
        forms, lemmas = sent.value
        words = lists.flatten()
        found = lemmas.take(pc.index_in(words, value_set=forms))
        ends = pa.array(np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]), pa.int32())
        return pa.ListArray.from_arrays(ends, pc.coalesce(found, words))

    empty = F.array().cast("array<string>")
    return df.withColumn(tokens, spelled(F.when(F.col(key).isNotNull(), F.coalesce(F.array_compact(tokens), empty)).otherwise(empty)))


def _lemmatize_by_join(df: DataFrame, lemma_table: DataFrame, key: str, tokens: str) -> DataFrame:
    """Rows that are placed by `key` are taken apart, looked up and put together again where they are, as long as the table is broadcast."""
    apart = df.select(key, F.posexplode_outer(tokens).alias("_pos", "form")).filter("form IS NOT NULL")
    spelled = lookup_join(apart, lemma_table.select("form", "lemma"), "form", [key, "_pos"], how="left")
    whole = (
        spelled.groupBy(key)
        .agg(F.collect_list(F.struct("_pos", F.coalesce("lemma", "form").alias("lemma"))).alias("_parts"))
        .select(key, F.sort_array("_parts")["lemma"].alias("_lemmas"))
    )
    empty = F.array().cast("array<string>")
    return df.join(whole, key, "left").withColumn(tokens, F.coalesce("_lemmas", empty)).drop("_lemmas")


def clean_text(
    df: DataFrame,
    preprocessing: Mapping | None,
    key: str = "index",
    text: str = "text",
    out: str = "clean",
    stop_words: Sequence[str] = STOP_WORDS,
    lemma_table: DataFrame | None = None,
    emoji: dict[str, str] | None = None,
) -> DataFrame:
    """Add the cleaned text. Fixed order: lower, URLs, mentions, elongation, emoji, tokens, white space.

    `None` is the identity. The steps are column expressions; only lemmas need a join.
    """
    if preprocessing is None:
        return df.withColumn(out, F.col(text))
    cleaned = df.withColumn(out, X.lower_text(F.col(text)) if preprocessing["lowercase"] else F.col(text))
    cleaned = cleaned.withColumn(out, X.replace_urls(F.col(out), preprocessing["url"]))
    cleaned = cleaned.withColumn(out, X.replace_mentions(F.col(out), preprocessing["mention"]))
    if preprocessing["elongation"] == "normalize":
        cleaned = cleaned.withColumn(out, X.squeeze_elongation(F.col(out)))
    if preprocessing["emoji"] == "text":
        cleaned = cleaned.withColumn(out, X.emoji_to_text(F.col(out), emoji))
    stopwords = preprocessing["stopwords"]
    if stopwords != "keep" or preprocessing["lemmatize"]:
        words = K.tokenize_words(F.col(out))
        if stopwords != "keep":
            kept = preprocessing["negators"] if stopwords == "remove_preserve_negation" else ()
            words = K.remove_stopwords(words, stop_words, kept)
        cleaned = cleaned.withColumn("_tokens", words)
        if preprocessing["lemmatize"]:
            if lemma_table is None:
                raise ValueError("lemmatize needs a lemma table")
            cleaned = lemmatize(cleaned, lemma_table, key, "_tokens")
        cleaned = cleaned.withColumn(out, K.join_tokens(F.col("_tokens"))).drop("_tokens")
    if preprocessing["whitespace"] == "normalize":
        cleaned = cleaned.withColumn(out, X.normalize_whitespace(F.col(out)))
    return cleaned
