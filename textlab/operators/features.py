"""Term counts, vocabulary, TF-IDF and token vectors as long tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from textlab.functions.tokens import ngrams, vector_tokens
from textlab.operators.lookup import BROADCAST_BYTES, fits_broadcast, lookup_join
from textlab.operators.ranking import global_rank
from textlab.session import stage

TASK_TEXT = 8 << 20  # bytes of text in a task that holds all its terms, some 24 times as much
TASK_ROWS = 1 << 20  # rows of terms in a task that holds or sorts them


def tasks_for(docs: DataFrame, text: str = "text") -> int:
    """How many tasks hold `TASK_TEXT` each of these texts; no fewer than run at once."""
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    return max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_TEXT))


def placed_by(docs: DataFrame, key: str = "index", tasks: int | None = None) -> DataFrame:
    """Shuffle texts by key before any work on them.

    A text is smaller than its terms, and cleaning, counting and everything that groups by `key`
    later then runs without a further shuffle. `tasks`, as `tasks_for` gives them, bound what each of these tasks holds.
    """
    return docs.repartition(key) if tasks is None else docs.repartition(tasks, key)


def apart(df: DataFrame, items: Column, out: str, keep: Sequence[str]) -> DataFrame:
    """One row per array item; rows without items are dropped.

    The outer form with a filter on the item: a plain explode makes the optimizer push a size test
    below the shuffle, and the test computes the whole text chain a second and third time.
    """
    return df.select(*keep, F.explode_outer(items).alias(out)).filter(F.col(out).isNotNull())


def term_counts(
    docs: DataFrame,
    key: str = "index",
    text: str = "clean",
    ngram_range: Sequence[int] = (1, 1),
    carry: Sequence[str] = (),
) -> DataFrame:
    """`(key, carry..., term, n)` for each term of each text; `carry` depends on `key`.

    With texts that are `placed_by` the key the count moves nothing.
    """
    words = docs.select(key, *carry, vector_tokens(F.col(text)).alias("_tokens"))
    terms = apart(words, ngrams(F.col("_tokens"), *ngram_range), "term", [key, *carry])
    return terms.groupBy(key, *carry, "term").agg(F.count(F.lit(1)).alias("n"))


def distinct_terms(docs: DataFrame, text: str = "clean", ngram_range: Sequence[int] = (1, 1)) -> DataFrame:
    """`(term)` of all texts, each once; the first combine happens before anything moves."""
    words = docs.select(vector_tokens(F.col(text)).alias("_tokens"))
    return apart(words, ngrams(F.col("_tokens"), *ngram_range), "term", []).distinct()


def text_terms(docs: DataFrame, text: str = "clean", ngram_range: Sequence[int] = (1, 1)) -> DataFrame:
    """`(term)`, once for each text that has it: enough for document frequencies, and no text moves."""
    words = docs.select(vector_tokens(F.col(text)).alias("_tokens"))
    return apart(words, F.array_distinct(ngrams(F.col("_tokens"), *ngram_range)), "term", [])


def fit_vocabulary(terms: DataFrame) -> DataFrame:
    """Distinct terms with their alphabetic position: `(term, term_index)`. Nothing is capped."""
    return global_rank(terms.select("term"), ["term"], "term_index")


@dataclass(frozen=True)
class TermTable:
    """Fitted terms: a staged table `(term, df)` or `(term, df_0, df_1, ...)`, its rows, the texts behind it."""

    table: DataFrame
    rows: int
    texts: Mapping[int | None, int]


def document_frequencies(counts: DataFrame, folds: Sequence[int] = ()) -> DataFrame:
    """Texts per term, and with folds the texts outside of each one, in one aggregation.

    `counts` has one row for each term of each text, as `term_counts` and `text_terms` give.

    `df_<k>` is the total minus the texts of fold k, so no fold is counted on its own.
    """
    total = F.count(F.lit(1))
    outside = [(total - F.count_if(F.col("fold") == k)).alias(f"df_{k}") for k in folds]
    return counts.groupBy("term").agg(total.alias("df"), *outside)


def fit_terms(docs: DataFrame, counts: DataFrame, folds: Sequence[int] = ()) -> TermTable:
    """Fit document frequencies on `docs`; texts without a term count as texts."""
    table = stage(document_frequencies(counts, folds), "terms")
    if folds:
        by_fold = {row["fold"]: row["n"] for row in docs.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
        texts = {k: sum(by_fold.values()) - by_fold.get(k, 0) for k in folds} | {None: sum(by_fold.values())}
    else:
        texts = {None: docs.count()}
    return TermTable(table, table.count(), texts)


def smooth_idf(df: Column, texts: int) -> Column:
    return F.log((F.lit(1.0) + texts) / (F.lit(1.0) + df)) + 1.0


def bow(counts: DataFrame, vocabulary: DataFrame, key: str = "index") -> DataFrame:
    """Raw counts by vocabulary position; terms that were not fitted are dropped."""
    return lookup_join(counts, vocabulary, "term", [key])


def _unit_length(weighted: DataFrame, key: Sequence[str], weight: str, out: str) -> DataFrame:
    """Divide by the Euclidean length of the row; rows are the terms of one text, so groups are small."""
    length = F.sqrt(F.sum(F.col(weight) * F.col(weight)).over(Window.partitionBy(*key)))
    return weighted.withColumn(out, F.col(weight) / length)


def tfidf(counts: DataFrame, terms: TermTable, key: str = "index") -> DataFrame:
    """`n * (ln((1 + texts) / (1 + df)) + 1)`, then each text to length 1: `(key, term, value)`."""
    tasks = max(counts.sparkSession.sparkContext.defaultParallelism, -(-terms.rows // TASK_ROWS))
    known = lookup_join(counts, terms.table.select("term", "df"), "term", [key], rows=terms.rows, frequency="df", tasks=tasks)
    weighted = known.withColumn("_weight", F.col("n") * smooth_idf(F.col("df"), terms.texts[None]))
    return _unit_length(weighted, [key], "_weight", "value").select(key, "term", "value")


def tfidf_per_fold(
    counts: DataFrame, terms: TermTable, folds: Sequence[int], key: str = "index", role: str | None = None
) -> DataFrame:
    """TF-IDF of the texts under each split, fitted on the texts outside of fold `split`.

    One join for all splits. A term that the fitting texts lack is dropped in that split. `role`
    keeps only the `train` or only the `validation` texts of each split. The tasks that sort terms are as many as
    the texts behind `terms` need.
    """
    frequencies = [f"df_{k}" for k in folds]
    pairs = terms.table.agg(F.sum("df").alias("n")).first()["n"] or 0
    tasks = max(counts.sparkSession.sparkContext.defaultParallelism, -(-pairs // TASK_ROWS))
    known = lookup_join(
        counts.select(key, "fold", "term", "n"),
        terms.table.select("term", "df", *frequencies),
        "term",
        [key],
        row_bytes=128 + 8 * len(folds),
        rows=terms.rows,
        frequency="df",
        tasks=tasks,
    )

    def wanted(k: int) -> Column:
        inside = F.col("fold") == k
        shown = {None: F.lit(True), "validation": inside, "train": ~inside}[role]
        return shown & (F.col(f"df_{k}") > 0)

    per_split = F.array(
        *[
            F.struct(F.lit(k).alias("split"), F.when(wanted(k), F.col("n") * smooth_idf(F.col(f"df_{k}"), terms.texts[k])).alias("weight"))
            for k in folds
        ]
    )
    weighted = (
        known.select(key, "fold", "term", F.explode(per_split).alias("_w"))
        .select(F.col("_w.split").alias("split"), key, "fold", "term", F.col("_w.weight").alias("_weight"))
        .filter("_weight IS NOT NULL")
    )
    # The window sorts by (key, split) inside the partitioning by key.
    return _unit_length(weighted.repartition(tasks, key), [key, "split"], "_weight", "value").select("split", key, "fold", "term", "value")


def mean_token_vectors(
    docs: DataFrame, vectors: DataFrame, dim: int, key: str = "index", tokens: str = "tokens"
) -> DataFrame:
    """`(key, vec)`: mean vector of the tokens that have one; zeros for a text without any.

    Equal tokens of a text are counted first, so each pair of text and token meets its vector once. The vectors of as many of the most
    frequent tokens as may be broadcast come to the pairs; only pairs with the other tokens move. Sums per dimension
    are plain aggregates: rows with vectors are never sorted.
    """
    occurrences = apart(docs, F.col(tokens), "token", [key])
    counts = occurrences.groupBy(key, "token").agg(F.count(F.lit(1)).cast("double").alias("_n"))
    row_bytes, rows = 64 + 8 * dim, vectors.count()
    vectors = vectors.select("token", "vec")
    if fits_broadcast(vectors, row_bytes, rows):
        known = counts.join(F.broadcast(vectors), "token")
    else:
        counts = stage(counts, "token-counts")
        least, often = frequent(counts, "token", BROADCAST_BYTES // row_bytes)
        of_often = stage(vectors.join(often.filter(F.col("_often") >= least).select("token"), "token", "left_semi"), "frequent-vectors")
        of_rare = vectors.join(often.filter(F.col("_often") < least).select("token"), "token", "left_semi")
        served = counts.join(F.broadcast(of_often), "token")
        known = served.unionByName(counts.join(of_rare.hint("merge"), "token").select(served.columns))
    sums = [F.sum(F.get("vec", F.lit(i)) * F.col("_n")).alias(f"_{i}") for i in range(dim)]
    whole = known.groupBy(key).agg(F.sum(F.when(F.col("vec").isNotNull(), F.col("_n"))).alias("_all"), *sums)
    means = whole.filter("_all > 0").select(key, F.array(*[F.col(f"_{i}") / F.col("_all") for i in range(dim)]).alias("vec"))
    zeros = F.array_repeat(F.lit(0.0), dim)
    return docs.select(key).join(means, key, "left").select(key, F.coalesce("vec", zeros).alias("vec"))


def frequent(rows: DataFrame, key: str, most: int) -> tuple[int, DataFrame]:
    """The least frequency that at most `most` keys have or exceed, and the staged `(key, _often)`."""
    often = stage(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_often")), "frequencies")
    # Frequencies of the keys in powers of two: a row for each.
    steps = often.groupBy(F.ceil(F.log2(F.col("_often"))).alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    taken, least = 0, None
    for row in sorted(steps, key=lambda r: -r["step"]):
        taken += row["n"]
        if taken > most:
            break
        least = 1 if row["step"] == 0 else 2 ** (row["step"] - 1) + 1
    return (1 << 62 if least is None else least), often
