"""A corpus from raw documents to packed sequences: each stage reads what the one before it wrote.

A stage takes (spark, docs, folder). All but the last return the columns of `documents`; rows of clean documents
stay as they are. A text that a stage changes gets its new length in `n_chars`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textlab.llm import packing, secret_scan, simhash, suffix_dedup, toxicity
from textlab.llm.queries import VOCABULARY, toxicity_model
from textlab.session import new_folder, stage

# SQL has neither the classifier nor the fingerprints nor the tokenizer; tests/llm has brute-force versions.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half.

    Null and empty texts have the score of the model's intercept. Rows given twice both stay or both go. Any column names do.
    """
    out = unused(docs, "score")
    scored = toxicity.score(docs, toxicity_model(docs, sf_dir), docs.columns, out=out)
    return scored.filter(F.col(out) < 0.5).select(*[quoted(c) for c in docs.columns])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of the SimHash operator, with its defaults: four-word shingles, at most 4 differing bits.

    The row with the least id stays, one without an id only if its group has no other; then the least hash of the text. Rows with the
    same id and text are one document, of which the row with the least hash of its columns stays. Null texts are empty, and empty
    texts are copies of each other. Any column names do.
    """
    key = F.struct(F.isnull("doc_id").alias("no_id"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("content"))
    keyed = docs.select(key.alias("doc_id"), "text")
    groups = simhash.near_components(stage(simhash.fingerprints(keyed), "fingerprints"))
    kept = groups.filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id.id").alias("of_id"), F.col("doc_id.content").alias("of_content")).distinct()
    rows = docs.select(row_of(docs).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("content"))
    same = [F.col("id").eqNullSafe(F.col("of_id")), F.col("content") == F.col("of_content")]
    found = rows.join(stage(kept, "kept"), same, "left_semi")
    comparable = [F.col(f"row.c{i}") for i, f in enumerate(docs.schema.fields) if "map<" not in f.dataType.simpleString()]
    one_each = found.groupBy("id", "content").agg(F.min_by("row", F.xxhash64(*comparable)).alias("row"))
    return columns_of(one_each, docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay where they are first found; a text of nothing else goes.

    Null, empty and short texts stay as they are. Rows given twice are the same place and are cut alike. Any column names do.
    """
    return recounted(suffix_dedup.without_repeats(docs, docs.columns))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; each text is scanned once, by way of the ledger.

    Null and empty texts stay as they are, every row stays. Any column names do.
    """
    ledger = new_folder(spark, "ledger")
    secret_scan.scan_new(docs, ledger)
    found = secret_scan.read_ledger(spark, ledger).filter(F.size("findings") > 0).select("blob", "findings")
    rows = docs.select(row_of(docs).alias("row"), "text", secret_scan.blob().alias("blob")).join(found, "blob", "left")
    redacted = secret_scan.redact(rows, ["row", "text"])
    return recounted(columns_of(redacted.withColumn("row", F.col("row").withField(f"c{docs.columns.index('text')}", F.col("text"))), docs))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in sequences of 1024 tokens.

    Null and empty texts are the end id alone; rows given twice are packed twice. Only the id and the text are read.
    """
    return packing.packed_documents(docs, VOCABULARY)


def quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def unused(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def row_of(docs: DataFrame) -> Column:
    """All columns as one, so that no name of theirs meets one of a stage."""
    return F.struct(*[quoted(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])


def columns_of(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def recounted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("toxicity", without_toxic),
    ("simhash near copies", without_near_copies),
    ("suffix-array dedup", without_repeated_passages),
    ("secret scan", without_secrets),
    ("best-fit packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
