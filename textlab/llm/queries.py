"""The queries of this folder: each applies an operator to a whole table and derives the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textlab.llm import bpe, collocations, knn, line_quality, packing, ranked_search, rans, rendezvous, secret_scan, simhash, suffix_dedup, toxicity, url_templates
from textlab.session import new_folder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SHARDS = 24
# The listed rules.
URL_RULES = [
    url_templates.Rule("allow", "com", "/"),
    url_templates.Rule("block", "example.com", "/en/"),
    url_templates.Rule("allow", "www.example.com", "/en/"),
    url_templates.Rule("block", "net", "/es/"),
    url_templates.Rule("block", "net", "/fr/"),
]

_registered: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    _registered[function.__name__] = function
    return function


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_registered)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s[0].cast("string"), s[1].cast("string"))), ",")


@query
def op1_suffix_array_dedup(spark, folder):
    """One row per document with a passage of 50 or more words that is found elsewhere, too."""
    found = suffix_dedup.repeated_passages(documents(spark, folder))
    length = lambda spans: F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s[1] - s[0])
    return found.select(
        "doc_id",
        F.size("spans").cast("bigint").alias("n_spans"),
        length("spans").alias("n_repeated_words"),
        length("removed").alias("n_removed_words"),
        spans_text(F.col("spans")).alias("spans"),
        spans_text(F.col("removed")).alias("removed"),
    )


@query
def op2_line_quality(spark, folder):
    return line_quality.judged(documents(spark, folder))


def is_held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string")) % 5 == 0


def toxicity_model(rows: DataFrame, folder: str) -> toxicity.ToxicityModel:
    labels = rows.sparkSession.read.parquet(f"{folder}/labels.parquet").filter(~is_held_out())
    return toxicity.train_model(rows, labels)


@query
def op3_toxicity(spark, folder):
    rows = documents(spark, folder)
    scored = toxicity.score(rows, toxicity_model(rows, folder), ["doc_id"])
    held_out = F.coalesce(is_held_out(), F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op4_secret_scan(spark, folder):
    ledger = new_folder(spark, "ledger")
    rows = documents(spark, folder)
    secret_scan.scan_new(rows, ledger)
    found = secret_scan.findings_by_path(rows, ledger)
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("findings", lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))
    return found.select("doc_id", *[count(k) for k in secret_scan.BASE_KINDS], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("findings")).alias("spans"))


@query
def op5_rans_files(spark, folder):
    files = new_folder(spark, "rans")
    rans.write_ids(documents(spark, folder), VOCABULARY, files)
    return rans.read_checksums(spark, files)


@query
def op6_rendezvous_shards(spark, folder):
    found = rendezvous.sharded(documents(spark, folder), [1.0] * SHARDS, grown=[1.0] * (SHARDS + 1))
    return found.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op7_simhash_pigeonring(spark, folder):
    found = simhash.near_components(simhash.fingerprints(documents(spark, folder)))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@query
def op8_bpe_prefix_dp(spark, folder):
    return bpe.digests(documents(spark, folder), VOCABULARY)


@query
def op9_best_fit_packing(spark, folder):
    return packing.packed_documents(documents(spark, folder), VOCABULARY)


@query
def op10_voronoi_knn(spark, folder):
    vectors = knn.integer_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))
    return knn.top_k(vectors, F.col("id") % 20 == 0)


@query
def op11_collocations(spark, folder):
    return collocations.collocations(documents(spark, folder))


@query
def op12_url_templates(spark, folder):
    return url_templates.judged(spark.read.parquet(f"{folder}/pages.parquet"), URL_RULES)


@query
def op13_ranked_search(spark, folder):
    return ranked_search.top_documents(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
