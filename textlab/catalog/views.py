"""Tables derived from the given ones. Each view is one SQL text for both engines.

`{table}` is a given table, `{H(x)}` the seeded hash of x, and a view may name earlier views.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from textlab.functions.words import NEGATORS
from textlab.operators.runlog import CONFIGURATION_ARTIFACT, EXPERIMENT_ARTIFACTS, FINAL_ARTIFACTS
from textlab.plans.configurations import VECTOR_MODEL, baseline_configuration
from textlab.sources.tables import spread

VERSION = "1.5.0"
PROTOCOL = {
    "dataset_id": "documents",
    "dataset_revision": "seed-42",
    "sampling_strategy": "stratified",
    "sample_size": "200000",
    "random_seed": "42",
    "cv_strategy": "StratifiedKFold",
    "cv_folds": "3",
    "cv_shuffle": "True",
}

VIEWS = {
    # Decorated texts with two classes; train and test by hash.
    "tweets": """
SELECT doc_id AS index, lang,
  concat(CASE WHEN doc_id % 3 = 0 THEN concat('@Bob_', doc_id % 50, ' ') ELSE '' END, text,
    CASE doc_id % 7 WHEN 0 THEN concat(' https://ex.com/a?b=', doc_id) WHEN 1 THEN ' WWW.Site.org/x' WHEN 2 THEN ' ❤️ it'
      WHEN 3 THEN ' 👍🏽 🇫🇷 ⭐ ⌚ 👩‍💻 ✁' ELSE '' END,
    CASE doc_id % 6 WHEN 0 THEN ' soooo  GOOD!!!!' WHEN 1 THEN ' 😀 omg' WHEN 2 THEN ' I don''t like it but ok'
      WHEN 3 THEN ' yeah right #fun' WHEN 4 THEN ' really never cannot' ELSE '' END) AS text,
  CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS label,
  CASE WHEN {H(doc_id)} % 20 < 17 THEN 'train' ELSE 'test' END AS split
FROM {documents}""",
    # About one prediction in five is wrong.
    "predictions": """
SELECT index, CAST(index % 3 AS int) AS fold, text, label,
  CASE WHEN {H(index)} % 5 = 0 THEN 1 - label ELSE label END AS prediction
FROM {tweets}""",
    # M6 is not on the list, so its runs cannot be attributed.
    "members": """
SELECT DISTINCT concat('M', user_id % 7) AS member_id, concat('arn:nb:M', user_id % 7) AS notebook_arn
FROM {events} WHERE concat('M', user_id % 7) <> 'M6'""",
    "runs_flat": """
SELECT event_id, concat('run-', lpad(CAST(event_id AS string), 8, '0')) AS run_id,
  CASE WHEN event_id % 11 = 0 THEN 'FAILED' ELSE 'FINISHED' END AS status,
  CASE WHEN event_id = 1 THEN 'protocol' WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 29 = 0 THEN 'final' ELSE 'experiment' END AS lab_run_type,
  'run-00000001' AS lab_protocol_run_id,
  CASE event_id % 8 WHEN 0 THEN 'T0' WHEN 1 THEN 'B0' WHEN 2 THEN 'P_STOPWORDS' WHEN 3 THEN 'P_EMOJI' WHEN 4 THEN 'R_TFIDF_UNI'
    WHEN 5 THEN 'C_SGD' WHEN 6 THEN 'EXTRA' ELSE 'ABLATION' END AS lab_experiment_id,
  CASE event_id % 8 WHEN 0 THEN 'reference' WHEN 1 THEN 'baseline' WHEN 2 THEN 'preprocessing' WHEN 3 THEN 'preprocessing'
    WHEN 4 THEN 'representation' WHEN 5 THEN 'classifier' WHEN 6 THEN 'classifier' ELSE 'ablation' END AS lab_stage,
  CASE WHEN event_id % 41 = 0 THEN NULL ELSE concat('M', user_id % 7) END AS lab_member_id,
  CASE WHEN event_id % 23 = 0 THEN '' ELSE concat('CFG_', event_id % 19) END AS lab_configuration_id,
  CASE WHEN event_id % 17 = 0 THEN 'arn:nb:other' ELSE concat('arn:nb:M', user_id % 7) END AS notebook_arn,
  CASE WHEN event_id % 8 = 7 THEN concat('run-', lpad(CAST(event_id - 3 AS string), 8, '0')) END AS lab_ablation_parent_run_id,
  concat('run-', lpad(CAST(event_id - 3 AS string), 8, '0')) AS previous_run_id,
  CAST(0.5 + (event_id * 7919 % 1000) / 2000.0 AS double) AS macro_f1_fold_0,
  CAST(0.5 + (event_id * 104729 % 1000) / 2000.0 AS double) AS macro_f1_fold_1,
  CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(0.5 + (event_id * 1299709 % 1000) / 2000.0 AS double) END AS macro_f1_fold_2,
  CASE WHEN event_id % 37 = 0 THEN 0 ELSE 1 END AS has_provenance,
  CASE WHEN event_id % 43 = 0 THEN 0 ELSE 1 END AS has_configuration
FROM {events}""",
    # Mean and population deviation exist where all three folds do.
    "runs_scored": """
SELECT r.*,
  (macro_f1_fold_0 + macro_f1_fold_1 + macro_f1_fold_2) / 3 AS macro_f1_mean,
  sqrt((power(macro_f1_fold_0, 2) + power(macro_f1_fold_1, 2) + power(macro_f1_fold_2, 2)) / 3
    - power((macro_f1_fold_0 + macro_f1_fold_1 + macro_f1_fold_2) / 3, 2)) AS macro_f1_std
FROM {runs_flat} r""",
    # Five names, one version per final run; the newest version with the alias is the champion.
    "models": """
SELECT concat('model_', event_id % 5) AS name, CAST(event_id AS int) AS version, run_id,
  CASE WHEN event_id % 3 > 0 THEN 'champion' END AS alias
FROM {runs_flat} WHERE lab_run_type = 'final'""",
    # Turns as texts to score, some blank, null or too long.
    "requests": """
SELECT conv_id AS request_id, CAST(turn AS int) AS pos,
  CASE (conv_id + turn) % 13 WHEN 0 THEN ' ' WHEN 1 THEN NULL ELSE text END AS text
FROM {conversations}""",
    # Page ids beyond the conversations are requests without a text.
    "request_list": """
SELECT conv_id AS request_id FROM {conversations} UNION SELECT page_id AS request_id FROM {pages}""",
    # Valid and invalid configurations.
    "configs_flat": """
SELECT p_partkey AS config_key,
  CASE p_size % 3 WHEN 0 THEN 'keep' WHEN 1 THEN 'remove' ELSE 'remove_preserve_negation' END AS stopwords,
  CASE WHEN p_partkey % 5 < 2 THEN 1 ELSE 0 END AS has_negators,
  p_partkey % 2 = 0 AS lemmatize,
  CASE WHEN p_size % 2 = 0 THEN 'keep' ELSE 'normalize' END AS elongation,
  CASE WHEN p_partkey % 3 = 0 THEN 'reduce_repeated_chars_to_2' END AS elongation_spec,
  CASE WHEN p_size % 5 < 3 THEN 'keep' ELSE 'text' END AS emoji,
  CASE WHEN p_partkey % 4 = 0 THEN 'emoji_table' END AS emoji_spec,
  CASE p_partkey % 7 WHEN 0 THEN 'spacy_embedding' WHEN 1 THEN 'unknown' WHEN 2 THEN 'bow' WHEN 3 THEN 'bow' ELSE 'tfidf' END AS rep_type,
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(1 + p_partkey % 2 AS int) END AS ngram_max,
  CASE WHEN p_partkey % 13 < 9 THEN 'mean_token_vectors' END AS document_vector_method,
  CASE p_partkey % 5 WHEN 0 THEN 'most_frequent' WHEN 1 THEN 'linear_svm' WHEN 2 THEN 'sgd' WHEN 3 THEN 'logistic_regression' ELSE 'forest' END AS clf_type
FROM {part}""",
}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

_HASH = re.compile(r"\{H\(([^()]*)\)\}")
_SPARK_HASH = r"cast(conv(substring(md5(concat('42:',\1)),1,15),16,10) as bigint)"
_DUCKDB_HASH = r"cast(('0x'||substring(md5(concat('42:',\1)),1,15)) as bigint)"


def duckdb_hash(expression: str) -> str:
    return _DUCKDB_HASH.replace(r"\1", expression)


def spark_view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.sql(_spark_text(folder, name))


def _spark_text(folder: str, name: str) -> str:
    def source(match: re.Match) -> str:
        found = match.group(1)
        if found in TABLES:
            return f"parquet.`{folder}/{found}.parquet`"
        return f"({_spark_text(folder, found)})"

    return re.sub(r"\{(\w+)\}", source, _HASH.sub(_SPARK_HASH, VIEWS[name]))


def duckdb_views(*names: str) -> list[str]:
    """`name AS (...)` of the views and of those they read, in order."""
    parts: dict[str, str] = {}

    def add(name: str) -> None:
        if name in parts:
            return
        for found in re.findall(r"\{(\w+)\}", VIEWS[name]):
            if found not in TABLES:
                add(found)
        text = _HASH.sub(lambda m: duckdb_hash(m.group(1)), VIEWS[name])
        parts[name] = f"{name} AS ({re.sub(r'[{}]', '', text)})"

    for name in names:
        add(name)
    return list(parts.values())


def run_configuration_template() -> dict:
    """Baseline configuration with one classifier parameter; `K` stands for its value."""
    found = baseline_configuration(VERSION)
    found["classifier"]["parameters"] = {"k": "K"}
    return found


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Run log from `runs_scored`: maps hold what is not null."""
    flat = spread(spark_view(spark, folder, "runs_scored"), "event_id")
    kind = F.col("lab_run_type")

    def entries(pairs: dict, to: str):
        items = [c for name, value in pairs.items() for c in (F.lit(name), value.cast(to))]
        return F.map_filter(F.create_map(*items), lambda _, value: value.isNotNull())

    names = ["lab_run_type", "lab_protocol_run_id", "lab_experiment_id", "lab_stage", "lab_member_id", "lab_configuration_id", "notebook_arn"]
    tags = {name: F.col(name) for name in names}
    tags["lab_ablation_parent_run_id"] = F.when(kind == "experiment", F.col("lab_ablation_parent_run_id"))
    tags["lab_selected_experiment_run_id"] = F.when(kind == "final", F.col("previous_run_id"))
    experiment = {name: F.when(kind == "experiment", F.col(name)) for name in ["macro_f1_fold_0", "macro_f1_fold_1", "macro_f1_fold_2", "macro_f1_mean", "macro_f1_std"]}
    experiment["macro_f1_delta"] = F.when(
        (kind == "experiment") & F.col("lab_ablation_parent_run_id").isNotNull(), F.col("macro_f1_fold_0") - F.col("macro_f1_mean")
    )
    experiment["test_macro_f1"] = F.when(kind == "final", F.col("macro_f1_fold_0"))
    params = {name: F.when(kind == "protocol", F.lit(value)) for name, value in PROTOCOL.items()}
    params["training_size"] = F.when((kind == "final") & (F.col("event_id") % 53 != 0), F.lit("1000"))
    artifacts = F.array_compact(
        F.array(
            F.when(F.col("has_configuration") == 1, CONFIGURATION_ARTIFACT),
            F.when(F.col("has_provenance") == 1, EXPERIMENT_ARTIFACTS[1]),
            *[F.when(kind == "final", path) for path in FINAL_ARTIFACTS[2:]],
        )
    )
    before, after = json.dumps(run_configuration_template(), separators=(",", ":")).split('"K"')
    text = F.concat(F.lit(before + '"'), (F.col("event_id") % 20).cast("string"), F.lit('"' + after))
    return flat.select(
        "run_id",
        "status",
        entries(tags, "string").alias("tags"),
        entries(params, "string").alias("params"),
        entries(experiment, "double").alias("metrics"),
        artifacts.alias("artifacts"),
        F.when(F.col("event_id") % 47 == 0, "{bad").otherwise(text).alias("configuration"),
    )


def configurations(spark: SparkSession, folder: str) -> DataFrame:
    """`(config_key, preprocessing, representation, classifier)` from `configs_flat`."""
    flat = spark_view(spark, folder, "configs_flat")
    none = F.create_map().cast("map<string,string>")
    vectors = F.col("rep_type") == "spacy_embedding"
    method = F.map_from_arrays(F.array(F.lit("document_vector_method")), F.array("document_vector_method"))
    return flat.select(
        "config_key",
        F.struct(
            F.lit(True).alias("lowercase"),
            F.lit("token:url").alias("url"),
            F.lit("token:user").alias("mention"),
            F.lit("normalize").alias("whitespace"),
            "stopwords",
            F.when(F.col("has_negators") == 1, F.array(*[F.lit(w) for w in NEGATORS])).otherwise(F.array().cast("array<string>")).alias("negators"),
            "lemmatize",
            "elongation",
            "elongation_spec",
            "emoji",
            "emoji_spec",
            none.alias("resources"),
            none.alias("additional"),
        ).alias("preprocessing"),
        F.struct(
            F.col("rep_type").alias("type"),
            F.when(F.col("ngram_max").isNotNull(), F.array(F.lit(1), "ngram_max")).otherwise(F.array().cast("array<int>")).alias("ngram_range"),
            F.lit("lib").alias("library"),
            F.lit(VERSION).alias("library_version"),
            F.when(vectors, VECTOR_MODEL).alias("spacy_model"),
            F.when(vectors, VERSION).alias("spacy_model_version"),
            F.when(F.col("document_vector_method").isNotNull(), method).otherwise(none).alias("parameters"),
        ).alias("representation"),
        F.struct(
            F.col("clf_type").alias("type"), F.lit("lib").alias("library"), F.lit(VERSION).alias("library_version"), none.alias("parameters")
        ).alias("classifier"),
    )
