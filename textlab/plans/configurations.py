"""Experiment configurations as struct columns: named variants, checks, comparison and ablation."""

from __future__ import annotations

import copy
import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from textlab.functions.words import NEGATORS

PREPROCESSING = (
    "struct<lowercase:boolean,url:string,mention:string,whitespace:string,stopwords:string,negators:array<string>,"
    "lemmatize:boolean,elongation:string,elongation_spec:string,emoji:string,emoji_spec:string,"
    "resources:map<string,string>,additional:map<string,string>>"
)
REPRESENTATION = (
    "struct<type:string,ngram_range:array<int>,library:string,library_version:string,spacy_model:string,"
    "spacy_model_version:string,parameters:map<string,string>>"
)
CLASSIFIER = "struct<type:string,library:string,library_version:string,parameters:map<string,string>>"
CONFIGURATION = f"struct<preprocessing:{PREPROCESSING},representation:{REPRESENTATION},classifier:{CLASSIFIER}>"
_PARTS = {"preprocessing": PREPROCESSING, "representation": REPRESENTATION, "classifier": CLASSIFIER}

# Names, parts and specs of the configurations that experiments are identified by.
ELONGATION_SPEC = "reduce_repeated_chars_to_2"
EMOJI_SPEC = "emoji.demojize"
DOCUMENT_VECTOR_METHOD = "mean_token_vectors"
LIBRARY = "scikit-learn"
VECTOR_LIBRARY = "spacy"
VECTOR_MODEL = "en_core_web_md"
PREPROCESSING_TAGS = {
    "P_STOPWORDS": {"stopwords": "remove", "negators": []},
    "P_STOPWORDS_NEGATION": {"stopwords": "remove_preserve_negation", "negators": NEGATORS},
    "P_LEMMA": {"lemmatize": True},
    "P_ELONGATION": {"elongation": "normalize", "elongation_spec": ELONGATION_SPEC},
    "P_EMOJI": {"emoji": "text", "emoji_spec": EMOJI_SPEC},
}
REPRESENTATION_TAGS = {
    "R_BOW": ("bow", [1, 1]),
    "R_TFIDF_UNI": ("tfidf", [1, 1]),
    "R_TFIDF_UNI_BI": ("tfidf", [1, 2]),
    "R_SPACY": ("spacy_embedding", []),
}
CLASSIFIER_TAGS = {"C_LOGREG": "logistic_regression", "C_LINEAR_SVM": "linear_svm", "C_SGD": "sgd"}
STOPWORD_MODES = ("keep", "remove", "remove_preserve_negation")
REPRESENTATION_TYPES = ("bow", "tfidf", "spacy_embedding")
CLASSIFIER_TYPES = ("logistic_regression", "linear_svm", "sgd", "most_frequent")
DECISIONS = (
    "preprocessing.stopwords",
    "preprocessing.lemmatize",
    "preprocessing.elongation",
    "preprocessing.emoji",
    "representation",
    "classifier",
)


def classifier_part(kind: str, library: str, version: str, parameters: Mapping | None = None) -> dict:
    return {"type": kind, "library": library, "library_version": version, "parameters": dict(parameters or {})}


def representation_part(kind: str, ngram_range: list, version: str, vector_version: str | None = None) -> dict:
    vectors = kind == "spacy_embedding"
    return {
        "type": kind,
        "ngram_range": ngram_range,
        "library": VECTOR_LIBRARY if vectors else LIBRARY,
        "library_version": version,
        "spacy_model": VECTOR_MODEL if vectors else None,
        "spacy_model_version": (vector_version or version) if vectors else None,
        "parameters": {"document_vector_method": DOCUMENT_VECTOR_METHOD} if vectors else {},
    }


def baseline_configuration(version: str) -> dict:
    """Lower case, URL and mention tokens, unigram counts, logistic regression."""
    return {
        "preprocessing": {
            "lowercase": True,
            "url": "token:url",
            "mention": "token:user",
            "whitespace": "normalize",
            "stopwords": "keep",
            "negators": [],
            "lemmatize": False,
            "elongation": "keep",
            "elongation_spec": None,
            "emoji": "keep",
            "emoji_spec": None,
            "resources": {},
            "additional": {},
        },
        "representation": representation_part("bow", [1, 1], version),
        "classifier": classifier_part("logistic_regression", LIBRARY, version),
    }


def reference_configuration(library: str, version: str) -> dict:
    """The majority guess: no text work at all."""
    return {"preprocessing": None, "representation": None, "classifier": classifier_part("most_frequent", library, version)}


def named_configuration(
    tag: str,
    version: str,
    preprocessing: Mapping | None = None,
    representation: Mapping | None = None,
    classifier: Mapping | None = None,
) -> dict:
    """Configuration of one named experiment.

    A preprocessing tag changes one choice of the baseline. A representation tag keeps the chosen
    preprocessing, a classifier tag also the chosen representation; `EXTRA` takes all three parts.
    What is not given is the baseline's.
    """
    found = baseline_configuration(version)
    if tag in PREPROCESSING_TAGS:
        found["preprocessing"].update(copy.deepcopy(PREPROCESSING_TAGS[tag]))
        return found
    if tag not in REPRESENTATION_TAGS and tag not in CLASSIFIER_TAGS and tag != "EXTRA":
        raise ValueError(f"unknown tag {tag}")
    found["preprocessing"] = dict(preprocessing or found["preprocessing"])
    if tag in REPRESENTATION_TAGS:
        kind, ngram_range = REPRESENTATION_TAGS[tag]
        found["representation"] = representation_part(kind, list(ngram_range), version)
        return found
    found["representation"] = dict(representation or found["representation"])
    if tag in CLASSIFIER_TAGS:
        found["classifier"] = classifier_part(CLASSIFIER_TAGS[tag], LIBRARY, version)
    else:
        found["classifier"] = dict(classifier or found["classifier"])
    return found


def tag_stage(tag: str) -> str:
    for stage, tags in (
        ("preprocessing", PREPROCESSING_TAGS),
        ("representation", REPRESENTATION_TAGS),
        ("classifier", CLASSIFIER_TAGS),
    ):
        if tag in tags:
            return stage
    raise ValueError(f"{tag} has no stage of its own")


def as_column(part: Mapping | None, name: str) -> Column:
    """Struct literal of a configuration part; Spark folds it to a constant."""
    if part is None:
        return F.lit(None).cast(_PARTS[name])
    return F.from_json(F.lit(json.dumps(part)), _PARTS[name])


def comparison_grid(configs: DataFrame, version: str) -> DataFrame:
    """The twelve named configurations for each row's chosen preprocessing and representation."""
    base = baseline_configuration(version)
    chosen = {"preprocessing": F.col("preprocessing"), "representation": F.col("representation")}
    rows = []
    for tag in [*PREPROCESSING_TAGS, *REPRESENTATION_TAGS, *CLASSIFIER_TAGS]:
        named = named_configuration(tag, version)
        stage = tag_stage(tag)
        kept = {"preprocessing": (), "representation": ("preprocessing",), "classifier": ("preprocessing", "representation")}
        parts = []
        for name in _PARTS:
            picked = as_column(named[name], name)
            if name in kept[stage]:
                picked = F.coalesce(chosen[name], as_column(base[name], name))
            parts.append(picked.alias(name))
        rows.append(F.struct(F.lit(tag).alias("tag"), F.lit(stage).alias("stage"), *parts))
    others = [c for c in configs.columns if c not in _PARTS]
    return configs.select(*others, F.inline(F.array(*rows)))


def _rules() -> dict[str, Column]:
    pre, rep, clf = (lambda f: F.col(f"preprocessing.{f}")), (lambda f: F.col(f"representation.{f}")), (lambda f: F.col(f"classifier.{f}"))
    no_negators = F.coalesce(F.size(pre("negators")), F.lit(0)) <= 0
    keeps_negators = pre("stopwords").eqNullSafe("remove_preserve_negation")
    known = lambda c, values: F.coalesce(c.isin(*values), F.lit(False))
    counted = rep("type").isin("bow", "tfidf")
    vectors = rep("type") == "spacy_embedding"
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    return {
        "negators_missing": keeps_negators & no_negators,
        "negators_not_allowed": ~keeps_negators & ~no_negators,
        "elongation_spec_missing": (pre("elongation") == "normalize") & pre("elongation_spec").isNull(),
        "elongation_spec_not_allowed": (pre("elongation") == "keep") & pre("elongation_spec").isNotNull(),
        "emoji_spec_missing": (pre("emoji") == "text") & pre("emoji_spec").isNull(),
        "emoji_spec_not_allowed": (pre("emoji") == "keep") & pre("emoji_spec").isNotNull(),
        "ngram_range_missing": counted & (F.coalesce(F.size(rep("ngram_range")), F.lit(0)) != 2),
        "vector_method_missing": vectors & blank(F.try_element_at(rep("parameters"), F.lit("document_vector_method"))),
        "vector_model_missing": vectors & (blank(rep("spacy_model")) | blank(rep("spacy_model_version"))),
        "representation_unknown": F.col("representation").isNotNull() & ~known(rep("type"), REPRESENTATION_TYPES),
        "classifier_unknown": ~known(clf("type"), CLASSIFIER_TYPES),
    }


def validate_configs(configs: DataFrame) -> DataFrame:
    """Add `violations`: the broken rules in rule order. Without preprocessing or representation their rules do not apply; a classifier has to be there."""
    broken = F.array(*[F.when(rule, F.lit(name)) for name, rule in _rules().items()])
    return configs.withColumn("violations", F.array_compact(broken))


def canonical_json(configuration: Column) -> Column:
    """Text that is equal for equal configurations: fixed field order, sorted maps, lists as they are."""
    def sorted_map(m: Column) -> Column:
        return F.map_from_entries(F.array_sort(F.map_entries(m)))

    pre, rep, clf = (configuration[part] for part in _PARTS)
    ordered = F.struct(
        F.when(
            pre.isNotNull(),
            pre.withField("resources", sorted_map(pre["resources"])).withField("additional", sorted_map(pre["additional"])),
        ).alias("preprocessing"),
        F.when(rep.isNotNull(), rep.withField("parameters", sorted_map(rep["parameters"]))).alias("representation"),
        F.when(clf.isNotNull(), clf.withField("parameters", sorted_map(clf["parameters"]))).alias("classifier"),
    )
    return F.to_json(ordered, {"ignoreNullFields": "false"})


def config_conflicts(runs: DataFrame) -> DataFrame:
    """Configurations with several ids and ids with several configurations, with how many.

    Runs shrink to the distinct pairs of id and text before a text is parsed, and to those of id and
    configuration before anything is counted, so a popular id weighs no more than its texts.
    """
    texts = runs.select(F.try_element_at("tags", F.lit("lab_configuration_id")).alias("id"), "configuration")
    parsed = (
        texts.filter("id <> '' AND configuration IS NOT NULL")
        .distinct()
        .select("id", F.from_json("configuration", CONFIGURATION).alias("parsed"))
        .filter("parsed.classifier IS NOT NULL")
    )
    pairs = parsed.select("id", F.sha2(canonical_json(F.col("parsed")), 256).alias("hash")).distinct()
    by_hash = pairs.groupBy(F.col("hash").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    by_id = pairs.groupBy(F.col("id").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return (
        by_hash.withColumn("kind", F.lit("configuration_with_ids"))
        .unionAll(by_id.withColumn("kind", F.lit("id_with_configurations")))
        .filter("n > 1")
        .select("kind", "value", "n")
    )


def _reverted(decision: str, version: str) -> dict[str, Column]:
    base = baseline_configuration(version)
    pre = F.col("preprocessing")
    parts = {"preprocessing": pre, "representation": F.col("representation"), "classifier": F.col("classifier")}
    if decision == "preprocessing.stopwords":
        parts["preprocessing"] = pre.withField("stopwords", F.lit("keep")).withField("negators", F.array().cast("array<string>"))
    elif decision == "preprocessing.lemmatize":
        parts["preprocessing"] = pre.withField("lemmatize", F.lit(False))
    elif decision in ("preprocessing.elongation", "preprocessing.emoji"):
        name = decision.split(".")[1]
        parts["preprocessing"] = pre.withField(name, F.lit("keep")).withField(f"{name}_spec", F.lit(None).cast("string"))
    elif decision in ("representation", "classifier"):
        parts[decision] = as_column(base[decision], decision)
    else:
        raise ValueError(f"{decision} is not a decision that can be reverted")
    return parts


def revert_decision(configs: DataFrame, decision: str, version: str) -> DataFrame:
    """Put one decision back to the baseline's; all else stays."""
    return configs.withColumns(_reverted(decision, version))


def revert_each(configs: DataFrame, version: str) -> DataFrame:
    """Six rows per configuration, each with one decision reverted."""
    rows = [
        F.struct(F.lit(d).alias("decision"), *[c.alias(n) for n, c in _reverted(d, version).items()]) for d in DECISIONS
    ]
    others = [c for c in configs.columns if c not in _PARTS]
    return configs.select(*others, F.inline(F.array(*rows)))


def ablation_plan(configs: DataFrame) -> DataFrame:
    """Decisions that differ from the baseline, and how many ablations that requires: up to two.

    What counts is what is computed: types, ranges, models and parameters, not library versions.
    """
    base = baseline_configuration("")
    pre, rep, clf = F.col("preprocessing"), F.col("representation"), F.col("classifier")
    unigrams = F.array(*[F.lit(n) for n in base["representation"]["ngram_range"]])
    differs = {
        "preprocessing.stopwords": pre["stopwords"] != base["preprocessing"]["stopwords"],
        "preprocessing.lemmatize": pre["lemmatize"] != base["preprocessing"]["lemmatize"],
        "preprocessing.elongation": pre["elongation"] != base["preprocessing"]["elongation"],
        "preprocessing.emoji": pre["emoji"] != base["preprocessing"]["emoji"],
        "representation": (rep["type"] != base["representation"]["type"]) | ~rep["ngram_range"].eqNullSafe(unigrams),
        "classifier": (clf["type"] != base["classifier"]["type"]) | (F.size(clf["parameters"]) > 0),
    }
    found = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in differs.items()]))
    others = [c for c in configs.columns if c not in _PARTS]
    return configs.select(*others, found.alias("decisions")).withColumn(
        "required", F.least(F.lit(2), F.size("decisions"))
    )
