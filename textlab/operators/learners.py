"""Linear learners on term or vector features, and the fitted text model.

Training needs vectors, so each text becomes one sparse vector, built by expressions and written
once. Scoring needs none: the model is a table of terms and weights that the term counts join.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from textlab.functions.signals import model_label
from textlab.functions.tokens import tokenize_words
from textlab.operators.cleaning import clean_text
from textlab.operators.features import fit_terms, mean_token_vectors, placed_by, smooth_idf, term_counts
from textlab.operators.linear_solver import Found, Shards, Sums, ascend, descend, margins, minimise, settle, shards_of, solve
from textlab.operators.lookup import lookup_join
from textlab.operators.ranking import global_rank
from textlab.session import discard, new_folder, stage

LEARNERS = ("logistic_regression", "linear_svm", "sgd")
_COMMON = {"C", "max_iter", "tol", "fit_intercept"}
_ACCEPTED = {
    "logistic_regression": _COMMON,
    "linear_svm": _COMMON,
    "sgd": {"alpha", "max_iter", "tol", "fit_intercept"},
}


@dataclass(frozen=True)
class Resources:
    """Lookup tables a configuration may need in place of a language model."""

    lemma_table: DataFrame | None = None
    token_vectors: DataFrame | None = None
    vector_dim: int = 0
    clean_options: Mapping = field(default_factory=dict)


@dataclass(frozen=True)
class LinearWeights:
    """What a learner found: one weight per feature position and the intercept."""

    weights: Sequence[float]
    intercept: float


def check_classifier(classifier: Mapping) -> dict:
    """Parameters of a classifier that can be fitted; anything unknown is an error."""
    kind, given = classifier["type"], dict(classifier.get("parameters") or {})
    if kind not in LEARNERS:
        raise ValueError(f"{kind} is not a classifier that can be fitted")
    unknown = set(given) - _ACCEPTED[kind]
    if unknown:
        raise ValueError(f"{kind} does not take {sorted(unknown)}")
    return given


def objective_of(classifier: Mapping) -> tuple[str, float, bool, bool]:
    """(loss, penalty, intercept penalised, mean loss) of a classifier, with the parameters' defaults.

    Logistic regression: sum of the losses and |w|^2 / 2C, the intercept free. Linear SVM: sum of the squared hinges and |w|^2 / 2C, the
    intercept penalised as any weight. SGD: mean hinge and alpha / 2 |w|^2, the intercept free.
    """
    given, kind = check_classifier(classifier), classifier["type"]
    if kind == "sgd":
        return "hinge", float(given.get("alpha", 1e-4)), False, True
    return ("squared_hinge" if kind == "linear_svm" else "logistic"), 1.0 / float(given.get("C", 1.0)), kind == "linear_svm", False


def fit_folds(shards: Shards, classifier: Mapping) -> Found:
    """Weights for all folds of `shards`: one run of the optimiser, or of seeded descent for SGD."""
    loss, penalty, penalised, mean = objective_of(classifier)
    given = check_classifier(classifier)
    intercept = str(given.get("fit_intercept", True)).lower() == "true"
    tolerance, most = float(given.get("tol", 1e-3 if mean else 1e-4)), int(given.get("max_iter", 100 if loss == "logistic" else 1000))
    if mean:
        count = 1 if shards.together else shards.count
        return solve(shards, loss, lambda data: descend(data, count, penalty, intercept, tolerance, most))

    several = shards.count > 1

    def method(data: Sums) -> Found:
        first = None
        if several:
            found, done = settle(data, penalty, intercept, penalised, tolerance, most)
            if done:
                return found
            first = found.weights, found.start
        if loss == "squared_hinge":
            first = ascend(data, penalty, intercept, tolerance)
        return minimise(data, penalty, intercept, penalised, tolerance, most, first)

    return solve(shards, loss, method)


def fit_classifier(train: DataFrame, classifier: Mapping) -> LinearWeights:
    """Fit on `(label double, features vector)`."""
    rows = train.select(F.monotonically_increasing_id().alias("index"), F.lit(None).cast("int").alias("fold"), "label", F.unwrap_udt("features").alias("v"))
    rows = stage(rows, "vectors")
    sizes = rows.agg(F.max(F.coalesce("v.size", F.size("v.values"))).alias("size"), F.sum(F.size("v.values")).alias("entries")).first()
    found = fit_folds(shards_of(rows, ["v"], sizes["size"], [None], sizes["entries"]), classifier)
    return LinearWeights(found.weights[0, :-1], float(found.weights[0, -1]))


@dataclass(frozen=True)
class TextModel:
    """Cleaning, features and weights in one: raw text in, label out.

    `terms` is `(term, df, idf, weight)` for term features and unused for token vectors.
    """

    configuration: Mapping
    intercept: float
    resources: Resources
    terms: DataFrame | None = None
    term_rows: int = 0
    dense_weights: Sequence[float] = ()

    def predict(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """`docs` with `margin`, `prediction` and `predicted_label`; every row stays.

        A label depends on the text alone, so equal texts are scored once, by their digest. Rows need no key of
        their own: keys that are null or come twice change nothing.
        """
        key = "_content"
        keyed = docs.withColumn(key, F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
        prepared = prepare_text(keyed.select(key, text).dropDuplicates([key]), self.configuration, self.resources, key, text)
        if self.terms is None:
            margins = _dense_margins(embed(prepared, self.resources, key), self.dense_weights, key)
        else:
            counts = term_counts(prepared, key, "clean", self.configuration["representation"]["ngram_range"])
            unit = self.configuration["representation"]["type"] == "tfidf"
            margins = term_margins(counts, self.terms, self.term_rows, unit, key)
        margins = stage(margins, "margins")  # read back, so that the join can split a text that comes very often
        margin = F.coalesce("_margin", F.lit(0.0)) + self.intercept
        return keyed.join(margins, key, "left").select(*docs.columns, margin.alias("margin")).select(
            "*",
            (F.col("margin") > 0).cast("int").alias("prediction"),
            model_label((F.col("margin") > 0).cast("int")).alias("predicted_label"),
        )


_MODEL = (
    "configuration string, intercept double, dense_weights array<double>, term_rows bigint, vector_dim int, "
    "clean_options string, has_terms boolean, has_lemmas boolean, has_vectors boolean"
)


def save_model(model: TextModel, path: str) -> None:
    """Write a model with the lookup tables it needs; the folder must be new."""
    found = model.resources
    tables = {"terms": model.terms, "lemmas": found.lemma_table, "vectors": found.token_vectors}
    for name, table in tables.items():
        if table is not None:
            table.write.parquet(f"{path}/{name}")
    row = (
        json.dumps(model.configuration), model.intercept, [float(w) for w in model.dense_weights], model.term_rows,
        found.vector_dim, json.dumps(dict(found.clean_options)), *[table is not None for table in tables.values()],
    )
    SparkSession.active().createDataFrame([row], _MODEL).write.parquet(f"{path}/model")


def load_model(spark: SparkSession, path: str) -> TextModel:
    row = spark.read.parquet(f"{path}/model").first()

    def table(name: str, there: bool) -> DataFrame | None:
        return spark.read.parquet(f"{path}/{name}") if there else None

    resources = Resources(
        lemma_table=table("lemmas", row["has_lemmas"]),
        token_vectors=table("vectors", row["has_vectors"]),
        vector_dim=row["vector_dim"],
        clean_options=json.loads(row["clean_options"]),
    )
    return TextModel(
        json.loads(row["configuration"]), row["intercept"], resources, table("terms", row["has_terms"]),
        row["term_rows"], row["dense_weights"],
    )


def prepare_text(docs: DataFrame, configuration: Mapping, resources: Resources, key: str, text: str = "text") -> DataFrame:
    return clean_text(
        placed_by(docs, key), configuration["preprocessing"], key, text, lemma_table=resources.lemma_table, **resources.clean_options
    )


def embed(cleaned: DataFrame, resources: Resources, key: str) -> DataFrame:
    """`(key, vec)` by the mean of the token vectors of the cleaned text."""
    if resources.token_vectors is None:
        raise ValueError("this representation needs token vectors")
    words = cleaned.select(key, tokenize_words(F.col("clean")).alias("tokens"))
    return mean_token_vectors(words, resources.token_vectors, resources.vector_dim, key)


def term_margins(counts: DataFrame, terms: DataFrame, rows: int, unit: bool, key: str) -> DataFrame:
    """Weighted sum of the known terms per text, divided by the text's length where texts have length 1."""
    known = lookup_join(counts, terms, "term", [key], rows=rows, frequency="df")
    value = F.col("n") * F.col("idf") if unit else F.col("n")
    total = F.sum(value * F.col("weight"))
    if unit:
        total = total / F.sqrt(F.sum(value * value))
    return known.groupBy(key).agg(total.alias("_margin"))


def _dense_margins(vectors: DataFrame, weights: Sequence[float], key: str) -> DataFrame:
    fixed = F.array(*[F.lit(float(w)) for w in weights])
    products = F.zip_with("vec", fixed, lambda a, b: a * b)
    return vectors.select(key, F.aggregate(products, F.lit(0.0), lambda total, x: total + x).alias("_margin"))


# --- training tables ------------------------------------------------------------------------------


def _sparse(parts: Column, size: int, value: str) -> Column:
    """Struct that has the storage layout of a sparse vector."""
    return F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).alias("size"),
        parts["slot"].alias("indices"),
        parts[value].alias("values"),
    )


def _read_vectors(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Read staged structs back as vectors: the file layout of both is the same."""
    fields = [T.StructField("index", T.LongType()), T.StructField("fold", T.IntegerType()), T.StructField("label", T.DoubleType())]
    return spark.read.schema(T.StructType(fields + [T.StructField(c, VectorUDT()) for c in columns])).parquet(path)


class TermTraining:
    """Term features of labelled texts `(index, fold, label, clean)`, for one fit or for every fold.

    Texts are counted once. Document frequencies outside of each fold come from one aggregation, one table
    holds the vectors of every split, and one run of the optimiser fits all of them.

    Each term has its own slot, however many there are. Only `hash_slots` among the parameters of the representation
    makes terms share that many slots by hash; it is part of the configuration and so of the logged run.
    """

    def __init__(self, docs: DataFrame, representation: Mapping, folds: Sequence[int]):
        self.folds = list(folds)
        self.unit = representation["type"] == "tfidf"
        self.docs = stage(docs.select("index", "fold", F.col("label").cast("double").alias("label")), "labels")
        self.counts = stage(
            term_counts(docs, "index", "clean", representation["ngram_range"], ["fold"]), "counts"
        )
        fitted = fit_terms(self.docs, self.counts, self.folds)
        self.rows, self.texts = fitted.rows, fitted.texts
        slots = (representation.get("parameters") or {}).get("hash_slots")
        self.exact = slots is None
        self.size = max(fitted.rows, 1) if self.exact else int(slots)
        if self.exact:
            ranked = global_rank(fitted.table, ["term"], "slot")
            self.terms = ranked.withColumn("slot", F.col("slot").cast("int"))
        else:
            self.terms = fitted.table.withColumn("slot", F.pmod(F.xxhash64("term"), F.lit(self.size)).cast("int"))
        self.path = new_folder(docs.sparkSession, "features")
        self._write_features()

    def _splits(self) -> list[int | None]:
        return self.folds or [None]

    def _idf(self, split: int | None) -> Column:
        name = "df" if split is None else f"df_{split}"
        fitted = F.when(F.col(name) > 0, smooth_idf(F.col(name), self.texts[split]))
        return fitted if self.unit else F.when(F.col(name) > 0, F.lit(1.0))

    def _write_features(self) -> None:
        # Bag-of-words counts do not depend on the split; a term unseen outside of a fold gets weight 0.
        values = {f"v_{s}": F.col("n") * self._idf(s) for s in self._splits()} if self.unit else {"v": F.col("n").cast("double")}
        known = lookup_join(self.counts, self.terms, "term", ["index"], rows=self.rows, frequency="df")
        weighted = known.select("index", "slot", *[v.alias(name) for name, v in values.items()])
        if self.unit:
            lengths = [F.sqrt(F.sum(F.col(v) * F.col(v))).alias(f"len_{v}") for v in values]
        if not self.exact:
            summed = weighted
            if self.unit:
                summed = weighted.join(weighted.groupBy("index").agg(*lengths), "index").select(
                    "index", "slot", *[(F.col(v) / F.col(f"len_{v}")).alias(v) for v in values]
                )
            weighted = summed.groupBy("index", "slot").agg(*[F.sum(v).alias(v) for v in values])
        part = F.struct("slot", *values)
        grouped = weighted.groupBy("index").agg(
            F.sort_array(F.collect_list(part)).alias("_parts"), *(lengths if self.unit and self.exact else [])
        )
        if self.unit and self.exact:
            scaled = F.transform(
                "_parts",
                lambda p: F.struct(p["slot"].alias("slot"), *[(p[v] / F.col(f"len_{v}")).alias(v) for v in values]),
            )
            grouped = grouped.withColumn("_parts", scaled)
        empty = F.array().cast(grouped.schema["_parts"].dataType)
        vectors = self.docs.join(grouped, "index", "left").withColumn("_parts", F.coalesce("_parts", empty))
        vectors.select(
            "index", "fold", "label", *[_sparse(F.col("_parts"), self.size, v).alias(v) for v in values]
        ).write.parquet(self.path)

    def features(self, split: int | None) -> DataFrame:
        """Training rows of a split with their vectors."""
        column = f"v_{split}" if self.unit else "v"
        rows = _read_vectors(self.docs.sparkSession, self.path, [column]).withColumnRenamed(column, "features")
        return rows if split is None else rows.filter(F.col("fold") != split)

    @cached_property
    def shards(self) -> Shards:
        columns = [f"v_{s}" for s in self._splits()] if self.unit else ["v"]
        return shards_of(self.docs.sparkSession.read.parquet(self.path), columns, self.size, self._splits(), self.entries)

    @cached_property
    def entries(self) -> int:
        return self.counts.count()

    def only_shards(self) -> None:
        """Stage the shards and delete what they were made of; that leaves `fit`, without scores or proofs by `features`."""
        spark, _ = self.docs.sparkSession, self.entries
        discard(self.counts)
        _ = self.shards
        discard(spark.read.parquet(self.path))

    def fit(self, classifier: Mapping, split: int | None = None) -> tuple[DataFrame, float]:
        """`(term, df, idf, weight)` of the terms known in a split, staged, and the intercept."""
        found = fit_folds(self.shards.only(split), classifier).weights[0]
        return self.model_terms(found, split), float(found[-1])

    def model_terms(self, found: np.ndarray, split: int | None) -> DataFrame:
        """`(term, df, idf, weight)` from the weights by slot."""
        spark = self.docs.sparkSession
        weights = spark.createDataFrame(pd.DataFrame({"slot": range(self.size), "weight": found[:-1]}), "slot int, weight double")
        known = self.terms.withColumn("idf", self._idf(split)).filter("idf IS NOT NULL").select("term", "df", "slot", "idf")
        placed = lookup_join(known, weights, "slot", ["term"], row_bytes=16, rows=self.size)
        return stage(placed.select("term", "df", "idf", "weight"), "model")

    def score(self, terms: DataFrame, intercept: float, split: int) -> DataFrame:
        """Predictions for the texts that validate in a split."""
        inside = self.counts.filter(F.col("fold") == split)
        margins = term_margins(inside, terms, self.rows, self.unit, "index")
        rows = self.docs.filter(F.col("fold") == split).join(margins, "index", "left")
        return _decide(rows, F.coalesce("_margin", F.lit(0.0)) + intercept)


class VectorTraining:
    """The same steps for mean token vectors, which need no fit of their own."""

    def __init__(self, docs: DataFrame, resources: Resources):
        self.dim = resources.vector_dim
        vectors = embed(docs, resources, "index")
        labelled = docs.select("index", "fold", F.col("label").cast("double").alias("label"))
        self.rows = stage(labelled.join(vectors, "index"), "vectors")
        self.texts = {row["fold"]: row["n"] for row in self.rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}

    @cached_property
    def shards(self) -> Shards:
        folds = sorted(fold for fold in self.texts if fold is not None) or [None]
        vector = F.struct(F.lit(1).cast("tinyint").alias("type"), F.lit(self.dim).alias("size"), F.lit(None).cast("array<int>").alias("indices"), F.col("vec").alias("values"))
        rows = self.rows.select("index", "fold", "label", vector.alias("v"))
        return shards_of(rows, ["v"], self.dim, folds, sum(self.texts.values()) * self.dim)

    def fit(self, classifier: Mapping) -> LinearWeights:
        found = fit_folds(self.shards, classifier).weights[0]
        return LinearWeights(found[:-1], float(found[-1]))


def _decide(rows: DataFrame, margin: Column) -> DataFrame:
    return rows.select("index", "fold", F.col("label").cast("int").alias("label"), (margin > 0).cast("int").alias("prediction"))


# --- entry points ---------------------------------------------------------------------------------


def cross_validate(docs: DataFrame, configuration: Mapping, resources: Resources = Resources()) -> DataFrame:
    """Predictions `(index, fold, label, prediction)` for labelled texts `(index, fold, label, text)`.

    Each row is predicted by the model fitted outside of its fold. Texts are cleaned once; a pass over the features serves all folds.
    """
    shards = training_data(docs, configuration, resources).shards
    found = fit_folds(shards, configuration["classifier"])
    return _decide(margins(shards, found.weights), F.col("margin"))


def training_data(docs: DataFrame, configuration: Mapping, resources: Resources = Resources()) -> TermTraining | VectorTraining:
    """The features of labelled texts `(index, fold, label, text)` for all folds."""
    check_classifier(configuration["classifier"])
    cleaned = prepare_text(docs, configuration, resources, "index")
    if configuration["representation"]["type"] == "spacy_embedding":
        return VectorTraining(cleaned, resources)
    folds = sorted(row["fold"] for row in docs.select("fold").distinct().collect())
    return TermTraining(cleaned, configuration["representation"], folds)


def train_model(train: DataFrame, configuration: Mapping, resources: Resources = Resources()) -> TextModel:
    """Fit cleaning, features and classifier on all of `(index, label, text)`."""
    check_classifier(configuration["classifier"])
    cleaned = prepare_text(train.withColumn("fold", F.lit(None).cast("int")), configuration, resources, "index")
    if configuration["representation"]["type"] == "spacy_embedding":
        found = VectorTraining(cleaned, resources).fit(configuration["classifier"])
        return TextModel(configuration, found.intercept, resources, dense_weights=list(found.weights))
    training = TermTraining(cleaned, configuration["representation"], [])
    training.only_shards()
    terms, intercept = training.fit(configuration["classifier"])
    return TextModel(configuration, intercept, resources, terms, training.rows)
