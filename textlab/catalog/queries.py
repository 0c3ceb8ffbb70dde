"""One registered query per operator: `(spark, folder) -> DataFrame`.

Every query reads its tables whole. Lists are joined to text and doubles rounded to six places, so
that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from textlab.catalog import views as V
from textlab.functions import signals as G, text as X, tokens as K
from textlab.functions.words import NEGATORS
from textlab.operators import (
    certificates, cleaning, errors, evaluation, features, learners, ranking, runlog, scoring, splits,
)
from textlab.plans import configurations as C, experiment as E
from textlab.session import new_folder, stage
from textlab.sources import tables as S
from textlab.streaming.scoring import REQUESTS, score_stream as start_score_stream

SAMPLE_FRACTION = 0.6
FOLDS = [0, 1, 2]
SERVED = "model_0"
FULL_PREPROCESSING = {
    "lowercase": True, "url": "drop", "mention": "token:user", "whitespace": "normalize",
    "stopwords": "remove_preserve_negation", "negators": NEGATORS, "lemmatize": True,
    "elongation": "normalize", "elongation_spec": C.ELONGATION_SPEC, "emoji": "text", "emoji_spec": C.EMOJI_SPEC,
}

_registered: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    _registered[function.__name__] = function
    return function


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_registered)


def round6(name: str):
    return F.round(F.col(name), 6).alias(name)


def joined(name: str, by: str = ","):
    return F.array_join(name, by).alias(name)


def tweets(spark: SparkSession, folder: str, split: str | None = None) -> DataFrame:
    rows = V.spark_view(spark, folder, "tweets")
    return rows if split is None else rows.filter(F.col("split") == split)


def spread_texts(spark: SparkSession, folder: str) -> DataFrame:
    return S.spread(tweets(spark, folder).select("index", "text"), "index")


def folds(spark: SparkSession, folder: str) -> DataFrame:
    """`(index, label, fold)` of the train texts."""
    return splits.stratified_kfold(tweets(spark, folder, "train").select("index", "label"))


def folded_texts(spark: SparkSession, folder: str) -> DataFrame:
    texts = tweets(spark, folder, "train").select("index", "label", "text")
    return texts.join(folds(spark, folder).select("index", "fold"), "index")


def baseline_clean(rows: DataFrame, *keep: str, tasks: int | None = None) -> DataFrame:
    return features.placed_by(rows.select("index", *keep, "text"), tasks=tasks).select("index", *keep, X.clean_text_b0(F.col("text")).alias("clean"))


def clean_in_place(spark: SparkSession, folder: str, split: str | None = None, tasks: int | None = None) -> DataFrame:
    """Cleaned texts where the scan has them, for aggregates that need no place by index; `tasks` moves them to tasks of a bounded size."""
    found = tweets(spark, folder, split).select("index", "text")
    rows = S.spread(found, "index") if tasks is None else features.placed_by(found, tasks=tasks)
    return rows.select("index", X.clean_text_b0(F.col("text")).alias("clean"))


def lemma_table(spark: SparkSession, folder: str) -> DataFrame:
    """Forms of four or more letters that end in `s` and whose stem is a term, too."""
    terms = stage(features.distinct_terms(clean_in_place(spark, folder)), "lemma-terms")
    forms = terms.filter("length(term) >= 4 AND term LIKE '%s'").select(
        F.col("term").alias("form"), F.expr("substring(term, 1, length(term) - 1)").alias("lemma")
    )
    return stage(forms.join(terms.select(F.col("term").alias("lemma")), "lemma", "left_semi"), "lemmas")


def token_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """A vector for each term of Latin letters: the embedding at the place its hash points to."""
    found = features.distinct_terms(clean_in_place(spark, folder))
    terms = found.select(F.col("term").alias("token")).filter("token RLIKE '^[a-z]+$'")
    ranked = ranking.global_rank(spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding"), ["vec_id"], "place")
    rows = ranked.count()
    placed = terms.withColumn("place", F.pmod(ranking.seeded_hash(F.col("token")), F.lit(rows)))
    return stage(placed.join(ranked, "place").select("token", F.col("embedding").alias("vec")), "token-vectors")


VECTOR_DIM = 64


# --- sources, sinks, checks -------------------------------------------------------------------------


@query
def labelled_text(spark, folder):
    return S.read_labelled_text(spark, folder)


@query
def source_profile(spark, folder):
    return S.profile_source(S.read_labelled_text(spark, folder, "left"))


@query
def check_row_count(spark, folder):
    return S.check_row_count(spark.read.parquet(f"{folder}/documents.parquet"), 1000, "documents")


@query
def row_index(spark, folder):
    rows = S.read_labelled_text(spark, folder, "left").select(F.col("index").alias("doc_id"), "label")
    return ranking.with_row_index(rows, ["doc_id"])


@query
def partitions_with_text(spark, folder):
    parts = folds(spark, folder).select("index", "fold")
    return S.join_partitions_text(parts, S.read_labelled_text(spark, folder))


@query
def check_unmatched(spark, folder):
    return S.check_unmatched(folds(spark, folder).select("index", "fold"), S.read_labelled_text(spark, folder))


@query
def check_unique(spark, folder):
    turns = spark.read.parquet(f"{folder}/conversations.parquet")
    return S.check_unique(turns.select(F.col("conv_id").alias("index")))


@query
def csv_roundtrip(spark, folder):
    wrong = S.in_order(errors.misclassified(V.spark_view(spark, folder, "predictions")), ["index"])
    report = errors.with_category(wrong).select(
        "index", "text", G.report_label(F.col("label")).alias("true_label"),
        G.report_label(F.col("prediction")).alias("predicted_label"), "category",
    )
    path = new_folder(spark, "report")
    S.write_table(report, path, S.ERROR_REPORT.names)
    return S.read_table(spark, path, S.ERROR_REPORT, multiline=True)


@query
def members_roundtrip(spark, folder):
    path = new_folder(spark, "members")
    S.write_table(V.spark_view(spark, folder, "members"), path, S.MEMBERS.names, ["member_id"])
    return S.read_table(spark, path, S.MEMBERS)


@query
def run_log_append(spark, folder):
    path = new_folder(spark, "runs")
    runlog.append_run(V.run_log(spark, folder), path)
    scores = evaluation.macro_f1_per_fold(V.spark_view(spark, folder, "predictions"))
    tags = {"lab_experiment_id": "EXTRA", "lab_stage": "classifier", "lab_member_id": "M0"}
    text = E.configuration_json(C.baseline_configuration(V.VERSION))
    runlog.append_run(runlog.experiment_run(scores, "run-new", tags, text, runlog.EXPERIMENT_ARTIFACTS), path)
    return runlog.read_runs(spark, path).select(
        "run_id", "status", runlog.tag("lab_experiment_id").alias("experiment_id"),
        F.size("artifacts").cast("bigint").alias("artifacts"),
        *[F.round(runlog.metric(m), 6).alias(m) for m in ["macro_f1_fold_0", "macro_f1_fold_1", "macro_f1_fold_2", "macro_f1_mean", "macro_f1_std"]],
    )


# --- sampling and splits ----------------------------------------------------------------------------


@query
def stratified_sample(spark, folder):
    return splits.stratified_sample(tweets(spark, folder, "train"), fraction=SAMPLE_FRACTION)


@query
def stratified_kfold(spark, folder):
    return folds(spark, folder)


@query
def fold_balance(spark, folder):
    return splits.fold_balance(folds(spark, folder))


@query
def cv_splits(spark, folder):
    return splits.cv_splits(folds(spark, folder))


@query
def protocol_row(spark, folder):
    sample = splits.stratified_sample(tweets(spark, folder, "train"), fraction=SAMPLE_FRACTION)
    return splits.protocol_row(sample, V.PROTOCOL["dataset_id"], V.PROTOCOL["dataset_revision"])


# --- text cleaning ----------------------------------------------------------------------------------


def _text_query(spark, folder, **columns):
    return spread_texts(spark, folder).select("index", *[c.alias(n) for n, c in columns.items()])


@query
def text_lower(spark, folder):
    return _text_query(spark, folder, lowered=X.lower_text(F.col("text")))


@query
def text_urls(spark, folder):
    text = F.col("text")
    return _text_query(spark, folder, token=X.replace_urls(text), dropped=X.replace_urls(text, "drop"), kept=X.replace_urls(text, "keep"))


@query
def text_mentions(spark, folder):
    text = F.col("text")
    return _text_query(spark, folder, token=X.replace_mentions(text), dropped=X.replace_mentions(text, "drop"))


@query
def text_elongation(spark, folder):
    return _text_query(spark, folder, squeezed=X.squeeze_elongation(F.col("text")))


@query
def text_emoji(spark, folder):
    return _text_query(spark, folder, named=X.emoji_to_text(F.col("text")))


@query
def text_whitespace(spark, folder):
    return _text_query(spark, folder, normalized=X.normalize_whitespace(F.col("text")))


def words(spark, folder) -> DataFrame:
    return spread_texts(spark, folder).select("index", K.tokenize_words(F.col("text")).alias("tokens"))


@query
def tokens_words(spark, folder):
    return words(spark, folder).select("index", F.size("tokens").cast("bigint").alias("n"), joined("tokens", " "))


@query
def stopwords_remove(spark, folder):
    return words(spark, folder).select("index", K.join_tokens(K.remove_stopwords(F.col("tokens"))).alias("kept"))


@query
def stopwords_keep_negation(spark, folder):
    kept = K.remove_stopwords(F.col("tokens"), negators=NEGATORS)
    return words(spark, folder).select("index", K.join_tokens(kept).alias("kept"))


@query
def lemmatize(spark, folder):
    rows = baseline_clean(tweets(spark, folder)).select("index", K.tokenize_words(F.col("clean")).alias("tokens"))
    return cleaning.lemmatize(rows, lemma_table(spark, folder)).select("index", joined("tokens", " "))


@query
def clean_text(spark, folder):
    rows = features.placed_by(tweets(spark, folder).select("index", "text"))
    return cleaning.clean_text(rows, FULL_PREPROCESSING, lemma_table=lemma_table(spark, folder)).select("index", "clean")


@query
def clean_text_b0(spark, folder):
    return _text_query(spark, folder, clean=X.clean_text_b0(F.col("text")))


# --- representations --------------------------------------------------------------------------------


def grams(spark, folder, split, ngram_range=(1, 1), tasks: int | None = None) -> DataFrame:
    return features.term_counts(baseline_clean(tweets(spark, folder, split), tasks=tasks), ngram_range=ngram_range)


@query
def vector_tokens(spark, folder):
    rows = spread_texts(spark, folder).select("index", K.vector_tokens(F.col("text")).alias("tokens"))
    return rows.select("index", F.size("tokens").cast("bigint").alias("n"), joined("tokens", " "))


@query
def ngrams(spark, folder):
    rows = spread_texts(spark, folder).select("index", K.ngrams(K.vector_tokens(F.col("text")), 1, 2).alias("grams"))
    return rows.select("index", F.size("grams").cast("bigint").alias("n"), joined("grams", "|"))


@query
def vocabulary(spark, folder):
    return features.fit_vocabulary(features.distinct_terms(clean_in_place(spark, folder, "train")))


@query
def bow_unigram(spark, folder):
    known = vocabulary(spark, folder)
    return features.bow(grams(spark, folder, "test"), known).select("index", "term", "term_index", "n")


def _tfidf(spark, folder, ngram_range):
    train, test = tweets(spark, folder, "train"), tweets(spark, folder, "test")
    texts = clean_in_place(spark, folder, "train", features.tasks_for(train))
    fitted = features.fit_terms(train, features.text_terms(texts, ngram_range=ngram_range))
    counts = grams(spark, folder, "test", ngram_range, features.tasks_for(test))
    return features.tfidf(counts, fitted).select("index", "term", round6("value"))


@query
def tfidf_unigram(spark, folder):
    return _tfidf(spark, folder, (1, 1))


@query
def tfidf_uni_bi(spark, folder):
    return _tfidf(spark, folder, (1, 2))


@query
def tfidf_per_fold(spark, folder):
    tasks = features.tasks_for(tweets(spark, folder, "train"))
    counts = stage(features.term_counts(baseline_clean(folded_texts(spark, folder), "fold", tasks=tasks), carry=["fold"]), "counts")
    fitted = features.fit_terms(folds(spark, folder), counts, FOLDS)
    return features.tfidf_per_fold(counts, fitted, FOLDS, role="validation").select("split", "index", "term", round6("value"))


@query
def mean_token_vectors(spark, folder):
    rows = baseline_clean(tweets(spark, folder)).select("index", K.tokenize_words(F.col("clean")).alias("tokens"))
    found = features.mean_token_vectors(rows, token_vectors(spark, folder), VECTOR_DIM)
    return found.select("index", F.posexplode("vec").alias("pos", "value")).select("index", "pos", round6("value"))


# --- learners ---------------------------------------------------------------------------------------


@query
def majority_per_fold(spark, folder):
    return evaluation.majority_class(folds(spark, folder))


def cv_data(spark, folder, tag, preprocessing=None, representation=None):
    return folded_texts(spark, folder), C.named_configuration(tag, V.VERSION, preprocessing, representation)


def cv_scores(spark, folder, tag, preprocessing=None, resources=learners.Resources()):
    rows, configuration = cv_data(spark, folder, tag, preprocessing)
    return E.run_configuration(rows, configuration, resources).select("fold", round6("macro_f1"))


def cv_certificate(spark, folder, tag, preprocessing=None, resources=learners.Resources()):
    """The fits of all folds, each proven: gradient at the weights against the gradient at zero."""
    rows, configuration = cv_data(spark, folder, tag, preprocessing)
    found = certificates.certified(learners.training_data(rows, configuration, resources), configuration["classifier"])
    return found.select("fold", "train_rows", "validation_rows", "features", F.round("start_norm", 3).alias("start_norm"), "optimal")


@query
def cv_logreg(spark, folder):
    return cv_certificate(spark, folder, "C_LOGREG")


@query
def cv_logreg_scores(spark, folder):
    return cv_scores(spark, folder, "C_LOGREG")


@query
def cv_linear_svm(spark, folder):
    return cv_certificate(spark, folder, "C_LINEAR_SVM")


@query
def cv_linear_svm_scores(spark, folder):
    return cv_scores(spark, folder, "C_LINEAR_SVM")


@query
def cv_sgd(spark, folder):
    return cv_certificate(spark, folder, "C_SGD")


@query
def cv_sgd_scores(spark, folder):
    return cv_scores(spark, folder, "C_SGD")


@query
def run_configuration(spark, folder):
    resources = learners.Resources(lemma_table=lemma_table(spark, folder))
    return cv_certificate(spark, folder, "R_TFIDF_UNI", FULL_PREPROCESSING, resources)


@query
def run_configuration_scores(spark, folder):
    resources = learners.Resources(lemma_table=lemma_table(spark, folder))
    return cv_scores(spark, folder, "R_TFIDF_UNI", FULL_PREPROCESSING, resources)


@query
def run_configuration_vectors(spark, folder):
    resources = learners.Resources(token_vectors=token_vectors(spark, folder), vector_dim=VECTOR_DIM)
    return cv_certificate(spark, folder, "R_SPACY", resources=resources)


@query
def run_configuration_vectors_scores(spark, folder):
    resources = learners.Resources(token_vectors=token_vectors(spark, folder), vector_dim=VECTOR_DIM)
    return cv_scores(spark, folder, "R_SPACY", resources=resources)


def fixed_model(spark, folder) -> learners.TextModel:
    """Baseline cleaning and counts; the weight of a train term is a whole number from its hash, so margins are exact."""
    counted = features.text_terms(clean_in_place(spark, folder, "train")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = (F.pmod(ranking.seeded_hash(F.col("term")), F.lit(7)) - 3).cast("double").alias("weight")
    terms = stage(counted.select("term", "df", F.lit(1.0).alias("idf"), weight), "fixed-terms")
    return learners.TextModel(C.baseline_configuration(V.VERSION), 0.5, learners.Resources(), terms, terms.count())


@query
def predict_labels(spark, folder):
    """Labels by a model with fixed weights."""
    return fixed_model(spark, folder).predict(tweets(spark, folder, "test").select("index", "text")).select("index", "predicted_label")


def fitted_model(spark, folder) -> learners.TextModel:
    return learners.train_model(tweets(spark, folder, "train"), C.named_configuration("R_TFIDF_UNI", V.VERSION))


def model_certificate(spark, folder, model: learners.TextModel) -> DataFrame:
    found = certificates.certified_model(model, tweets(spark, folder, "train").select("index", "label", "text"))
    return found.select(F.col("train_rows").alias("training_size"), "features", F.round("start_norm", 3).alias("start_norm"), "optimal")


@query
def predict_fitted(spark, folder):
    """A model that is fitted first, its proof, and how many texts it labels."""
    model = fitted_model(spark, folder)
    labelled = model.predict(tweets(spark, folder, "test").select("index", "text")).agg(F.count("predicted_label").alias("labelled")).first()
    return model_certificate(spark, folder, model).withColumn("labelled", F.lit(labelled["labelled"]).cast("bigint"))


@query
def predict_fitted_labels(spark, folder):
    return fitted_model(spark, folder).predict(tweets(spark, folder, "test").select("index", "text")).select("index", "predicted_label")


def final_experiment(spark, folder) -> E.FinalModel:
    tags = {"lab_member_id": "M0", "lab_configuration_id": "CFG_0", "notebook_arn": "arn:nb:M0"}
    return E.train_final(
        tweets(spark, folder, "train"), tweets(spark, folder, "test"), C.baseline_configuration(V.VERSION), "run-final", tags
    )


@query
def final_model(spark, folder):
    """The final run with the proof of its model."""
    found = final_experiment(spark, folder)
    run = found.run.select("run_id", runlog.param("training_size").cast("bigint").alias("training_size"))
    return run.join(model_certificate(spark, folder, found.model), "training_size")


@query
def final_model_score(spark, folder):
    return final_experiment(spark, folder).run.select(
        "run_id", runlog.param("training_size").cast("bigint").alias("training_size"),
        F.round(runlog.metric("test_macro_f1"), 6).alias("test_macro_f1"),
    )


# --- scores, configurations, ablation ---------------------------------------------------------------


@query
def confusion_per_fold(spark, folder):
    return evaluation.confusion(V.spark_view(spark, folder, "predictions"))


@query
def macro_f1_per_fold(spark, folder):
    return evaluation.macro_f1_per_fold(V.spark_view(spark, folder, "predictions")).select("fold", round6("macro_f1"))


@query
def score_summary(spark, folder):
    scores = evaluation.macro_f1_per_fold(V.spark_view(spark, folder, "predictions"))
    return evaluation.score_summary(scores).select(round6("macro_f1_mean"), round6("macro_f1_std"))


@query
def t0_scores(spark, folder):
    return evaluation.t0_scores(folds(spark, folder)).select("fold", round6("macro_f1"))


def flat_configuration(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(
        *keep,
        *[F.col(f"preprocessing.{f}").alias(f) for f in ["stopwords", "lemmatize", "elongation", "elongation_spec", "emoji", "emoji_spec"]],
        F.array_join("preprocessing.negators", ",").alias("negators"),
        F.col("representation.type").alias("rep_type"),
        F.array_join(F.col("representation.ngram_range").cast("array<string>"), ",").alias("ngram_range"),
        F.col("classifier.type").alias("clf_type"),
    )


@query
def comparison_grid(spark, folder):
    return flat_configuration(C.comparison_grid(V.configurations(spark, folder), V.VERSION), "config_key", "tag", "stage")


@query
def validate_configs(spark, folder):
    return C.validate_configs(V.configurations(spark, folder)).select("config_key", joined("violations"))


@query
def config_conflicts(spark, folder):
    return C.config_conflicts(V.run_log(spark, folder))


@query
def revert_decision(spark, folder):
    return flat_configuration(C.revert_each(V.configurations(spark, folder), V.VERSION), "config_key", "decision")


@query
def ablation_plan(spark, folder):
    return C.ablation_plan(V.configurations(spark, folder)).select("config_key", joined("decisions"), "required")


@query
def ablation_delta(spark, folder):
    return runlog.ablation_delta(V.run_log(spark, folder)).select("run_id", "parent_run_id", round6("macro_f1_delta"), "status")


@query
def leaderboard(spark, folder):
    return runlog.leaderboard(V.run_log(spark, folder)).select("stage", "run_id", "configuration_id", round6("macro_f1_mean"))


# --- error analysis ---------------------------------------------------------------------------------


@query
def misclassified(spark, folder):
    return errors.misclassified(V.spark_view(spark, folder, "predictions"))


@query
def select_errors(spark, folder):
    return errors.select_errors(V.spark_view(spark, folder, "predictions"))


@query
def error_signals(spark, folder):
    return spread_texts(spark, folder).select("index", F.array_join(G.error_signals(F.col("text")), ",").alias("signals"))


@query
def error_category(spark, folder):
    return errors.with_category(spread_texts(spark, folder)).select("index", "category")


def counted_categories(spark, folder) -> DataFrame:
    """Categories of the errors in the report."""
    return errors.category_counts(errors.error_report(V.spark_view(spark, folder, "predictions")))


@query
def category_counts_of_all_errors(spark, folder):
    wrong = errors.misclassified(V.spark_view(spark, folder, "predictions")).select("index", "text")
    return errors.category_counts(errors.with_category(S.spread(wrong, "index")))


@query
def category_counts(spark, folder):
    return counted_categories(spark, folder)


@query
def top_categories(spark, folder):
    return errors.top_categories(counted_categories(spark, folder))


@query
def error_report(spark, folder):
    return errors.error_report(V.spark_view(spark, folder, "predictions"))


# --- run-log audit ----------------------------------------------------------------------------------


@query
def presented_runs(spark, folder):
    return runlog.presented_runs(V.run_log(spark, folder)).select("run_id", runlog.tag("lab_run_type").alias("run_type"))


@query
def protocol_audit(spark, folder):
    return runlog.protocol_audit(V.run_log(spark, folder))


@query
def runs_audit(spark, folder):
    return runlog.runs_audit(V.run_log(spark, folder)).select(
        "run_id", "status", "run_type",
        F.size("params").cast("bigint").alias("params"), F.size("metrics").cast("bigint").alias("metrics"),
        F.size("tags").cast("bigint").alias("tags"), joined("artifacts"), "configuration",
    )


@query
def valid_experiment(spark, folder):
    return runlog.valid_experiment(V.run_log(spark, folder)).select("run_id", "valid")


@query
def valid_final(spark, folder):
    return runlog.valid_final(V.run_log(spark, folder)).select("run_id", "valid")


def members(spark, folder) -> DataFrame:
    return V.spark_view(spark, folder, "members")


@query
def attribute_runs(spark, folder):
    return runlog.attribute_runs(V.run_log(spark, folder), members(spark, folder)).select(
        "run_id", "valid", "member_id", "notebook_arn", "attributed"
    )


@query
def contributions(spark, folder):
    return runlog.contributions(V.run_log(spark, folder), members(spark, folder))


@query
def contribution_items(spark, folder):
    return runlog.contribution_items(V.run_log(spark, folder), members(spark, folder))


@query
def rejected_runs(spark, folder):
    return runlog.rejected_runs(V.run_log(spark, folder), members(spark, folder))


@query
def contribution_minimum(spark, folder):
    return runlog.contribution_minimum(V.run_log(spark, folder))


@query
def experiment_table(spark, folder):
    found = runlog.experiment_table(V.run_log(spark, folder))
    return found.select(
        "run_id", "lab_experiment_id", "lab_stage", "lab_member_id", "lab_configuration_id",
        round6("macro_f1_mean"), round6("macro_f1_std"), round6("macro_f1_delta"),
    )


@query
def champion(spark, folder):
    return runlog.champion(V.spark_view(spark, folder, "models"))


@query
def champion_audit(spark, folder):
    models = V.spark_view(spark, folder, "models")
    wanted = models.select("name").distinct().unionAll(models.agg(F.lit("model_5").alias("name")))
    return runlog.champion_audit(wanted, models, V.run_log(spark, folder)).withColumn("test_macro_f1", F.round("test_macro_f1", 6))


# --- request scoring --------------------------------------------------------------------------------


def requests(spark, folder) -> DataFrame:
    return V.spark_view(spark, folder, "requests")


@query
def validate_texts(spark, folder):
    return scoring.validate_texts(requests(spark, folder)).select("request_id", "pos", "ok", "reason")


@query
def validate_requests(spark, folder):
    return scoring.validate_requests(requests(spark, folder), V.spark_view(spark, folder, "request_list"))


@query
def score_requests(spark, folder):
    listed = V.spark_view(spark, folder, "request_list")
    found = scoring.score_requests(requests(spark, folder), listed, fixed_model(spark, folder), "run-final")
    return found.select("request_id", "model_run_id", joined("predictions"))


@query
def score_stream(spark, folder):
    """The feed of all requests, scored by the champion: saved by run id, registered, resolved for each batch."""
    feed, out, rejects, saved = (new_folder(spark, name) for name in ("feed", "scores", "rejects", "models"))
    registered = V.spark_view(spark, folder, "models").filter(F.col("name") == SERVED)
    newest = runlog.champion(registered).first()
    if newest is not None:
        learners.save_model(fixed_model(spark, folder), f"{saved}/{newest['run_id']}")
    requests(spark, folder).write.parquet(feed)
    stream = spark.readStream.schema(REQUESTS).parquet(feed)
    serving = lambda: E.champion_model(registered, SERVED, saved)
    start_score_stream(stream, serving, out, rejects, new_folder(spark, "progress")).awaitTermination()
    scored = spark.read.parquet(out).select("request_id", "pos", "model_run_id", F.col("predicted_label").alias("outcome"))
    refused = spark.read.parquet(rejects).select("request_id", "pos", F.lit(None).cast("string").alias("model_run_id"), F.col("reason").alias("outcome"))
    return scored.unionAll(refused)
