"""Whole experiments: cross-validated comparison, ablation and final model."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from textlab.operators.errors import category_counts, error_report
from textlab.operators.evaluation import macro_f1_per_fold, t0_scores
from textlab.operators.learners import Resources, TextModel, cross_validate, load_model, train_model
from textlab.operators.runlog import (
    EXPERIMENT_ARTIFACTS, champion, experiment_run, final_run, known_configuration, metric,
)
from textlab.plans.configurations import CONFIGURATION, canonical_json, revert_decision
from textlab.session import stage


def configuration_json(configuration: Mapping):
    """Canonical JSON of a configuration as a constant column."""
    return canonical_json(F.from_json(F.lit(json.dumps(configuration)), CONFIGURATION))


def run_configuration(docs: DataFrame, configuration: Mapping, resources: Resources = Resources()) -> DataFrame:
    """`(fold, macro_f1)` of a configuration on texts `(index, fold, label, text)`."""
    if configuration["classifier"]["type"] == "most_frequent":
        return t0_scores(docs)
    return macro_f1_per_fold(cross_validate(docs, configuration, resources))


def experiment(
    docs: DataFrame,
    configuration: Mapping,
    run_id: str,
    tags: Mapping[str, str],
    resources: Resources = Resources(),
    parent_mean: float | None = None,
    reverted: str | None = None,
) -> DataFrame:
    """Evaluate a configuration and return its run row; `parent_mean` and `reverted` make it an ablation."""
    scores = run_configuration(docs, configuration, resources)
    params = {"ablation_reverted_decision": reverted} if reverted else {}
    return experiment_run(
        scores, run_id, tags, configuration_json(configuration), EXPERIMENT_ARTIFACTS, params, parent_mean
    )


def stored_configuration(runs: DataFrame, run_id: str) -> dict:
    """Configuration of one run of the log; one row comes to the driver."""
    found = runs.filter(F.col("run_id") == run_id).select(known_configuration().alias("text")).first()
    if found is None or found["text"] is None:
        raise ValueError(f"no configuration for run {run_id}")
    return json.loads(found["text"])


def ablation(
    docs: DataFrame,
    runs: DataFrame,
    parent_run_id: str,
    decision: str,
    run_id: str,
    tags: Mapping[str, str],
    version: str,
    resources: Resources = Resources(),
) -> DataFrame:
    """Evaluate a logged run's configuration with one decision reverted; returns the run row."""
    parent = runs.filter(F.col("run_id") == parent_run_id).select(metric("macro_f1_mean").alias("mean")).first()
    if parent is None or parent["mean"] is None:
        raise ValueError(f"no macro_f1_mean for run {parent_run_id}")
    stored = F.from_json(F.lit(json.dumps(stored_configuration(runs, parent_run_id))), CONFIGURATION)
    parts = docs.sparkSession.range(1).select(stored.alias("c")).select("c.*")
    text = canonical_json(F.struct("preprocessing", "representation", "classifier")).alias("text")
    reverted = json.loads(revert_decision(parts, decision, version).select(text).first()["text"])
    own = {"lab_experiment_id": "ABLATION", "lab_stage": "ablation", "lab_ablation_parent_run_id": parent_run_id}
    return experiment(docs, reverted, run_id, {**tags, **own}, resources, parent["mean"], decision)


def champion_model(models: DataFrame, name: str, folder: str) -> tuple[TextModel, str] | None:
    """The champion's model and run id; models are saved below `folder` by run id. None without a champion."""
    found = champion(models.filter(F.col("name") == name)).first()
    if found is None:
        return None
    return load_model(models.sparkSession, f"{folder}/{found['run_id']}"), found["run_id"]


@dataclass(frozen=True)
class FinalModel:
    model: TextModel
    predictions: DataFrame
    score: DataFrame
    report: DataFrame
    categories: DataFrame
    run: DataFrame


def train_final(
    train: DataFrame,
    test: DataFrame,
    configuration: Mapping,
    run_id: str,
    tags: Mapping[str, str],
    resources: Resources = Resources(),
) -> FinalModel:
    """Fit on all of train `(index, label, text)`, score all of test once, report the errors on the raw texts.

    The predictions are staged: the score and the report read them, the model does not run again.
    """
    model = train_model(train, configuration, resources)
    predictions = stage(model.predict(test.select("index", "label", "text")), "predictions")
    score = macro_f1_per_fold(predictions.withColumn("fold", F.lit(0))).select("macro_f1")
    report = error_report(predictions)
    run = final_run(score, run_id, tags, configuration_json(configuration), train.count())
    return FinalModel(model, predictions, score, report, category_counts(report), run)
