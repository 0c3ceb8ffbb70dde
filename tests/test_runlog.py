"""Configurations and run-log audits on small logs."""

import copy
import json

import pytest
from pyspark.sql import functions as F

from textlab.operators import runlog as R
from textlab.plans import configurations as C

VERSION = "1.5.0"


def table(spark, *configurations):
    rows = [json.dumps(c) for c in configurations]
    frame = spark.createDataFrame(list(enumerate(rows)), "key int, text string")
    return frame.select("key", F.from_json("text", C.CONFIGURATION).alias("c")).select("key", "c.*")


def test_baseline_and_reference_shapes():
    base = C.baseline_configuration(VERSION)
    assert base["preprocessing"] == {
        "lowercase": True, "url": "token:url", "mention": "token:user", "whitespace": "normalize", "stopwords": "keep",
        "negators": [], "lemmatize": False, "elongation": "keep", "elongation_spec": None, "emoji": "keep",
        "emoji_spec": None, "resources": {}, "additional": {},
    }
    assert base["representation"] == {
        "type": "bow", "ngram_range": [1, 1], "library": "scikit-learn", "library_version": VERSION,
        "spacy_model": None, "spacy_model_version": None, "parameters": {},
    }
    assert base["classifier"] == {"type": "logistic_regression", "library": "scikit-learn", "library_version": VERSION, "parameters": {}}
    assert C.reference_configuration("lib", "2") == {
        "preprocessing": None, "representation": None,
        "classifier": {"type": "most_frequent", "library": "lib", "library_version": "2", "parameters": {}},
    }


def changed():
    found = C.named_configuration("R_TFIDF_UNI_BI", VERSION)
    found["preprocessing"].update(
        stopwords="remove_preserve_negation", negators=["no"], lemmatize=True, elongation="normalize",
        elongation_spec="x", emoji="text", emoji_spec="y",
    )
    found["classifier"] = C.classifier_part("linear_svm", "scikit-learn", VERSION)
    return found


@pytest.mark.parametrize(
    "decision, fields",
    [
        ("preprocessing.stopwords", {"stopwords": "keep", "negators": []}),
        ("preprocessing.lemmatize", {"lemmatize": False}),
        ("preprocessing.elongation", {"elongation": "keep", "elongation_spec": None}),
        ("preprocessing.emoji", {"emoji": "keep", "emoji_spec": None}),
        ("representation", None),
        ("classifier", None),
    ],
)
def test_revert(spark, decision, fields):
    want = copy.deepcopy(changed())
    if fields is None:
        want[decision] = C.baseline_configuration(VERSION)[decision]
    else:
        want["preprocessing"].update(fields)
    got = C.revert_decision(table(spark, changed()), decision, VERSION).first().asDict(recursive=True)
    assert {part: got[part] for part in want} == want


def test_revert_unknown_decision(spark):
    with pytest.raises(ValueError):
        C.revert_decision(table(spark, changed()), "no_such", VERSION)


def test_rules(spark):
    bad = copy.deepcopy(changed())
    bad["preprocessing"].update(negators=[], elongation_spec=None, emoji="keep")
    bad["representation"].update(type="spacy_embedding")
    bad["classifier"]["type"] = "forest"
    rows = C.validate_configs(table(spark, changed(), C.reference_configuration("l", "1"), bad)).orderBy("key").collect()
    assert rows[0]["violations"] == [] and rows[1]["violations"] == []
    assert rows[2]["violations"] == [
        "negators_missing", "elongation_spec_missing", "emoji_spec_not_allowed", "vector_method_missing",
        "vector_model_missing", "classifier_unknown",
    ]


def test_rules_hold_for_nulls(spark):
    unset, absent = copy.deepcopy(changed()), copy.deepcopy(changed())
    unset["preprocessing"].update(stopwords=None, negators=["not"])
    unset["representation"]["type"] = unset["classifier"]["type"] = None
    absent["representation"] = absent["classifier"] = None
    rows = C.validate_configs(table(spark, unset, absent)).orderBy("key").collect()
    assert rows[0]["violations"] == ["negators_not_allowed", "representation_unknown", "classifier_unknown"]
    assert rows[1]["violations"] == ["classifier_unknown"]


def test_a_json_null_is_no_configuration(spark):
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(["null", "\nnull\n", "{", '{"a": null}', None])], "i int, configuration string")
    rows = texts.withColumn("artifacts", F.array(F.lit(R.CONFIGURATION_ARTIFACT)))
    assert [r["i"] for r in rows.filter(R.known_configuration().isNotNull()).collect()] == [3]


def test_named_configurations_are_valid(spark):
    grid = C.comparison_grid(table(spark, changed()), VERSION)
    assert grid.count() == 12
    assert C.validate_configs(grid).filter("size(violations) > 0").count() == 0
    rows = {r["tag"]: r for r in grid.collect()}
    assert rows["P_LEMMA"]["preprocessing"]["lemmatize"] and rows["P_LEMMA"]["preprocessing"]["stopwords"] == "keep"
    assert rows["C_SGD"]["representation"]["ngram_range"] == [1, 2] and rows["C_SGD"]["classifier"]["type"] == "sgd"
    extra = C.named_configuration("EXTRA", VERSION, classifier=C.classifier_part("sgd", "l", "1", {"alpha": 0.001}))
    assert extra["classifier"]["parameters"] == {"alpha": 0.001}
    with pytest.raises(ValueError):
        C.named_configuration("X", VERSION)


def test_ablation_plan(spark):
    rows = C.ablation_plan(table(spark, C.baseline_configuration("9"), C.named_configuration("C_SGD", "1"), changed())).orderBy("key").collect()
    assert [r["required"] for r in rows] == [0, 1, 2]
    assert rows[2]["decisions"] == list(C.DECISIONS)


def test_conflicts_ignore_key_order_but_not_list_order(spark):
    one = C.baseline_configuration("1")
    one["classifier"]["parameters"] = {"a": "1", "b": "2"}
    swapped = copy.deepcopy(one)
    swapped["classifier"]["parameters"] = {"b": "2", "a": "1"}
    listed = copy.deepcopy(one)
    listed["representation"]["ngram_range"] = [2, 1]
    texts = [("A", json.dumps(one)), ("B", json.dumps(swapped)), ("B", json.dumps(listed)), ("C", "{bad"), ("", json.dumps(one))]
    runs = spark.createDataFrame(texts, "id string, configuration string").withColumn(
        "tags", F.create_map(F.lit("lab_configuration_id"), F.col("id"))
    )
    got = {(r["kind"], r["n"]) for r in C.config_conflicts(runs).collect()}
    assert got == {("configuration_with_ids", 2), ("id_with_configurations", 2)}


TAGS = {name: "x" for name in R.EXPERIMENT_TAGS} | {"lab_run_type": "experiment", "notebook_arn": "arn1"}
METRICS = {name: 0.5 for name in R.EXPERIMENT_METRICS}


def run(run_id, status="FINISHED", tags=None, params=None, metrics=None, artifacts=None, configuration="{}"):
    return (run_id, status, TAGS | (tags or {}), params or {}, METRICS if metrics is None else metrics,
            R.EXPERIMENT_ARTIFACTS if artifacts is None else artifacts, configuration)


def without(mapping, *names):
    return {k: v for k, v in mapping.items() if k not in names}


def log(spark, *rows):
    return spark.createDataFrame(list(rows), R.RUN_LOG)


@pytest.fixture(scope="module")
def runs(spark):
    return log(
        spark,
        run("a", tags={"lab_member_id": "m1", "lab_experiment_id": "T0"}),
        run("b", tags={"lab_member_id": "m1", "lab_configuration_id": "", "lab_stage": "s"}),
        run("c", tags={"lab_member_id": "m1", "notebook_arn": "other"}),
        run("d", status="FAILED", tags={"lab_member_id": "m1"}),
        run("e", metrics=without(METRICS, "macro_f1_std")),
        run("f", artifacts=[]),
        run("g", tags={"lab_run_type": "scratch"}),
    )


def test_validity_tests_keys_only(spark, runs):
    got = {r["run_id"]: r["valid"] for r in R.valid_experiment(runs).collect()}
    assert got == {"a": True, "b": True, "c": True, "d": False, "e": False, "f": False}


def test_contributions_and_rejects(spark, runs):
    members = spark.createDataFrame([("m1", "old", 0), ("m1", "arn1", 1)], "member_id string, notebook_arn string, position int")
    row = R.contributions(runs, members).first()
    assert (row["runs"], row["counted_runs"], row["valid_configurations"], row["stages"]) == (2, 1, 0, 1)
    rejected = {r["run_id"]: r["unattributed"] for r in R.rejected_runs(runs, members).collect()}
    assert rejected == {"c": True, "d": False, "e": False, "f": False}
    nobody = members.filter("member_id = 'none'")
    credited = R.contribution_items(runs, nobody).filter("list = 'run_ids'").select("value").collect()
    assert {r["value"] for r in credited} == {"a", "b", "c"}


def test_protocol_must_be_unique(spark):
    params = {"dataset_id": "d", "sample_size": "10", "cv_shuffle": "True"}
    one = log(spark, run("p", tags={"lab_run_type": "protocol"}, params=params))
    row = R.protocol_audit(one).first()
    assert (row["sample_size"], row["random_seed"], row["cv_shuffle"], row["dataset_revision"]) == (10, 0, True, None)
    assert R.protocol_audit(one.unionAll(one)).count() == 0
    assert R.protocol_audit(one.filter("false")).count() == 0


def test_runs_audit_shows_only_good_configurations(spark):
    rows = R.runs_audit(log(
        spark, run("a"), run("b", configuration="{bad"), run("c", artifacts=[]), run("d", configuration=None),
        run("e", tags={"lab_run_type": "protocol"}),
    )).collect()
    assert [(r["run_id"], r["configuration"]) for r in rows] == [("a", "{}"), ("b", None), ("c", None), ("d", None), ("e", None)]


def test_ablation_delta(spark):
    rows = log(
        spark, run("p", metrics={"macro_f1_mean": 0.8}), run("q", metrics={}),
        run("a", tags={"lab_ablation_parent_run_id": "p"}, metrics={"macro_f1_mean": 0.7}),
        run("b", tags={"lab_ablation_parent_run_id": "q"}),
    )
    got = {r["run_id"]: (r["status"], r["macro_f1_delta"]) for r in R.ablation_delta(rows).collect()}
    assert got["a"] == ("ok", pytest.approx(0.1)) and got["b"] == ("parent_without_mean", None)
    with pytest.raises(Exception, match="no macro_f1_mean"):
        R.ablation_delta(rows, strict=True).collect()


def test_champion(spark):
    final = {name: "x" for name in R.FINAL_TAGS}
    good = ("f1", "FINISHED", final, {"training_size": "7"}, {"test_macro_f1": 0.9}, R.FINAL_ARTIFACTS, "{}")
    bad = ("f2", "FINISHED", final, {}, {"test_macro_f1": 0.9}, R.FINAL_ARTIFACTS, "{}")
    runs = log(spark, good, bad)
    models = spark.createDataFrame(
        [("m", 1, "f2", "champion"), ("m", 2, "f1", "champion"), ("n", 1, "f2", "champion"), ("o", 1, "f1", None)],
        "name string, version int, run_id string, alias string",
    )
    wanted = spark.createDataFrame([("m",), ("n",), ("o",)], "name string")
    got = {r["name"]: (r["status"], r["version"], r["training_size"]) for r in R.champion_audit(wanted, models, runs).collect()}
    assert got == {"m": ("ok", 2, 7), "n": ("champion_invalid", 1, None), "o": ("champion_not_found", None, None)}
    assert tuple(R.next_version(models, "m", "f9").first()) == ("m", 3, "f9", "champion")
    assert R.next_version(models, "new", "f9").first()["version"] == 1


def test_minimum_and_leaderboard(spark):
    rows = [run(f"r{i}", tags={"lab_member_id": "m", "lab_configuration_id": f"c{i}", "lab_stage": f"s{i % 2}"}, metrics={"macro_f1_mean": 0.5}) for i in range(3)]
    runs = log(spark, *rows, run("t", tags={"lab_experiment_id": "T0", "lab_member_id": "only"}))
    minimum = R.contribution_minimum(runs).collect()
    assert [(r["member_id"], r["meets_minimum"]) for r in minimum] == [("m", True)]
    best = {r["stage"]: r["run_id"] for r in R.leaderboard(runs).collect()}
    assert best["s0"] == "r0" and best["s1"] == "r1"


def test_runs_without_status_or_artifacts_are_invalid_not_null(spark):
    runs = spark.createDataFrame(
        [("a", None, {"lab_run_type": "experiment"}, None, None, ["x"]), ("b", "FINISHED", {"lab_run_type": "experiment"}, {}, None, None)],
        "run_id string, status string, tags map<string,string>, params map<string,string>, metrics map<string,double>, artifacts array<string>",
    )
    assert [r["valid"] for r in R.valid_experiment(runs).collect()] == [False, False]
