"""Run log: `(run_id, status, tags, params, metrics, artifacts, configuration)` and its audits.

`tags` and `params` map strings to strings, `metrics` to doubles, `artifacts` lists paths and
`configuration` is the JSON text of `run/configuration.json`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textlab.operators.lookup import lookup_join
from textlab.session import stage

RUN_LOG = (
    "run_id string, status string, tags map<string,string>, params map<string,string>, "
    "metrics map<string,double>, artifacts array<string>, configuration string"
)

# What a run has to carry to be valid.
RUN_TYPES = ["protocol", "experiment", "final"]
CONFIGURATION_ARTIFACT = "run/configuration.json"
EXPERIMENT_TAGS = [
    "lab_run_type", "lab_protocol_run_id", "lab_experiment_id",
    "lab_stage", "lab_member_id", "lab_configuration_id", "notebook_arn",
]
EXPERIMENT_METRICS = [
    "macro_f1_fold_0", "macro_f1_fold_1", "macro_f1_fold_2",
    "macro_f1_mean", "macro_f1_std",
]
EXPERIMENT_ARTIFACTS = [CONFIGURATION_ARTIFACT, "provenance/sagemaker-resource-metadata.json"]
FINAL_TAGS = [
    "lab_run_type", "lab_protocol_run_id", "lab_selected_experiment_run_id",
    "lab_configuration_id", "lab_member_id", "notebook_arn",
]
FINAL_PARAMS = ["training_size"]
FINAL_METRICS = ["test_macro_f1"]
FINAL_ARTIFACTS = [*EXPERIMENT_ARTIFACTS, "reports/error_analysis.csv", "reports/error_analysis.md"]
UNCOUNTED_EXPERIMENTS = ["T0", "B0"]
MIN_CONFIGURATIONS = 3
MIN_STAGES = 2


def tag(name: str) -> Column:
    return F.try_element_at("tags", F.lit(name))


def param(name: str) -> Column:
    return F.try_element_at("params", F.lit(name))


def metric(name: str) -> Column:
    return F.try_element_at("metrics", F.lit(name))


def _has_all(have: Column, need: Sequence[str]) -> Column:
    """A list that is missing holds nothing."""
    listed = F.coalesce(have, F.array().cast("array<string>"))
    return F.size(F.array_except(F.array(*[F.lit(n) for n in need]), listed)) == 0


# --- writing --------------------------------------------------------------------------------------


def _literal_map(values: Mapping[str, object]) -> Column:
    pairs = [c for name, value in values.items() for c in (F.lit(name), F.lit(str(value)))]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def experiment_run(
    scores: DataFrame,
    run_id: str,
    tags: Mapping[str, str],
    configuration: Column,
    artifacts: Sequence[str],
    params: Mapping[str, object] | None = None,
    parent_mean: float | None = None,
) -> DataFrame:
    """One run row from fold scores `(fold, macro_f1)`: a metric per fold, mean and population deviation.

    For an ablation give the mean of the parent run: the delta is parent minus ablation.
    """
    def entry(name: Column, value: Column) -> Column:
        return F.struct(name.alias("key"), value.alias("value"))

    per_fold = entry(F.concat(F.lit("macro_f1_fold_"), F.col("fold").cast("string")), F.col("macro_f1"))
    mean = F.avg("macro_f1")
    totals = [
        entry(F.lit("macro_f1_mean"), mean),
        entry(F.lit("macro_f1_std"), F.stddev_pop("macro_f1")),
    ]
    if parent_mean is not None:
        totals.append(entry(F.lit("macro_f1_delta"), F.lit(float(parent_mean)) - mean))
    # One entry per fold, so the list is as short as the fold list.
    metrics = F.map_from_entries(F.concat(F.array_sort(F.collect_list(per_fold)), F.array(*totals)))
    row = scores.agg(metrics.alias("metrics"))
    return row.select(
        F.lit(run_id).alias("run_id"),
        F.lit("FINISHED").alias("status"),
        _literal_map({"lab_run_type": "experiment", **tags}).alias("tags"),
        _literal_map(params or {}).alias("params"),
        "metrics",
        F.array(*[F.lit(a) for a in artifacts]).alias("artifacts"),
        configuration.alias("configuration"),
    )


def final_run(
    score: DataFrame, run_id: str, tags: Mapping[str, str], configuration: Column, training_size: int
) -> DataFrame:
    """One run row from the single test score `(macro_f1)`."""
    return score.select(
        F.lit(run_id).alias("run_id"),
        F.lit("FINISHED").alias("status"),
        _literal_map({"lab_run_type": "final", **tags}).alias("tags"),
        _literal_map({"training_size": training_size}).alias("params"),
        F.create_map(F.lit("test_macro_f1"), F.col("macro_f1")).alias("metrics"),
        F.array(*[F.lit(a) for a in FINAL_ARTIFACTS]).alias("artifacts"),
        configuration.alias("configuration"),
    )


def protocol_run(protocol: DataFrame, run_id: str) -> DataFrame:
    """One run row whose params are the columns of the protocol row."""
    params = [c for name in protocol.columns for c in (F.lit(name), F.col(name).cast("string"))]
    return protocol.select(
        F.lit(run_id).alias("run_id"),
        F.lit("FINISHED").alias("status"),
        _literal_map({"lab_run_type": "protocol"}).alias("tags"),
        F.create_map(*params).alias("params"),
        F.create_map().cast("map<string,double>").alias("metrics"),
        F.array(F.lit("protocol/members.csv"), F.lit("protocol/partitions.csv")).alias("artifacts"),
        F.lit(None).cast("string").alias("configuration"),
    )


def append_run(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path)


# --- audits ---------------------------------------------------------------------------------------


def presented_runs(runs: DataFrame) -> DataFrame:
    return runs.filter(tag("lab_run_type").isin(RUN_TYPES))


def protocol_audit(runs: DataFrame) -> DataFrame:
    """Typed parameters of the protocol run; no row unless there is exactly one such run."""
    found = runs.filter(tag("lab_run_type") == "protocol").agg(
        F.count(F.lit(1)).alias("_n"), F.min_by(F.struct("run_id", "params"), "run_id").alias("_run")
    )
    only = found.filter("_n = 1").select("_run.run_id", "_run.params")

    def number(name: str) -> Column:
        return F.coalesce(param(name).cast("bigint"), F.lit(0).cast("bigint"))

    return only.select(
        F.col("run_id").alias("protocol_run_id"),
        param("dataset_id").alias("dataset_id"),
        param("dataset_revision").alias("dataset_revision"),
        param("sampling_strategy").alias("sampling_strategy"),
        number("sample_size").alias("sample_size"),
        number("random_seed").alias("random_seed"),
        param("cv_strategy").alias("cv_strategy"),
        number("cv_folds").alias("cv_folds"),
        F.coalesce(param("cv_shuffle").isin("True", "true"), F.lit(False)).alias("cv_shuffle"),
        F.lit("protocol/partitions.csv").alias("partitions_artifact"),
        F.lit("protocol/members.csv").alias("members_artifact"),
    )


def known_configuration() -> Column:
    """Configuration text of a run, null unless the artifact is listed and the text is JSON."""
    text = F.when(F.array_contains("artifacts", CONFIGURATION_ARTIFACT), F.col("configuration"))
    parsed = F.try_parse_json(text)
    return F.when(parsed.isNotNull() & ~F.is_variant_null(parsed), text)


def runs_audit(runs: DataFrame) -> DataFrame:
    """Presented runs in full; only experiments and final runs show a configuration.

    Rows are put in order first: the sort samples what is below it, and that should not parse JSON.
    """
    run_type = tag("lab_run_type")
    return (
        presented_runs(runs)
        .orderBy("run_id")
        .select(
            "run_id",
            "status",
            run_type.alias("run_type"),
            "params",
            "metrics",
            "tags",
            F.sort_array("artifacts").alias("artifacts"),
            F.when(run_type.isin("experiment", "final"), known_configuration()).alias("configuration"),
        )
    )


def valid_experiment_test() -> Column:
    """Finished, with all keys and artifacts an experiment needs. Keys count, not their values."""
    return (
        F.col("status").eqNullSafe("FINISHED")
        & _has_all(F.map_keys("tags"), EXPERIMENT_TAGS)
        & _has_all(F.map_keys("metrics"), EXPERIMENT_METRICS)
        & _has_all(F.col("artifacts"), EXPERIMENT_ARTIFACTS)
    )


def valid_final_test() -> Column:
    """Finished, with all keys and artifacts a final run needs. The run type itself is not tested."""
    return (
        F.col("status").eqNullSafe("FINISHED")
        & _has_all(F.map_keys("tags"), FINAL_TAGS)
        & _has_all(F.map_keys("params"), FINAL_PARAMS)
        & _has_all(F.map_keys("metrics"), FINAL_METRICS)
        & _has_all(F.col("artifacts"), FINAL_ARTIFACTS)
    )


def valid_experiment(runs: DataFrame) -> DataFrame:
    """Experiment runs with their validity."""
    return runs.filter(tag("lab_run_type") == "experiment").withColumn("valid", valid_experiment_test())


def valid_final(runs: DataFrame) -> DataFrame:
    """Final runs with their validity."""
    return runs.filter(tag("lab_run_type") == "final").withColumn("valid", valid_final_test())


def attribute_runs(runs: DataFrame, members: DataFrame) -> DataFrame:
    """Experiment runs with `valid`, their member and whether that member can be credited.

    `members` is `(member_id, notebook_arn)`, with `position` where an id comes twice: the last row
    counts. With members, the id must be listed with the same notebook; without any, it is enough
    that both tags are filled.
    """
    work = valid_experiment(runs).select(
        "run_id",
        "valid",
        tag("lab_member_id").alias("member_id"),
        tag("notebook_arn").alias("notebook_arn"),
        tag("lab_experiment_id").alias("experiment_id"),
        tag("lab_configuration_id").alias("configuration_id"),
        tag("lab_stage").alias("stage"),
    )
    position = "position" if "position" in members.columns else "notebook_arn"
    known = members.groupBy("member_id").agg(F.max_by("notebook_arn", position).alias("_arn"))
    rows = members.count()
    if rows == 0:
        filled = (F.coalesce("member_id", F.lit("")) != "") & (F.coalesce("notebook_arn", F.lit("")) != "")
        return work.withColumn("attributed", filled)
    matched = lookup_join(work, known, "member_id", ["run_id"], how="left", rows=rows)
    return matched.withColumn("attributed", F.coalesce(F.col("_arn") == F.col("notebook_arn"), F.lit(False))).drop("_arn")


def _credited(runs: DataFrame, members: DataFrame) -> DataFrame:
    rows = attribute_runs(runs, members).filter("valid AND attributed")
    return rows.withColumn("counted", ~F.coalesce(F.col("experiment_id").isin(UNCOUNTED_EXPERIMENTS), F.lit(False)))


def contribution_items(runs: DataFrame, members: DataFrame) -> DataFrame:
    """What each member contributed, one row per item: `(member_id, notebook_arn, list, value)`.

    The lists are `run_ids`, `counted_run_ids`, `configuration_ids` and `stages`. Rows instead of
    arrays, since one member may hold any share of the runs. Ids and stages that are empty do not count.
    """
    filled = lambda name: F.when(F.col("counted") & (F.coalesce(name, F.lit("")) != ""), F.col(name))
    items = F.array(
        F.struct(F.lit("run_ids").alias("list"), F.col("run_id").alias("value")),
        F.struct(F.lit("counted_run_ids").alias("list"), F.when(F.col("counted"), F.col("run_id")).alias("value")),
        F.struct(F.lit("configuration_ids").alias("list"), filled("configuration_id").alias("value")),
        F.struct(F.lit("stages").alias("list"), filled("stage").alias("value")),
    )
    return (
        _credited(runs, members)
        .select("member_id", "notebook_arn", F.inline(items))
        .filter("value IS NOT NULL")
        .distinct()
    )


def contributions(runs: DataFrame, members: DataFrame) -> DataFrame:
    """Sizes of the four lists per member; `valid_configurations` is the number of distinct ids."""
    items = contribution_items(runs, members)
    count = lambda name: F.count_if(F.col("list") == name)
    return (
        items.groupBy("member_id", "notebook_arn")
        .agg(
            count("run_ids").alias("runs"),
            count("counted_run_ids").alias("counted_runs"),
            count("configuration_ids").alias("valid_configurations"),
            count("stages").alias("stages"),
        )
        .orderBy("member_id", "notebook_arn")
    )


def rejected_runs(runs: DataFrame, members: DataFrame) -> DataFrame:
    """Experiment runs that nobody is credited for. Unattributed runs count as invalid too."""
    return (
        attribute_runs(runs, members)
        .filter("NOT (valid AND attributed)")
        .select("run_id", F.lit(True).alias("invalid"), F.col("valid").alias("unattributed"))
        .orderBy("run_id")
    )


def contribution_minimum(runs: DataFrame) -> DataFrame:
    """Whether each member reaches the minimum, by member id alone and without a validity test."""
    filled = lambda name: F.when(tag(name) != "", tag(name))
    work = runs.filter(
        (tag("lab_run_type") == "experiment")
        & tag("lab_member_id").isNotNull()
        & ~F.coalesce(tag("lab_experiment_id").isin(UNCOUNTED_EXPERIMENTS), F.lit(False))
    ).select(
        tag("lab_member_id").alias("member_id"),
        filled("lab_configuration_id").alias("configuration_id"),
        filled("lab_stage").alias("stage"),
    )
    counts = work.groupBy("member_id").agg(
        F.count_distinct(F.col("configuration_id")).alias("valid_configurations"),
        F.count_distinct(F.col("stage")).alias("stages"),
    )
    reached = (F.col("valid_configurations") >= MIN_CONFIGURATIONS) & (F.col("stages") >= MIN_STAGES)
    return counts.withColumn("meets_minimum", reached).orderBy("member_id")


def experiment_table(runs: DataFrame) -> DataFrame:
    """Flat table of the experiment runs."""
    names = ["lab_experiment_id", "lab_stage", "lab_member_id", "lab_configuration_id"]
    scores = ["macro_f1_mean", "macro_f1_std", "macro_f1_delta"]
    return (
        runs.filter(tag("lab_run_type") == "experiment")
        .select("run_id", *[tag(n).alias(n) for n in names], *[metric(s).alias(s) for s in scores])
        .orderBy("run_id")
    )


def ablation_delta(runs: DataFrame, strict: bool = False) -> DataFrame:
    """Parent mean minus ablation mean per ablation run: positive where the reverted decision helped.

    A parent without a mean gives the status `parent_without_mean`, with `strict` an error. The
    parents that are asked for are looked up once each, however many ablations they have.
    """
    ablations = runs.filter(tag("lab_ablation_parent_run_id").isNotNull()).select(
        "run_id",
        tag("lab_ablation_parent_run_id").alias("parent_run_id"),
        metric("macro_f1_mean").alias("ablation_mean"),
    )
    asked = ablations.select("parent_run_id").distinct()
    means = runs.select(F.col("run_id").alias("parent_run_id"), metric("macro_f1_mean").alias("parent_mean"))
    parents = stage(means.join(asked, "parent_run_id", "left_semi"), "parents")
    matched = lookup_join(ablations, parents, "parent_run_id", ["run_id"], how="left", row_bytes=64)
    missing = F.col("parent_mean").isNull()
    message = F.concat(F.lit("no macro_f1_mean for run "), F.col("parent_run_id"))
    flag = F.raise_error(message).cast("string") if strict else F.lit("parent_without_mean")
    return matched.select(
        "run_id",
        "parent_run_id",
        (F.col("parent_mean") - F.col("ablation_mean")).alias("macro_f1_delta"),
        F.when(missing, flag).otherwise("ok").alias("status"),
    )


def leaderboard(runs: DataFrame) -> DataFrame:
    """Best run per stage by cross-validated mean; ties go to the smaller run id.

    The best mean is a hash aggregate, so no stage is sorted; only the runs that reach it go on.
    """
    scored = runs.filter((tag("lab_run_type") == "experiment") & metric("macro_f1_mean").isNotNull()).select(
        tag("lab_stage").alias("stage"),
        "run_id",
        tag("lab_configuration_id").alias("configuration_id"),
        metric("macro_f1_mean").alias("macro_f1_mean"),
    )
    best = scored.groupBy("stage").agg(F.max("macro_f1_mean").alias("macro_f1_mean"))
    tied = scored.join(best, ["stage", "macro_f1_mean"], "left_semi")
    first = tied.groupBy("stage", "macro_f1_mean").agg(F.min(F.struct("run_id", "configuration_id")).alias("run"))
    return first.select("stage", "run.run_id", "run.configuration_id", "macro_f1_mean")


def champion(models: DataFrame, alias: str = "champion") -> DataFrame:
    """`(name, version, run_id)` that the alias points at: the newest version that carries it."""
    carrying = models.filter(F.col("alias") == alias).select("name", "version", "run_id")
    newest = carrying.groupBy("name").agg(F.max("version").alias("version"))
    return carrying.join(newest, ["name", "version"], "left_semi")


def next_version(models: DataFrame, name: str, run_id: str, alias: str = "champion") -> DataFrame:
    """Row to append for a new version of a model; the alias moves to it."""
    known = models.filter(F.col("name") == name).agg(F.coalesce(F.max("version"), F.lit(0)).alias("_last"))
    return known.select(
        F.lit(name).alias("name"),
        (F.col("_last") + 1).cast("int").alias("version"),
        F.lit(run_id).alias("run_id"),
        F.lit(alias).alias("alias"),
    )


def champion_audit(wanted: DataFrame, models: DataFrame, runs: DataFrame) -> DataFrame:
    """State of the champion of each wanted model name: `ok`, `champion_not_found` or `champion_invalid`."""
    found = wanted.select("name").join(champion(models), "name", "left")
    facts = runs.select(
        "run_id",
        (valid_final_test() & known_configuration().isNotNull()).alias("_valid"),
        tag("lab_protocol_run_id").alias("protocol_run_id"),
        tag("lab_selected_experiment_run_id").alias("selected_experiment_run_id"),
        tag("lab_configuration_id").alias("configuration_id"),
        known_configuration().alias("configuration"),
        F.coalesce(param("training_size").cast("bigint"), F.lit(0).cast("bigint")).alias("training_size"),
        F.coalesce(metric("test_macro_f1"), F.lit(0.0)).alias("test_macro_f1"),
    )
    joined = found.join(facts, "run_id", "left")
    status = (
        F.when(F.col("version").isNull(), "champion_not_found")
        .when(F.coalesce("_valid", F.lit(False)), "ok")
        .otherwise("champion_invalid")
    )
    shown = [
        "protocol_run_id", "selected_experiment_run_id", "configuration_id",
        "configuration", "training_size", "test_macro_f1",
    ]
    return joined.withColumn("status", status).select(
        "name", "status", "version", "run_id", *[F.when(F.col("status") == "ok", F.col(c)).alias(c) for c in shown]
    )
