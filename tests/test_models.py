"""Features, learners, experiments, requests and the stream."""

import math
import os
import tracemalloc
import types
from collections import Counter
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.sql import functions as F

from textlab.operators import certificates as CE, features as FE, learners as L, linear_solver as S, lookup as LO, runlog as R, scoring
from textlab.operators.evaluation import macro_f1_per_fold
from textlab.plans import configurations as C, experiment as E
from textlab.session import discard, new_folder, stage
from textlab.streaming.scoring import REQUESTS, score_stream

GOOD, BAD = "good fine nice lovely".split(), "bad awful poor sad".split()


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(90):
        label = i % 2
        own, other = (GOOD, BAD) if label else (BAD, GOOD)
        words = [*rng.choice(own, 4), rng.choice(other), f"w{i % 9}"]
        rows.append((i, i // 2 % 3, label, " ".join(words)))
    rows.append((90, 0, 1, "!"))
    return spark.createDataFrame(rows, "index bigint, fold int, label int, text string").cache()


def counted(docs):
    return FE.term_counts(docs, text="text", carry=["fold"])


def by_hand(texts, fit_texts):
    """Smoothed, length-normalised TF-IDF in plain Python."""
    df = Counter(t for text in fit_texts for t in set(text.split()))
    n, out = len(fit_texts), {}
    for i, text in texts.items():
        w = {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in Counter(text.split()).items() if t in df and len(t) > 1}
        length = math.sqrt(sum(x * x for x in w.values()))
        out.update({(i, t): x / length for t, x in w.items()})
    return out


def test_tfidf(spark, docs):
    texts = {r["index"]: r["text"] for r in docs.collect()}
    counts = counted(docs)
    got = {(r["index"], r["term"]): r["value"] for r in FE.tfidf(counts, FE.fit_terms(docs, counts)).collect()}
    assert got == pytest.approx(by_hand(texts, list(texts.values())))


def test_tfidf_per_fold(spark, docs):
    rows = docs.collect()
    counts = counted(docs)
    terms = FE.fit_terms(docs, counts, [0, 1, 2])
    found = FE.tfidf_per_fold(counts, terms, [0, 1, 2]).collect()
    for k in range(3):
        want = by_hand({r["index"]: r["text"] for r in rows}, [r["text"] for r in rows if r["fold"] != k])
        assert {(r["index"], r["term"]): r["value"] for r in found if r["split"] == k} == pytest.approx(want)
    only = FE.tfidf_per_fold(counts, terms, [0, 1, 2], role="validation").collect()
    assert {tuple(r) for r in only} == {tuple(r) for r in found if r["split"] == r["fold"]}


def test_terms_of_a_task_do_not_grow_with_the_input(spark, docs, monkeypatch):
    """More texts give more tasks for them and for their sorted terms; AQE does not put them together again."""
    monkeypatch.setattr(FE, "TASK_TEXT", 2000)
    monkeypatch.setattr(FE, "TASK_ROWS", 20)
    for texts in (40, 400):
        rows = spark.range(texts).selectExpr("id AS index", "repeat('words ', 100) AS text")
        placed = FE.placed_by(rows, tasks=FE.tasks_for(rows))
        sizes = [r["n"] for r in placed.groupBy(F.spark_partition_id()).agg(F.sum(F.length("text")).alias("n")).collect()]
        assert sum(sizes) == texts * 600 and max(sizes) <= 8 * 2000
    assert FE.tasks_for(spark.createDataFrame([(None,)], "text string")) == spark.sparkContext.defaultParallelism
    counts = counted(docs)
    terms = FE.fit_terms(docs, counts, [0, 1, 2])
    want = {tuple(r) for r in FE.tfidf_per_fold(counts, terms, [0, 1, 2]).collect()}
    for limit in (LO.BROADCAST_BYTES, 0):
        monkeypatch.setattr(LO, "BROADCAST_BYTES", limit)
        found = FE.tfidf_per_fold(counts, terms, [0, 1, 2])
        assert found.rdd.getNumPartitions() >= counts.count() / 20
        got = {tuple(r)[:-1]: r["value"] for r in found.collect()}
        assert got == pytest.approx({r[:-1]: r[-1] for r in want})


def test_tfidf_beyond_the_broadcast_limit_sorts_no_terms(spark, docs, monkeypatch):
    """Terms meet the counts in tasks that hold a bounded part of the table: hashed, as many as the terms need."""
    counts = FE.term_counts(docs, text="text", ngram_range=(1, 2))
    terms = FE.fit_terms(docs, FE.text_terms(docs, "text", (1, 2)))
    want = {(r["index"], r["term"]): r["value"] for r in FE.tfidf(counts, terms).collect()}
    monkeypatch.setattr(LO, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(FE, "TASK_ROWS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = FE.tfidf(counts, terms)
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = {(r["index"], r["term"]): r["value"] for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and f", {-(-terms.rows // 10)})" in plan
    assert got == pytest.approx(want)


def test_vocabulary_and_counts(spark, docs):
    vocabulary = {r["term"]: r["term_index"] for r in FE.fit_vocabulary(FE.distinct_terms(docs, "text")).collect()}
    assert [t for t, _ in sorted(vocabulary.items(), key=lambda kv: kv[1])] == sorted({*GOOD, *BAD, *[f"w{i}" for i in range(9)]})
    known = spark.createDataFrame([("good", 0)], "term string, term_index int")
    assert {r["term"] for r in FE.bow(counted(docs), known).collect()} == {"good"}


def test_mean_token_vectors(spark):
    rows = spark.createDataFrame([(1, ["a", "a", "b", "x"]), (2, ["x"]), (3, [])], "index bigint, tokens array<string>")
    vectors = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [4.0, -1.0])], "token string, vec array<float>")
    got = {r["index"]: r["vec"] for r in FE.mean_token_vectors(rows, vectors, 2).collect()}
    assert got == {1: pytest.approx([2.0, 1.0]), 2: [0.0, 0.0], 3: [0.0, 0.0]}


@pytest.mark.parametrize("limit", [0, 2 * 80, 1 << 20])
def test_vectors_of_frequent_tokens_are_broadcast_and_no_row_with_a_vector_is_sorted(spark, monkeypatch, limit):
    monkeypatch.setattr(LO, "BROADCAST_BYTES", min(limit, 100))
    monkeypatch.setattr(FE, "BROADCAST_BYTES", limit)
    texts = [(i, ["a"] * (1 + i % 3) + ["b"] * (i % 2) + [f"r{i}", "x"]) for i in range(40)]
    rows = spark.createDataFrame(texts, "index bigint, tokens array<string>")
    table = {"a": [1.0, 2.0], "b": [4.0, -1.0]} | {f"r{i}": [float(i), 0.5] for i in range(0, 40, 2)}
    found = FE.mean_token_vectors(rows, spark.createDataFrame(list(table.items()), "token string, vec array<double>"), 2)
    assert "ObjectHashAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    for row in found.collect():
        known = np.array([table[t] for t in texts[row["index"]][1] if t in table])
        assert row["vec"] == pytest.approx(known.mean(axis=0).tolist())


def configuration(representation="R_BOW", classifier="C_LOGREG"):
    rep = C.named_configuration(representation, "1")["representation"]
    return C.named_configuration(classifier, "1", representation=rep)


def test_logistic_regression_reaches_the_optimum(spark, docs):
    """Gradient of sum of losses + |w|^2 / 2 is zero at the fitted weights."""
    training = L.TermTraining(docs.withColumn("clean", F.col("text")), {"type": "bow", "ngram_range": [1, 1]}, [])
    rows = training.features(None).collect()
    tight = {"type": "logistic_regression", "parameters": {"tol": 1e-9, "max_iter": 500}}
    found = L.fit_classifier(training.features(None).select("label", "features"), tight)
    x = np.array([r["features"].toArray() for r in rows])
    y = np.array([r["label"] for r in rows])
    p = 1 / (1 + np.exp(-(x @ np.array(found.weights) + found.intercept)))
    assert len(rows) == 91 and not x[y == 1].sum(axis=1).all()
    assert np.abs(x.T @ (p - y) + np.array(found.weights)).max() < 1e-3
    assert abs((p - y).sum()) < 1e-3


@pytest.fixture(scope="module")
def training(docs):
    return L.TermTraining(docs.withColumn("clean", F.col("text")), {"type": "bow", "ngram_range": [1, 1]}, [0, 1, 2])


@pytest.fixture(scope="module")
def unit_training(docs):
    return L.TermTraining(docs.withColumn("clean", F.col("text")), {"type": "tfidf", "ngram_range": [1, 1]}, [0, 1, 2])


def in_shards(training, count):
    """The same data in several shards, so that every pass is a job over all of them."""
    before, S.SHARD_BYTES = S.SHARD_BYTES, -(-training.counts.count() * 12 // count)
    try:
        columns = [f"v_{k}" for k in training.folds] if training.unit else ["v"]
        return S.shards_of(training.docs.sparkSession.read.parquet(training.path), columns, training.size, training.folds, training.counts.count())
    finally:
        S.SHARD_BYTES = before


def dense(training, split):
    rows = [r for r in training.features(split).collect()]
    return np.array([r["features"].toArray() for r in rows]), np.array([2 * r["label"] - 1 for r in rows])


@pytest.mark.parametrize("kind", ["logistic_regression", "linear_svm"])
def test_all_folds_at_once_equal_single_fits(training, unit_training, kind):
    tight = {"type": kind, "parameters": {"tol": 1e-9, "max_iter": 200}}
    for data in (training, unit_training):
        whole, spread = L.fit_folds(data.shards, tight), L.fit_folds(in_shards(data, 3), tight)
        assert data.shards.count == 1 and whole.weights == pytest.approx(spread.weights, abs=1e-6)
        for i, fold in enumerate(data.folds):
            assert L.fit_folds(data.shards.only(fold), tight).weights[0] == pytest.approx(whole.weights[i], abs=1e-6)
            x, y = dense(data, fold)
            w, b = whole.weights[i, :-1], whole.weights[i, -1]
            z = y * (x @ w + b)
            slope = y * (-1 / (1 + np.exp(z)) if kind == "logistic_regression" else -2 * np.maximum(0, 1 - z))
            assert np.abs(x.T @ slope + w).max() < 1e-5
            assert abs(slope.sum() + (b if kind == "linear_svm" else 0)) < 1e-5


def test_passes_leave_no_shuffle_files_and_send_weights_once(spark, training, monkeypatch):
    monkeypatch.setattr(S, "_FEW_TASKS", 1)
    shards = in_shards(training, 3)
    weights = np.full((3, shards.size + 1), 0.1)
    want = S.summed([S.Block(r) for r in shards.table.toArrow().to_pylist()], shards.problem, "logistic", weights, weights)
    data = S.OverShards(replace(shards, tasks=3), "logistic")
    folder = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in map(str, folder.getAllFiles().mkString("\n").split("\n")) if "shuffle_" in f}
    before = files()
    assert data.sums(weights, weights) == pytest.approx(want)
    held = data.held
    assert data.sums(weights, weights) == pytest.approx(want) and data.held is held
    assert not files() - before
    data.close()
    assert spark.conf.get(S._CLEANUP) == "false" and data.held is None


def test_a_task_holds_sums_for_the_slots_of_one_shard(training):
    shards = replace(in_shards(training, 3), size=3_000_000)
    batches, peaks = shards.table.toArrow().to_batches(), []

    class Here:
        """The staged table, its passes in this process."""

        sparkSession, coalesce, persist, unpersist = shards.table.sparkSession, lambda self, _: self, lambda self: self, lambda self: None

        def mapInArrow(self, apply, schema):
            tracemalloc.start()
            found = [b for b in apply(iter(batches))]
            peaks.append(tracemalloc.get_traced_memory()[1])
            tracemalloc.stop()
            return types.SimpleNamespace(toArrow=lambda: pa.Table.from_batches(found))

    random = np.random.default_rng(5)
    weights, along = random.normal(size=(3, shards.size + 1)), random.normal(size=(3, shards.size + 1))
    blocks = [S.Block(r) for r in shards.table.toArrow().to_pylist()]
    data = S.OverShards(replace(shards, table=Here()), "logistic")
    try:
        assert np.allclose(data.sums(weights, None), S.summed(blocks, shards.problem, "logistic", weights, None))
        assert np.allclose(data.sums(weights, along), S.summed(blocks, shards.problem, "logistic", weights, along))
        assert np.allclose(data.losses(weights, along), S.summed_along(blocks, shards.problem, "logistic", weights, along))
        course = S.Course(0, 1000.0, 1e-2, 42, True, (20, 20, 20), 3)
        assert np.allclose(data.epoch(weights, along, course), S.epoch_sums(blocks, shards.problem, weights, along, course))
        rows = {block.shard: block.n for block in blocks}
        climb = S.Climb(0, 1.0, True, 42, (True, True, True), {shard: sum(n for s, n in rows.items() if s < shard) for shard in rows})
        duals = np.zeros((3, sum(rows.values())))
        assert np.allclose(data.round(weights, duals, climb), S.round_sums(blocks, shards.problem, weights, duals, climb))
    finally:
        data.close()
    assert len(peaks) == 5 and max(peaks) < weights.nbytes + 8 * shards.size  # the weights that a pass reads, and less than one sum


def test_packing_holds_one_shard(training):
    asked = []

    def batches():
        rows = training.docs.sparkSession.read.parquet(training.path).select("index", "fold", "label", "v").toArrow().combine_chunks()
        for shard in range(4):
            asked.append(shard)
            yield rows.append_column("shard", pa.array([shard] * len(rows), pa.int32())).combine_chunks().to_batches()[0]

    found = S._packed(["v"])(batches())
    seen = []
    for batch in found:
        block = S.Block(batch.to_pylist()[0])
        seen.append((block.shard, block.n, len(asked)))
    assert seen == [(shard, training.docs.count(), min(shard + 2, 4)) for shard in range(4)]


def test_long_shards_are_multiplied_in_parts(training, monkeypatch):
    rows = in_shards(training, 1).table.toArrow().to_pylist()
    block, weights = S.Block(rows[0]), np.random.default_rng(6).normal(size=training.size)
    by_row = np.random.default_rng(7).normal(size=block.n)
    want = block.dot(0, weights), block.transposed(0, by_row, training.size, squared=True)
    monkeypatch.setattr(S, "_ENTRIES", 3)
    assert np.array_equal(block.dot(0, weights), want[0]) and block.transposed(0, by_row, training.size, squared=True) == pytest.approx(want[1])


def test_stochastic_descent_is_near_the_optimum_wherever_the_rows_are(spark, training, unit_training):
    for data in (training, unit_training):
        found = L.fit_folds(data.shards, {"type": "sgd", "parameters": {"tol": 1e-5, "alpha": 0.05}})
        x, y = dense(data, 0)
        of = lambda w, b: np.maximum(0, 1 - y * (x @ w + b)).mean() + 0.025 * (w**2).sum()  # noqa: B023, E731
        exact = LinearSVC(regParam=0.05, standardization=False, maxIter=100, tol=1e-8).fit(data.features(0).select("label", "features").coalesce(1).cache())
        best = of(exact.coefficients.toArray(), exact.intercept)
        assert found.objective[0] == pytest.approx(of(found.weights[0, :-1], found.weights[0, -1])) and found.objective[0] < 1.01 * best
    several = in_shards(training, 3)
    moved = replace(several, table=several.table.repartition(2), tasks=1)
    short = {"type": "sgd", "parameters": {"max_iter": 4}}
    assert several.count == 3 and L.fit_folds(several, short).weights == pytest.approx(L.fit_folds(moved, short).weights, rel=1e-12)


def test_an_epoch_of_descent_is_one_pass(training, monkeypatch):
    passes = []
    run = S.OverShards._run
    monkeypatch.setattr(S.OverShards, "_run", lambda self, *args: passes.append(1) or run(self, *args))
    L.fit_folds(in_shards(training, 3), {"type": "sgd", "parameters": {"max_iter": 6}})
    assert len(passes) == 8  # the loss at zero, six epochs, the loss of the last mean


def test_linear_svm_with_rows_of_very_different_length_needs_few_passes():
    random = np.random.default_rng(3)
    n, size = 300, 2000
    lengths = random.integers(5, 40, n)
    slots = [np.sort(random.choice(size, k, replace=False)) for k in lengths]
    values = [random.integers(1, 4, k) * 10.0 ** random.integers(0, 4) for k in lengths]
    label = random.integers(0, 2, n).astype(float)
    arrays = {"index": np.arange(n), "fold": np.zeros(n, np.int32), "label": label, "ends": np.cumsum(lengths).astype(np.int64), "slots": np.concatenate(slots).astype(np.int32)}
    block = S.Block({"shard": 0, "n": n, "values": [np.concatenate(values).tobytes()]} | {name: a.tobytes() for name, a in arrays.items()})
    data = S.InTask(block, S.Problem(size, (None,), (0,)), "squared_hinge")
    first, start = S.ascend(data, 1.0, True, 1e-4)
    gradient, _, loss, _ = data.at(first)
    assert np.linalg.norm(gradient + first) <= 1e-4 * start[0] and data.count < 60
    found = S.minimise(data, 1.0, True, True, 1e-4, 1000, (first, start))
    assert found.objective[0] == pytest.approx(loss[0] + (first**2).sum() / 2) and found.weights == pytest.approx(first)


def separable(n=1500, size=1500):
    """Texts of two classes and very different lengths; few of them are near the border."""
    random = np.random.default_rng(9)
    label = random.integers(0, 2, n).astype(float)
    lengths = random.integers(3, 30, n)
    slots = [np.unique(np.append(random.choice(size, k), random.integers(0, 20) + 20 * int(y))) for k, y in zip(lengths, label)]
    lengths = np.array([len(s) for s in slots])
    values = random.integers(1, 4, lengths.sum()) * np.repeat(10.0 ** random.integers(0, 3, n), lengths)
    arrays = {"index": np.arange(n), "fold": np.arange(n, dtype=np.int32) % 3, "label": label, "ends": np.cumsum(lengths).astype(np.int64), "slots": np.concatenate(slots).astype(np.int32)}
    return S.Block({"shard": 0, "n": n, "values": [values.tobytes()]} | {name: a.tobytes() for name, a in arrays.items()}), size


@pytest.mark.parametrize("loss", ["logistic", "squared_hinge"])
def test_fits_of_the_rows_with_curvature_need_few_passes(loss, monkeypatch):
    """The minimum of all rows, from a tenth of the passes; where it ends early the rest goes on from the best weights."""
    block, size = separable()
    monkeypatch.setattr(S, "_CHOSEN", 1 << 15)
    fresh, penalised = lambda: S.InTask(block, S.Problem(size, (0,), (0,)), loss, direct=True), loss == "squared_hinge"
    plain = S.minimise(fresh(), 1.0, True, penalised, 1e-6, 1000)
    found, done = S.settle(fresh(), 1.0, True, penalised, 1e-6, 1000)
    assert done and found.norms[0] <= 1e-6 * found.start[0] and found.passes <= 40
    assert found.start == pytest.approx(plain.start) and found.objective <= plain.objective * (1 + 1e-6)
    monkeypatch.setattr(S, "_SETTLING", 1)
    data = fresh()
    found, done = S.settle(data, 1.0, True, penalised, 1e-6, 1000)
    gradient, _, value, _ = data.at(found.weights)
    ridge = np.append(np.ones(size), float(penalised))
    assert not done and found.objective == pytest.approx(value + (ridge * found.weights[0] ** 2).sum() / 2)
    whole = S.minimise(data, 1.0, True, penalised, 1e-6, 1000, (found.weights, found.start))
    assert whole.objective < found.objective


def test_products_of_sparse_rows(monkeypatch):
    random = np.random.default_rng(4)
    dense = random.normal(size=(70, 50)) * (random.random((70, 50)) < random.random(50))
    dense[3] = 0
    row, slots = np.nonzero(dense)
    for most in (7, 1 << 21):
        monkeypatch.setattr(S, "_ENTRIES", most * 8)
        assert np.allclose(S.gram(np.bincount(row, minlength=70), slots, dense[row, slots]), dense @ dense.T)


@pytest.mark.parametrize("kind", ["logistic_regression", "linear_svm", "sgd"])
def test_shards_in_one_task_give_what_passes_over_them_give(training, unit_training, kind, monkeypatch):
    """A task for each fold and no job for each pass; descent goes through all rows as one shard."""
    for data in (training, unit_training):
        shards = in_shards(data, 3)
        tight = {"type": kind, "parameters": {"tol": 1e-5, "alpha": 0.05} if kind == "sgd" else {"tol": 1e-9}}
        assert shards.count > 1 and not shards.together
        want = L.fit_folds(data.shards if kind == "sgd" else shards, tight)
        with monkeypatch.context() as patch:
            patch.setattr(S, "OverShards", None)
            found = L.fit_folds(replace(shards, together=True), tight)
        assert found.objective == pytest.approx(want.objective, rel=1e-2) if kind == "sgd" else found.weights == pytest.approx(want.weights, abs=1e-6)


def test_staging_leaves_no_shuffle_files(spark, docs):
    folder = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in map(str, folder.getAllFiles().mkString("\n").split("\n")) if "shuffle_" in f}
    before, conf = files(), spark.conf.get(S._CLEANUP)
    found = stage(counted(docs).groupBy("term").count().repartition(3, "count").sortWithinPartitions("term"), "counted")
    assert not files() - before and spark.conf.get(S._CLEANUP) == conf and found.count()


def test_a_fit_of_all_texts_needs_the_shards_alone(spark, docs):
    whole = docs.withColumn("clean", F.col("text")).withColumn("fold", F.lit(None).cast("int"))
    training = L.TermTraining(whole, {"type": "tfidf", "ngram_range": [1, 1]}, [])
    counts, kind = training.counts.inputFiles(), {"type": "logistic_regression"}
    want = training.fit(kind)[0].orderBy("term").collect()
    del vars(training)["shards"]
    training.only_shards()
    left = [f for f in [*counts, training.path] if os.path.exists(f.removeprefix("file://"))]
    assert not left and training.fit(kind)[0].orderBy("term").collect() == want
    with pytest.raises(ValueError, match="not a folder of this session"):
        discard(spark.read.parquet("/root/testdata/sf0.001/nation.parquet"))


def test_a_task_reads_the_weights_of_one_fold_at_a_time(training):
    data = S.OverShards(in_shards(training, 3), "logistic")
    try:
        matrix = np.arange(12.0).reshape(3, 4)
        sent = data._sent(matrix)
        assert np.array_equal(S._cut(sent, np.array([2, 0])), matrix[:, [2, 0]]) and not any("_value" in vars(one) for one in sent)
    finally:
        data.close()


def test_sums_without_zero_ranges_are_whole():
    total = np.zeros((2, 3 * S._RANGE // 2))
    total[0, 5], total[1, -1] = 1.0, 2.0
    held = S._summed_ranges([S._parts(S._ranges(total)), S._parts(S._ranges(total))])
    assert sorted(held) == [0, 2 * S._RANGE] and held[0][5] == 2.0 and held[2 * S._RANGE][-1] == 4.0


def test_certificates(training, unit_training):
    for data in (training, unit_training):
        for kind in ("logistic_regression", "linear_svm", "sgd"):
            assert [r.optimal for r in CE.certified(data, {"type": kind}).collect()] == [True] * 3
        found = L.fit_folds(data.shards, {"type": "linear_svm"})
        moved = found.weights + 0.01
        for weights, optimal in ((found.weights, True), (moved, False)):
            for i, r in enumerate(CE.optimality(data, weights, "squared_hinge", 1.0, True, False, 2e-4).collect()):
                x, y = dense(data, r.fold)
                w, b = weights[i, :-1], weights[i, -1]
                gap = np.maximum(0, 1 - y * (x @ w + b))
                gradient = np.append(x.T @ (-2 * y * gap) + w, (-2 * y * gap).sum() + b)
                assert r.optimal == optimal and r.norm == pytest.approx(np.linalg.norm(gradient), abs=1e-8)
                assert r.objective == pytest.approx((gap**2).sum() + (w @ w + b * b) / 2) and (r.train_rows, r.features) == (len(y), (x != 0).any(axis=0).sum())


@pytest.mark.parametrize("classifier", ["C_LOGREG", "C_LINEAR_SVM", "C_SGD"])
def test_cross_validation_beats_the_majority(spark, docs, classifier):
    predictions = L.cross_validate(docs, configuration("R_TFIDF_UNI", classifier))
    assert predictions.count() == 91 and predictions.select("index").distinct().count() == 91
    assert min(r["macro_f1"] for r in macro_f1_per_fold(predictions).collect()) > 0.8


def test_shared_slots_only_if_the_configuration_says_so(spark, docs):
    prepared = docs.withColumn("clean", F.col("text"))
    for kind in ("bow", "tfidf"):
        training = L.TermTraining(prepared, {"type": kind, "ngram_range": [1, 1], "parameters": {"hash_slots": "8"}}, [0, 1, 2])
        assert training.size == 8 and not training.exact
        terms, intercept = training.fit({"type": "logistic_regression"}, 0)
        assert terms.count() == training.terms.filter("df_0 > 0").count()
        assert training.score(terms, intercept, 0).count() == docs.filter("fold = 0").count()


def test_token_vector_configuration(spark, docs):
    vectors = spark.createDataFrame([(w, [1.0, 0.0]) for w in GOOD] + [(w, [0.0, 1.0]) for w in BAD], "token string, vec array<float>")
    found = L.Resources(token_vectors=vectors, vector_dim=2)
    scores = E.run_configuration(docs, configuration("R_SPACY"), found)
    assert min(r["macro_f1"] for r in scores.collect()) > 0.9


def test_unknown_parameters_and_classifiers_are_errors(spark, docs):
    with pytest.raises(ValueError):
        L.check_classifier({"type": "sgd", "parameters": {"C": 1}})
    with pytest.raises(ValueError):
        L.cross_validate(docs, {**configuration(), "classifier": {"type": "most_frequent"}})


@pytest.fixture(scope="module")
def model(docs):
    return L.train_model(docs, configuration("R_TFIDF_UNI"))


def test_model_scores_as_the_vectors_do(spark, docs, model):
    """Margins from the term table equal those from sparse vectors."""
    prepared = L.prepare_text(docs.withColumn("fold", F.lit(0)), model.configuration, L.Resources(), "index")
    training = L.TermTraining(prepared, {"type": "tfidf", "ngram_range": [1, 1]}, [])
    found = L.fit_classifier(training.features(None).select("label", "features"), {"type": "logistic_regression"})
    want = {r["index"]: float(r["features"].dot(np.array(found.weights)) + found.intercept) for r in training.features(None).collect()}
    got = {r["index"]: r["margin"] for r in model.predict(docs).collect()}
    assert got == pytest.approx(want, abs=1e-6)


def test_rows_with_equal_or_null_keys_get_labels_of_their_own(spark, model):
    rows = spark.createDataFrame([(1, 0, "good nice"), (1, 0, "bad sad"), (None, 0, "bad sad"), (None, None, "good nice"), (2, 0, None)], REQUESTS)
    got = [(r["text"], r["predicted_label"]) for r in scoring.predict_texts(rows, model).collect()]
    assert len(got) == 5
    assert {g for g in got if g[0]} == {("good nice", "positive"), ("bad sad", "negative")}


def test_final_model(spark, docs):
    found = E.train_final(docs.filter("fold > 0"), docs.filter("fold = 0"), configuration(), "run-1", {"lab_member_id": "M"})
    row = found.run.first()
    assert row["tags"]["lab_run_type"] == "final" and row["params"]["training_size"] == "60"
    assert 0.8 < row["metrics"]["test_macro_f1"] <= 1
    assert found.report.columns == ["index", "text", "true_label", "predicted_label", "category"]
    assert found.categories.agg({"n": "sum"}).first()[0] == found.report.count()


def test_experiment_row_of_an_ablation(spark, docs):
    config = C.reference_configuration("lib", "1")
    row = E.experiment(docs, config, "run-a", {"lab_ablation_parent_run_id": "run-p"}, parent_mean=0.9, reverted="classifier").first()
    metrics = row["metrics"]
    folds = [metrics[f"macro_f1_fold_{k}"] for k in range(3)]
    assert metrics["macro_f1_mean"] == pytest.approx(np.mean(folds))
    assert metrics["macro_f1_std"] == pytest.approx(np.std(folds))
    assert metrics["macro_f1_delta"] == pytest.approx(0.9 - np.mean(folds))
    assert row["params"] == {"ablation_reverted_decision": "classifier"}


def test_ablation_of_a_logged_run(spark, docs):
    path = new_folder(spark, "log")
    tags = {"lab_experiment_id": "EXTRA", "lab_stage": "classifier"}
    R.append_run(E.experiment(docs, configuration("R_TFIDF_UNI", "C_SGD"), "run-p", tags), path)
    runs = R.read_runs(spark, path)
    assert E.stored_configuration(runs, "run-p")["classifier"]["type"] == "sgd"
    R.append_run(E.ablation(docs, runs, "run-p", "classifier", "run-a", {"lab_member_id": "M"}, "1"), path)
    runs = R.read_runs(spark, path)
    kept = E.stored_configuration(runs, "run-a")
    assert kept["classifier"]["type"] == "logistic_regression" and kept["representation"]["type"] == "tfidf"
    rows = {r["run_id"]: r["metrics"] for r in runs.collect()}
    assert rows["run-a"]["macro_f1_delta"] == pytest.approx(rows["run-p"]["macro_f1_mean"] - rows["run-a"]["macro_f1_mean"])
    with pytest.raises(ValueError):
        E.ablation(docs, runs, "no-run", "classifier", "x", {}, "1")


def test_saved_models_predict_the_same(spark, docs, model):
    folder = new_folder(spark, "models")
    L.save_model(model, f"{folder}/run-2")
    models = spark.createDataFrame([("m", 1, "run-1", "champion"), ("m", 2, "run-2", "champion")], "name string, version int, run_id string, alias string")
    loaded, run_id = E.champion_model(models, "m", folder)
    assert run_id == "run-2" and E.champion_model(models, "other", folder) is None
    columns = ["index", "margin", "predicted_label"]
    assert sorted(loaded.predict(docs).select(columns).collect()) == sorted(model.predict(docs).select(columns).collect())


REQUEST_TEXTS = {
    1: ["good nice", "bad sad"], 2: ["good"], 3: [None], 4: [""], 5: [" "], 6: [], 7: ["ok", ""],
    8: ["ok"] * 33, 9: ["a" * 1001], 10: ["a" * 1000], 11: ["\x1c\xa0"], 12: ["bad"] * 32,
}


@pytest.fixture(scope="module")
def requests(spark):
    texts = [(r, i, t) for r, items in REQUEST_TEXTS.items() for i, t in enumerate(items)]
    return spark.createDataFrame(texts, REQUESTS), spark.createDataFrame([(r,) for r in REQUEST_TEXTS], "request_id bigint")


def test_request_checks(spark, requests):
    got = {r["request_id"]: r["reason"] for r in scoring.validate_requests(*requests).collect()}
    bad = dict.fromkeys((3, 4, 5, 7, 9, 11), "bad_text")
    assert got == {1: None, 2: None, 10: None, 12: None, **bad, 6: "no_text", 8: "too_many_texts"}


def test_request_scores_keep_the_order(spark, requests, model):
    got = {r["request_id"]: r for r in scoring.score_requests(*requests, model, "run-7").collect()}
    assert set(got) == {1, 2, 10, 12}
    assert got[1]["predictions"] == ["positive", "negative"] and got[1]["model_run_id"] == "run-7"
    assert got[2]["predictions"] == ["positive"] and got[12]["predictions"] == ["negative"] * 32


def test_stream_equals_batch_and_restarts(spark, requests, model):
    feed, out, rejects, progress = (new_folder(spark, n) for n in ("feed", "out", "rejects", "progress"))
    texts = requests[0]
    texts.repartition(2).write.parquet(feed)

    def run():
        stream = spark.readStream.schema(REQUESTS).option("maxFilesPerTrigger", 1).parquet(feed)
        score_stream(stream, lambda: (model, "run-7"), out, rejects, progress).awaitTermination()
        return spark.read.parquet(out), spark.read.parquet(rejects)

    scored, refused = run()
    good = scoring.validate_texts(texts)
    want = scoring.predict_texts(good.filter("ok").drop("ok", "reason"), model)
    columns = ["request_id", "pos", "predicted_label"]
    assert sorted(scored.select(columns).collect()) == sorted(want.select(columns).collect())
    assert refused.count() == good.filter("NOT ok").count()
    again, _ = run()
    assert again.count() == scored.count()


def test_stream_asks_for_the_champion_of_each_batch(spark, model):
    feed, out, rejects, progress = (new_folder(spark, n) for n in ("feed", "out", "rejects", "progress"))
    for i in range(3):
        spark.createDataFrame([(i, 0, "good")], REQUESTS).coalesce(1).write.mode("append").parquet(feed)
    runs = iter(["run-1", "run-1", "run-2"])
    stream = spark.readStream.schema(REQUESTS).option("maxFilesPerTrigger", 1).parquet(feed)
    score_stream(stream, lambda: (model, next(runs)), out, rejects, progress).awaitTermination()
    assert sorted(r["model_run_id"] for r in spark.read.parquet(out).collect()) == ["run-1", "run-1", "run-2"]
    stopped = score_stream(spark.readStream.schema(REQUESTS).parquet(feed), lambda: None, out + "-none", rejects + "-none", progress + "-none")
    with pytest.raises(Exception, match="no model to score with"):
        stopped.awaitTermination()
