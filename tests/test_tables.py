"""Ranks, splits, checks and lookups."""

import random

import pytest
from pyspark.sql import functions as F

from textlab.operators import lookup, ranking, splits
from textlab.operators.evaluation import macro_f1_per_fold, majority_class, t0_scores
from textlab.operators.errors import category_counts, error_report, select_errors, top_categories
from textlab.sources import tables as S
from textlab.session import new_folder


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(1000).select(F.col("id").alias("index"), (F.col("id") % 3 == 0).cast("int").alias("label"))


def test_global_rank_is_dense_and_ordered(spark):
    keys = random.Random(1).sample(range(10**9), 500)
    rows = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(5)
    got = {r["k"]: r["place"] for r in ranking.global_rank(rows, ["k"], "place").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_sample_takes_the_rounded_share_of_each_class(spark, labelled):
    sample = splits.stratified_sample(labelled, fraction=0.125).collect()
    sizes = {c: sum(r["label"] == c for r in sample) for c in (0, 1)}
    assert sizes == {0: round(0.125 * 666), 1: round(0.125 * 334)}
    assert len({r["index"] for r in sample}) == len(sample)
    by_size = splits.stratified_sample(labelled, size=125).collect()
    assert sorted(by_size) == sorted(sample)


def test_sample_is_the_head_of_the_hash_order(spark, labelled):
    whole = labelled.withColumn("h", ranking.seeded_hash(F.col("index"))).collect()
    want = set()
    for c, k in ((0, 83), (1, 42)):
        want |= {r["index"] for r in sorted((r for r in whole if r["label"] == c), key=lambda r: (r["h"], r["index"]))[:k]}
    for bits in (1, 16):
        got = splits.stratified_sample(labelled, fraction=0.125, bits=bits)
        assert {r["index"] for r in got.collect()} == want


def test_sample_larger_than_the_table_is_an_error(spark, labelled):
    with pytest.raises(ValueError):
        splits.stratified_sample(labelled, fraction=1.5)
    with pytest.raises(Exception, match="larger than the table"):
        splits.stratified_sample(labelled, size=2000).collect()


def test_folds_are_balanced_and_do_not_depend_on_partitions(spark, labelled):
    first = {r["index"]: r["fold"] for r in splits.stratified_kfold(labelled).collect()}
    second = {r["index"]: r["fold"] for r in splits.stratified_kfold(labelled.repartition(7)).collect()}
    assert first == second and len(first) == 1000
    counts = {(r["label"], r["fold"]): r["n"] for r in splits.fold_balance(splits.stratified_kfold(labelled)).collect()}
    for label in (0, 1):
        sizes = [counts[label, k] for k in range(3)]
        assert max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("frequency", [None, "often"])
def test_lookup_without_broadcast_equals_a_plain_join(spark, monkeypatch, how, frequency):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(lookup, "HOT_KEYS", 2)
    left = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("key"))
    table = spark.createDataFrame(
        [(str(k), k, 12) for k in range(0, 50, 2)] + [("hot", -1, 200)], "key string, value int, often int"
    )
    got = lookup.lookup_join(left, table, "key", ["id"], how=how, frequency=frequency)
    want = left.join(table, "key", how)
    assert sorted(map(str, got.select(sorted(got.columns)).collect())) == sorted(map(str, want.select(sorted(want.columns)).collect()))


def test_served_rows_of_a_lookup_are_spread(spark, monkeypatch):
    """All rows have the frequent key, which is broadcast: they must not meet in one task of the shuffle with the rest."""
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    left = spark.range(6000).select("id", F.when(F.col("id") % 7 < 7, "hot").alias("key"))
    table = spark.createDataFrame([("hot", 1, 6000), ("cold", 2, 1)], "key string, value int, often int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = lookup.lookup_join(left, table, "key", ["id"], frequency="often", tasks=16)
        sizes = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 6000 and len(sizes) > 8 and max(sizes) < 1500


def test_checks(spark):
    parts = spark.createDataFrame([(0, 0), (1, 1), (1, 2), (9, 0)], S.PARTITIONS)
    train = spark.createDataFrame([(0, "a", 1), (1, "b", 0), (9, None, 1)], "index bigint, text string, label int")
    assert S.check_unmatched(parts, train).first()["unmatched"] == 1
    assert [tuple(r) for r in S.check_unique(parts).collect()] == [(1, 2)]
    assert S.check_row_count(train, 4).first()["ok"] is False
    assert S.join_partitions_text(parts, train).count() == 4


def test_csv_keeps_texts_and_order(spark):
    texts = ['plain', 'with "quotes", comma', "line\nbreak", " blanks ", "", "tab\t\\ back"]
    rows = spark.createDataFrame([(i, t, "negative", "positive", "other") for i, t in enumerate(texts)], S.ERROR_REPORT)
    path = new_folder(spark, "csv")
    S.write_table(rows.orderBy(F.desc("index")), path, S.ERROR_REPORT.names, ["index"])
    back = S.read_table(spark, path, S.ERROR_REPORT, multiline=True)
    assert {r["index"]: r["text"] for r in back.collect()} == dict(enumerate(texts))
    header = spark.read.text(path).first()["value"]
    assert header == "index,text,true_label,predicted_label,category"


def test_majority_tie_is_zero(spark):
    rows = spark.createDataFrame([(0, 1), (0, 0), (1, 0), (1, 1)], "fold int, label int")
    assert {r["majority"] for r in majority_class(rows).collect()} == {0}
    scores = {r["fold"]: r["macro_f1"] for r in t0_scores(rows).collect()}
    assert scores == pytest.approx({0: 1 / 3, 1: 1 / 3})


def test_macro_f1_by_hand(spark):
    rows = spark.createDataFrame(
        [(0, 0, 0), (0, 0, 1), (0, 1, 1), (1, 1, 1), (2, 0, 1)], "fold int, label int, prediction int"
    )
    scores = {r["fold"]: r["macro_f1"] for r in macro_f1_per_fold(rows).collect()}
    assert scores == pytest.approx({0: (2 / 3 + 2 / 3) / 2, 1: 1.0, 2: 0.0})


def flipped(spark, n=200, every=5):
    texts = ["not bad, actually pretty good #great", "soooo tired of this 😀", "yeah right, best service ever", "this is a normal review text"]
    rows = [(1000 + i, texts[min(i % 5, 3)], i % 2, 1 - i % 2 if i % every == 0 else i % 2) for i in range(n)]
    return spark.createDataFrame(rows, "index bigint, text string, label int, prediction int")


def test_error_report(spark):
    report = error_report(flipped(spark, every=3)).collect()
    assert len(report) == 20
    assert [r["index"] for r in report] == sorted(r["index"] for r in report)
    assert {r["true_label"] for r in report} == {"negative", "positive"}
    assert all(r["true_label"] != r["predicted_label"] for r in report)


def test_select_errors_sizes(spark):
    rows = spark.createDataFrame([(i, i // 3 % 2, 1 - i // 3 % 2) for i in range(60)], "index bigint, label int, prediction int")
    chosen = {r["index"] for r in select_errors(rows).collect()}
    assert len(chosen) == 20 and {i // 3 % 2 for i in chosen} == {0, 1}
    assert select_errors(rows, min_errors=1).count() == 2
    assert select_errors(rows.filter("index < 5")).count() == 5
    assert select_errors(rows.withColumn("prediction", F.col("label"))).count() == 0


def test_category_counts_show_zeros_and_ties_keep_order(spark):
    rows = spark.createDataFrame([("other",), ("emoji",), ("hashtag",), ("hashtag",)], "category string")
    counts = category_counts(rows)
    assert counts.count() == 10 and counts.agg(F.sum("n")).first()[0] == 4
    assert [r["category"] for r in top_categories(counts).collect()] == ["hashtag", "emoji"]


def test_lookup_spreads_frequent_keys_that_the_table_lacks_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    left = spark.range(2000).select("id", F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).when(F.col("id") % 2 == 0, "hot").alias("key"))
    table = spark.createDataFrame([("10", 1), ("20", 2)], "key string, value int")
    got = lookup.lookup_join(left, table, "key", ["id"], how="left")
    assert got.count() == 2000 and got.filter("value IS NOT NULL").count() == 2
    assert lookup.lookup_join(left, table, "key", ["id"]).count() == 2
