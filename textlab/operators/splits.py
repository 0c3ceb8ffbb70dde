"""Stratified sample, folds and the protocol row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from textlab.functions.hashing import SEED
from textlab.operators.ranking import BUCKET_BITS, bucket_offsets, hashed, shuffled_position

FOLDS = 3


def stratified_sample(
    df: DataFrame,
    label: str = "label",
    size: int | None = None,
    fraction: float | None = None,
    key: str = "index",
    seed: int = SEED,
    bits: int = BUCKET_BITS,
) -> DataFrame:
    """Per class, round-half-even(fraction x class rows) rows without replacement.

    `size` stands for fraction = size / rows. The total is the sum over the classes and may differ
    from `size`. Members are those with the smallest seeded hash. Buckets below the cut are taken
    by a filter; only the one bucket per class that holds the cut is ranked, so nothing large moves.
    """
    if (size is None) == (fraction is None):
        raise ValueError("give either size or fraction")
    rows = hashed(df.select(key, label), key, seed, bits)
    filled = bucket_offsets(rows, [label])
    total = F.sum("_class_rows").over(Window.partitionBy()) if size is not None else None
    classes = filled.groupBy(label).agg(F.sum("_rows").alias("_class_rows"))
    share = F.lit(float(fraction)) if size is None else F.lit(float(size)) / total
    if fraction is not None and not 0 <= fraction <= 1:
        raise ValueError("fraction must lie in [0, 1]")
    take = F.bround(share * F.col("_class_rows")).cast("bigint")
    too_many = F.raise_error(F.lit("the sample is larger than the table")).cast("bigint")
    classes = classes.select(label, F.when(take <= F.col("_class_rows"), take).otherwise(too_many).alias("_take"))
    # One row per class: the bucket in which the class reaches its share, and what is missing there.
    cut = (
        filled.join(F.broadcast(classes), label)
        .filter((F.col("_before") < F.col("_take")) & (F.col("_before") + F.col("_rows") >= F.col("_take")))
        .select(label, F.col("_bucket").alias("_cut"), (F.col("_take") - F.col("_before")).alias("_missing"))
    )
    placed = rows.join(F.broadcast(cut), label)
    below = placed.filter(F.col("_bucket") < F.col("_cut")).select(key, label)
    in_cut = Window.partitionBy(label).orderBy("_hash", key)
    at_cut = (
        placed.filter(F.col("_bucket") == F.col("_cut"))
        .withColumn("_rank", F.row_number().over(in_cut))
        .filter(F.col("_rank") <= F.col("_missing"))
        .select(key, label)
    )
    return below.unionAll(at_cut)


def stratified_kfold(
    sample: DataFrame, label: str = "label", k: int = FOLDS, key: str = "index", seed: int = SEED
) -> DataFrame:
    """Fold of each row: position in (label, seeded hash) order modulo k.

    Class sizes differ by at most one row between folds. A row validates in its own fold.
    """
    ranked, position = shuffled_position(sample, key, label, seed)
    return ranked.select(*sample.columns, F.pmod(position, F.lit(k)).cast("int").alias("fold"))


def fold_balance(parts: DataFrame, label: str = "label") -> DataFrame:
    """Rows per fold and class."""
    return parts.groupBy("fold", label).agg(F.count(F.lit(1)).alias("n"))


def cv_splits(df: DataFrame, k: int = FOLDS) -> DataFrame:
    """Each row once per split, as `train` where its fold differs and as `validation` where it is the split."""
    return df.withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).withColumn(
        "role", F.when(F.col("fold") == F.col("split"), "validation").otherwise("train")
    )


def protocol_row(
    parts: DataFrame, dataset_id: str, dataset_revision: str, seed: int = SEED, k: int = FOLDS
) -> DataFrame:
    """The fixed protocol as one row; `sample_size` is the number of rows really drawn."""
    return parts.agg(
        F.lit(dataset_id).alias("dataset_id"),
        F.lit(dataset_revision).alias("dataset_revision"),
        F.lit("stratified").alias("sampling_strategy"),
        F.count(F.lit(1)).alias("sample_size"),
        F.lit(seed).alias("random_seed"),
        F.lit("StratifiedKFold").alias("cv_strategy"),
        F.lit(k).alias("cv_folds"),
        F.lit(True).alias("cv_shuffle"),
    )
