"""Sources, sinks and data checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Quotes are doubled and blanks kept, so any text comes back as it was written.
_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "nullValue": "\\N",
    "lineSep": "\n",
}

PARTITIONS = T.StructType([T.StructField("index", T.LongType()), T.StructField("fold", T.IntegerType())])
MEMBERS = T.StructType([T.StructField("member_id", T.StringType()), T.StructField("notebook_arn", T.StringType())])
ERROR_REPORT = T.StructType(
    [
        T.StructField("index", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("true_label", T.StringType()),
        T.StructField("predicted_label", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Place a scan by `key` if its files give fewer tasks than there are cores.

    One file with one row group is one task, however many cores wait for the text work that follows.
    A scan with enough splits stays as it is. `scan` must not hold a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)


def read_split(spark: SparkSession, path: str, text: str = "text", label: str = "label", fmt: str = "parquet") -> DataFrame:
    """A labelled split; only the two columns are read."""
    return spark.read.format(fmt).load(path).select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"))


def read_labelled_text(spark: SparkSession, folder: str, how: str = "inner") -> DataFrame:
    """Texts with the labels given for them: `(index, text, label)`; with `how` left, all texts."""
    texts = spark.read.parquet(f"{folder}/documents.parquet").select(F.col("doc_id").alias("index"), "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select(
        F.col("doc_id").alias("index"), F.col("quality").cast("int").alias("label")
    )
    return texts.join(labels, "index", how)


def profile_source(df: DataFrame, text: str = "text", label: str = "label", key: str = "index") -> DataFrame:
    """One pass over a new source: rows, null texts, text lengths, classes and the first row as an example."""
    length = F.length(text)
    return df.agg(
        F.lit(",".join(df.columns)).alias("columns"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(text).isNull()).alias("null_texts"),
        F.min(length).cast("bigint").alias("min_length"),
        F.max(length).cast("bigint").alias("max_length"),
        F.count_distinct(F.col(label)).alias("classes"),
        F.count_if(F.col(label).isNull()).alias("missing_labels"),
        F.min_by(text, key).alias("example_text"),
        F.min_by(label, key).alias("example_label"),
    )


def check_row_count(df: DataFrame, expected: int, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("actual")).select(
        F.lit(name).alias("check"),
        F.lit(expected).cast("bigint").alias("expected"),
        "actual",
        (F.col("actual") == expected).alias("ok"),
    )


def join_partitions_text(parts: DataFrame, train: DataFrame) -> DataFrame:
    """Fold rows with the text and label at their index; a fold row without text stays."""
    return parts.join(train.select("index", "text", "label"), "index", "left")


def check_unmatched(parts: DataFrame, train: DataFrame) -> DataFrame:
    """How many fold rows have no text; 0 is right. A null text counts as none."""
    found = train.filter(F.col("text").isNotNull()).select("index")
    return parts.join(found, "index", "left_anti").agg(F.count(F.lit(1)).alias("unmatched"))


def check_unique(df: DataFrame, key: str = "index") -> DataFrame:
    """Keys that come more than once; an empty result is right."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows in order within and across partitions.

    The range shuffle samples its input, so add costly columns after this step, not before.
    """
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def write_table(df: DataFrame, path: str, columns: Sequence[str], order: Sequence[str] = ()) -> None:
    """CSV with exactly these columns, in the given order, or as the rows are if they are `in_order`."""
    rows = df.select(*columns)
    (in_order(rows, order) if order else rows).write.options(**_CSV).csv(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """`multiline` is only needed where a text may hold line breaks: such files are not cut for reading."""
    return spark.read.options(**_CSV, multiLine=multiline, enforceSchema=False).schema(schema).csv(path)
