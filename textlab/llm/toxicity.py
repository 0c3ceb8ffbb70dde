"""Toxicity score: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

An n-gram of lower-cased code points falls into one of 2^bits buckets. A text has a bucket or has it not.
For each bucket the ratio r is log((p + a) / |p|) - log((q + a) / |q|), p and q being the labelled
texts of either class that have it. The buckets that tell the classes apart best (chi-square) are kept; a
kept bucket enters a logistic regression with the value r. The fit sees at most `fit_rows` labelled
rows, those with the smallest hash of their key.

Null texts count as empty; an empty text gets the score of the intercept. With no labelled row, or one
class only, every text gets the share of the positive class (0 without rows). Rows given twice are scored
twice. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, functions as F

from textlab.llm.workers import flat_bytes, ship, slices

_BASE = np.uint32(0x01000193)
_SLICE_BYTES = 2 << 20  # of text at a time


@dataclass(frozen=True)
class Grams:
    """Which n-grams there are, and into how many buckets they fall."""

    orders: tuple[int, ...] = (4, 5)
    bits: int = 19

    def buckets(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Per order: the bucket at each place, the code point offsets of the texts, and the order."""
        data, offsets = flat_bytes(pc.utf8_lower(pc.fill_null(batch.column("text"), "")))
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        bounds = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        rolled, done = points, 1
        for order in sorted(self.orders):
            for step in range(done, order):
                rolled = rolled[:-1] * _BASE + points[step:] if len(rolled) else rolled
            done = order
            h = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x85EBCA6B) + np.uint32(order)
            h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
            yield h >> np.uint32(32 - self.bits), bounds, order


@dataclass(frozen=True)
class ToxicityModel:
    grams: Grams
    weights: np.ndarray  # one per bucket; 4 bytes x 2^bits
    intercept: float


def _present(buckets, bounds, order, wanted) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs whose bucket is wanted."""
    places = np.flatnonzero(wanted[buckets])
    text = np.searchsorted(bounds, places, side="right") - 1
    inside = places + order <= bounds[text + 1]
    pairs = np.unique(text[inside].astype(np.int64) << 32 | buckets[places[inside]])
    return pairs >> 32, pairs & 0xFFFFFFFF


def _class_counts(grams: Grams):
    def count(batches):
        totals = np.zeros((2, 1 << grams.bits), np.int64)
        everything = np.ones(1 << grams.bits, bool)
        for batch in slices(batches, limit=_SLICE_BYTES):
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            for buckets, bounds, order in grams.buckets(batch):
                text, bucket = _present(buckets, bounds, order, everything)
                for label in (0, 1):
                    totals[label] += np.bincount(bucket[labels[text] == label], minlength=1 << grams.bits)
        found = np.flatnonzero(totals.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(totals[0, found]), pa.array(totals[1, found])], ["bucket", "rest", "toxic"])

    return count


def _kept_buckets(grams: Grams, kept: np.ndarray):
    """Rows as `(label, places)`: the places of the text's buckets in the list of kept ones."""

    def bag(batches):
        place = np.full(1 << grams.bits, -1, np.int32)
        place[kept] = np.arange(len(kept), dtype=np.int32)
        wanted = place >= 0
        for batch in slices(batches, limit=_SLICE_BYTES):
            found = [_present(*g, wanted) for g in grams.buckets(batch)]
            text, bucket = (np.concatenate(x) for x in zip(*found))
            pairs = np.unique(text << 32 | place[bucket])
            cuts = np.searchsorted(pairs >> 32, np.arange(batch.num_rows + 1)).astype(np.int32)
            places = pa.ListArray.from_arrays(pa.array(cuts), pa.array((pairs & 0xFFFFFFFF).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("label").cast(pa.int32()), places], ["label", "places"])

    return bag


def fit_sample(labelled: DataFrame, fit_rows: int) -> DataFrame:
    """`(key, label)` of at most `fit_rows` rows, in the order of a hash."""
    return labelled.filter("label IN (0, 1) AND key IS NOT NULL").orderBy(F.xxhash64("key"), "key", "label").limit(fit_rows)


def train_model(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    grams: Grams = Grams(),
    fit_rows: int = 20_000,
    features: int = 1 << 11,
    smoothing: float = 1.0,
    least_score: float = 20.0,
    penalty: float = 1e-5,
    iterations: int = 100,
) -> ToxicityModel:
    """Fit on the rows of `labels`; what is broadcast has at most `fit_rows` rows of a key and a label."""
    ship(documents.sparkSession)
    sample = fit_sample(labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")), fit_rows)
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(sample), "key").select("label", "text")
    counted = rows.mapInArrow(_class_counts(grams), "bucket long, rest long, toxic long").groupBy("bucket").agg(F.sum("rest"), F.sum("toxic"))
    table = counted.toArrow()  # at most 2^bits rows
    counts = np.stack([table.column(i).to_numpy().astype(np.float64) for i in range(3)], axis=1)
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    weights = np.zeros(1 << grams.bits, np.float32)
    total = sum(sizes.values())
    share = sizes.get(1, 0) / total if total else 0.0
    unlearned = ToxicityModel(grams, weights, math.log(share / (1 - share)) if 0 < share < 1 else (50.0 if share else -50.0))
    if len(sizes) < 2 or not len(counts):
        return unlearned
    bucket, rest, toxic = counts[:, 0].astype(np.int64), counts[:, 1], counts[:, 2]
    ratio = np.log((toxic + smoothing) / (toxic + smoothing).sum()) - np.log((rest + smoothing) / (rest + smoothing).sum())
    have = toxic + rest
    a, b = toxic * (sizes[0] - rest) - rest * (sizes[1] - toxic), have * (total - have) * sizes[0] * sizes[1]
    score = np.where(b > 0, total * a * a / np.maximum(b, 1), 0.0)
    best = np.lexsort((bucket, -score))[:features]
    best = best[score[best] >= least_score]
    best = best[np.argsort(bucket[best])]
    if not len(best):
        return unlearned
    scale = ratio[best]
    bags = rows.mapInArrow(_kept_buckets(grams, bucket[best]), "label int, places array<int>")
    size = len(best)
    vector = F.udf(lambda places: Vectors.sparse(size, places, scale[places]), VectorUDT())
    bags = bags.repartition(documents.sparkSession.sparkContext.defaultParallelism).select(F.col("label").cast("double").alias("label"), vector("places").alias("features"))
    fitted = LogisticRegression(regParam=penalty, standardization=False, maxIter=iterations, tol=1e-7).fit(bags)
    weights[bucket[best]] = fitted.coefficients.toArray() * scale
    return ToxicityModel(grams, weights, float(fitted.intercept))


def score(documents: DataFrame, model: ToxicityModel, keep: Sequence[str], text: str = "text", out: str = "score") -> DataFrame:
    """The columns in `keep` and the score of each whole text, between 0 and 1."""
    ship(documents.sparkSession)
    source = documents.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").alias("text"))
    grams, weights, intercept = model.grams, model.weights, model.intercept

    def apply(batches):
        wanted = weights != 0
        for batch in slices(batches, limit=_SLICE_BYTES):
            margin = np.full(batch.num_rows, intercept)
            for g in grams.buckets(batch):
                rows, bucket = _present(*g, wanted)
                margin += np.bincount(rows, weights[bucket].astype(np.float64), minlength=batch.num_rows)
            value = 1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(value)], [*batch.schema.names[:-1], "_score"])

    schema = ", ".join([*[f"_{i} {f.dataType.simpleString()}" for i, f in enumerate(source.schema.fields[:-1])], "_score double"])
    scored = source.mapInArrow(apply, schema)
    return scored.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], F.col("_score").alias(out))
