"""Checks and predictions for scoring requests `(request_id, pos, text)`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textlab.functions import patterns as P
from textlab.operators.learners import TextModel
from textlab.operators.lookup import lookup_join
from textlab.session import stage

# Limits of one request.
MAX_TEXTS = 32
MAX_CHARS = 1000


def text_problem(text: Column) -> Column:
    """Why a text cannot be scored; null if it can. Length is in code points."""
    return (
        F.when(text.isNull(), "null_text")
        .when(~text.rlike(P.NOT_SPACE), "blank_text")
        .when(F.length(text) > MAX_CHARS, "long_text")
    )


def validate_texts(requests: DataFrame) -> DataFrame:
    problem = text_problem(F.col("text"))
    return requests.withColumn("reason", problem).withColumn("ok", F.col("reason").isNull())


def validate_requests(texts: DataFrame, requests: DataFrame) -> DataFrame:
    """`(request_id, texts, ok, reason)` for every request of the list, also those without a text.

    A request has 1 to 32 texts and one bad text rejects it. Texts are counted before they move.
    """
    counted = texts.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("texts"), F.count(text_problem(F.col("text"))).alias("_bad")
    )
    rows = requests.select("request_id").join(counted, "request_id", "left")
    number = F.coalesce("texts", F.lit(0).cast("bigint"))
    reason = (
        F.when(number == 0, "no_text").when(number > MAX_TEXTS, "too_many_texts").when(F.col("_bad") > 0, "bad_text")
    )
    return rows.select("request_id", number.alias("texts"), reason.isNull().alias("ok"), reason.alias("reason"))


def predict_texts(texts: DataFrame, model: TextModel) -> DataFrame:
    """`predicted_label` for texts `(request_id, pos, text)`."""
    return model.predict(texts)


def score_requests(texts: DataFrame, requests: DataFrame, model: TextModel, model_run_id: str) -> DataFrame:
    """`(request_id, model_run_id, predictions)` of the valid requests, labels in input order.

    Only valid requests get here, so a list has at most 32 labels. A rejected request may have any
    number of texts; the lookup spreads them.
    """
    valid = stage(validate_requests(texts, requests).filter("ok").select("request_id"), "valid-requests")
    scored = predict_texts(lookup_join(texts, valid, "request_id", ["pos"], how="left_semi", row_bytes=32), model)
    pairs = F.array_sort(F.collect_list(F.struct("pos", "predicted_label")))
    return scored.groupBy("request_id").agg(
        F.lit(model_run_id).alias("model_run_id"),
        F.transform(pairs, lambda pair: pair["predicted_label"]).alias("predictions"),
    )
