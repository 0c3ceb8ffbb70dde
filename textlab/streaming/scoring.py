"""Scoring of a live feed of single texts `(request_id, pos, text)`.

Every record is checked on its own, so the job keeps no state. A micro-batch that runs again after
a failure writes the same folders again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from textlab.operators.learners import TextModel
from textlab.operators.scoring import predict_texts, validate_texts

REQUESTS = "request_id bigint, pos int, text string"


def score_stream(
    stream: DataFrame,
    serving: Callable[[], tuple[TextModel, str] | None],
    out: str,
    rejects: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Write labels below `out` and rejected texts with the reason below `rejects`, one folder per batch.

    `serving` gives the model and its run id and is asked once for each batch, so a champion that changes counts from the
    next batch on; without a model the batch fails and its records stay unread. `every` is the time between batches of a
    feed that goes on; without it, the job ends with what is there.
    """

    def score(batch: DataFrame, batch_id: int) -> None:
        served = serving()
        if served is None:
            raise LookupError("no model to score with")
        model, model_run_id = served
        checked = validate_texts(batch.select("request_id", "pos", "text"))
        good = checked.filter("ok").select("request_id", "pos", "text")
        labels = predict_texts(good, model).select(
            "request_id", "pos", F.lit(model_run_id).alias("model_run_id"), "predicted_label"
        )
        labels.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        checked.filter("NOT ok").select("request_id", "pos", "reason").write.mode("overwrite").parquet(
            f"{rejects}/batch={batch_id}"
        )

    writer = stream.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
