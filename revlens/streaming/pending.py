"""Continuous scoring of rows that were stored without a score."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from revlens.config import SHIPPED_BANDS, RiskBands
from revlens.operators.tables import latest_by_key
from revlens.schemas import PREDICTION, PREDICTION_COLUMNS
from revlens.sinks.tables import append_batch
from revlens.streaming.scorer import score_pending, stream_name

_LAYOUT = T.StructType([*PREDICTION.fields, T.StructField("stream_id", T.StringType()), T.StructField("batch_id", T.LongType())])


def pending_rows(spark: SparkSession, predictions: str, max_files: int = 100) -> DataFrame:
    """The rows without a score of a table written batch by batch, as a stream: each file is read once."""
    rows = spark.readStream.schema(_LAYOUT).option("maxFilesPerTrigger", max_files).parquet(predictions)
    return rows.filter("scored = 0")


def pending_batch(target: str, stream_id: str, bands: RiskBands = SHIPPED_BANDS) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: the newest pending row of each edit, scored, replaces what this batch wrote."""

    def run(batch: DataFrame, batch_id: int) -> None:
        newest = [F.desc("created_at"), F.desc("batch_id"), F.desc("stream_id")]
        rows = latest_by_key(batch, ["id"], newest)
        append_batch(score_pending(rows, bands).select(*PREDICTION_COLUMNS), target, stream_id, batch_id)

    return run


def start_pending_scorer(
    spark: SparkSession,
    predictions: str,
    target: str,
    checkpoint: str,
    bands: RiskBands = SHIPPED_BANDS,
    trigger_seconds: int | None = 5,
    max_files: int = 100,
) -> StreamingQuery:
    """Scores what is appended to ``predictions`` without a score, each row once, into ``target``.

    The checkpoint remembers the files that were read, so a restart goes on where it stopped, and a
    batch that is run again replaces its rows. Read both with ``read_predictions(spark, predictions,
    target)``: a scored row takes the place of the pending one of its time and keeps its place in the
    feed. ``target`` must be another folder than ``predictions``. With ``trigger_seconds=None`` the
    stream ends when it has read all there is.
    """
    if predictions.rstrip("/") == target.rstrip("/"):
        raise ValueError("scored rows need a folder of their own")
    rows = pending_rows(spark, predictions, max_files)
    body = pending_batch(target, stream_name(checkpoint), bands)
    writer = rows.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    if trigger_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()
