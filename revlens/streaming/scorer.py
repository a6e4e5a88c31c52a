"""Scoring of live edits into tables a replay cannot duplicate."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from revlens.config import SHIPPED_BANDS, RiskBands
from revlens.functions.keys import edit_key
from revlens.functions.risk import heuristic_score, risk_band
from revlens.ml.scoring import score
from revlens.operators.features import (
    article_edits,
    event_features,
    event_revision,
    scored_predictions,
)
from revlens.operators.tables import latest_by_key
from revlens.schemas import PREDICTION, PREDICTION_COLUMNS
from revlens.sinks.tables import append_batch, append_delta, archive
from revlens.sources.events import stream_events


@dataclass(frozen=True)
class ScorerPaths:
    predictions: str
    archive: str | None = None
    delta: str | None = None


def event_key() -> Column:
    """The id the event's prediction row will have."""
    return edit_key(F.coalesce("wiki", F.lit("")), event_revision())


def drop_repeats(features: DataFrame) -> DataFrame:
    """One event per edit of a batch, the latest by its time."""
    latest = latest_by_key(
        features.withColumn("_key", event_key()), ["_key"], [F.desc("event_time"), F.desc("id")]
    )
    return latest.drop("_key")


def stream_name(checkpoint: str) -> str:
    """A stream is its checkpoint: batch numbers start anew with a new one."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def score_batch(
    model: PipelineModel | None,
    paths: ScorerPaths,
    stream_id: str,
    bands: RiskBands = SHIPPED_BANDS,
    dedup: bool = False,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: score once, write every sink from the kept rows, nothing on the driver.

    Each sink replaces what this stream wrote for this batch id, so running a batch again changes
    nothing, and streams that share a table leave each other's rows alone.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = drop_repeats(batch) if dedup else batch
        scored = score(rows, model, event_key()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if scored.isEmpty():
                return
            append_batch(scored_predictions(scored, bands), paths.predictions, stream_id, batch_id)
            if paths.archive:
                archive(scored, paths.archive, F.col("event_time"), stream_id, batch_id)
            if paths.delta:
                append_delta(scored, paths.delta, stream_id, batch_id)
        finally:
            scored.unpersist()

    return run


def start_scorer(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    paths: ScorerPaths,
    model: PipelineModel | None = None,
    bands: RiskBands = SHIPPED_BANDS,
    trigger_seconds: int | None = 30,
    max_files: int = 10,
    dedup: bool = False,
    drop_landed: bool = False,
) -> StreamingQuery:
    """Runs until stopped, or with ``trigger_seconds=None`` until the landed files are used up.

    ``dedup`` folds repeats within a batch. Those of other batches stay in the tables and give way in
    ``read_predictions`` and ``read_archive``, which keep one row per edit. ``dedup.start_deduped``
    keeps them out of the tables, by a bounded state.

    ``drop_landed`` deletes the landed files of a batch when the next one begins, so the folder does not
    grow with the stream's age; only for a folder that no other stream reads.
    """
    features = event_features(article_edits(stream_events(spark, landing, max_files, drop_landed)))
    body = score_batch(model, paths, stream_name(checkpoint), bands, dedup)
    writer = features.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    if trigger_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The archive with one row per edit, the latest by event time."""
    rows = spark.read.parquet(path).withColumn("_key", event_key())
    order = [F.desc("event_time"), F.desc("stream_id"), F.desc("batch_id")]
    return latest_by_key(rows, ["_key"], order).drop("_key")


def read_predictions(spark: SparkSession, *paths: str) -> DataFrame:
    """Latest row per edit over tables written batch by batch and compacted generations of them.

    Rows of a generation carry no batch id and give way to a batch row of the same time; a row without
    a score gives way to a scored one of its time.
    """
    layout = T.StructType(
        [
            *PREDICTION.fields,
            T.StructField("stream_id", T.StringType()),
            T.StructField("batch_id", T.LongType()),
        ]
    )
    rows = spark.read.schema(layout).parquet(paths[0])
    for path in paths[1:]:
        rows = rows.unionByName(spark.read.schema(layout).parquet(path))
    newest = [F.desc("created_at"), F.desc("scored"), F.desc("batch_id"), F.desc("stream_id")]
    return latest_by_key(rows, ["id"], newest).select(*PREDICTION_COLUMNS)


def score_pending(predictions: DataFrame, bands: RiskBands = SHIPPED_BANDS) -> DataFrame:
    """Heuristic score and band for rows not scored yet; ``created_at`` keeps the feed's order."""
    pending = F.col("scored") == 0
    new = heuristic_score(F.col("comment"), F.col("user"), F.col("is_anon"), F.col("length_delta"))
    scored = predictions.withColumn("_new", F.when(pending, new))
    return scored.withColumns(
        {
            "risk_score": F.coalesce("_new", "risk_score"),
            "risk_label": F.when(pending, risk_band(F.col("_new"), bands)).otherwise(
                F.col("risk_label")
            ),
            "scored": F.lit(1),
            "scored_at": F.when(pending, F.current_timestamp()),
        }
    ).drop("_new")
