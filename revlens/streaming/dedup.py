"""Scoring stream that stores each edit once across batches, with a bounded state and a table for late events."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from revlens.config import SHIPPED_BANDS, RiskBands
from revlens.operators.features import article_edits, event_features
from revlens.session import folder_names
from revlens.sinks.tables import append_batch
from revlens.sources.events import stream_events
from revlens.streaming.scorer import ScorerPaths, event_key, score_batch, stream_name

_KEPT, _KEY = "_kept", "_key"


def with_kept(features: DataFrame, delay: str) -> DataFrame:
    """Every row of the stream once as it came (``_kept`` false), and the first row of each edit once
    more (``_kept`` true).

    An edit's key stays in the state until the watermark, the latest event time less ``delay``, is
    ``delay`` past its event, so the state holds the edits of a stretch of time, whatever the stream's
    age. Rows behind the watermark are never kept: they only come as they are. Rows without an event
    time count as the oldest possible, and only rows with one move the watermark.
    """
    timed = features.withColumn(_KEY, event_key()).withWatermark("event_time", delay)
    kept = timed.dropDuplicatesWithinWatermark([_KEY])
    return timed.withColumn(_KEPT, F.lit(False)).unionByName(kept.withColumn(_KEPT, F.lit(True)))


def _watermark(spark: SparkSession, path: str, stream_id: str, batch_id: int) -> DataFrame | None:
    """One row: the latest event time of the batches that count for this one, None if there are none.

    A stream tells late rows by the watermark of the batch before, which the batches before that one
    made; so the last batch does not count yet.
    """
    folder = f"{path.rstrip('/')}/stream_id={stream_id}"
    done = [int(n.split("=")[1]) for n in folder_names(spark, folder, "batch_id=")]
    earlier = [b for b in done if b < batch_id - 1]
    if not earlier:
        return None
    return spark.read.schema("latest timestamp").parquet(f"{folder}/batch_id={max(earlier)}")


def late_rows(batch: DataFrame, latest: Column | None, delay: str) -> DataFrame:
    """Rows as they came that the state did not see, being no later than the watermark."""
    came = batch.filter(~F.col(_KEPT))
    if latest is None:
        return came.limit(0)
    bound = F.timestamp_millis(F.unix_millis(latest)) - F.expr(f"INTERVAL {delay}")
    return came.filter(F.col("event_time") <= bound)


def dedup_batch(
    model: PipelineModel | None,
    paths: ScorerPaths,
    late_path: str,
    times_path: str,
    stream_id: str,
    delay: str,
    bands: RiskBands = SHIPPED_BANDS,
):
    """``foreachBatch`` body: kept rows are scored into the sinks, late ones go to the late table.

    The watermark is worked out from a table of the batches' latest event times, written by batch, as
    the stream's own is: the maximum over the batches that count, less the delay. A batch that is run again
    finds the same one. All three tables replace what the batch wrote before.
    """
    score = score_batch(model, paths, stream_id, bands)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            before = _watermark(spark, times_path, stream_id, batch_id)
            latest = None if before is None else before.agg(F.max("latest")).scalar()
            score(batch.filter(_KEPT).drop(_KEPT, _KEY), batch_id)
            late = late_rows(batch, latest, delay).drop(_KEPT, _KEY)
            if not late.isEmpty():
                append_batch(late, late_path, stream_id, batch_id)
            times = batch.agg(F.max("event_time").alias("latest"))
            last = _watermark(spark, times_path, stream_id, batch_id + 1)
            if last is not None:
                times = times.unionByName(last)
            append_batch(times.agg(F.max("latest").alias("latest")), times_path, stream_id, batch_id)
        finally:
            batch.unpersist()

    return run


def start_deduped(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    paths: ScorerPaths,
    late_path: str,
    delay: str = "1 hour",
    model: PipelineModel | None = None,
    bands: RiskBands = SHIPPED_BANDS,
    trigger_seconds: int | None = 30,
    max_files: int = 10,
) -> StreamingQuery:
    """Like ``start_scorer``, but an edit that comes again, in whatever batch, does not reach the sinks.

    Events behind the watermark, repeats of known edits or not, are kept unscored in the table at
    ``late_path``; ``read_late`` names those whose edit no table has. With ``trigger_seconds=None`` the
    stream ends when the landed files are used up.
    """
    features = event_features(article_edits(stream_events(spark, landing, max_files)))
    times_path = f"{checkpoint.rstrip('/')}-event-times"
    body = dedup_batch(model, paths, late_path, times_path, stream_name(checkpoint), delay, bands)
    writer = with_kept(features, delay).writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    if trigger_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()


def read_late(late: DataFrame, predictions: DataFrame) -> DataFrame:
    """The late events whose edit is not among the predictions, one per edit, the first by event time."""
    keyed = late.withColumn(_KEY, event_key())
    unknown = keyed.join(predictions.select(F.col("id").alias(_KEY)), _KEY, "left_anti")
    first = unknown.groupBy(_KEY).agg(F.min_by(F.struct(*late.columns), F.struct("event_time", "batch_id")).alias("row"))
    return first.select("row.*")
