"""Landing of feed messages as JSON lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from revlens.operators.prefix import first_rows
from revlens.session import folder_names, stage_table
from revlens.sinks.tables import append_batch
from revlens.sources.events import parse_messages, to_messages

EVENTS_PER_FILE = 100


def land_events(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    wiki: str = "enwiki",
    flush_seconds: int | None = 10,
    events_per_file: int = EVENTS_PER_FILE,
    max_events: int | None = None,
) -> StreamingQuery:
    """Filters a message stream and lands it as JSON lines.

    A flush happens per trigger; no file holds more than ``events_per_file`` events. Without
    ``flush_seconds`` the query drains what is there and stops. ``max_events`` ends the landing after that
    many events: each batch is counted by its tasks, which keep their share of what is left, and lies in
    a folder of its own below ``path``; later batches land nothing.
    """
    lines = to_messages(parse_messages(messages, wiki))
    if max_events is None:
        writer = lines.writeStream.format("text").option("maxRecordsPerFile", events_per_file)
    else:
        writer = lines.writeStream.foreachBatch(_land_up_to(max_events, path, checkpoint, events_per_file))
    writer = writer.option("checkpointLocation", checkpoint)
    if flush_seconds is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{flush_seconds} seconds")
    return writer.start(path) if max_events is None else writer.start()


def _land_up_to(most: int, path: str, checkpoint: str, events_per_file: int) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body; the events landed so far are a table by batch next to the checkpoint."""
    counts_path, stream = f"{checkpoint.rstrip('/')}-landed", "landing"

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = f"{counts_path}/stream_id={stream}"
        done = [int(n.split("=")[1]) for n in folder_names(spark, folder, "batch_id=")]
        earlier = [f"{folder}/batch_id={b}" for b in done if b < batch_id]
        landed = 0
        if earlier:
            landed = spark.read.schema("n bigint").parquet(*earlier).agg(F.sum("n").alias("n")).first()["n"]
        if landed >= most:
            return
        count = Observation()
        rows = first_rows(stage_table(batch, "landing-batch"), most - landed).observe(count, F.count(F.lit(1)).alias("n"))
        rows.write.mode("overwrite").option("maxRecordsPerFile", events_per_file).text(f"{path.rstrip('/')}/batch_id={batch_id}")
        n = spark.range(1).select(F.lit(count.get["n"]).cast("bigint").alias("n"))
        append_batch(n, counts_path, stream, batch_id)

    return run
