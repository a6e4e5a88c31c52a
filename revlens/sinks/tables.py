"""Parquet (and, where installed, Delta) writers that a retry can repeat without duplicating rows."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

ROWS_PER_FILE = 50_000


def write_revisions(revisions: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    revisions.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_batch(rows: DataFrame, path: str, stream_id: str, batch_id: int) -> None:
    """Adds one micro-batch to a table laid out by stream and batch; the same batch of the same stream
    replaces itself, other streams' batches of that number stay."""
    _replace(rows, path, [], stream_id, batch_id)


def _replace(
    rows: DataFrame, path: str, layout: list[str], stream_id: str, batch_id: int
) -> None:
    (
        rows.withColumn("stream_id", F.lit(stream_id))
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*layout, "stream_id", "batch_id")
        .parquet(path)
    )


def archive(
    rows: DataFrame,
    path: str,
    date: Column,
    stream_id: str | None = None,
    batch_id: int | None = None,
) -> None:
    """Archive laid out by event date, so a query for some days reads only their folders.

    Rows of one day are many; they are not gathered, each task writes its own files. With stream and
    batch a repeated micro-batch replaces its own files.
    """
    rows = rows.withColumn("date", F.date_format(date, "yyyy-MM-dd"))
    rows = rows.withColumn("processed_date", F.date_format(F.current_timestamp(), "yyyy-MM-dd"))
    if batch_id is None:
        rows.write.mode("append").partitionBy("date").parquet(path)
    else:
        _replace(rows, path, ["date"], stream_id or "", batch_id)


def append_delta(rows: DataFrame, path: str, stream_id: str, batch_id: int) -> bool:
    """Appends to a Delta table, once for each stream and batch; without the Delta jar it logs that.

    Any other problem, such as a full disk or a schema that does not fit, is raised.
    """
    writer = (
        rows.write.format("delta")
        .mode("append")
        .option("txnAppId", stream_id)
        .option("txnVersion", batch_id)
    )
    try:
        writer.save(path)
    except Exception as problem:
        if "DATA_SOURCE_NOT_FOUND" not in str(problem):
            raise
        log.warning("no Delta source: %s", str(problem).splitlines()[0])
        return False
    return True


def compact_latest(latest: DataFrame, path: str) -> None:
    """Writes the latest rows as a new generation; readers switch to it plus the batches after it.

    Files are cut by time, so a question about recent edits skips most of them by their statistics.
    The id in the cut spreads rows that share one stamp.
    """
    ordered = latest.repartitionByRange("created_at", "id").sortWithinPartitions("created_at", "id")
    ordered.write.mode("errorifexists").parquet(path)
