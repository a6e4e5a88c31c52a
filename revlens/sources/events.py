"""Live edit events: landed JSON lines and raw feed messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.schemas import EVENT


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT).json(path)


def stream_events(
    spark: SparkSession, path: str, max_files: int = 10, drop_read: bool = False
) -> DataFrame:
    """Landing folder as a stream. Malformed lines become all-NULL rows, which the type filter removes.

    With ``drop_read`` the files of a batch that is done are deleted.
    """
    reader = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", max_files)
    return reader.option("cleanSource", "delete" if drop_read else "off").json(path)


def target_edits(wiki: str = "enwiki") -> Column:
    return (F.col("type") == "edit") & (F.col("wiki") == wiki) & (F.col("namespace") == 0)


def parse_messages(messages: DataFrame, wiki: str = "enwiki", value: str = "value") -> DataFrame:
    """Feed messages (one JSON text per row) to events of the target wiki; the rest is dropped.

    The same expression serves a batch frame and a text or Kafka stream. The event is unfolded with
    ``inline``: as a plain struct column the optimizer would copy the parse into each part of the filter.
    """
    event = F.from_json(F.col(value), EVENT)
    return (
        messages.filter(~F.coalesce(F.trim(F.col(value)) == "", F.lit(True)))
        .select(F.inline(F.array(event)))
        .filter(target_edits(wiki))
    )


def to_messages(events: DataFrame) -> DataFrame:
    """Events as JSON text, one per row."""
    return events.select(F.to_json(F.struct(*EVENT.fieldNames())).alias("value"))
