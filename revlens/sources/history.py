"""Tab-separated history dumps: 76 text columns, no header, no quoting, bz2 or plain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.schemas import HISTORY, HISTORY_COLUMNS


def read_history(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Typed by position; empty fields are NULL, ``#`` lines are skipped, unused columns are not parsed."""
    return (
        spark.read.schema(HISTORY)
        .option("sep", "\t")
        .option("header", "false")
        .option("quote", "")
        .option("escape", "")
        .option("comment", "#")
        .csv(paths)
    )


def read_history_lenient(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Drops lines with another number of columns and keeps empty fields as ''."""
    width = len(HISTORY_COLUMNS)
    fields = spark.read.text(paths).select(F.split("value", "\t", -1).alias("f"))
    return fields.filter(F.size("f") == width).select(
        *[F.col("f")[i].alias(name) for i, name in enumerate(HISTORY_COLUMNS)]
    )
