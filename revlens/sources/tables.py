"""Parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """A table written as sub-folders of parts."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


def read_union(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All rows of several tables, by column name; columns absent from one are NULL there."""
    tables = [spark.read.parquet(p) for p in paths]
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table, allowMissingColumns=True)
    return result


def read_or_build(
    spark: SparkSession, path: str, build: Callable[[], DataFrame]
) -> tuple[DataFrame, bool]:
    """The table at ``path``, built and written first if it cannot be read. Second: was it reused."""
    try:
        return spark.read.parquet(path), True
    except AnalysisException:
        build().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path), False
