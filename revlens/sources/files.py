"""Inventories of raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions.numbers import round_exact

# published ratio of raw to bz2 size, fixed value
EXPANSION = 7
REQUIRED_BYTES = 10_000_000_000


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length) of matching files; contents are not read. Empty files are not listed; a
    missing folder is an error."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length")
    )


def find_dumps(spark: SparkSession, path: str) -> list[str]:
    """Sorted paths of the ``*.bz2`` dumps in a folder; an error if there are none."""
    found = sorted(row.path for row in list_files(spark, path, "*.bz2").collect())
    if not found:
        raise FileNotFoundError(f"no .bz2 files in {path}")
    return found


def size_rows(files: DataFrame, name: str = "name", size: str = "compressed_bytes") -> DataFrame:
    """Sizes per file with the estimated raw size."""
    compressed = F.col(size).cast("bigint")
    estimate = compressed * EXPANSION
    return files.select(
        F.col(name).alias("name"),
        compressed.alias("compressed_bytes"),
        round_exact(compressed / 1e6, 1).alias("compressed_mb"),
        estimate.alias("decompressed_bytes_estimate"),
        round_exact(estimate / 1e9, 2).alias("decompressed_gb_estimate"),
    )


def file_inventory(spark: SparkSession, path: str, pattern: str = "*.bz2") -> DataFrame:
    files = list_files(spark, path, pattern)
    return size_rows(
        files.select(
            F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("n")
        ),
        size="n",
    )


def size_totals(sizes: DataFrame) -> DataFrame:
    """Totals of the size rows and whether the data is large enough."""
    raw = F.sum("decompressed_bytes_estimate")
    return sizes.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.coalesce(round_exact(F.sum("compressed_bytes") / 1e9, 2), F.lit(0.0)).alias(
            "total_compressed_gb"
        ),
        F.coalesce(round_exact(raw / 1e9, 2), F.lit(0.0)).alias("total_decompressed_gb_estimate"),
        F.coalesce(raw >= REQUIRED_BYTES, F.lit(False)).alias("requirement_10gb_met"),
    )


def raw_bytes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Exact uncompressed bytes per file of newline-ended text; bz2 is decompressed in parallel."""
    return (
        spark.read.option("lineSep", "\n")
        .text(paths)
        .groupBy(F.col("_metadata.file_name").alias("name"))
        .agg(F.sum(F.octet_length("value").cast("bigint") + 1).alias("n_bytes"))
    )
