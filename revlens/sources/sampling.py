"""Estimates from some of the splits of raw files."""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def split_bytes(lines: DataFrame) -> list[int]:
    """Bytes of the files that each task of a scan would read, known from planning alone."""
    found = []
    for part in lines._jdf.queryExecution().toRdd().partitions():
        found.append(sum(piece.length() for piece in part.files()))
    return found


def estimate_tags(
    spark: SparkSession, paths: str | list[str], splits: int, tag: str = "<revision>", seed: int = 42
) -> DataFrame:
    """How often a tag stands in raw files, from ``splits`` of their splits: one row with ``estimate``,
    ``standard_error``, ``sampled_splits``, ``all_splits``, ``sampled_bytes``, ``all_bytes``.

    Splits are drawn without replacement; tasks of the others end without reading on. Tags per byte of
    the drawn splits, times all bytes, is the estimate; the error is that of a ratio, with the
    correction for a finite number of splits, so it is 0 if all are read, and unknown (NULL) for one of
    several. No files, an estimate of 0.
    """
    if splits < 1:
        raise ValueError("at least one split must be read")
    lines = spark.read.text(paths)
    sizes = split_bytes(lines)
    chosen = sorted(random.Random(seed).sample(range(len(sizes)), min(splits, len(sizes))))
    wanted, total = {i: sizes[i] for i in chosen}, sum(sizes)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId()
        if at not in wanted:
            return
        tags = sum(pc.sum(pc.count_substring(b.column(0), tag)).as_py() or 0 for b in batches)
        yield pa.RecordBatch.from_pydict({"tags": pa.array([float(tags)]), "size": pa.array([float(wanted[at])])})

    found = lines.mapInArrow(count, "tags double, size double")
    k, n = len(chosen), len(sizes)
    sums = found.agg(
        F.coalesce(F.sum("tags"), F.lit(0.0)).alias("t"), F.sum("size").alias("s"),
        F.sum(F.col("tags") * F.col("tags")).alias("tt"), F.sum(F.col("tags") * F.col("size")).alias("ts"), F.sum(F.col("size") * F.col("size")).alias("ss"),
    )
    rate = F.col("t") / F.nullif(F.col("s"), F.lit(0.0))
    residuals = F.greatest(F.col("tt") - 2 * rate * F.col("ts") + rate * rate * F.col("ss"), F.lit(0.0))
    spread = F.sqrt(residuals / (k - 1) * (n * n / k) * (1 - k / n)) if 1 < k < n else F.lit(0.0 if k == n else None).cast("double")
    return sums.select(
        F.coalesce(F.round(rate * total), F.lit(0.0)).cast("bigint").alias("estimate"),
        spread.alias("standard_error"),
        F.lit(k).alias("sampled_splits"),
        F.lit(n).alias("all_splits"),
        F.lit(sum(wanted.values())).cast("bigint").alias("sampled_bytes"),
        F.lit(total).cast("bigint").alias("all_bytes"),
    )
