"""Small JSON documents: manifests, label statistics, confusion matrices."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.sources.files import size_totals


def write_document(document: DataFrame, path: str) -> None:
    """One-row frame as one JSON file."""
    document.coalesce(1).write.mode("overwrite").json(path)


def write_dataset_manifest(sizes: DataFrame, path: str, source: str, dump_date: str) -> None:
    """Totals as a document under ``summary``; the file rows, which grow with the data, under ``files``."""
    sizes.write.mode("overwrite").json(f"{path}/files")
    files = sizes.sparkSession.read.schema(sizes.schema).json(f"{path}/files")
    write_document(
        size_totals(files).select(
            F.current_timestamp().cast("string").alias("generated_at"),
            F.lit(source).alias("source"),
            F.lit(dump_date).alias("dump_date"),
            "*",
        ),
        f"{path}/summary",
    )


def model_manifest(
    stats: DataFrame, run_id: str, model_path: str, source: str, label: str, metrics: dict[str, float]
) -> DataFrame:
    """Manifest of a trained model around its one-row label statistics."""
    measured = F.struct(*[F.lit(float(v)).alias(k) for k, v in metrics.items()])
    return stats.select(
        F.lit(run_id).alias("run_id"),
        F.lit(model_path).alias("model_local_path"),
        F.current_timestamp().cast("string").alias("trained_at"),
        F.lit(source).alias("data_source"),
        F.lit(label).alias("label_field"),
        measured.alias("metrics"),
        F.struct("total", "positive", "positive_rate").alias("training_data_stats"),
    )


def read_document(df: DataFrame) -> dict:
    """The single document of a frame as a dictionary."""
    return json.loads(df.select(F.to_json(F.struct("*"))).first()[0])
