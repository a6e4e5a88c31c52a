"""Weak labels over frames whose columns may go by either of two names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.labels import weak_label


def apply_weak_labels(
    df: DataFrame, label_col: str = "label", null_as_zero: bool = True
) -> DataFrame:
    """Adds the weak label from ``comment`` (else ``comment_clean``), ``is_anon_int`` (else ``is_anon``)
    and ``length_delta``."""
    comment = "comment" if "comment" in df.columns else "comment_clean"
    anon = "is_anon_int" if "is_anon_int" in df.columns else "is_anon"
    label = weak_label(F.col(comment), F.col(anon), F.col("length_delta"), null_as_zero)
    return df.withColumn(label_col, label)
