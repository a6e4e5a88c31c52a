"""Repeatable splits: a row's part depends on its key only, not on file layout or partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.keys import hash_bucket


def with_split(df: DataFrame, key: str, train_percent: int = 80, salt: str = "split42") -> DataFrame:
    part = F.when(hash_bucket(F.col(key), 100, salt) < train_percent, "train").otherwise("test")
    return df.withColumn("split", part)


def with_fold(df: DataFrame, key: str, folds: int = 3, salt: str = "fold42") -> DataFrame:
    return df.withColumn("fold", hash_bucket(F.col(key), folds, salt))


def random_split(df: DataFrame, train_percent: int = 80, seed: int = 42) -> list[DataFrame]:
    """Spark's own split; differs when the input is partitioned differently."""
    return df.randomSplit([train_percent / 100, 1 - train_percent / 100], seed)
