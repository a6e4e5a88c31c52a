"""Confusion matrix and the metrics that follow from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (actual, predicted), in order."""
    return (
        df.groupBy(
            F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted")
        )
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy("actual", "predicted")
    )


def _cells(label: str, prediction: str) -> dict[str, Column]:
    def cell(a: int, p: int) -> Column:
        return F.count_if((F.col(label) == a) & (F.col(prediction) == p))

    return {"tp": cell(1, 1), "fp": cell(0, 1), "tn": cell(0, 0), "fn": cell(1, 0)}


def confusion_cells(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """The four cells of a two-class problem in one row, zeros included."""
    return df.agg(*[c.alias(k) for k, c in _cells(label, prediction).items()])


def confusion_document(
    df: DataFrame, run_id: str, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One-row document with non-empty cells and the four counts."""
    cells = confusion_cells(df, label, prediction)
    order = ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    listed = F.array(
        *[
            F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("count"))
            for a, p, c in order
        ]
    )
    return cells.select(
        F.lit(run_id).alias("run_id"),
        F.filter(listed, lambda cell: cell["count"] > 0).alias("confusion_matrix"),
        "tp",
        "fp",
        "tn",
        "fn",
    )


def weighted_metrics(cells: DataFrame) -> DataFrame:
    """Precision, recall and F1 weighted by class size, and accuracy, from the four cells."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    total = tp + fp + tn + fn

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole == 0, 0.0).otherwise(part / F.nullif(whole, F.lit(0.0)))

    def scores(hit: Column, claimed: Column, actual: Column) -> tuple[Column, Column, Column]:
        precision, recall = share(hit, claimed), share(hit, actual)
        return precision, recall, share(2 * precision * recall, precision + recall)

    pos, neg = scores(tp, tp + fp, tp + fn), scores(tn, tn + fn, tn + fp)
    weighted = [((tp + fn) * a + (tn + fp) * b) / total for a, b in zip(pos, neg, strict=True)]
    return cells.select(
        weighted[2].alias("f1"),
        weighted[0].alias("precision"),
        weighted[1].alias("recall"),
        ((tp + tn) / total).alias("accuracy"),
    )
