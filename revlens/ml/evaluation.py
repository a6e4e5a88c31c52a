"""Metrics of scored rows."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.confusion import confusion_cells, weighted_metrics
from revlens.operators.ranking import ranking_metrics


def evaluate(predictions: DataFrame, label: str = "label") -> dict[str, float]:
    """Areas under ROC and precision-recall curve, weighted F1, precision, recall, and accuracy.

    The areas come from Spark's evaluator, the rest from one pass that counts the four cells.
    """
    curve = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="raw_prediction")
    narrow = predictions.select(label, "raw_prediction", "prediction")
    cells = weighted_metrics(confusion_cells(narrow, label)).first().asDict()
    areas = {
        "auc": curve.setMetricName("areaUnderROC").evaluate(narrow),
        "pr_auc": curve.setMetricName("areaUnderPR").evaluate(narrow),
    }
    return {name: round(float(value or 0.0), 4) for name, value in (areas | cells).items()}


def exact_areas(predictions: DataFrame, label: str = "label") -> DataFrame:
    """The same areas without threshold binning, as a frame."""
    scored = predictions.select(label, vector_to_array("probability")[1].alias("score"))
    return ranking_metrics(scored, "score", label).select(
        F.col("positives"), F.col("negatives"), "roc_auc", "pr_auc"
    )
