"""Exact ranking metrics over any number of scores.

A running total over all scores in one window would run in one task. Scores are first counted per
distinct value (pre-aggregated, so a score shared by very many rows is one row), then dealt out by
range; totals of the ranges before, one row per task, are added to the running total within a range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlens.session import stage_table

def score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """Positives and negatives per distinct score; NULL and NaN are the score NULL."""
    value = F.col(score).cast("double")
    return df.groupBy(F.when(~F.isnan(value), value).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) == 0).alias("neg"),
    )


def running_counts(counts: DataFrame) -> DataFrame:
    """Adds ``tp`` and ``fp``: positives and negatives with this score or a higher one."""
    ranged = counts.repartitionByRange(F.desc("score")).withColumn("range", F.spark_partition_id())
    ranged = stage_table(ranged, "score-ranges")
    higher = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    before = (
        ranged.groupBy("range")
        .agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
        .select(
            "range",
            F.coalesce(F.sum("p").over(higher), F.lit(0)).alias("p0"),
            F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("n0"),
        )
    )
    local = W.partitionBy("range").orderBy(F.desc("score"))
    return (
        ranged.withColumn("tp", F.sum("pos").over(local))
        .withColumn("fp", F.sum("neg").over(local))
        .join(F.broadcast(before), "range")  # one row per task
        .withColumn("tp", F.col("tp") + F.col("p0"))
        .withColumn("fp", F.col("fp") + F.col("n0"))
        .drop("range", "p0", "n0")
    )


def ranking_metrics(df: DataFrame, score: str, label: str) -> DataFrame:
    """Areas under the ROC curve and the precision-recall curve.

    Ties count half in the ROC area. The precision-recall curve is joined by straight lines and
    starts at recall 0 with the precision of its first point. Rows whose score is NULL or NaN have no
    place on a curve; ``unscored`` counts those with a label, the other numbers leave them out.
    """
    # several readers follow: the scores, often a model's output, are computed once
    all_counts = stage_table(score_counts(df, score, label), "score-counts")
    counts = all_counts.filter("score is not null")
    unscored = all_counts.agg(
        F.coalesce(F.sum(F.when(F.col("score").isNull(), F.col("pos") + F.col("neg"))), F.lit(0)).alias("u")
    )
    curve = running_counts(counts)
    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "pos", "neg"))
    seen_before = tp + fp - pos - neg
    precision = tp / (tp + fp)
    precision_before = F.when(seen_before == 0, precision).otherwise((tp - pos) / seen_before)
    wins = (pos.cast("decimal(19,0)") * (fp - neg) * 2 + pos.cast("decimal(19,0)") * neg).cast(
        "decimal(38,0)"
    )
    sums = curve.agg(
        F.sum("pos").alias("p"),
        F.sum("neg").alias("n"),
        F.sum(wins).alias("lost2"),
        F.sum(pos * (precision + precision_before) / 2).alias("area"),
    )
    p, n = F.col("p"), F.col("n")
    return sums.select(
        p.alias("positives"),
        n.alias("negatives"),
        (1 - F.col("lost2").cast("double") / 2 / p / n).alias("roc_auc"),
        (F.col("area") / p).alias("pr_auc"),
        unscored.scalar().alias("unscored"),
    )
