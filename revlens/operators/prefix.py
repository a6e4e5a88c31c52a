"""The first rows of a frame, as many as asked for, without bringing them to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_ROW = (1 << 33) - 1


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """``n`` rows of ``df``, or all if there are fewer: those of its first tasks, and of the last of them a part.

    Rows per task are counted and added up, one number a task; then every task keeps its share. The
    frame is worked out twice and must deal its rows to its tasks alike both times, as scans and what
    works row by row do; write other frames out first. Fewer than none is an error.
    """
    if n < 0:
        raise ValueError("a number of rows is not negative")
    numbered = df.withColumn("_at", F.monotonically_increasing_id())
    sizes = numbered.groupBy(F.shiftright("_at", 33).alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shares = sizes.withColumn("_share", F.lit(n) - before).filter("_share > 0").select("_task", "_share")
    kept = numbered.withColumn("_task", F.shiftright("_at", 33)).join(F.broadcast(shares), "_task")
    return kept.filter(F.col("_at").bitwiseAND(_ROW) < F.col("_share")).select(*df.columns)
