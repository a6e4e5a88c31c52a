"""One-pass counts and summaries. Every grouping here pre-aggregates before its shuffle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.config import REPORT_BANDS, RiskBands
from revlens.functions.numbers import round_exact
from revlens.functions.risk import risk_band

BAND_DOMAIN = ("HIGH", "MEDIUM", "LOW", "UNSCORED")


def _ratio(part: Column, whole: Column, places: int) -> Column:
    """part / whole with an empty whole counting as 1."""
    return round_exact(part / F.greatest(whole, F.lit(1)), places)


def label_stats(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows, positives, the rest (NULL labels included) and the positive rate."""
    stats = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0)).alias("positive"),
    )
    return stats.select(
        "total",
        "positive",
        (F.col("total") - F.col("positive")).alias("negative"),
        _ratio(F.col("positive"), F.col("total"), 4).alias("positive_rate"),
    )


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Positives and negatives by value; NULL labels are in neither and are shown separately."""
    stats = df.agg(
        F.count_if(F.col(label) == 1).alias("positive"),
        F.count_if(F.col(label) == 0).alias("negative"),
        F.count_if(F.col(label).isNull()).alias("null_labels"),
    )
    total = F.col("positive") + F.col("negative")
    return stats.select(
        total.alias("total"),
        "positive",
        "negative",
        "null_labels",
        _ratio(F.col("positive"), total, 3).alias("pos_rate"),
    )


def split_stats(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    """Rows and positive rate per part."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col(label).cast("bigint")).alias("positive"),
        round_exact(F.sum(F.col(label).cast("bigint")) / F.count(F.lit(1)), 4).alias("positive_rate"),
    )


def step_counts(steps: Mapping[str, Column]) -> list[Column]:
    """Aggregates ``c0``, ``c1``, ...: all rows, and those left after each successive predicate."""
    counts = [F.count(F.lit(1)).alias("c0")]
    kept = F.lit(True)
    for i, predicate in enumerate(steps.values(), 1):
        kept = kept & predicate
        counts.append(F.count_if(kept).alias(f"c{i}"))
    return counts


def observed_waterfall(spark: SparkSession, steps: Mapping[str, Column], counts: Mapping[str, int]) -> DataFrame:
    """The waterfall of counts that were observed on the way of another pass."""
    rows = [(i, name, counts[f"c{i}"]) for i, name in enumerate(["input", *steps])]
    return spark.createDataFrame(rows, "step int, name string, n_rows bigint")


def waterfall(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """Rows left after each successive predicate, all in one pass over the input."""
    counts = step_counts(steps)
    rows = [
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("name"), F.col(f"c{i}").alias("n_rows"))
        for i, name in enumerate(["input", *steps])
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def count_by(df: DataFrame, column: str, output: str = "n_rows", descending: bool = True) -> DataFrame:
    """Rows per value: most frequent first, or in value order."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias(output))
    return counted.orderBy(F.desc(output), column) if descending else counted.orderBy(column)


def editor_types(df: DataFrame) -> DataFrame:
    named = F.when(F.col("is_anon_int") == 1, "anonymous").otherwise("registered")
    return (
        df.groupBy("is_anon_int")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(named.alias("editor_type"), "n_rows")
        .orderBy("editor_type")
    )


def feed_stats(predictions: DataFrame) -> DataFrame:
    """Totals over the predictions table; NULLs become 0 or ''."""
    band = F.col("risk_label")
    return predictions.agg(
        F.count(F.lit(1)).alias("total_edits"),
        F.count_if(band == "HIGH").alias("high_risk"),
        F.count_if(band == "MEDIUM").alias("medium_risk"),
        F.count_if(band == "LOW").alias("low_risk"),
        F.count_if(F.col("scored") == 0).alias("unscored"),
        F.coalesce(round_exact(F.avg("risk_score"), 4), F.lit(0.0)).alias("avg_risk_score"),
        F.coalesce(F.max("created_at"), F.lit("")).alias("last_updated"),
    )


def kpi_shares(stats: DataFrame) -> DataFrame:
    """Share of high-risk edits in percent, NULL for an empty table."""
    total = F.col("total_edits")
    share = round_exact(F.col("high_risk") / F.nullif(total, F.lit(0)) * F.lit(100.0), 1)
    return stats.select("total_edits", "high_risk", share.alias("high_percent"))


def band_summary(predictions: DataFrame) -> DataFrame:
    """Count and mean score per band, highest mean first."""
    return (
        predictions.groupBy("risk_label")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            round_exact(F.avg("risk_score"), 3).alias("avg_score"),
        )
        .orderBy(F.desc("avg_score"), "risk_label")
    )


def band_domain_counts(predictions: DataFrame) -> DataFrame:
    """Counts over the fixed list of bands, absent bands as 0."""
    spark = predictions.sparkSession
    domain = spark.range(1).select(
        F.posexplode(F.array(*[F.lit(b) for b in BAND_DOMAIN])).alias("band_order", "risk_label")
    )
    counts = (
        predictions.groupBy(F.coalesce("risk_label", F.lit("UNSCORED")).alias("risk_label"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("risk_label").isin(*BAND_DOMAIN))  # at most one row per band from here on
    )
    return (
        domain.join(F.broadcast(counts), "risk_label", "left")
        .select("band_order", "risk_label", F.coalesce("n", F.lit(0)).alias("n_rows"))
        .orderBy("band_order")
    )


def scoring_progress(predictions: DataFrame) -> DataFrame:
    done = F.count_if((F.col("scored") == 1) & F.col("risk_score").isNotNull())
    total = F.count(F.lit(1))
    return predictions.agg(
        done.alias("already_scored"),
        total.alias("total_edits"),
        ((done == total) & (total > 0)).alias("complete"),
    )


def score_histogram(
    predictions: DataFrame, bins: int = 40, bands: RiskBands = REPORT_BANDS
) -> DataFrame:
    """Equal-width bins between lowest and highest score, the last bin closed; NULL scores dropped.

    The range is a scalar subquery over the same scan, the result has one row per bin.
    """
    scores = predictions.select("risk_score").filter(F.col("risk_score").isNotNull())
    low, high = F.min("risk_score"), F.max("risk_score")
    low, high = F.when(low == high, low - 0.5).otherwise(low), F.when(low == high, high + 0.5).otherwise(high)
    edges = scores.agg(F.struct(low.alias("lo"), ((high - low) / bins).alias("w")).alias("e"))
    ranged = scores.withColumn("e", edges.scalar())
    guess = F.least(F.floor((F.col("risk_score") - F.col("e.lo")) / F.col("e.w")), F.lit(bins - 1))
    binned = ranged.withColumn("g", guess)

    def edge(i: Column) -> Column:
        return F.col("e.lo") + i * F.col("e.w")

    # the division may land one bin off next to an edge; the edges themselves decide
    fixed = (
        F.when(F.col("risk_score") < edge(F.col("g")), F.col("g") - 1)
        .when((F.col("risk_score") >= edge(F.col("g") + 1)) & (F.col("g") < bins - 1), F.col("g") + 1)
        .otherwise(F.col("g"))
    )
    counts = binned.groupBy(fixed.cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    domain = predictions.sparkSession.range(0, bins, 1, 1).withColumnRenamed("id", "bin")
    return (
        domain.join(F.broadcast(counts), "bin", "left")
        .withColumn("e", edges.scalar())
        .select(
            F.col("bin").cast("int").alias("bin"),
            edge(F.col("bin")).alias("low_edge"),
            edge(F.col("bin") + 1).alias("high_edge"),
            F.coalesce("n", F.lit(0)).alias("n_rows"),
            risk_band(edge(F.col("bin")), bands).alias("band"),
        )
        .orderBy("bin")
    )


def require_rows(df: DataFrame, minimum: int) -> int:
    """Row count, or an error if there are too few to train on."""
    found = df.count()
    if found < minimum:
        raise ValueError(f"need at least {minimum} records, found {found}")
    return found
