"""Keyed tables without updates in place: rows are appended, readers keep the latest per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlens.config import SHIPPED_BANDS, RiskBands
from revlens.functions.risk import risk_band
from revlens.functions.wording import EXPLAINED_BY, explanation


def latest_by_key(df: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """The newest row per key.

    Spark turns ``row_number() == 1`` into a per-task top-1 before the shuffle, so a key with very
    many versions sends one row per task.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def insert_or_ignore(
    existing: DataFrame, incoming: DataFrame, keys: list[str], oldest_first: list[Column]
) -> DataFrame:
    """Existing rows plus the first incoming row of every key not present yet."""
    first = latest_by_key(incoming, keys, oldest_first)
    return existing.unionByName(first.join(existing.select(*keys), keys, "left_anti"))


def update_scores(
    predictions: DataFrame, scores: DataFrame, bands: RiskBands = SHIPPED_BANDS
) -> DataFrame:
    """Rows with a new score take it, its band and ``scored = 1``; others stay. ``created_at`` is kept.

    Of several scores for one id the newest by ``created_at`` counts where there is one, then the
    highest; so scores never multiply rows.
    """
    newest = [F.desc("created_at")] if "created_at" in scores.columns else []
    scores = latest_by_key(scores, ["id"], [*newest, F.desc_nulls_last("risk_score")])
    new = scores.select("id", F.col("risk_score").alias("_new"))
    hit = F.col("_new").isNotNull()
    return (
        predictions.join(new, "id", "left")
        .withColumns(
            {
                "risk_label": F.when(hit, risk_band(F.col("_new"), bands)).otherwise(
                    F.col("risk_label")
                ),
                "scored": F.when(hit, 1).otherwise(F.col("scored")),
                "risk_score": F.coalesce("_new", "risk_score"),
            }
        )
        .select(*predictions.columns)
    )


def unexplained_edits(
    predictions: DataFrame, explanations: DataFrame, limit: int | None = None, not_in: bool = False
) -> DataFrame:
    """Edits without an explanation.

    ``not_in`` keeps the semantics of SQL ``NOT IN``: one NULL among the explained ids leaves nothing.
    """
    explained = explanations.select(F.col("edit_id").alias("id"))
    if not_in:
        no_null = explained.agg(F.count_if(F.col("id").isNull()) == 0)
        predictions = predictions.filter(no_null.scalar())
    left = predictions.join(explained.filter(F.col("id").isNotNull()), "id", "left_anti")
    return left if limit is None else left.limit(limit)


def rule_explanations(edits: DataFrame, now: Column | None = None) -> DataFrame:
    """Explanation rows written by rule."""
    stamp = F.current_timestamp() if now is None else now
    return edits.select(
        F.col("id").alias("edit_id"),
        explanation(
            F.col("comment"),
            F.col("length_delta"),
            F.col("is_anon"),
            F.col("risk_score"),
            F.col("risk_label"),
        ).alias("explanation"),
        F.lit(EXPLAINED_BY).alias("model"),
        stamp.cast("string").alias("generated_at"),
    )


def latest_explanations(explanations: DataFrame) -> DataFrame:
    """The newest explanation per edit of a table that is only appended to."""
    newest = [F.desc("generated_at"), F.desc("explanation")]
    return latest_by_key(explanations, ["edit_id"], newest)


def answer_explanations(
    requests: DataFrame,
    predictions: DataFrame,
    explanations: DataFrame,
    now: Column | None = None,
) -> DataFrame:
    """Answers a set of requests (``edit_id``, ``force_refresh``) from the cache or by rule.

    A request made many times is answered once; repeats are folded before the shuffle, so a popular
    edit does not fill one task.

    The cache is asked first, so a stored explanation answers even for an edit that is gone. ``found``
    is false for unknown edits; rows with ``found and not cached`` are the ones to append to the
    explanations table, whose newest row per edit counts. A NULL ``force_refresh`` asks for none.
    """
    stored = latest_explanations(explanations).select(
        "edit_id",
        F.struct("explanation", "model", "generated_at").alias("_stored"),
    )
    known = predictions.withColumnRenamed("id", "edit_id").withColumn("_known", F.lit(True))
    forced = F.coalesce("force_refresh", F.lit(False)).alias("force_refresh")
    asked = requests.select("edit_id", forced).distinct()
    joined = asked.join(known, "edit_id", "left").join(stored, "edit_id", "left")
    cached = F.col("_stored").isNotNull() & ~F.col("force_refresh")
    found = cached | F.col("_known").isNotNull()
    stamp = (F.current_timestamp() if now is None else now).cast("string")
    computed = explanation(
        F.col("comment"),
        F.col("length_delta"),
        F.col("is_anon"),
        F.col("risk_score"),
        F.col("risk_label"),
    )

    def pick(field: str, fresh: Column) -> Column:
        return F.when(cached, F.col(f"_stored.{field}")).when(found, fresh).alias(field)

    return joined.select(
        "edit_id",
        pick("explanation", computed),
        pick("model", F.lit(EXPLAINED_BY)),
        cached.alias("cached"),
        pick("generated_at", stamp),
        found.alias("found"),
    )
