"""Risk scores and bands."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from revlens.config import SHIPPED_BANDS, RiskBands
from revlens.functions.keys import hash32
from revlens.functions.labels import risky_comment
from revlens.functions.text import is_blank


def risk_band(score: Column, bands: RiskBands = SHIPPED_BANDS) -> Column:
    """HIGH / MEDIUM / LOW; a NULL score counts as 0."""
    score = F.coalesce(score, F.lit(0.0))
    return F.when(score >= bands.high, "HIGH").when(score >= bands.medium, "MEDIUM").otherwise("LOW")


def heuristic_score(comment: Column, user: Column, anon: Column, delta: Column) -> Column:
    """Score without a model: a base rate plus weights per signal. The weights are fixed values."""
    anon = F.coalesce(anon.cast("boolean"), F.lit(False))
    delta = F.coalesce(delta.cast("double"), F.lit(0.0))
    comment = F.coalesce(comment, F.lit(""))
    user = F.coalesce(user, F.lit(""))
    weighted = (
        (anon, 0.18),
        (delta < -500.0, 0.22),
        (F.abs(delta) > 1000.0, 0.10),
        (anon & is_blank(comment), 0.10),
        (F.lower(F.ltrim(user)).startswith("bot"), -0.03),
        (risky_comment(comment), 0.25),
    )
    score = F.lit(0.05)
    for signal, weight in weighted:
        score = score + F.when(signal, weight).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(score, F.lit(0.99)))


def pass_through_score(key: Column) -> Column:
    """Placeholder score in [0.1, 0.5) for running without a model, fixed per key."""
    return hash32(key, "pass") / F.lit(4294967296.0) * 0.4 + 0.1


def linear_score(intercept: float, weights: Mapping[str, float]) -> Column:
    """Logistic score of numeric columns under given weights."""
    margin = F.lit(float(intercept))
    for name, weight in weights.items():
        margin = margin + F.col(name).cast("double") * F.lit(float(weight))
    return 1.0 / (1.0 + F.exp(-margin))


def positive_probability(probability: Column) -> Column:
    """Probability of class 1 out of a classifier's vector, 0.5 where there is none."""
    return F.when(probability.isNotNull(), vector_to_array(probability)[1]).otherwise(0.5)
