"""Saving, finding and applying models."""

from __future__ import annotations

import logging

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.config import SHIPPED_BANDS, RiskBands
from revlens.functions.risk import pass_through_score, positive_probability, risk_band
from revlens.operators.features import prediction_features

log = logging.getLogger(__name__)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_first_model(paths: list[str]) -> PipelineModel:
    """The first loadable of several model folders (local copy, production, staging), else an error."""
    for path in paths:
        try:
            return PipelineModel.load(path)
        except Exception as problem:
            log.warning("no model at %s: %s", path, str(problem).splitlines()[0])
    raise FileNotFoundError(f"no model in {paths}")


def score(features: DataFrame, model: PipelineModel | None, key: Column | None = None) -> DataFrame:
    """Adds ``risk_score``; without a model a placeholder fixed per key."""
    if model is None:
        return features.withColumn("risk_score", pass_through_score(key))
    kept = [F.col(c) for c in features.columns]
    return model.transform(features).select(
        *kept, positive_probability(F.col("probability")).alias("risk_score")
    )


def rescore(
    predictions: DataFrame, model: PipelineModel, bands: RiskBands = SHIPPED_BANDS
) -> DataFrame:
    """The predictions table with fresh scores and bands, in one pass over it: the rows carry their
    columns through the model, so nothing is joined back and repeated ids stay as many as they are."""
    names = predictions.columns
    own = [F.col(c).alias(f"own_{c}") for c in names]
    inputs = prediction_features(predictions, own)
    scored = score(inputs, model)
    replaced = {
        "risk_score": F.col("risk_score"),
        "risk_label": risk_band(F.col("risk_score"), bands),
        "scored": F.lit(1),
    }
    return scored.select(*[replaced.get(c, F.col(f"own_{c}")).alias(c) for c in names])
