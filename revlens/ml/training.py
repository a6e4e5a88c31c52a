"""Cross-validated training.

The search gives the scores of a cross-validation that refits the whole feature chain for every
grid point, with less work:

* tokens and hashed counts have no state, so they are computed once and written;
* IDF and scaling do not depend on the grid, so they are fitted once per fold, on its training rows;
* with ``share_fits``, points that differ only in the iteration limit share one fit when the
  optimizer stopped by itself before the lower limit, as the larger limit then leads to the same
  coefficients. ``TrainResult.fits`` says how many were made.
"""

from __future__ import annotations

import time
from collections import defaultdict
from dataclasses import dataclass, field, replace
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.config import TrainConfig
from revlens.ml.evaluation import evaluate
from revlens.ml.features import NUMERIC, classifier, fitted_stages, text_stages
from revlens.operators.splits import with_fold, with_split
from revlens.operators.stats import require_rows
from revlens.session import stage_table


@dataclass
class TrainResult:
    model: PipelineModel
    best: dict[str, float]
    cv_scores: dict[tuple[float, int], float]
    metrics: dict[str, float]
    rows: dict[str, int]
    seconds: float
    test: DataFrame
    scored: DataFrame
    fits: int = 0
    folds: int = field(default=3)


def hashed_rows(df: DataFrame, key: str, cfg: TrainConfig) -> tuple[DataFrame, PipelineModel]:
    """Key, label, hashed counts and numbers of every row, and the stateless stages that made them."""
    stages = PipelineModel(stages=text_stages(cfg))
    hashed = stages.transform(df)
    columns = [key, F.col("label").cast("double").alias("label"), "comment_tf", "title_tf", *NUMERIC]
    return hashed.select(*columns), stages


# what the metrics read of a scored row; written once, as several of them make a pass each
SCORED = ("raw_prediction", "probability", "prediction")


def _auc() -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="raw_prediction", metricName="areaUnderROC"
    )


def _fit_limits(
    estimator: LogisticRegression, train: DataFrame, reg: float, limits: tuple[int, ...], share: bool
) -> dict[int, LogisticRegressionModel]:
    """Models per iteration limit, lowest limit first."""
    models: dict[int, LogisticRegressionModel] = {}
    done = None
    for limit in sorted(limits):
        if done is None:
            settings = {estimator.regParam: reg, estimator.maxIter: limit}
            model = estimator.fit(train, settings)
            if share and model.summary.totalIterations < limit:
                done = model
        else:
            model = done
        models[limit] = model
    return models


def cross_validate(
    hashed: DataFrame, cfg: TrainConfig, fold: str = "fold"
) -> tuple[dict[tuple[float, int], float], int]:
    """Mean AUC per (regParam, maxIter) over the folds, and the number of fits made."""
    sums: dict[tuple[float, int], float] = defaultdict(float)
    fits = 0
    for i in range(cfg.folds):
        train, held = hashed.filter(F.col(fold) != i), hashed.filter(F.col(fold) == i)
        features = Pipeline(stages=fitted_stages(cfg)).fit(train)
        train, held = (
            features.transform(part).select("label", "features").persist(StorageLevel.MEMORY_AND_DISK)
            for part in (train, held)
        )

        def score(reg: float, train=train, held=held) -> tuple[int, dict[tuple[float, int], float]]:
            models = _fit_limits(classifier(cfg), train, reg, cfg.grid_iter, cfg.share_fits)
            by_model = {id(m): _auc().evaluate(m.transform(held)) for m in models.values()}
            return len(by_model), {(reg, k): by_model[id(m)] for k, m in models.items()}

        with ThreadPool(min(cfg.parallelism, len(cfg.grid_reg))) as pool:
            for made, scores in pool.map(score, cfg.grid_reg):
                fits += made
                for point, value in scores.items():
                    sums[point] += value / cfg.folds
        train.unpersist()
        held.unpersist()
    return dict(sums), fits


def best_point(scores: dict[tuple[float, int], float]) -> tuple[float, int]:
    """The first grid point with the highest score, in grid order."""
    return max(scores, key=lambda point: (scores[point], -point[0], -point[1]))


def fit_final(hashed: DataFrame, text: PipelineModel, cfg: TrainConfig) -> PipelineModel:
    """Scoring model over cleaned texts: stateless stages, fitted stages, classifier."""
    features = Pipeline(stages=fitted_stages(cfg)).fit(hashed)
    model = classifier(cfg).fit(features.transform(hashed).select("label", "features"))
    return PipelineModel(stages=[*text.stages, *features.stages, model])


def train(
    labeled: DataFrame, key: str, cfg: TrainConfig, scored_path: str | None = None
) -> TrainResult:
    """Guard, split, search, refit on all training rows, evaluate on the held-out part.

    The held-out part's scores are written to ``scored_path``, else to the scratch folder.
    """
    total = require_rows(labeled, cfg.min_rows)
    parts = with_split(labeled, key, cfg.train_percent)
    test = parts.filter(F.col("split") == "test")
    hashed, text = hashed_rows(parts.filter(F.col("split") == "train"), key, cfg)
    hashed = stage_table(with_fold(hashed, key, cfg.folds), "train-rows")

    n_train = hashed.count()
    start = time.monotonic()
    scores, fits = cross_validate(hashed, cfg)
    reg, limit = best_point(scores)
    chosen = replace(cfg, reg_param=reg, max_iter=limit)
    model = fit_final(hashed, text, chosen)
    seconds = time.monotonic() - start
    columns = [key, F.col("label").cast("double").alias("label"), *SCORED]
    scored = model.transform(test).select(*columns)
    if scored_path is None:
        scored = stage_table(scored, "test-scores")
    else:
        scored.write.mode("overwrite").parquet(scored_path)
        scored = labeled.sparkSession.read.schema(scored.schema).parquet(scored_path)
    metrics = evaluate(scored) | {"training_time_seconds": round(seconds, 1)}
    return TrainResult(
        model=model,
        best=best_params(model),
        cv_scores=scores,
        metrics=metrics,
        rows={"train": n_train, "test": total - n_train},
        seconds=seconds,
        test=test,
        scored=scored,
        fits=fits + 1,
        folds=cfg.folds,
    )


def best_params(model: PipelineModel) -> dict[str, float]:
    last = model.stages[-1]
    return {"best_reg_param": last.getRegParam(), "best_max_iter": last.getMaxIter()}
