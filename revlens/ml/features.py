"""Feature stages of the classifier."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    RegexTokenizer,
    StandardScaler,
    VectorAssembler,
)
from pyspark.sql import DataFrame

from revlens.config import TrainConfig

# assembled in this order. fixed values
NUMERIC = ("length_delta", "is_anon_int", "hour_of_day", "day_of_week")


def text_stages(cfg: TrainConfig, comment: str = "comment_clean", title: str = "title_clean") -> list:
    """Stateless part: tokens and hashed term counts."""
    stages = []
    for name, column, width in (
        ("comment", comment, cfg.comment_buckets),
        ("title", title, cfg.title_buckets),
    ):
        stages.append(
            RegexTokenizer(
                inputCol=column,
                outputCol=f"{name}_tokens",
                pattern=r"\s+",
                toLowercase=True,
                minTokenLength=2,
            )
        )
        stages.append(
            HashingTF(inputCol=f"{name}_tokens", outputCol=f"{name}_tf", numFeatures=width)
        )
    return stages


def fitted_stages(cfg: TrainConfig) -> list:
    """Part that learns from data: inverse document frequencies and scaling."""
    return [
        IDF(inputCol="comment_tf", outputCol="comment_idf", minDocFreq=cfg.min_doc_freq),
        IDF(inputCol="title_tf", outputCol="title_idf", minDocFreq=cfg.min_doc_freq),
        VectorAssembler(
            inputCols=["comment_idf", "title_idf", *NUMERIC],
            outputCol="raw_features",
            handleInvalid="keep",
        ),
        StandardScaler(
            inputCol="raw_features", outputCol="features", withMean=False, withStd=True
        ),
    ]


def feature_pipeline(cfg: TrainConfig) -> Pipeline:
    return Pipeline(stages=[*text_stages(cfg), *fitted_stages(cfg)])


def fit_features(df: DataFrame, cfg: TrainConfig) -> PipelineModel:
    return feature_pipeline(cfg).fit(df)


def classifier(cfg: TrainConfig) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="features",
        labelCol="label",
        probabilityCol="probability",
        rawPredictionCol="raw_prediction",
        maxIter=cfg.max_iter,
        regParam=cfg.reg_param,
        elasticNetParam=cfg.elastic_net,
    )
