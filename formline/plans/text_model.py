"""Binary text classification with a distributed linear model."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from formline.functions.outcomes import TEXT_LABELS, mapped
from formline.operators.encode import text_or_nan, words
from formline.operators.metrics import argmax

HASH_FEATURES = 1 << 18


def with_words(df: DataFrame, text: str = "text", length: int | None = None) -> DataFrame:
    """The words the model sees: all of them, or the first ``length``."""
    listed = words(text_or_nan(text))
    return df.withColumn("words", F.slice(listed, 1, length) if length else listed)


def fit_text_model(train: DataFrame, text: str = "text", label: str = "label", rounds: int = 50) -> PipelineModel:
    stages = [
        HashingTF(inputCol="words", outputCol="counts", numFeatures=HASH_FEATURES),
        IDF(inputCol="counts", outputCol="features"),
        LogisticRegression(labelCol=label, maxIter=rounds, regParam=0.01),
    ]
    seen = with_words(train, text).select("words", label).persist()
    try:
        return Pipeline(stages=stages).fit(seen)
    finally:
        seen.unpersist()


def score_texts(model: PipelineModel, df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``p_fake``, the class and its name to any texts."""
    scored = model.transform(with_words(df, text)).withColumn("_scores", vector_to_array("probability"))
    return scored.select(
        *df.columns,
        F.get("_scores", F.lit(1)).alias("p_fake"),
        argmax(F.col("_scores")).alias("y_hat"),
        mapped(argmax(F.col("_scores")), TEXT_LABELS).alias("verdict"),
    )
