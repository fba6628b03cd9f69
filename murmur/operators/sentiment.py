"""Training and applying a two-class sentiment model."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def train_sentiment(
    labelled: DataFrame, text: str = "text", label: str = "label", features: int = 1 << 16, epochs: int = 20
) -> PipelineModel:
    """Model for texts labelled 0 or 1."""
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        LogisticRegression(featuresCol="_tfidf", labelCol=label, maxIter=epochs, regParam=0.01),
    ]
    return Pipeline(stages=stages).fit(labelled)


def apply_sentiment(model: PipelineModel, docs: DataFrame) -> DataFrame:
    """``docs`` with the predicted label and its confidence."""
    chance = vector_to_array("probability")
    out = model.transform(docs)
    return out.select(
        *docs.columns,
        F.when(F.col("prediction") == 1, "positive").otherwise("negative").alias("predicted"),
        F.array_max(chance).alias("confidence"),
    )


def split(labelled: DataFrame, key: str, test_percent: int = 20) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of the key, so every run splits alike."""
    bucket = F.pmod(F.xxhash64(key), F.lit(100))
    return labelled.filter(bucket >= test_percent), labelled.filter(bucket < test_percent)


def area_under_roc(model: PipelineModel, test: DataFrame, label: str = "label") -> float:
    return BinaryClassificationEvaluator(labelCol=label).evaluate(model.transform(test))
