"""Sentiment from review text: hashed words and logistic regression."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, StopWordsRemover, Tokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewscope.models.frames import kept_rows, stable_order

WORDS, KEPT, FEATURES = "words", "kept_words", "features"


def text_stages(text: str = "text") -> list:
    """Lower-cased white-space words, stop words removed, counted in 2^18 hash buckets."""
    return [
        Tokenizer(inputCol=text, outputCol=WORDS),
        StopWordsRemover(inputCol=WORDS, outputCol=KEPT),
        HashingTF(inputCol=KEPT, outputCol=FEATURES),
    ]


def regression(
    label: str = "label", max_iter: int = 10, reg: float = 0.01, aggregation_depth: int = 2,
) -> LogisticRegression:
    """Each task sends a 2 MB gradient; a greater depth merges more of them before the driver."""
    return LogisticRegression(
        labelCol=label, featuresCol=FEATURES, maxIter=max_iter, regParam=reg,
        aggregationDepth=aggregation_depth,
    )


def fit_sentiment(train: DataFrame, key: str, text: str = "text", label: str = "label", **settings) -> PipelineModel:
    """Fitted text stages and regression.

    Words are hashed where the texts are read; only key, vector and label move.
    """
    stages = text_stages(text)
    hashed = PipelineModel(stages=stages).transform(train).select(key, FEATURES, label)
    with kept_rows(stable_order(hashed, key)) as rows:
        model = regression(label, **settings).fit(rows)
    return PipelineModel(stages=[*stages, model])


def sparse_entries(vector: Column) -> Column:
    """Non-zero (bucket, weight) entries of a sparse vector, without unpacking its zeros."""
    parts = F.regexp_extract_all(vector.cast("string"), F.lit(r"\[[^\]]*\]"), F.lit(0))
    buckets = F.from_json(F.get(parts, F.lit(0)), "array<int>")
    weights = F.from_json(F.get(parts, F.lit(1)), "array<double>")
    return F.zip_with(
        buckets, weights, lambda b, w: F.struct(b.alias("bucket"), w.alias("weight")),
    )
