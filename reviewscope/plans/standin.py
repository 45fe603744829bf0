"""Review-shaped views of the given tables.

``events`` supplies the ratings and ``documents`` the texts. Plans that need
no text start from ``ratings`` and skip the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewscope.functions.calendar import DATE_FORMAT
from reviewscope.operators.lookup import broadcast_if_small
from reviewscope.schema import ID_COLUMNS, REVIEW_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """One row per event: ids, date, three vote counts, one to five stars, and ``keep`` columns."""
    kind, whole = F.col("event_type"), F.floor("value").cast("bigint")
    stars = (
        F.when(kind == "error", 1).when(kind == "view", 2).when(kind == "click", 3)
        .when(kind == "signup", 4).otherwise(5)
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("review_id"), "user_id",
        ((F.col("event_id") * 7919 + 13) % 997).alias("business_id"),
        F.col("ts").alias("date"),
        (whole % 7).cast("int").alias("funny"), (whole % 5).cast("int").alias("cool"),
        (whole % 11).cast("int").alias("useful"), stars.alias("stars"), *keep,
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ratings`` with a text each; the texts are dealt out in turn, so no text is hot.

    Both sides are shuffled by id: a broadcast of short ratings would leave all texts to the few tasks that scan them.
    """
    size = table(spark, sf_dir, "documents").agg((F.max("doc_id") + 1).alias("n")).scalar()
    rated = ratings(spark, sf_dir).withColumn("doc_id", F.col("review_id") % size)
    return rated.join(texts(spark, sf_dir).hint("merge"), "doc_id").select(REVIEW_COLUMNS)


def dated(df: DataFrame) -> DataFrame:
    """Date as text, the way the raw files hold it."""
    return df.withColumn("date", F.date_format("date", DATE_FORMAT))


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell as byte-literal text, ids as hexadecimal strings."""
    df = dated(reviews(spark, sf_dir))
    return df.select([
        F.concat(F.lit("b'"), F.md5(F.col(c).cast("string")) if c in ID_COLUMNS else F.col(c).cast("string"),
                 F.lit("'")).alias(c)
        for c in df.columns
    ])


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))


def labelled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with a 0/1 label that depends on them."""
    labels = _labels(spark, sf_dir)
    return texts(spark, sf_dir).join(broadcast_if_small(labels, labels.count()), "doc_id")


def rule_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of a fixed rule: long texts are good."""
    lengths = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return lengths.join(_labels(spark, sf_dir), "doc_id").select(
        "doc_id", "n_chars", (F.col("n_chars") > 1400).cast("double").alias("prediction"),
        F.col("label").alias("trueLabel"),
    )
