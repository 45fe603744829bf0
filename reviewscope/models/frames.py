"""Model input frames and a stable row order for fitting."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from reviewscope.functions.numbers import binarize

ROWS_PER_PARTITION = 20_000
ID_FEATURES = ["user_id", "review_id", "business_id"]


def stable_order(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Place rows by a hash of the unique ``key`` and sort inside each partition.

    Fits with the same seed then see the same partitions, whatever the input
    layout was: hash placement needs no sampled range bounds, and a fixed
    partition number is not merged at run time. Without ``partitions`` the
    session's number of shuffle partitions holds, whatever the row count.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, key).sortWithinPartitions(key)


def search_partitions(df: DataFrame) -> int:
    """One for every ROWS_PER_PARTITION counted rows, at most the session's number of shuffle partitions.

    A search fits with many short jobs, whose cost on few rows is their number of tasks.
    """
    return min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), max(1, -(-df.count() // ROWS_PER_PARTITION)))


@contextmanager
def kept_rows(rows: DataFrame) -> Iterator[DataFrame]:
    """Keep ``rows`` while a fit passes over them again and again, so that the source is read once."""
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def id_frame(df: DataFrame, *keep: str) -> DataFrame:
    """Three ids and the 0/1 label."""
    return df.select(*keep, *ID_FEATURES, binarize(F.col("stars")).alias("label"))


def rating_frame(df: DataFrame, *keep: str) -> DataFrame:
    """User, business and the 0/1 label; ids must be whole numbers within int range."""
    return df.select(
        *keep, F.col("user_id").cast("int"), F.col("business_id").cast("int"),
        binarize(F.col("stars")).alias("label"),
    )


def text_frame(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, "text", binarize(F.col("stars")).alias("label"))


def assemble(columns: list[str] = ID_FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol="features")


def assembled_array(df: DataFrame, columns: list[str] = ID_FEATURES) -> DataFrame:
    """``df`` with its feature vector shown as an array."""
    vectors = assemble(columns).transform(df)
    return vectors.withColumn("features", vector_to_array("features"))
