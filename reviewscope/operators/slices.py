"""First rows in key order, hash splits and random splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewscope.operators.ordering import PART, POS, block_totals, stage_in_order


def peek(df: DataFrame, n: int, key: str) -> DataFrame:
    """The ``n`` smallest rows by ``key``, for looking at: they meet in one task. For many use ``first_rows``."""
    return df.orderBy(key).limit(n)


def first_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """The ``n`` smallest rows by the unique column ``key``; rows without a key are never among them.

    If keys repeat, all rows that share the last key are returned.

    A big ``limit`` would gather all n rows in one task. Here only the keys are
    sorted, the n-th smallest is looked up, and the slice is a plain filter on
    it, which the file scan can use.
    """
    if n < 1:
        return df.where(F.lit(False))
    staged = stage_in_order(df.select(key).where(F.col(key).isNotNull()), key, name="slice")
    blocks = block_totals(staged.withColumn("_all", F.lit(0)), ["_all"], F.lit(1))
    block = blocks.where(
        (F.col("before") < n) & (F.col("before") + F.col("block_total") >= n)
    ).first()
    if block is None:
        return df.where(F.col(key).isNotNull())
    place = n - 1 - block["before"] + block["block_first"]
    cutoff = staged.where((F.col(PART) == block[PART]) & (F.col(POS) == place)).first()[key]
    return df.where(F.col(key) <= F.lit(cutoff))


def in_training_part(key: Column, tenths: int = 7) -> Column:
    """True for about ``tenths``/10 of all keys, always the same ones.

    Depends on the key alone, so reruns, lost executors and other partitionings
    do not move a row from one part to the other.
    """
    bucket = F.conv(F.substr(F.md5(key.cast("string")), F.lit(1), F.lit(4)), 16, 10).cast("int")
    return bucket % 10 < tenths


def hash_split(df: DataFrame, key: str, tenths: int = 7) -> DataFrame:
    """Add ``split`` = train or test."""
    part = F.when(in_training_part(F.col(key), tenths), "train").otherwise("test")
    return df.withColumn("split", part)


def train_test(df: DataFrame, key: str, tenths: int = 7, label: str = "label") -> tuple[DataFrame, DataFrame]:
    """Training part, and test part with the label renamed to ``trueLabel``."""
    inside = in_training_part(F.col(key), tenths)
    return df.where(inside), df.where(~inside).withColumnRenamed(label, "trueLabel")


def random_split(df: DataFrame, key: str, weights: list[float], seed: int) -> list[DataFrame]:
    """Seeded random split; a fixed number of partitions by ``key`` makes it repeatable."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, key).randomSplit(weights, seed)
