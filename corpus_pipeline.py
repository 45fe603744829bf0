"""Raw documents to a decontaminated, mixed and sharded training corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``docs``; further columns, whatever their names, pass through.

Rows with NULL ids are documents of their own; rows that repeat an id and its text
are copies of one document and leave with near-duplicate removal. An empty table
stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewscope.llm import decontaminate, language_id, mixing, near_dedup, sharding
from reviewscope.llm.common import read_table
from reviewscope.session import materialize


def _packed(docs: DataFrame) -> DataFrame:
    """The whole row beside id and text, so that an operator's columns clash with none of it."""
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language models reject go."""
    models = language_id.fit_languages(docs.where(~language_id.held_out("doc_id")))
    return language_id.identify(_packed(docs), models).where("not rejected").select("row.*")


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    found = near_dedup.near_duplicates(docs.select("doc_id", "text"))
    # A row is known by its id and its text: NULL ids and ids that occur twice are told apart.
    # Plain columns, so that whole rows are shuffled once for the join and for what repeats.
    known = [F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id")]
    keep = found.where("kept").select(*known, "text_class").distinct()
    return (
        _packed(docs).select("row", *known, near_dedup.text_class("text").alias("text_class"))
        .join(keep, ["id", "no_id", "text_class"], "left_semi")
        .dropDuplicates(["id", "no_id", "text_class"]).select("row.*")
    )


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    found = decontaminate.find_leaks(_packed(docs), read_table(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaked_items") == 0).select("row.*")


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    named = docs.select(
        F.struct("*").alias("row"), F.col("text").alias("text"), F.col("source").alias("source"),
        F.concat_ws(":", F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")))).alias("name"),
    )
    mixed = mixing.mix_sources(named, key="name").groupBy("name").agg(F.sum("copies").cast("int").alias("copies")).where("copies > 0")
    return (
        named.select("row", "name").dropDuplicates(["name"]).join(mixed, "name")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
    )


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's shard and slot."""
    return sharding.shard_documents(docs.select("doc_id", "text")).drop("group")


STAGES = [
    ("language_id", identify_languages),
    ("near_dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark_leaks),
    ("source_mixing", mix_to_targets),
    ("sharding", assign_shards),
]
# Language models, near-duplicate components and duals are iterative: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
