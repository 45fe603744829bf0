"""Word frequencies per rating and the most frequent words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewscope.functions.text import is_stop_word, raw_tokens, strip_punctuation
from reviewscope.functions.wordlists import ENGLISH_STOP_WORDS
from reviewscope.schema import RATINGS

GROUP_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"


def word_freq_by_rating(
    df: DataFrame, text: str = "text", rating: str = "stars",
    stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """Counts of lower-cased words without stop words and punctuation, per rating.

    All five ratings are counted in one pass, side by side, so that a word is
    grouped once and not once per rating. No word rule looks across a blank:
    the texts are first cut at blanks and the pieces counted, and the costly
    pattern runs once per distinct piece instead of once per text. Other white
    space inside a piece is left to that second step.
    """
    sides = [f"_n{r}" for r in RATINGS]
    pieces = (
        df.where(F.col(rating).isin(RATINGS))
        .select(rating, F.explode(F.split(text, " ")).alias("piece"))
        .where(F.col("piece") != "")
        .groupBy("piece").agg(*[F.count_if(F.col(rating) == r).alias(c) for r, c in zip(RATINGS, sides)])
    )
    words = (
        pieces.select(*sides, F.explode(raw_tokens(F.col("piece"))).alias("token"))
        .where(~is_stop_word(F.col("token"), stop_words))
        .select(*sides, F.lower(strip_punctuation(F.col("token"))).alias("word"))
        .where(F.col("word") != "")
        .groupBy("word").agg(*[F.sum(c).alias(c) for c in sides])
    )
    per_rating = F.inline(F.array(*[
        F.struct(F.lit(r).alias(rating), F.col(c).alias("n")) for r, c in zip(RATINGS, sides)
    ]))
    return words.select("word", per_rating).where(F.col("n") > 0).select(rating, "word", "n")


def top_k_per_group(
    df: DataFrame, group: str, score: str, tie_break: str, k: int, shards: int = 512,
) -> DataFrame:
    """The ``k`` highest rows per group; ``tie_break`` (ascending) decides between equals.

    For a small k Spark keeps only k rows per group and partition ahead of the
    shuffle. Beyond its limit the same is done with an explicit first round, so
    that no task sorts a whole group.
    """
    order = [F.desc(score), F.col(tie_break)]
    if k > int(df.sparkSession.conf.get(GROUP_LIMIT_CONF)):
        shard = F.pmod(F.xxhash64(tie_break), F.lit(shards))
        df = _ranked(df.withColumn("_shard", shard), [group, "_shard"], order, k).drop("_shard", "rank")
    return _ranked(df, [group], order, k)


def _ranked(df: DataFrame, groups: list[str], order: list, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def top_words_by_rating(df: DataFrame, k: int = 25, text: str = "text", rating: str = "stars") -> DataFrame:
    return top_k_per_group(word_freq_by_rating(df, text, rating), rating, "n", "word", k)
