"""Sentences and their tokens, with abbreviations that the texts themselves reveal.

A period ends a sentence unless it belongs to an abbreviation. What is an abbreviation is counted, not listed: one pass
over the texts adds up which piece (run without white space) follows what; everything else is read from that table.

* A word is an abbreviation when a log-likelihood ratio says that it stands with a period almost always (0.99) rather than
  as often as any word, weighted down by its length and by its share without a period, and up by periods inside it.
* After an abbreviation a sentence ends only before a capital, and only if that following word likes to start sentences (a
  second log-likelihood ratio) or is otherwise written small and never has a capital inside a sentence.

Both ratios use shares of all occurrences, so they mean the same at every size. Abbreviations and starters are looked up by
``lookup_join``: broadcast after measuring them, else shuffled with hot words split off.

Edge cases: NULL, empty and blank texts have no sentence; the end of a text ends its last sentence; words without a letter
are no abbreviations; a corpus without periods has none; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewscope.functions.text import sentence_tokens
from reviewscope.operators.lookup import lookup_join
from reviewscope.session import materialize

OPENING, CLOSING, AFTER_PERIOD = "\"'([{<", "\"')]}>", "\"')]}>,;:"
ALWAYS = 0.99          # share of occurrences with a period that an abbreviation is taken to have
LEAST_SCORE = 0.3      # from which a word is an abbreviation
PLAIN_PENALTY = 20     # weight of the occurrences without a period, as a share of those with one
LEAST_STARTER = 30     # from which a word likes to start sentences


class SentenceModel(NamedTuple):
    """``abbreviations`` (word, n_dot, n_plain, ratio, score) and ``starters`` (word, n): words that open a sentence even after one."""

    abbreviations: DataFrame
    starters: DataFrame


def pieces_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\s\p{Z}]+"), lambda p: p != "")


def word_of(piece: Column) -> Column:
    """The piece in lower case, without quotes and brackets around it and marks behind it."""
    return F.lower(F.rtrim(F.ltrim(piece, F.lit(OPENING)), F.lit(CLOSING + ".,;:!?")))


def _one_period(bare: Column) -> Column:
    return F.endswith(bare, F.lit(".")) & ~F.endswith(bare, F.lit("..")) & (bare != ".")


def has_period(piece: Column) -> Column:
    """A single period behind the word, even if a comma follows (``e.g.,``)."""
    return _one_period(F.rtrim(piece, F.lit(AFTER_PERIOD)))


def ending(piece: Column) -> Column:
    """``end`` after ``!`` or ``?``, ``dot`` after one period, ``dots`` after several, else ``open``."""
    bare = F.rtrim(piece, F.lit(CLOSING))
    return (
        F.when(F.endswith(bare, F.lit("!")) | F.endswith(bare, F.lit("?")), "end")
        .when(_one_period(bare), "dot").when(F.endswith(bare, F.lit("..")), "dots").otherwise("open")
    )


def _first_letter(piece: Column) -> Column:
    return F.substring(F.ltrim(piece, F.lit(OPENING)), 1, 1)


def is_capital(piece: Column) -> Column:
    return _first_letter(piece) != F.lower(_first_letter(piece))


def is_small(piece: Column) -> Column:
    return _first_letter(piece) != F.upper(_first_letter(piece))


def piece_uses(df: DataFrame, text: str = "text") -> DataFrame:
    """(before, before_word, piece, n): how often each piece follows what.

    ``before_word`` is kept after one period only, so the table has a few rows per distinct piece, and those pairs.
    """
    placed = df.select(pieces_of(F.col(text)).alias("ps")).select("ps", F.posexplode("ps").alias("place", "piece"))
    last = F.get("ps", F.col("place") - 1)
    before = F.coalesce(F.when(last.isNotNull(), ending(last)), F.lit("end"))
    return (
        placed.select("piece", before.alias("before"), last.alias("last"))
        .select("piece", "before", F.when(F.col("before") == "dot", word_of(F.col("last"))).alias("before_word"))
        .groupBy("before", "before_word", "piece").agg(F.count("*").alias("n"))
    )


def abbreviation_scores(uses: DataFrame) -> DataFrame:
    """(word, n_dot, n_plain, ratio, score) of every word that occurs with a period."""
    counted = uses.groupBy("piece").agg(F.sum("n").alias("n")).select(
        word_of(F.col("piece")).alias("word"), has_period(F.col("piece")).alias("dot"), "n")
    words = (
        counted.where(F.lower("word") != F.upper("word")).groupBy("word")
        .agg(F.sum(F.when(F.col("dot"), F.col("n")).otherwise(0)).alias("n_dot"), F.sum(F.when(F.col("dot"), 0).otherwise(F.col("n"))).alias("n_plain"))
    )
    total = words.agg(F.struct(F.sum("n_dot").alias("dot"), F.sum("n_plain").alias("plain"))).scalar()
    any_word = F.col("total.dot") / (F.col("total.dot") + F.col("total.plain"))
    n_inner = F.length("word") - F.length(F.replace("word", F.lit("."), F.lit("")))
    n_letters = (F.length("word") - n_inner).cast("double")
    with_period = F.col("n_dot") * F.log(F.lit(ALWAYS) / any_word)
    without = F.when(F.col("n_plain") > 0, F.col("n_plain") * F.log(F.lit(1 - ALWAYS) / (1 - any_word))).otherwise(0.0)
    weight = F.exp(-n_letters) * (n_inner + 1) * F.pow(n_letters, -PLAIN_PENALTY * F.col("n_plain") / F.col("n_dot"))
    return (
        words.where("n_dot > 0").select("*", total.alias("total"))
        .select("word", "n_dot", "n_plain", (2 * (with_period + without)).alias("ratio"), weight.alias("weight"))
        .select("word", "n_dot", "n_plain", "ratio", (F.col("ratio") * F.col("weight")).alias("score"))
    )


def _log_likelihood(k: Column, n: Column, share: Column) -> Column:
    """Of k hits in n draws at ``share``; shares of 0 and 1 that the draws agree with cost nothing."""
    hits = F.when(k > 0, k * F.log(share)).otherwise(0.0)
    return hits + F.when(n > k, (n - k) * F.log(1 - share)).otherwise(0.0)


def sentence_starters(uses: DataFrame, abbreviations: DataFrame) -> DataFrame:
    """(word, n): words before which, written large, a sentence ends even after an abbreviation.

    Places after an abbreviation say nothing about its follower and are left out of the ratio.
    """
    plain = uses.where("before <> 'dot'").select("before", "piece", "n")
    dotted = (
        uses.where("before = 'dot'").join(abbreviations.select(F.col("word").alias("before_word")), "before_word", "left_anti")
        .select(F.lit("end").alias("before"), "piece", "n")
    )
    piece, n = F.col("piece"), F.col("n")
    counts = plain.unionByName(dotted).where("before in ('end', 'open')").groupBy(word_of(piece).alias("word")).agg(
        F.sum(F.when(F.col("before") == "end", n).otherwise(0)).alias("n_first"),
        F.sum(F.when(F.col("before") == "open", n).otherwise(0)).alias("n_inside"),
        F.sum(F.when(is_small(piece), n).otherwise(0)).alias("n_small"),
        F.sum(F.when(is_capital(piece) & (F.col("before") == "open"), n).otherwise(0)).alias("n_capital_inside"),
    )
    total = counts.agg(F.struct(F.sum("n_first").alias("first"), F.sum("n_inside").alias("inside"))).scalar()
    first, inside, firsts, insides = F.col("n_first"), F.col("n_inside"), F.col("total.first"), F.col("total.inside")
    both, share_first, share_inside = (first + inside) / (firsts + insides), F.try_divide(first, firsts), F.try_divide(inside, insides)
    ratio = 2 * (
        _log_likelihood(first, firsts, share_first) + _log_likelihood(inside, insides, share_inside)
        - _log_likelihood(first, firsts, both) - _log_likelihood(inside, insides, both)
    )
    likes_to_start = (share_first > share_inside) & (ratio >= LEAST_STARTER)
    only_first = (F.col("n_small") > 0) & (F.col("n_capital_inside") == 0)
    return (
        counts.where(F.lower("word") != F.upper("word")).select("*", total.alias("total"))
        .where(F.coalesce(likes_to_start, F.lit(False)) | only_first)
        .select("word", (first + inside).alias("n"))
    )


def sentence_model(df: DataFrame, text: str = "text") -> SentenceModel:
    """Abbreviations and starters of the texts of ``df``, from one pass over them."""
    uses = materialize(piece_uses(df, text), "uses")
    abbreviations = materialize(abbreviation_scores(uses).where(F.col("score") >= LEAST_SCORE), "abbreviations")
    return SentenceModel(abbreviations, materialize(sentence_starters(uses, abbreviations), "starters"))


def _inner_periods(df: DataFrame, key: str, text: str, model: SentenceModel) -> DataFrame:
    """(key, places): the pieces of each text whose period does not end a sentence. Only words with a period are looked up."""
    placed = df.select(F.col(key), pieces_of(F.col(text)).alias("ps")).select(key, "ps", F.posexplode("ps").alias("place", "piece"))
    follow = F.get("ps", F.col("place") + 1)
    dotted = (
        placed.select(key, "place", "piece", follow.alias("follow"))
        .where((ending(F.col("piece")) == "dot") & F.col("follow").isNotNull())
        .select(key, "place", word_of(F.col("piece")).alias("word"),
                F.when(is_capital(F.col("follow")), word_of(F.col("follow"))).alias("next_word"))
    )
    known = model.abbreviations.select("word", F.col("n_dot").alias("n"), F.lit(True).alias("short"))
    starters = model.starters.select(F.col("word").alias("next_word"), "n", F.lit(True).alias("starts"))
    inner = lookup_join(dotted, known, ["word"], "n", [key, "place"]).where("short")
    inner = lookup_join(inner, starters, ["next_word"], "n", [key, "place"]).where(F.col("starts").isNull())
    return inner.groupBy(key).agg(F.collect_list("place").alias("places"))


def sentences(df: DataFrame, key: str, text: str = "text", model: SentenceModel | None = None) -> DataFrame:
    """(key, sentence, tokens): numbered from 0 per text; ``key`` is unique and never NULL."""
    model = model or sentence_model(df, text)
    inner = _inner_periods(df, key, text, model)
    cut = (
        df.select(F.col(key), pieces_of(F.col(text)).alias("ps")).where(F.size("ps") > 0)
        .join(inner, key, "left").withColumn("last", F.size("ps") - 1)
    )
    follow_is_capital = lambda i: F.coalesce(is_capital(F.get("ps", i + 1)), F.lit(True))
    kind = lambda i: ending(F.get("ps", i))
    ends = F.filter(
        F.sequence(F.lit(0), F.col("last")),
        lambda i: (i == F.col("last")) | kind(i).isin("end", "dot") | ((kind(i) == "dots") & follow_is_capital(i)),
    )
    # A difference of sets, so that a long text with many abbreviations takes linear time.
    cut = cut.withColumn("ends", F.array_except(ends, F.coalesce("places", F.array().cast("array<int>"))))
    starts = F.concat(F.array(F.lit(0)), F.transform(F.slice("ends", 1, F.size("ends") - 1), lambda e: e + 1))
    spans = F.arrays_zip(starts.alias("first"), F.col("ends").alias("end"))
    return (
        cut.select(key, "ps", F.posexplode(spans).alias("sentence", "span"))
        .select(key, "sentence", F.array_join(F.slice("ps", F.col("span.first") + 1, F.col("span.end") - F.col("span.first") + 1), " ").alias("line"))
        .select(key, "sentence", sentence_tokens(F.col("line")).alias("tokens"))
    )
