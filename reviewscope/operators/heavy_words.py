"""Most frequent words per rating without shuffling the vocabulary.

Texts are cut at blanks and line breaks, and equal pieces are counted where they are read. Pieces of plain letters and
digits with such marks at their end as always come apart are words at once; the costly word rules run on the other pieces only, once per
piece and stretch of texts. The passes read a short table of (rating, word, n) instead of every occurrence.

Pass 1 adds the words up in a few rows of hashed counters per rating: a table whose size depends on neither rows nor
vocabulary, and in which every counter is an upper bound of each of its words. Pass 2 counts exactly the words whose
counters are all among the largest; the k-th of those counts is a floor that the result cannot fall below. A word with
a counter below the floor is out for certain. Where other words could still reach it, pass 3 counts those too. The
result is exact in every case; only the number of counted words depends on the data.

Edge cases: rows whose rating is none of the given ones and NULL texts are left out; equal counts go by the word, for
the last place too; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewscope.functions.text import is_stop_word, raw_tokens, strip_punctuation
from reviewscope.functions.wordlists import ENGLISH_STOP_WORDS
from reviewscope.operators.words import top_k_per_group
from reviewscope.schema import RATINGS
from reviewscope.session import materialize

HASH_ROWS, COUNTERS, FIRST_CANDIDATES = 3, 1 << 15, 8
BATCH_BYTES = 16 << 20    # of texts whose pieces are counted at once
KEPT_COUNTS = 1_000_000   # different pieces that a task holds before it sends them on
OUT_ROWS = 100_000
NO_RATING = -1 << 63
PIECES = ["rating", "piece", "n", "done"]
# Words of these letters, whose lower case is the same everywhere, and the marks that always come apart at the end of one.
PLAIN = "^[A-Za-z0-9À-ÖØ-öø-ÿ]+(?:[.,:]|[;@#$%&?!]+)?$"
TWO_WORDS = "cannot|gimme|gonna|gotta|lemme|wanna"


def words_of(text: Column, stop_words: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Lower-cased words without stop words and punctuation, in text order."""
    kept = F.filter(raw_tokens(text), lambda t: (t != "") & ~is_stop_word(t, stop_words))
    return F.filter(F.transform(kept, lambda t: F.lower(strip_punctuation(t))), lambda w: w != "")


def _runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows in runs of about BATCH_BYTES; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    row = 0
    while row < len(ends):
        done = int(ends[row - 1]) if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, done + BATCH_BYTES, "right")))
        yield row, stop
        row = stop


def _run_counts(ratings: np.ndarray, texts: pa.Array, stop_words: pa.Array) -> pa.Table:
    """(rating, piece, n, done) of a run of texts; a piece that is done is a word, the others need the word rules."""
    texts = texts.cast(pa.large_string())
    # No rule looks across white space either. But a next-line character counts as an end of text where it comes last.
    unbroken = pc.replace_substring(texts, "\n", " ")
    if not re.search(b"\xc2\x85", unbroken.buffers()[2] or b""):
        texts = unbroken
    cut = pc.split_pattern(texts, " ")
    pieces = pa.table([pa.array(ratings).take(pc.list_parent_indices(cut)), pc.list_flatten(cut).cast(pa.string())], PIECES[:2])
    counts = pieces.group_by(PIECES[:2], use_threads=False).aggregate([([], "count_all")]).rename_columns(PIECES[:3])
    counts = counts.filter(pc.not_equal(counts.column("piece"), ""))
    piece = counts.column("piece")
    word = pc.utf8_lower(pc.ascii_rtrim(piece, characters=".,:;@#$%&?!"))
    done = pc.and_not(pc.match_substring_regex(piece, PLAIN), pc.match_substring_regex(word, TWO_WORDS))
    counts = counts.set_column(1, "piece", pc.if_else(done, word, piece)).append_column("done", done)
    return counts.filter(pc.invert(pc.and_(done, pc.is_in(word, stop_words))))


def _merged(counts: list[pa.Table]) -> pa.Table:
    table = pa.concat_tables(counts).group_by(["rating", "piece", "done"], use_threads=False).aggregate([("n", "sum")])
    return table.rename_columns(["rating", "piece", "done", "n"]).select(PIECES)


def _count_pieces(stop_words: Sequence[str]):
    """(rating, piece, n, done): runs are added up until more than KEPT_COUNTS different ones are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stops, held, rows, limit = pa.array(stop_words, pa.string()), [], 0, 2 * KEPT_COUNTS
        for batch in batches:
            ratings = batch.column(0).to_numpy(zero_copy_only=False)
            for row, stop in _runs(batch.column(1)):
                held.append(_run_counts(ratings[row:stop], batch.column(1).slice(row, stop - row), stops))
                rows += held[-1].num_rows
                if rows > limit:
                    held = [_merged(held)]
                    if held[0].num_rows > KEPT_COUNTS:
                        yield from held.pop().to_batches(max_chunksize=OUT_ROWS)
                    rows = sum(x.num_rows for x in held)
        if held:
            yield from _merged(held).to_batches(max_chunksize=OUT_ROWS)

    return run


def counted_words(df: DataFrame, text: str, rating: str, stop_words: Sequence[str]) -> DataFrame:
    """(rating, word, n): occurrences, added up per piece and task as far as they fit; a word has many rows. No rule looks across a blank."""
    rated = df.where(F.col(rating).isin(RATINGS)).select(F.col(rating).cast("int").alias("rating"), F.col(text).alias("text"))
    pieces = rated.mapInArrow(_count_pieces(list(stop_words)), "rating int, piece string, n bigint, done boolean")
    found = F.when(F.col("done"), F.array("piece")).otherwise(words_of(F.col("piece"), stop_words))
    return pieces.select(F.col("rating").cast(df.schema[rating].dataType).alias(rating), F.explode(found).alias("word"), "n")


def counter_of(word: Column, row: int, counters: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(row), word), F.lit(counters)).cast("int")


def _occurrences(words: DataFrame) -> Column:
    """Of the words in a group; a row without ``n`` is one of them."""
    return F.sum("n") if "n" in words.columns else F.count("*")


def counter_table(words: DataFrame, rating: str, hash_rows: int, counters: int) -> DataFrame:
    """(rating, row, counter, n): at most ratings x hash_rows x counters rows, added up in arrays ahead of the shuffle."""
    n = F.col("n") if "n" in words.columns else F.lit(1)
    places = [counter_of(F.col("word"), r, counters).alias(f"_at_{r}") for r in range(hash_rows)]
    added = words.select(F.coalesce(F.col(rating).cast("bigint"), F.lit(NO_RATING)).alias("rating"), n.cast("bigint").alias("n"), *places).mapInArrow(
        _add_up(hash_rows, counters), "rating bigint, row int, counter int, n bigint")
    shown = F.when(F.col("rating") != NO_RATING, F.col("rating")).cast(words.schema[rating].dataType).alias(rating)
    return added.groupBy("rating", "row", "counter").agg(F.sum("n").alias("n")).select(shown, "row", "counter", "n")


def _add_up(hash_rows: int, counters: int):

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            ratings, n, *places = (batch.column(i).to_numpy() for i in range(2 + hash_rows))
            for rating in np.unique(ratings).tolist():
                here = np.flatnonzero(ratings == rating)
                table = sums.setdefault(rating, np.zeros((hash_rows, counters), np.int64))
                for row, place in enumerate(places):
                    table[row] += np.bincount(place[here], n[here], counters).astype(np.int64)
        for rating, table in sums.items():
            row, counter = np.nonzero(table)
            for a in range(0, len(row), OUT_ROWS):
                r, c = row[a:a + OUT_ROWS], counter[a:a + OUT_ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(r), rating)), pa.array(r.astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(table[r, c])],
                    ["rating", "row", "counter", "n"])

    return run


def _counted(words: DataFrame, rating: str, floors: dict[int, int], sketch: DataFrame, hash_rows: int, counters: int) -> DataFrame:
    """Exact counts of the words whose counters all reach their rating's floor.

    Those counters are broadcast, per hash row at most ratings x counters short rows (2 MB by default).
    """
    floor = F.lit(None).cast("bigint")
    for r, n in floors.items():
        floor = F.when(F.col(rating) == r, F.lit(n)).otherwise(floor)
    tall = sketch.where(F.col("n") >= floor).select(
        F.col(rating).alias("_rating"), F.col("counter").alias("_counter"), F.col("row").alias("_row"))
    out = words
    for r in range(hash_rows):
        row = F.broadcast(tall.where(F.col("_row") == r).drop("_row"))
        out = out.join(row, (F.col(rating) == F.col("_rating")) & (counter_of(F.col("word"), r, counters) == F.col("_counter")), "left_semi")
    return out.groupBy(rating, "word").agg(_occurrences(words).alias("n"))


def heavy_words_by_rating(
    df: DataFrame, k: int = 25, text: str = "text", rating: str = "stars", stop_words: Sequence[str] = ENGLISH_STOP_WORDS,
    hash_rows: int = HASH_ROWS, counters: int = COUNTERS,
) -> DataFrame:
    """The ``k`` most frequent words of each rating: (rating, word, n, rank).

    Words are cut out of the texts once, counted by runs of texts and written; the passes read that table.
    """
    words = materialize(counted_words(df, text, rating, stop_words), "words")
    sketch = materialize(counter_table(words, rating, hash_rows, counters), "counters")
    first = _nth_largest(sketch.where("row = 0"), rating, FIRST_CANDIDATES * k)
    exact = _counted(words, rating, first, sketch, hash_rows, counters)
    best = materialize(top_k_per_group(exact, rating, "n", "word", k), "heavy")
    # The k-th exact count bounds the result from below; ratings with fewer candidates than k have no bound yet.
    sure = {r[0]: r["n"] for r in best.where(F.col("rank") == k).select(rating, "n").collect()}
    floors = {r: sure.get(r, 1) for r in first}
    if all(floors[r] >= first[r] for r in first):  # words not counted have a counter below first, so fewer occurrences
        return best
    return top_k_per_group(_counted(words, rating, floors, sketch, hash_rows, counters), rating, "n", "word", k)


def _nth_largest(row: DataFrame, rating: str, n: int) -> dict[int, int]:
    """Per rating the n-th largest counter (or the smallest, if there are fewer)."""
    ranked = top_k_per_group(row, rating, "n", "counter", n)
    return {r[0]: r[1] for r in ranked.groupBy(rating).agg(F.min("n")).collect()}
