"""Phrase collocations counted in counting quotient filters.

1. Words: each language's words are counted; those that reach ``LEAST`` get dense
   numbers (a phrase that reaches it has no other words). The dictionary is broadcast
   within ``DICTIONARY_WORDS`` words and ``DICTIONARY_BYTES``; a larger one is joined to
   the words of the texts by shuffle, hot words apart.
2. Filters: a task packs each run of two or three numbered words into one number of three
   word ids and permutes it (a Feistel network over the first id and the other two, so the
   permutation can be undone). The permuted first part is the quotient, the rest the full
   remainder: nothing is lost, whatever collides. A filter holds sorted remainders of whole
   bytes, one bit per entry and per quotient for the runs, one bit per entry that occurs more
   than once and counters for those only.
3. Merging: filters are cut by the leading bits of the quotient, which the permutation spreads
   evenly; the sorted filters of one range meet in one task, which adds up their counters.
   A phrase that fills a third of the corpus is one entry per filter. Phrases that
   reach ``LEAST`` are permuted back.
4. Scores: joins of the phrases with the counts of their parts, exact in 38 digits.

Edge cases: a NULL language is ``und``; NULL, empty and separator-only texts have no words;
repeated rows and rows with NULL or repeated ids all count, as no id is read; phrases of a text
never cross a piece; equal scores and counts go by the phrase's bytes; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewscope.llm.common import byte_parts, cut_words
from reviewscope.operators.lookup import lookup_join
from reviewscope.operators.ordering import PART, POS, stage_in_order
from reviewscope.session import materialize

# What parts pieces and, inside them, words.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
BLANKS = " \t"
LEAST = 10
DROP_PERCENT = 50
TOP = 2000
UNKNOWN = "und"

LONGEST = 3
DICTIONARY_WORDS = 4_000_000
DICTIONARY_BYTES = 64 << 20
WORD_CHUNK_BYTES = 1 << 22
CHUNK_BYTES = 1 << 21
FILTER_ENTRIES = 1 << 20
RANGE_ENTRIES = 1 << 19
MOST_RANGE_BITS = 16
RACE_ROWS = 50_000


def _byte_table(gone: str) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A"):ord("Z") + 1] += 32
    table[[0, *map(ord, gone)]] = 0
    return table


# A zero byte may be part of a word, but marks gaps in a table: it changes places with 0xFF, which UTF-8 never has.
_TABLE = _byte_table(PIECE_ENDS + BLANKS)
_TABLE[0] = 0xFF
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in PIECE_ENDS]] = True


def _words(flat: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words and, for each, the number of its piece."""
    words, rows, places = cut_words(_TABLE, flat, starts)
    pieces = np.cumsum(_ENDS[flat], dtype=np.int64)[places] + rows if len(places) else rows
    return words, pieces


def _plain(words: pa.Array) -> pa.Array:
    """Back to text."""
    return pc.replace_substring(words, b"\xff", b"\x00").cast(pa.large_string())


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    languages = batch.column("lang")
    for lang in pc.unique(languages).to_pylist():
        yield lang, batch.column("text").filter(pc.equal(languages, lang))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) per run of texts."""
    for batch in batches:
        for lang, texts in _by_language(batch):
            for _, _, flat, starts in byte_parts(texts, WORD_CHUNK_BYTES):
                words, counts = pc.value_counts(_words(flat, starts)[0]).flatten()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words), pa.string()), _plain(words).cast(pa.string()), counts], ["lang", "word", "n"],
                )


def mix(values: np.ndarray, seed: int) -> np.ndarray:
    values = (values + np.uint64(0x9E3779B97F4A7C15 * seed % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Packing:
    """Three word ids of ``bits`` bits (at most 32) as quotient and remainder, and back."""

    def __init__(self, bits: int):
        self.bits = np.uint64(bits)
        self.low = np.uint64((1 << bits) - 1)
        self.wide = np.uint64((1 << 2 * bits) - 1)

    def permute(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, right = a.astype(np.uint64), (b.astype(np.uint64) << self.bits) | c.astype(np.uint64)
        left = left ^ (mix(right, 1) & self.low)
        right = right ^ (mix(left, 2) & self.wide)
        return left ^ (mix(right, 3) & self.low), right

    def restore(self, quotients: np.ndarray, remainders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        left = quotients ^ (mix(remainders, 3) & self.low)
        right = remainders ^ (mix(left, 2) & self.wide)
        left = left ^ (mix(right, 1) & self.low)
        return left, right >> self.bits, right & self.low

    def in_order(self, quotients: np.ndarray, remainders: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted, equal entries merged into one with the sum of their counters."""
        if not len(quotients):
            return quotients, remainders, counts
        if 3 * int(self.bits) <= 64:
            order = np.argsort((quotients << (self.bits + self.bits)) | remainders, kind="stable")
        else:
            order = np.lexsort((remainders, quotients))
        quotients, remainders, counts = quotients[order], remainders[order], counts[order]
        new = np.concatenate([[True], (quotients[1:] != quotients[:-1]) | (remainders[1:] != remainders[:-1])])
        at = np.flatnonzero(new)
        return quotients[at], remainders[at], np.add.reduceat(counts, at)


def write_filter(quotients: np.ndarray, remainders: np.ndarray, counts: np.ndarray, first: int, slots: int, width: int) -> bytes:
    """Sorted entries with quotients first to first + slots - 1 as one counting quotient filter; remainders take ``width`` bytes."""
    n = len(quotients)
    runs = np.zeros(n + slots, np.uint8)
    runs[np.arange(n) + (quotients - np.uint64(first)).astype(np.int64)] = 1
    many = counts > 1
    large = counts[many] >= 255
    return b"".join([
        np.array([n, slots, int(many.sum()), int(large.sum())], np.int64).tobytes(),
        np.packbits(runs).tobytes(),
        np.ascontiguousarray(remainders.astype("<u8")).view(np.uint8).reshape(n, 8)[:, :width].tobytes(),
        np.packbits(many).tobytes(),
        np.minimum(counts[many], 255).astype(np.uint8).tobytes(),
        counts[many][large].astype(np.int64).tobytes(),
    ])


def read_filter(data: bytes, first: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, slots, n_many, n_large = np.frombuffer(data, np.int64, 4).tolist()
    at, parts = 32, []
    for size in ((n + slots + 7) // 8, n * width, (n + 7) // 8, n_many, 8 * n_large):
        parts.append(np.frombuffer(data, np.uint8, size, at))
        at += size
    runs = np.flatnonzero(np.unpackbits(parts[0], count=n + slots))
    quotients = (runs - np.arange(n)).astype(np.uint64) + np.uint64(first)
    padded = np.zeros((n, 8), np.uint8)
    padded[:, :width] = parts[1].reshape(n, width)
    counts = np.ones(n, np.int64)
    some = parts[3].astype(np.int64)
    some[parts[3] == 255] = parts[4].view(np.int64)
    counts[np.unpackbits(parts[2], count=n).astype(bool)] = some
    return quotients, padded.view("<u8").ravel(), counts


def phrases(ids: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs of two and of three numbered words (id 0: none) of one piece, the latter with a third id."""
    pair = (ids[:-1] > 0) & (ids[1:] > 0) & (pieces[:-1] == pieces[1:])
    two = np.flatnonzero(pair)
    three = np.flatnonzero(pair[:-1] & pair[1:])
    starts = np.concatenate([two, three])
    third = np.concatenate([np.zeros(len(two), ids.dtype), ids[three + 2]])
    return ids[starts], ids[starts + 1], third


class FilterWriter:
    """Gathers phrases and writes them as filters, one per range of quotients, whenever FILTER_ENTRIES are held."""

    def __init__(self, bits: int, range_bits: int):
        self.packing, self.range_bits, self.bits = Packing(bits), range_bits, bits
        self.slots, self.width = 1 << (bits - range_bits), (2 * bits + 7) // 8
        self.held, self.size = [], 0

    def add(self, ids: np.ndarray, pieces: np.ndarray) -> Iterator[pa.RecordBatch]:
        quotients, remainders = self.packing.permute(*phrases(ids, pieces))
        entries = self.packing.in_order(quotients, remainders, np.ones(len(quotients), np.int64))
        self.held.append(entries)
        self.size += len(entries[0])
        if self.size >= FILTER_ENTRIES:
            yield self.written()

    def written(self) -> pa.RecordBatch:
        merged = self.packing.in_order(*(np.concatenate(x) for x in zip(*self.held))) if self.held else ()
        self.held, self.size = [], 0
        ranges, filters = [], []
        if merged and len(merged[0]):
            of = merged[0] >> np.uint64(self.bits - self.range_bits)
            ends = np.searchsorted(of, np.arange((1 << self.range_bits) + 1, dtype=np.uint64))
            for i in np.flatnonzero(np.diff(ends)).tolist():
                part = [x[ends[i]:ends[i + 1]] for x in merged]
                ranges.append(i)
                filters.append(write_filter(*part, i * self.slots, self.slots, self.width))
        return pa.RecordBatch.from_arrays([pa.array(ranges, pa.int32()), pa.array(filters, pa.binary())], ["range", "filter"])


def _filters_by_broadcast(dictionary, bits: int, range_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = FilterWriter(bits, range_bits)
        for batch in batches:
            for lang, texts in _by_language(batch):
                if lang not in dictionary.value:
                    continue
                known, numbers = dictionary.value[lang]
                for _, _, flat, starts in byte_parts(texts, CHUNK_BYTES):
                    words, pieces = _words(flat, starts)
                    coded = words.dictionary_encode()
                    place = pc.index_in(pc.replace_substring(coded.dictionary, b"\xff", b"\x00"), known)
                    number = np.where(place.is_valid().to_numpy(zero_copy_only=False), numbers[pc.fill_null(place, 0).to_numpy()], 0)
                    yield from writer.add(number[coded.indices.to_numpy()] if len(words) else np.empty(0, np.int64), pieces)
        yield writer.written()

    return run


def _filters_of_numbers(bits: int, range_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = FilterWriter(bits, range_bits)
        for batch in batches:
            found = batch.column("found")
            piece = np.repeat(np.arange(len(found)), pc.list_value_length(found).to_numpy())
            flat = found.flatten()
            yield from writer.add(flat.field("id").to_numpy(zero_copy_only=False), piece)
        yield writer.written()

    return run


def _merger(bits: int, range_bits: int, least: int):
    """Adds up the filters of one range and gives the phrases that reach ``least``."""

    def merge(table: pa.Table) -> pa.Table:
        packing, width = Packing(bits), (2 * bits + 7) // 8
        first = table.column("range")[0].as_py() << (bits - range_bits)
        held, size = [], 0
        for data in table.column("filter"):
            held.append(read_filter(data.as_buffer().to_pybytes(), first, width))
            size += len(held[-1][0])
            if size > 2 * RANGE_ENTRIES:  # merged now and then, so that memory follows the distinct phrases
                held = [packing.in_order(*(np.concatenate(x) for x in zip(*held)))]
                size = 0
        quotients, remainders, counts = packing.in_order(*(np.concatenate(x) for x in zip(*held)))
        kept = counts >= least
        a, b, c = packing.restore(quotients[kept], remainders[kept])
        return pa.table({**{k: pa.array(v.astype(np.int64)) for k, v in zip(("id1", "id2", "id3"), (a, b, c))}, "f": pa.array(counts[kept])})

    return merge


def number_words(words: DataFrame, least: int) -> DataFrame:
    """(id from 1, lang, word, f) of the words that reach ``least``, by language and word."""
    staged = stage_in_order(words.where(F.col("f") >= least), "lang", "word", name="words-in-order")
    sizes = sorted((r[PART], r["n"]) for r in staged.groupBy(PART).agg(F.count("*").alias("n")).collect())
    before, starts = 0, []
    for part, n in sizes:
        starts.append((part, before))
        before += n
    offsets = staged.sparkSession.createDataFrame(starts, f"{PART} int, before long")
    numbered = staged.join(F.broadcast(offsets), PART).select((F.col("before") + F.col(POS) + 1).alias("id"), "lang", "word", "f")
    return materialize(numbered, "dictionary")


def _numbered_pieces(texts: DataFrame, dictionary: DataFrame, tokens: int) -> DataFrame:
    """Pieces as arrays of word ids (0: none), by a join with the dictionary."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    pieces = F.split(lowered, "[" + PIECE_ENDS.replace("\n", "\\n").replace("\r", "\\r").replace("\x0b", "\\x0B").replace("\x0c", "\\x0C") + "]")
    rows = texts.select("lang", F.explode(pieces).alias("piece")).select(F.monotonically_increasing_id().alias("p"), "lang", "piece")
    words = materialize(rows.select("p", "lang", F.posexplode(F.filter(F.split("piece", r"[\x20\x09]+"), lambda w: w != "")).alias("i", "word")), "piece-words")
    found = lookup_join(words, dictionary, ["lang", "word"], "f", ["p", "i"], size=(DICTIONARY_WORDS + 1, tokens), small=DICTIONARY_WORDS)
    in_place = F.sort_array(F.collect_list(F.struct("i", F.coalesce("id", F.lit(0).cast("long")).alias("id"))))
    return found.groupBy("p").agg(in_place.alias("found")).select("found")


def phrase_counts(texts: DataFrame, dictionary: DataFrame, tokens: int, least: int) -> DataFrame:
    """(id1, id2, id3, f): runs of two words (id3 is 0) and three words that reach ``least``."""
    spark = texts.sparkSession
    n, size = dictionary.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0))).first()
    bits = max(1, int(n).bit_length())
    range_bits = min(bits, MOST_RANGE_BITS, max(0, math.ceil(math.log2(max(1, 2 * tokens / RANGE_ENTRIES)))))
    if n <= DICTIONARY_WORDS and size <= DICTIONARY_BYTES:
        held = dictionary.select("lang", "word", "id").toArrow().combine_chunks()
        by_lang = {}
        for lang in held.column("lang").unique().to_pylist():
            own = held.filter(pc.equal(held.column("lang"), lang)).combine_chunks()
            words = own.column("word").cast(pa.large_binary()).combine_chunks()
            by_lang[lang] = (words, own.column("id").to_numpy())
        filters = texts.mapInArrow(_filters_by_broadcast(spark.sparkContext.broadcast(by_lang), bits, range_bits), "range int, filter binary")
    else:
        filters = _numbered_pieces(texts, dictionary, tokens).mapInArrow(_filters_of_numbers(bits, range_bits), "range int, filter binary")
    return filters.groupBy("range").applyInArrow(_merger(bits, range_bits, least), "id1 long, id2 long, id3 long, f long")


def first_per_language(rows: DataFrame, order: list[Column], top: int) -> DataFrame:
    """The first ``top`` phrases of each language and their rank.

    Rounds of smaller races come first, so that no task sorts all phrases of a language.
    """
    while True:
        most = rows.groupBy("lang").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        races = math.ceil(most / max(RACE_ROWS, 10 * top))
        race = ["lang"] if races <= 1 else ["lang", F.pmod(F.xxhash64("phrase"), F.lit(races))]
        place = F.row_number().over(Window.partitionBy(*race).orderBy(*order))
        rows = materialize(rows.drop("rank").withColumn("rank", place).where(F.col("rank") <= top), "ranked")
        if races <= 1:
            return rows


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    texts = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text")).where("text is not null")
    counted = texts.mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("f"))
    counted = materialize(counted, "words")
    totals = materialize(counted.groupBy("lang").agg(F.sum("f").alias("n")), "language-totals")
    tokens = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    dictionary = number_words(counted, least)
    found = materialize(phrase_counts(texts, dictionary, tokens, least), "phrases")

    pairs = found.where("id3 = 0").select("id1", "id2", F.col("f").alias("a"))
    triples = found.where("id3 > 0").select("id1", "id2", "id3", F.col("f").alias("a"))
    # Of two words: the longest count of a longer phrase around them.
    around = triples.select("id1", "id2", "a").unionByName(triples.select(F.col("id2").alias("id1"), F.col("id3").alias("id2"), "a"))
    around = around.groupBy("id1", "id2").agg(F.max("a").alias("longer"))
    pairs = pairs.join(around, ["id1", "id2"], "left").where(f"longer is null or 100 * longer < {DROP_PERCENT} * a").drop("longer")
    head = found.where("id3 = 0").select("id1", "id2", F.col("f").alias("f12"))
    tail = found.where("id3 = 0").select(F.col("id1").alias("id2"), F.col("id2").alias("id3"), F.col("f").alias("f23"))
    triples = triples.join(head, ["id1", "id2"]).join(tail, ["id2", "id3"])
    nothing = F.lit(None).cast("long")
    every = pairs.select("id1", "id2", nothing.alias("id3"), "a", nothing.alias("f12"), nothing.alias("f23")).unionByName(
        triples.select("id1", "id2", "id3", "a", "f12", "f23"),
    )
    # A word that is not hot here fills less than 1/1000 of the texts, and of the phrases at most a tenth of that count.
    for i in (1, 2, 3):
        names = dictionary.select(F.col("id").alias(f"id{i}"), F.col("f").alias("weight"), F.col("word").alias(f"w{i}"), F.col("f").alias(f"f{i}"), *(["lang"] if i == 1 else []))
        every = lookup_join(every, names, [f"id{i}"], "weight", ["id1", "id2", "a"])

    def score(left: str, right: str) -> Column:
        return F.expr(f"(cast(1000000 as decimal(38,0)) * a * a) div (cast({left} as decimal(38,0)) * {right})")

    is_pair = F.col("id3").isNull()
    one, two = F.when(is_pair, score("f1", "f2")).otherwise(score("f1", "f23")), score("f12", "f3")
    cut = F.when(~is_pair & (two < one), 2).otherwise(1)
    scored = every.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", cut.alias("cut"), "f1", "f2", "f3", "f12", "f23",
        F.when(cut == 2, two).otherwise(one).alias("score"),
    ).select(
        "lang", "phrase", "a", F.when(F.col("cut") == 2, F.col("f12")).otherwise(F.col("f1")).alias("l"),
        F.when(F.col("cut") == 2, F.col("f3")).otherwise(F.coalesce("f23", "f2")).alias("r"), "score",
    )
    ranked = first_per_language(materialize(scored, "scored"), [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
