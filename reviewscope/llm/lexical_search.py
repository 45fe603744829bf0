"""Ranked lexical search with the Best Position Algorithm.

Documents are ranked for queries by a sum over the query's terms of integer impacts.

1. Query terms: distinct (item, term) pairs. Items are dealt into blocks of about
   ``BLOCK_TERMS`` pairs; a block's vocabulary is the only thing that is broadcast.
2. Postings: one pass over the texts counts each document's terms and how often it
   holds each term of the block. Collection size, length and document frequencies
   are sums over all documents.
3. Impact lists: a task turns its documents into shards of ``SHARD_POSTINGS``
   postings. Each term of a shard has a list of documents by falling impact; a
   document's own postings give direct access to its impact and position in every list.
4. Best positions: lists are read side by side. Each document met is scored at once by
   direct accesses, which also mark its positions in the other lists as seen. The best
   position of a list is the end of its unbroken run of seen positions, which lies at
   or beyond the last position read. No unseen document scores more than the impacts
   at the best positions together; reading stops once that is strictly below the kth
   score, so that equal scores are still told apart by the id. Reads double in depth.
5. The shards' best ``k`` are ranked once more, by item.

Edge cases: NULL texts and ids: a document without terms is not counted and never found,
an item without terms finds nothing; a NULL id ranks after all others; rows that repeat
an id are documents of their own; rows of one item id are one item with the terms of all
of them (a NULL id is an id, too); items with fewer matching documents return fewer rows; other
columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from reviewscope.llm.common import byte_parts, cut_words
from reviewscope.session import materialize

# What parts terms, and the ranking function's constants.
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
B_PERCENT, SCALE, TF_STEP, M_STEP = 90, 1_000_000_000, 1000, 8

K = 10
BLOCK_TERMS = 1_000_000
SHARD_POSTINGS = 1 << 20
CHUNK_BYTES = 1 << 21
FIRST_READ = 16

INTS = ArrayType(IntegerType())
COUNTED = StructType([StructField("n", LongType()), StructField("ids", INTS), StructField("tfs", INTS)])


def _term_table() -> np.ndarray:
    """Bytes of terms, A to Z lower-cased; bytes of characters beyond ASCII all belong to terms."""
    table = np.arange(256, dtype=np.uint8)
    parting = np.ones(256, bool)
    for low, high in (("0", "9"), ("A", "Z"), ("a", "z"), ("\x80", "\xff")):
        parting[ord(low):ord(high) + 1] = False
    table[parting] = 0
    table[ord("A"):ord("Z") + 1] += 32
    return table


_TABLE = _term_table()


def term_list(text: Column) -> Column:
    """Terms of a text in order, with repeats; none for NULL."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAPS), lambda t: t != "")


def count_terms(flat: np.ndarray, starts: np.ndarray, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms per row, and the (row, term id, occurrences) of the vocabulary's terms, by row and id."""
    words, rows, _ = cut_words(_TABLE, flat, starts)
    n = np.bincount(rows, minlength=len(starts) - 1)
    ids = pc.index_in(words, vocabulary)
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    ids = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)[known].astype(np.int64)
    pairs, tfs = np.unique(rows[known] * len(vocabulary) + ids, return_counts=True)
    return n, pairs // max(1, len(vocabulary)), pairs % max(1, len(vocabulary)), tfs


def _counter(vocabulary):
    @F.arrow_udf(COUNTED)
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        terms = pa.array(vocabulary.value, pa.large_binary())
        for batch in batches:
            n, sizes, ids, tfs = [np.empty(0, np.int64)], [np.zeros(1, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for _, _, flat, starts in byte_parts(batch, CHUNK_BYTES):
                total, rows, found, times = count_terms(flat, starts, terms)
                n.append(total)
                sizes.append(np.bincount(rows, minlength=len(starts) - 1))
                ids.append(found)
                tfs.append(times)
            ends = pa.array(np.cumsum(np.concatenate(sizes)), pa.int32())
            yield pa.StructArray.from_arrays([
                pa.array(np.concatenate(n), pa.int64()),
                *[pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x), pa.int32())) for x in (ids, tfs)],
            ], ["n", "ids", "tfs"])

    return count


class Shard:
    """Impact lists of some documents, and the same postings by document.

    ``by_doc`` starts: document d has the postings starts[d] to starts[d + 1]; each names
    a term, an impact and its position in that term's list. Lists run by falling impact.
    """

    def __init__(self, starts: np.ndarray, ids: np.ndarray, impacts: np.ndarray, n_terms: int):
        docs = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        order = np.lexsort((-impacts, ids))
        self.starts, self.ids, self.impacts = starts, ids, impacts
        self.list_starts = np.searchsorted(ids[order], np.arange(n_terms + 1))
        self.list_docs, self.list_impacts = docs[order], impacts[order]
        self.positions = np.empty(len(ids), np.int64)
        self.positions[order] = np.arange(len(ids)) - self.list_starts[ids[order]]
        self.reads = 0

    def best(self, terms: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores): all documents whose score may rank among the first ``k``, ties for the last place included."""
        terms = terms[self.list_starts[terms + 1] > self.list_starts[terms]]
        first, size = self.list_starts[terms], self.list_starts[terms + 1] - self.list_starts[terms]
        base = np.concatenate([[0], np.cumsum(size)])
        seen = np.zeros(base[-1], bool)
        list_of = np.full(len(self.list_starts) - 1, -1, np.int64)
        list_of[terms] = np.arange(len(terms))
        met = np.zeros(len(self.starts) - 1, bool)
        best_position = np.zeros(len(terms), np.int64)
        found, scores, depth, step = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0, FIRST_READ
        while True:
            read = _ranges(first + depth, np.clip(size - depth, 0, step))
            new = np.unique(self.list_docs[read])
            new = new[~met[new]]
            met[new] = True
            self.reads += len(read)
            spans = self.starts[new + 1] - self.starts[new]
            own = _ranges(self.starts[new], spans)
            lists = list_of[self.ids[own]]
            asked = lists >= 0
            sums = np.concatenate([[0], np.cumsum(np.where(asked, self.impacts[own], 0))])
            ends = np.cumsum(spans)
            found.append(new)
            scores.append(sums[ends] - sums[ends - spans])
            seen[base[lists[asked]] + self.positions[own[asked]]] = True
            limit = 0
            for j in np.flatnonzero(best_position < size):
                rest = seen[base[j] + best_position[j]:base[j + 1]]
                gap = int(rest.argmin())
                best_position[j] += len(rest) if rest[gap] else gap
                if best_position[j] < size[j]:
                    limit += int(self.list_impacts[first[j] + best_position[j] - 1])
            docs, score = np.concatenate(found), np.concatenate(scores)
            kth = int(np.partition(score, -k)[-k]) if len(score) >= k else 0
            if limit < kth or limit == 0:
                kept = (score >= kth) & (score > 0)
                return docs[kept], score[kept]
            found, scores = [docs], [score]
            depth, step = depth + step, 2 * step


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for ``sizes`` numbers each, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def impact(weights: np.ndarray, ids: np.ndarray, tfs: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weights[ids] * ((SCALE * tfs) // (TF_STEP * tfs + M_STEP * m))


def _flat(values: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(np.int64)


def _searcher(items, weights, k: int):
    """Best documents of each shard for every item of a block: rows (item number, key, score)."""

    def best_of(key, m, starts, ids, tfs) -> pa.RecordBatch:
        n_terms = len(weights.value)
        impacts = impact(weights.value, ids, tfs, np.repeat(m, np.diff(starts)))
        shard = Shard(starts, ids, impacts, n_terms)
        order = np.empty(len(key), np.int64)
        order[pc.sort_indices(key, null_placement="at_end").to_numpy()] = np.arange(len(key))
        numbers, rows, scores = [], [], []
        for number, terms in enumerate(items.value):
            docs, score = shard.best(terms, k)
            first = np.lexsort((order[docs], -score))[:k]
            numbers.append(np.full(len(first), number, np.int32))
            rows.append(docs[first])
            scores.append(score[first])
        rows = np.concatenate([np.empty(0, np.int64), *rows])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([np.empty(0, np.int32), *numbers]), pa.int32()), key.take(pa.array(rows)),
             pa.array(np.concatenate([np.empty(0, np.int64), *scores]), pa.int64())], ["number", "key", "score"],
        )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                rows = batch.slice(at, 1024)
                ids = rows.column("ids").flatten()
                parts.append((rows.column("key"), _flat(rows.column("m")), _flat(pc.list_value_length(rows.column("ids"))),
                              _flat(ids), _flat(rows.column("tfs").flatten())))
                size += len(ids)
                if size >= SHARD_POSTINGS:
                    yield _gathered(parts)
                    parts, size = [], 0
        if parts:
            yield _gathered(parts)

    def _gathered(parts) -> pa.RecordBatch:
        keys, *arrays = zip(*parts)
        m, sizes, ids, tfs = (np.concatenate(a) for a in arrays)
        return best_of(pa.concat_arrays(keys), m, np.concatenate([[0], np.cumsum(sizes)]), ids, tfs)

    return search


def _block_tops(docs: DataFrame, pairs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """Each shard's best documents (item, key, score) for the items of one block."""
    spark = docs.sparkSession
    listed = pairs.groupBy("item").agg(F.collect_list("term").alias("terms")).collect()
    vocabulary = sorted({t for row in listed for t in row["terms"]})
    number = {t: i for i, t in enumerate(vocabulary)}
    terms = spark.sparkContext.broadcast([t.encode() for t in vocabulary])
    counted = docs.select(F.col(key).cast("long").alias("key"), _counter(terms)(F.col(text)).alias("c")).select("key", "c.*")
    postings = materialize(counted.where("n > 0"), "postings")

    documents, length = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = postings.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("df")).collect()
    df = {r["id"]: r["df"] for r in held}
    weights = np.array([
        math.floor(1000 * math.log((2 * documents + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(vocabulary))
    ], np.int64)
    items = [np.array(sorted(number[t] for t in row["terms"]), np.int64) for row in listed]
    items = [x[weights[x] > 0] for x in items]
    share = f"100 - {B_PERCENT} + ((cast({B_PERCENT} as decimal(38,0)) * n * {documents}) div cast({max(1, length)} as decimal(38,0)))"
    lengths = postings.where(F.size("ids") > 0).select("key", F.expr(share).cast("long").alias("m"), "ids", "tfs")
    search = _searcher(spark.sparkContext.broadcast(items), spark.sparkContext.broadcast(weights), k)
    tops = lengths.mapInArrow(search, "number int, key long, score long")
    names = spark.createDataFrame([(i, row["item"]) for i, row in enumerate(listed)], f"number int, item {pairs.schema['item'].dataType.simpleString()}")
    return tops.join(F.broadcast(names), "number").select("item", "key", "score")


def rank_documents(
    docs: DataFrame, queries: DataFrame, k: int = K, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The ``k`` documents with the highest score above 0 for every item: item, rank, key, score.

    Equal scores go by ascending key. ``key`` must be a whole number.
    """
    pairs = queries.select(F.col(item).alias("item"), F.explode(term_list(F.col(item_text))).alias("term")).distinct()
    pairs = materialize(pairs, "query-terms")
    blocks = max(1, math.ceil(pairs.count() / BLOCK_TERMS))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    tops = [materialize(_block_tops(docs, pairs.where(block == i), key, text, k), "block-tops") for i in range(blocks)]
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
    ranked = reduce(DataFrame.unionByName, tops).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
