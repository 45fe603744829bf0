"""Benchmark decontamination by spaced-seed hashing.

Texts become sequences of token hashes (letters and digits, lower-cased). An item counts as
leaked when ``WINDOW`` consecutive tokens of it (the whole item, if it is shorter), laid over
the document, agree in a share of ``AGREE`` or more.

Seeds are fixed masks over such a window; tokens under a 0 do not count, so a hit survives
substitutions there. A window that may differ in k tokens is cut into k + 2 blocks, and each
mask shows two of them: however the k substitutions fall, two blocks stay clean, so that one
mask hits and no leak is missed. Hashes of all benchmark windows are joined with those of all
document windows, and around each hit the item is laid over the document; all hits of a
batch are verified together.

The benchmark is read in blocks of ``BLOCK_TOKENS`` tokens, split by a hash of the item; a
block's sorted seed table is broadcast. One block is looked up while the documents are read:
nothing is shuffled and no text is moved. For more of them the documents are written once, each
block is a pass over that table, and only rows with leaks are kept of it, so that memory does not
grow with the benchmark.

Edge cases: NULL and empty texts match nothing and are kept; items without tokens match
nothing; an item of a few tokens matches wherever they stand; equal items are all named; a NULL
item id is named as NULL; repeated rows are judged one by one; all columns pass through, but for
those named like the two added ones, which are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewscope.llm.common import list_parts
from reviewscope.session import materialize

WINDOW = 13
AGREE = 0.8
BLOCK_TOKENS = 500_000
CHUNK_TOKENS = 1 << 17
VERIFIED_TOKENS = 1 << 18
RESULT = "struct<items:array<bigint>,agreed:int>"

_BASE = np.uint64(0x9E3779B97F4A7C15)


def token_hashes(text: Column) -> Column:
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def least_agreement(window: int) -> int:
    return math.ceil(AGREE * window - 1e-9)


def masks(window: int) -> list[str]:
    """The seeds of a window: all pairs of its blocks; the whole window where nothing may differ."""
    blocks = window - least_agreement(window) + 2
    if blocks == 2:
        return ["1" * window]
    ends = [window * i // blocks for i in range(blocks + 1)]
    shown = [{*range(ends[i], ends[i + 1]), *range(ends[j], ends[j + 1])} for i, j in combinations(range(blocks), 2)]
    return ["".join("1" if at in places else "0" for at in range(window)) for places in shown]


def seed_hashes(tokens: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the masked tokens at each start; empty where the mask does not fit."""
    n = len(tokens) - len(mask) + 1
    out = np.zeros(max(n, 0), np.uint64)
    for offset, used in enumerate(mask):
        if used == "1" and n > 0:
            out = (out ^ tokens[offset:offset + n]) * _BASE
            out ^= out >> np.uint64(29)
    return out


class SeedTable:
    """Seed hashes of one block of the benchmark, sorted, with item and place."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]]):
        self.ids = [i for i, _ in items]
        tokens = [t for _, t in items]
        self.starts = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
        self.tokens = np.concatenate([np.empty(0, np.uint64), *tokens])
        self.by_mask: list[tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for window in sorted({min(WINDOW, len(t)) for t in tokens if len(t)}):
            own = [k for k, t in enumerate(tokens) if min(WINDOW, len(t)) == window]
            for mask in masks(window):
                parts = [seed_hashes(tokens[k], mask) for k in own]
                hashes = np.concatenate(parts)
                owner = np.repeat(own, [len(h) for h in parts]).astype(np.int32)
                place = np.concatenate([np.arange(len(h), dtype=np.int32) for h in parts])
                order = np.argsort(hashes, kind="stable")
                hashes = hashes[order]
                present = np.zeros(1 << 20, bool)
                present[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
                self.by_mask.append((mask, hashes, owner[order], place[order], present))

    def hits(self, flat: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(document place, item, item place) of all equal seed hashes in a run of tokens, mask by mask, in parts of bounded size."""
        for mask, hashes, owner, place, present in self.by_mask:
            seeds = seed_hashes(flat, mask)
            maybe = np.nonzero(present[(seeds & np.uint64((1 << 20) - 1)).astype(np.int64)])[0]
            low = np.searchsorted(hashes, seeds[maybe], "left")
            n = np.searchsorted(hashes, seeds[maybe], "right") - low
            ends = np.cumsum(n)
            for a, b in _parts(ends, VERIFIED_TOKENS):
                entry = _ranges(low[a:b], n[a:b])
                yield np.repeat(maybe[a:b], n[a:b]), owner[entry], place[entry]


def _parts(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of elements whose sizes, summed up in ``ends``, come to about ``most``."""
    at = 0
    while at < len(ends):
        done = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield at, stop
        at = stop


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for ``sizes`` numbers each, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def agreements(table: SeedTable, flat: np.ndarray, starts: np.ndarray, doc: np.ndarray, item: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """Most equal tokens in any window of each item laid over its document at ``shift``; 0 below the threshold."""
    size = table.starts[item + 1] - table.starts[item]
    window = np.minimum(WINDOW, size)
    low = np.maximum(0, -shift)
    length = np.minimum(size, starts[doc + 1] - starts[doc] - shift) - low
    out = np.zeros(len(doc), np.int64)
    fits = np.flatnonzero(length >= window)
    for a, b in _parts(np.cumsum(length[fits]), VERIFIED_TOKENS):
        at = fits[a:b]
        own = table.tokens[_ranges(table.starts[item[at]] + low[at], length[at])]
        equal = own == flat[_ranges(starts[doc[at]] + low[at] + shift[at], length[at])]
        sums = np.concatenate([[0], np.cumsum(equal)])
        n = length[at] - window[at] + 1
        first = _ranges(np.cumsum(length[at]) - length[at], n)
        counts = sums[first + np.repeat(window[at], n)] - sums[first]
        out[at] = np.maximum.reduceat(counts, np.cumsum(n) - n)
    least = np.array([least_agreement(w) for w in range(WINDOW + 1)])
    return np.where(out >= least[window], out, 0)


def leaks(flat: np.ndarray, starts: np.ndarray, table: SeedTable) -> dict[int, dict[int, int]]:
    """Per document number the items (by number) that it holds, with their agreement."""
    out: dict[int, dict[int, int]] = {}
    for at, item, place in table.hits(flat):
        doc = np.searchsorted(starts, at, "right") - 1
        laid = np.unique(np.stack([doc, item.astype(np.int64), at - starts[doc] - place], 1), axis=0)
        agreed = agreements(table, flat, starts, *laid.T)
        for (d, k, _), most in zip(laid[agreed > 0].tolist(), agreed[agreed > 0].tolist()):
            mine = out.setdefault(d, {})
            mine[k] = max(most, mine.get(k, 0))
    return out


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[SeedTable]:
    """The benchmark in blocks of bounded size, one at a time on the driver."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item"), token_hashes(F.col(text)).alias("tokens"))
    total = items.agg(F.sum(F.size("tokens"))).first()[0] or 0
    n = -(-total // BLOCK_TOKENS)
    for block in range(n):
        rows = items.where(F.pmod(F.xxhash64("item", "tokens"), F.lit(n)) == block).orderBy("item").collect()
        yield SeedTable([(r["item"], np.array(r["tokens"], np.int64).view(np.uint64)) for r in rows])


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Adds ``leaked_items`` (sorted item ids) and ``leaked_tokens`` (most agreeing tokens of a window)."""
    context = docs.sparkSession.sparkContext
    tables = _blocks(benchmark.withColumnRenamed(text, "text"), item_id, "text")
    first, second = next(tables, None), next(tables, None)
    rows = docs.select(F.struct("*").alias("row"), token_hashes(F.col(text)).alias("tokens"))
    if first is None:
        found = rows.select("row", F.array().cast("array<bigint>").alias("items"), F.lit(0).alias("agreed"))
    elif second is None:
        found = rows.withColumn("x", _lookup(context.broadcast(first))("tokens")).select("row", "x.*")
    else:
        rows = materialize(rows.withColumn("uid", F.monotonically_increasing_id()), "numbered-texts")
        passes = []
        for table in chain([first, second], tables):
            sent = context.broadcast(table)
            hit = rows.select("uid", _lookup(sent)("tokens").alias("x")).select("uid", "x.*").where(F.size("items") > 0)
            passes.append(materialize(hit, "block-leaks"))
            sent.unpersist()
        every = reduce(DataFrame.unionByName, passes).groupBy("uid").agg(F.flatten(F.collect_list("items")).alias("items"), F.max("agreed").alias("agreed"))
        found = rows.select("uid", "row").join(every, "uid", "left").select(
            "row", F.coalesce("items", F.array().cast("array<bigint>")).alias("items"), F.coalesce("agreed", F.lit(0)).alias("agreed"))
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("leaked_items", "leaked_tokens")]
    return found.select(*kept, F.sort_array("items").alias("leaked_items"), F.col("agreed").alias("leaked_tokens"))


def _lookup(shared):
    @F.arrow_udf(RESULT)
    def lookup(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = shared.value
        for batch in batches:
            items, agreed = [], []
            for flat, starts in list_parts(batch, CHUNK_TOKENS):
                found = leaks(flat, starts, table)
                for d in range(len(starts) - 1):
                    mine = found.get(d, {})
                    items.append([table.ids[k] for k in mine])
                    agreed.append(max(mine.values(), default=0))
            yield pa.StructArray.from_arrays(
                [pa.array(items, pa.list_(pa.int64())), pa.array(agreed, pa.int32())], ["items", "agreed"],
            )

    return lookup
