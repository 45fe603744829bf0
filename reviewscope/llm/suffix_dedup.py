"""Removal of repeated byte strings by longest-previous-factor arrays.

A byte goes if it lies in a string of ``length`` bytes that also starts at an earlier place
(``keep="first"``), or anywhere else (``keep="none"``). A place is a row and an offset in it;
rows come in the order of their keys.

1. Anchors: of the ``GRAM``-byte strings in each window of ``length`` bytes the one with the
   least hash (the leftmost of several). Equal windows have equal anchors at equal offsets,
   so windows are gathered by their anchor: consecutive windows with one anchor are a segment,
   and only segments whose anchor occurs twice matter.
2. Groups: equal segments of an anchor are counted and known by their first and last place;
   one of them fetches the bytes. A group of more than ``GROUP_SEGMENTS`` different segments is
   split by what more its windows have in common: the anchor with a fixed stretch around it,
   longer in every round, at last the whole window. So a passage that a third of all documents
   share is one segment inside and falls apart at its edges, where the documents differ.
3. Shards of about ``SHARD_BYTES`` hold whole groups. A shard sorts its suffixes by prefix
   doubling, to the depth of a window, equal ones by place. A segment that occurs more than
   once takes part at its first and at its last place.
4. Factors: previous and next smaller places in suffix order hold the longest earlier match
   of a suffix, previous and next larger places the longest later one. Windows whose factor
   has the whole length are removed where they start, at every place of their segment.

Edge cases: NULL and empty texts have no bytes; texts shorter than a window stay whole; every
row is a document of its own, also with a NULL or repeated id; NULL ids come last, in any
order, rows with one id share their places (with ``keep="first"`` none of them is later than
another); spans may cut a character, so what is kept are bytes; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, IntegerType, LongType, StructField, StructType,
)

from reviewscope.llm.common import byte_parts
from reviewscope.operators.lookup import lookup_join
from reviewscope.session import materialize

LENGTH = 400
GRAM = 64
BLOCK_WINDOWS = 1 << 18
CHUNK_BYTES = 1 << 20
GROUP_SEGMENTS = 1024
SPLIT = 4
SHARD_BYTES = 1 << 21
LOOKUP_ROWS = 20_000
NO_ID = 1 << 63
OFFSETS = 1 << 31

INTS, LONGS = ArrayType(IntegerType()), ArrayType(LongType())
SEGMENTS = StructType([StructField(c, INTS) for c in ("lo", "n", "q")] + [StructField(c, LONGS) for c in ("core", "c")])
PIECE = ("lo", "n", "q", "core", "c")
PIECES = ArrayType(StructType([StructField(c, IntegerType()) for c in PIECE[:3]] + [StructField(c, LongType()) for c in PIECE[3:]]))
CUT = StructType([StructField("kept", BinaryType()), StructField("n_removed", LongType()), StructField("n_spans", LongType())])
SPANS = "array<struct<a int, b int>>"

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BYTES = (np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE) ^ (np.arange(256, dtype=np.uint64) << np.uint64(41))) * _MIX


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _MIX
    return values ^ (values >> np.uint64(29))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    return tuple(
        np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(n - 1, b, np.uint64))]) for b in (_BASE, pow(_BASE, -1, 1 << 64))
    )


class Hashes:
    """Hash of any stretch of some bytes, from sums over their beginnings."""

    def __init__(self, flat: np.ndarray):
        size = 1 << max(12, len(flat).bit_length())
        powers, self.inverse = _powers(size)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[flat] * powers[:len(flat)])])

    def of(self, start: np.ndarray, end: np.ndarray, salt=0) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + np.uint64(_BASE) * np.asarray(salt).astype(np.uint64))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def segments(flat: np.ndarray, starts: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, lo, n, q, core, c): segments of n windows from offset lo, all with the anchor at q; hashes of anchor and segment."""
    width = length - gram + 1
    place = np.uint64((1 << (BLOCK_WINDOWS + width).bit_length()) - 1)
    for at in range(0, len(flat) - length + 1, BLOCK_WINDOWS):
        part = flat[at:at + BLOCK_WINDOWS + length - 1]
        hashes = Hashes(part)
        grams = np.arange(len(part) - gram + 1)
        found = hashes.of(grams, grams + gram)
        anchor = (_sliding_least((found & ~place) | grams.astype(np.uint64), width) & place).astype(np.int64)
        begins = np.arange(at, at + len(anchor))
        rows = np.searchsorted(starts, begins, "right") - 1
        whole = begins + length <= starts[rows + 1]
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1]) | (rows[1:] != rows[:-1])])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(anchor)))
        kept = whole[first]
        first, n = first[kept], n[kept]
        q, row = anchor[first], rows[first]
        yield row, first + at - starts[row], n, q + at - starts[row], hashes.of(q, q + gram), hashes.of(first, first + n + length - 1, n)


def _finder(length: int, gram: int):
    @F.arrow_udf(SEGMENTS)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sizes, parts = [np.zeros(1, np.int64)], []
            for _, _, flat, starts in byte_parts(batch, CHUNK_BYTES):
                found = list(segments(flat, starts, length, gram))
                parts += [x[1:] for x in found]
                rows = np.concatenate([x[0] for x in found]) if found else np.empty(0, np.int64)
                sizes.append(np.bincount(rows, minlength=len(starts) - 1))
            ends = pa.array(np.cumsum(np.concatenate(sizes)), pa.int32())
            columns = [np.concatenate(x) for x in zip(*parts)] if parts else [np.empty(0, np.int64)] * 5
            kinds = [pa.int32()] * 3 + [pa.int64()] * 2
            yield pa.StructArray.from_arrays([
                pa.ListArray.from_arrays(ends, pa.array(x.view(np.int64) if x.dtype == np.uint64 else x, kind)) for x, kind in zip(columns, kinds)
            ], SEGMENTS.names)

    return find


def pieces(data: bytes, n: int, q: int, width: int, length: int) -> Iterator[tuple[int, int, int, int, int]]:
    """A segment cut by ``width`` offsets of its anchor: windows of one piece have length - width + 1 bytes in common."""
    hashes = Hashes(np.frombuffer(data, np.uint8))
    for j in range((q - n + 1) // width, q // width + 1):
        first, last = max(0, q - (j + 1) * width + 1), min(n - 1, q - j * width)
        core = hashes.of(np.array([q - j * width]), np.array([q - (j + 1) * width + 1 + length]), j * length + width)
        content = hashes.of(np.array([first]), np.array([last + length]), last - first + 1)
        yield first, last - first + 1, q - first, int(core.view(np.int64)[0]), int(content.view(np.int64)[0])


def _splitter(width: int, length: int):
    @F.arrow_udf(PIECES)
    def split(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([(c, pa.int32()) for c in ("lo", "n", "q")] + [(c, pa.int64()) for c in ("core", "c")]))
        for contents, sizes, anchors in batches:
            rows = zip(contents.to_pylist(), sizes.to_pylist(), anchors.to_pylist())
            yield pa.array([[dict(zip(PIECE, p)) for p in pieces(data, n, q, width, length)] for data, n, q in rows], kind)

    return split


def _changes(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], values[1:] != values[:-1]])[:len(values)]


def prefix_ranks(flat: np.ndarray, depth: int) -> list[tuple[int, np.ndarray]]:
    """Ranks of all suffixes by their first d bytes, for d of 8, 16, ... and ``depth``; past the end come zeros.

    Prefix doubling: only suffixes that are not alone in their rank are sorted again.
    """
    n, d = len(flat), min(8, depth)
    padded = np.concatenate([flat, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for i in range(d):
        key = (key << np.uint64(8)) | padded[i:i + n]
    rank, held = np.zeros(n + 1, np.int32), np.arange(n)
    levels = []
    while True:
        order = np.argsort(key)
        key, held = key[order], held[order]
        new, group = _changes(key), rank[held]
        # Numbers of the first of equal keys, and of the first of the group that they split.
        sub, whole = np.flatnonzero(new), np.flatnonzero(_changes(group))
        rank = rank.copy()
        rank[held] = group + np.repeat(sub, np.diff(np.append(sub, len(held)))) - np.repeat(whole, np.diff(np.append(whole, len(held))))
        levels.append((d, rank[:n]))
        if d >= depth:
            return levels
        step = min(d, depth - d)
        held = held[~(new & np.append(new[1:], True)[:len(new)])]
        after = rank[np.minimum(held + step, n)].astype(np.uint64) + (held + step < n)
        key = (rank[held].astype(np.uint64) << np.uint64(32)) | after
        d += step


def common_length(flat: np.ndarray, levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of suffixes a and b, at most the depth of the ranks."""
    depth = levels[-1][0]
    out, n = np.zeros(len(a), np.int64), len(flat)
    for d, rank in reversed(levels):
        inside = np.maximum(a, b) + out + d <= n
        x, y = np.minimum(a + out, n - 1), np.minimum(b + out, n - 1)
        out += np.where((out + d <= depth) & inside & (rank[x] == rank[y]), d, 0)
    for _ in range(7):
        inside = (np.maximum(a, b) + out < n) & (out < depth)
        x, y = np.minimum(a + out, n - 1), np.minimum(b + out, n - 1)
        same = inside & (flat[x] == flat[y])
        if not same.any():
            break
        out += same
        a, b = np.where(same, a, n), b  # a suffix that differs once is done
    return out


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest one before it with a smaller value, -1 without one."""
    before = np.arange(len(values)) - 1
    due = np.flatnonzero(before >= 0)
    due = due[values[before[due]] > values[due]]
    for _ in range(64):
        if not len(due):
            return before
        before[due] = before[before[due]]
        due = due[before[due] >= 0]
        due = due[values[before[due]] > values[due]]
    for i in due.tolist():
        j = before[i]
        while j >= 0 and values[j] > values[i]:
            j = before[j]
        before[i] = j
    return before


def longest_previous(
    flat: np.ndarray, levels: list[tuple[int, np.ndarray]], at: np.ndarray, suffixes: np.ndarray, places: np.ndarray, whole: bool = False,
) -> np.ndarray:
    """Longest match of each suffix with one of a smaller place, at most the depth of the ranks.

    ``at`` is where suffixes start, ``suffixes`` their numbers in suffix order, ``places`` their places in that order.
    With ``whole``, matches that do not reach the depth count as 0 and need no search for their length.
    """
    n = len(suffixes)
    out = np.zeros(n, np.int64)
    before = previous_smaller(places)
    after = n - 1 - previous_smaller(places[::-1])[::-1]
    for near in (before, after):
        has = np.flatnonzero((near >= 0) & (near < n))
        a, b = at[suffixes[has]], at[suffixes[near[has]]]
        if whole:
            depth, rank = levels[-1]
            length = np.where(rank[a] == rank[b], depth, 0)
        else:
            length = common_length(flat, levels, a, b)
        out[suffixes[has]] = np.maximum(out[suffixes[has]], length)
    return out


def _place_order(places: pa.Array) -> np.ndarray:
    """Order of decimal numbers, from their two machine words."""
    halves = np.frombuffer(places.buffers()[1], np.int64)[2 * places.offset:2 * (places.offset + len(places))]
    return np.lexsort((halves[0::2].view(np.uint64), halves[1::2]))


def _runs(gone: np.ndarray, entries: np.ndarray, offsets: np.ndarray, n_entries: int) -> pa.Array:
    """Per entry its runs of marked windows as (a, b), b exclusive."""
    edge = np.concatenate([[True], (gone[1:] != gone[:-1]) | (entries[1:] != entries[:-1])]) if len(gone) else np.empty(0, bool)
    first = np.flatnonzero(edge)
    size = np.diff(np.append(first, len(gone)))
    kept = gone[first]
    first, size = first[kept], size[kept]
    ends = np.concatenate([[0], np.cumsum(np.bincount(entries[first], minlength=n_entries))])
    spans = pa.StructArray.from_arrays([pa.array(offsets[first], pa.int32()), pa.array(offsets[first] + size, pa.int32())], ["a", "b"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)


def _shard(length: int, keep: str):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        contents = table.column("content").combine_chunks().cast(pa.large_binary())
        bases = np.frombuffer(contents.buffers()[1], np.int64)[contents.offset:contents.offset + len(contents) + 1]
        flat = np.frombuffer(contents.buffers()[2], np.uint8)[bases[0]:bases[-1]]
        bases = bases - bases[0]
        n = np.diff(bases) - length + 1
        twice = np.flatnonzero(table.column("weight").to_numpy() > 1)
        # Segments at their first places, then those that recur at their last ones; windows numbered by place.
        first, last = (table.column(c).combine_chunks() for c in ("first", "last"))
        content = np.concatenate([np.arange(len(table)), twice])
        order = _place_order(pa.concat_arrays([first, last.take(pa.array(twice))]))
        sizes = n[content[order]]
        ends = np.cumsum(sizes)
        offsets = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
        at = np.repeat(bases[content[order]], sizes) + offsets

        levels = prefix_ranks(flat, length)
        suffixes = np.argsort((levels[-1][1][at].astype(np.int64) << 32) | np.arange(len(at)))
        gone = longest_previous(flat, levels, at, suffixes, suffixes, whole=True) >= length
        if keep == "none":
            gone |= longest_previous(flat, levels, at, suffixes, len(at) - 1 - suffixes, whole=True) >= length

        spans = _runs(gone, np.repeat(np.arange(len(order)), sizes), offsets, len(order))
        entry = np.empty(len(order), np.int64)
        entry[order] = np.arange(len(order))
        again = np.full(len(table), -1, np.int64)
        again[twice] = entry[len(table):]
        return pa.table({
            "core": table.column("core"), "c": table.column("c"), "weight": table.column("weight"), "first": first,
            "first_spans": spans.take(pa.array(entry[:len(table)])),
            "rest_spans": spans.take(pa.array(again, mask=again < 0)),
        })

    return run


@F.arrow_udf(CUT)
def _cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, found in batches:
        kept, removed, runs = [], [], []
        for text, mine in zip(texts, found):
            data, stays, at, n = text.as_py(), [], 0, 0
            for span in sorted((s["a"], s["b"]) for s in mine.as_py()):
                if n == 0 or span[0] > at:
                    stays.append(data[at:span[0]])
                    n += 1
                at = max(at, span[1])
            stays.append(data[at:])
            kept.append(b"".join(stays))
            removed.append(len(data) - len(kept[-1]))
            runs.append(n)
        yield pa.StructArray.from_arrays([pa.array(kept, pa.binary()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64())], CUT.names)


def _digits(column: Column) -> Column:
    return column.cast("decimal(38,0)")


def _recurring(found: DataFrame, weight: str | None, spread_by: list[str]) -> DataFrame:
    """Segments whose core occurs at two places or more."""
    cores = found.groupBy("core").agg(F.count("*").alias("rows"), (F.sum(weight) if weight else F.count("*")).alias("times")).where("times > 1")
    cores = materialize(cores.select("core", "rows", F.lit(True).alias("known")), "recurring-cores")
    return lookup_join(found, cores, ["core"], "rows", spread_by, small=LOOKUP_ROWS).where("known").drop("known")


def _with_text(rows: DataFrame, lists: DataFrame) -> DataFrame:
    return rows.select("uid", "text").join(lists, "uid")


def _contents(rows: DataFrame, distinct: DataFrame, length: int) -> DataFrame:
    """The different segments with their bytes, read at one place of each."""
    uid, lo = F.expr(f"rep div {OFFSETS}").cast("long"), F.expr(f"rep % {OFFSETS}").cast("int")
    kept = ("n", "q", "core", "c", "weight", "first", "last")
    lists = distinct.select(uid.alias("uid"), F.struct(lo.alias("lo"), *kept).alias("s")).groupBy("uid").agg(F.collect_list("s").alias("s"))
    return _with_text(rows, lists).select(F.explode(F.transform("s", lambda s: F.struct(
        *[s[c].alias(c) for c in kept], F.substr("text", s["lo"] + 1, s["n"] + (length - 1)).alias("content"),
    ))).alias("s")).select("s.*")


def _moved(spans: Column, by: Column | str) -> Column:
    shift = F.col(by) if isinstance(by, str) else by
    return F.transform(spans, lambda s: F.struct((s["a"] + shift).alias("a"), (s["b"] + shift).alias("b")))


def _verdicts(pool: DataFrame, width: int, length: int, keep: str) -> DataFrame:
    """Windows to remove (core, c, weight, first, first_spans, rest_spans) of each different segment, at its first place and at all others."""
    groups = pool.groupBy("core").agg(F.count("*").alias("different"), F.sum("weight").alias("times"), F.sum(F.octet_length("content")).alias("size"))
    groups = materialize(groups, "groups")
    crowded = F.col("different") > (GROUP_SEGMENTS if width > 1 else 1 << 62)
    large = groups.where(crowded).select("core", F.col("different").alias("rows"), F.lit(True).alias("large"))
    split, size = groups.agg(F.count_if(crowded), F.coalesce(F.sum(F.when(~crowded, F.col("size"))), F.lit(0))).first()
    marked = lookup_join(pool, large, ["core"], "rows", ["c"], small=LOOKUP_ROWS) if split else pool.withColumn("large", F.lit(None).cast("boolean"))
    shard = F.pmod(F.xxhash64("core"), F.lit(max(1, math.ceil(size / SHARD_BYTES))))
    small = marked.where("large is null").select(shard.alias("shard"), "core", "c", "weight", "first", "last", "content")
    out = f"core long, c long, weight long, first decimal(38,0), first_spans {SPANS}, rest_spans {SPANS}"
    verdicts = small.groupBy("shard").applyInArrow(_shard(length, keep), out)
    if not split:
        return materialize(verdicts, "verdicts")

    width = math.ceil(width / SPLIT)
    parent = [F.col(c).alias(f"of_{c}") for c in ("core", "c", "weight", "first", "last")]
    cut = marked.where("large").select(*parent, "content", F.explode(_splitter(width, length)("content", "n", "q")).alias("p"))
    cut = cut.select(*[f"of_{c}" for c in ("core", "c", "weight", "first", "last")], "p.*", F.substr("content", F.col("p.lo") + 1, F.col("p.n") + (length - 1)).alias("content"))
    cut = materialize(cut, "pieces")
    moved = (F.col("of_first") + F.col("lo")).cast("decimal(38,0)"), (F.col("of_last") + F.col("lo")).cast("decimal(38,0)")
    below = cut.groupBy("core", "c", "content").agg(
        F.min("n").alias("n"), F.min("q").alias("q"), F.sum("of_weight").alias("weight"), F.min(moved[0]).alias("first"), F.max(moved[1]).alias("last"),
    )
    below = materialize(_recurring(materialize(below, "different-pieces"), "weight", ["c"]), "different-pieces")
    told = lookup_join(cut.drop("content", "n", "q"), _verdicts(below, width, length, keep), ["core", "c"], "weight", ["of_core", "of_c", "lo"], small=LOOKUP_ROWS).where("first is not null")
    own = F.when(moved[0] == F.col("first"), F.col("first_spans")).otherwise(F.col("rest_spans"))
    of_parents = told.groupBy("of_core", "of_c").agg(
        F.min("of_weight").alias("weight"), F.min("of_first").alias("first"),
        F.flatten(F.collect_list(_moved(own, "lo"))).alias("first_spans"), F.flatten(F.collect_list(_moved(F.col("rest_spans"), "lo"))).alias("rest_spans"),
    ).withColumnsRenamed({"of_core": "core", "of_c": "c"})
    return materialize(verdicts.unionByName(of_parents), "verdicts")


def removed_spans(rows: DataFrame, length: int, gram: int, keep: str) -> DataFrame:
    """(uid, spans): stretches of bytes to remove, overlapping where windows do."""
    found = rows.select("uid", "key", F.explode(F.arrays_zip(*[F.col(f"s.{c}").alias(c) for c in PIECE])).alias("x")).select("uid", "key", *[F.col(f"x.{c}").alias(c) for c in PIECE])
    order = F.coalesce(_digits(F.col("key")), _digits(F.lit(str(NO_ID))) + F.col("uid"))
    place = (order * OFFSETS + F.col("lo")).cast("decimal(38,0)").alias("place")
    found = materialize(_recurring(found, None, ["uid", "lo"]).select("uid", *PIECE, place), "segments")
    distinct = found.groupBy("core", "c").agg(
        F.min("n").alias("n"), F.min(F.col("q") - F.col("lo")).alias("q"), F.count("*").alias("weight"),
        F.min("place").alias("first"), F.max("place").alias("last"),
        F.min((_digits(F.col("uid")) * OFFSETS + F.col("lo")).cast("decimal(38,0)")).alias("rep"),
    )
    pool = materialize(_contents(rows, distinct, length), "contents")
    verdicts = _verdicts(pool, length - gram + 1, length, keep)
    told = lookup_join(found, verdicts, ["core", "c"], "weight", ["uid", "lo"], small=LOOKUP_ROWS).where("first is not null")
    own = F.when(F.col("place") == F.col("first"), F.col("first_spans")).otherwise(F.col("rest_spans"))
    lo = F.col("lo")
    bytes_of = F.transform(own, lambda s: F.struct((lo + s["a"]).alias("a"), (lo + s["b"] + (length - 1)).alias("b")))
    return told.select("uid", bytes_of.alias("spans")).where(F.size("spans") > 0).groupBy("uid").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def dedup_bytes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, keep: str = "first", gram: int = GRAM,
) -> DataFrame:
    """One row per input row: key, n_bytes, n_removed, n_spans, text_sha256 (of the whole text) and kept.

    ``kept`` is NULL where nothing was removed. ``key`` must be a whole number, ``gram`` at most ``length``.
    """
    if keep not in ("first", "none"):
        raise ValueError(f"keep must be 'first' or 'none', not {keep!r}")
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(key).cast("long").alias("key"), data.alias("text"))
    rows = rows.select(
        "uid", "key", "text", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"),
        _finder(length, gram)(F.col("text")).alias("s"),
    )
    rows = materialize(rows, "rows")
    spans = removed_spans(rows, length, gram, keep)
    cut = _with_text(rows, spans).select("uid", _cut(F.col("text"), F.col("spans")).alias("x")).select("uid", "x.*")
    told = rows.select("uid", "key", "n_bytes", "text_sha256").join(materialize(cut, "cut-texts"), "uid", "left")
    return told.select(
        F.col("key").alias(key), "n_bytes", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_removed", "n_spans")], "text_sha256", "kept",
    )
