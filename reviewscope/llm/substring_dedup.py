"""Removal of repeated passages with suffix automata of reference shards.

A window of ``LENGTH`` words that also starts in a document with a smaller id goes,
word by word. Exact copies are settled by their text. For the rest:

1. Anchors: the least hash of the ``ANCHOR``-word runs in each window. Equal windows
   have equal anchors, so only windows around anchors seen in two documents matter.
2. References: each such window's first document is the least id of its hash; runs
   of windows that a document holds first are its reference passages, so every
   repeated passage is referenced once, however many copies it has.
3. Shards: reference passages are packed into shards of about ``SHARD_WORDS`` words;
   each becomes a suffix automaton. It is sent to all tasks that stream documents
   of that shard, as many as its documents need at ``TASK_WORDS`` words each, so a
   passage found in a third of all documents is spread over many tasks.
4. Streaming: a document's candidate passage runs through the automaton; where the
   matching statistic reaches ``LENGTH``, the maximal span is removed. Words are
   compared as such: no hash decides a removal.

Edge cases: NULL and empty texts have no words; a NULL id is no smaller id and has
none, so such rows neither lose words nor are references; rows with equal ids are
the same document and fare alike; shorter texts than a window stay whole; an
empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, IntegerType, LongType, StringType, StructField, StructType,
)

from reviewscope.llm.common import GAP, list_parts, word_list
from reviewscope.session import materialize

LENGTH = 50
ANCHOR = 20
SHARD_WORDS = 20_000
TASK_WORDS = 200_000
CHUNK_TOKENS = 1 << 18
BLOCK_WINDOWS = 1 << 14

PLACES, LONGS = ArrayType(IntegerType()), ArrayType(LongType())
ANCHORS = StructType([StructField("places", PLACES), StructField("hashes", LONGS)])
RUNS = ArrayType(StructType([
    StructField("owner", LongType()), StructField("start", IntegerType()),
    StructField("n", IntegerType()), StructField("passage", StringType()),
]))
CUT = StructType([StructField("kept_text", StringType()), StructField("n_removed", LongType())])

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_GAPS = re.compile(GAP)


def words_of(text: str) -> list[str]:
    return [w for w in _GAPS.split(text) if w]


def run_hashes(tokens: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` tokens from each start."""
    n = len(tokens) - length + 1
    out = np.zeros(max(n, 0), np.uint64)
    for i in range(length if n > 0 else 0):
        out = out * _BASE + tokens[i:i + n]
    out = (out ^ (out >> np.uint64(31))) * _MIX
    return out ^ (out >> np.uint64(29))


def anchor_places(tokens: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """For each window the place of its anchor, and the hashes of all anchor runs."""
    hashes = run_hashes(tokens, anchor)
    width = length - anchor + 1
    if len(hashes) < width:
        return np.empty(0, np.int64), hashes
    views = np.lib.stride_tricks.sliding_window_view(hashes, width)
    # In blocks, because the search copies the windows it looks at.
    least = np.concatenate([views[i:i + BLOCK_WINDOWS].argmin(1) for i in range(0, len(views), BLOCK_WINDOWS)])
    return least + np.arange(len(least)), hashes


@F.arrow_udf(ANCHORS)
def _anchors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        places, found = [], []
        for flat, starts in list_parts(batch, CHUNK_TOKENS):
            for a, b in zip(starts[:-1], starts[1:]):
                at, hashes = anchor_places(flat[a:b])
                at = np.unique(at)
                places.append(at.astype(np.int32))
                found.append(hashes[at].view(np.int64))
        yield pa.StructArray.from_arrays(
            [pa.array(places, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.int64()))], ["places", "hashes"],
        )


@F.arrow_udf(ANCHORS)
def _windows(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Starts and hashes of the windows whose anchor is among the given places."""
    for tokens, shared in batches:
        starts_out, hashes_out, row = [], [], 0
        for flat, starts in list_parts(tokens, CHUNK_TOKENS):
            for a, b in zip(starts[:-1], starts[1:]):
                at, _ = anchor_places(flat[a:b])
                marked = np.zeros(max(1, b - a), bool)
                marked[np.array(shared[row].as_py(), np.int64)] = True
                due = np.nonzero(marked[at])[0]
                starts_out.append(due.astype(np.int32))
                hashes_out.append(run_hashes(flat[a:b], LENGTH)[due].view(np.int64))
                row += 1
        yield pa.StructArray.from_arrays(
            [pa.array(starts_out, pa.list_(pa.int32())), pa.array(hashes_out, pa.list_(pa.int64()))], ["places", "hashes"],
        )


@F.arrow_udf(RUNS)
def _runs(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Runs of consecutive windows with one first document: its id, the first word, their number, the words."""
    for texts, windows in batches:
        out = []
        for text, found in zip(texts, windows):
            words, mine = words_of(text.as_py()), found.as_py()
            i = 0
            runs = []
            while i < len(mine):
                j = i
                while j + 1 < len(mine) and mine[j + 1]["place"] == mine[j]["place"] + 1 and mine[j + 1]["first"] == mine[i]["first"]:
                    j += 1
                start, stop = mine[i]["place"], mine[j]["place"] + LENGTH
                runs.append({"owner": mine[i]["first"], "start": start, "n": stop - start, "passage": " ".join(words[start:stop])})
                i = j + 1
            out.append(runs)
        yield pa.array(out, pa.list_(pa.struct([
            ("owner", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("passage", pa.string()),
        ])))


class SuffixAutomaton:
    """All substrings of the added passages, none across two of them."""

    def __init__(self):
        self.step: list[dict[str, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, words: list[str]) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)

    def _extend(self, last: int, word: str) -> int:
        step, link, length = self.step, self.link, self.length
        known = step[last].get(word)
        if known is not None and length[known] == length[last] + 1:
            return known
        if known is None:
            new = self._state(length[last] + 1, {})
            at = last
            while at >= 0 and word not in step[at]:
                step[at][word] = new
                at = link[at]
            if at < 0:
                link[new] = 0
                return new
            target = step[at][word]
            link[new] = target if length[target] == length[at] + 1 else self._split(at, word, target)
            return new
        return self._split(last, word, known)

    def _state(self, length: int, step: dict[str, int]) -> int:
        self.step.append(step)
        self.link.append(-1)
        self.length.append(length)
        return len(self.step) - 1

    def _split(self, at: int, word: str, target: int) -> int:
        twin = self._state(self.length[at] + 1, dict(self.step[target]))
        self.link[twin], self.link[target] = self.link[target], twin
        while at >= 0 and self.step[at].get(word) == target:
            self.step[at][word] = twin
            at = self.link[at]
        return twin

    def spans(self, words: list[str], least: int = LENGTH) -> list[tuple[int, int]]:
        """Maximal spans of ``words`` all of whose windows of ``least`` words lie in a passage."""
        out: list[list[int]] = []
        at = matched = 0
        for i, word in enumerate(words):
            while at and word not in self.step[at]:
                at = self.link[at]
                matched = self.length[at]
            if word in self.step[at]:
                at = self.step[at][word]
                matched += 1
            else:
                matched = 0
            if matched >= least:
                if out and i - least + 1 <= out[-1][1]:
                    out[-1][1] = i + 1
                else:
                    out.append([i - least + 1, i + 1])
        return [tuple(s) for s in out]


def _stream(references: pd.DataFrame, passages: pd.DataFrame) -> pd.DataFrame:
    """Build the shard's automaton and run the passages of one task through it."""
    automaton = SuffixAutomaton()
    for passage in references["reference"]:
        automaton.add(passage.split(" "))
    rows = [
        (key, start + a, start + b)
        for key, start, passage in zip(passages["key"], passages["start"], passages["passage"])
        for a, b in automaton.spans(passage.split(" "))
    ]
    return pd.DataFrame(rows, columns=["key", "start", "end"]).astype({"key": "int64", "start": "int32", "end": "int32"})


@F.arrow_udf(CUT)
def _cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, spans in batches:
        kept, removed = [], []
        for text, mine in zip(texts, spans):
            words = words_of(text.as_py())
            gone = np.zeros(len(words) + 1, np.int32)
            for s in mine.as_py():
                gone[s["start"]] += 1
                gone[s["end"]] -= 1
            stays = np.cumsum(gone)[:-1] == 0
            kept.append(" ".join(w for w, s in zip(words, stays.tolist()) if s))
            removed.append(len(words) - int(stays.sum()))
        yield pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(removed, pa.int64())], ["kept_text", "n_removed"])


def _tokens(text: str) -> Column:
    return F.transform(word_list(F.col(text)), lambda w: F.xxhash64(w))


def repeated_windows(census: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts around shared anchors, windows (key, place, first) that two documents hold)."""
    anchors = census.select("key", F.explode(F.arrays_zip("places", "hashes")).alias("x")).select("key", "x.places", "x.hashes")
    # What is found by hash is written before it is joined: a hot hash can then be split.
    shared = anchors.groupBy("hashes").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high")
    marked = (
        anchors.join(materialize(shared.select("hashes"), "shared-anchors"), "hashes")
        .groupBy("key").agg(F.collect_list("places").alias("shared"))
    )
    held = texts.join(marked, "key").dropDuplicates(["key"])
    held = materialize(held.withColumn("w", _windows(_tokens("text"), F.col("shared"))).select("key", "text", "w"), "shared-texts")
    windows = held.select("key", F.explode(F.arrays_zip("w.places", "w.hashes")).alias("x")).select(
        "key", F.col("x.places").alias("place"), F.col("x.hashes").alias("hash"),
    )
    first = windows.groupBy("hash").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first < last")
    first = materialize(first.select("hash", "first"), "first-windows")
    return held.select("key", "text"), windows.join(first, "hash").select("key", "place", "first")


def matched_spans(held: DataFrame, windows: DataFrame) -> DataFrame:
    """Spans (key, start, end) that the automata of the reference shards confirm."""
    listed = windows.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "first"))).alias("found"))
    runs = (
        held.join(listed, "key").select("key", F.explode(_runs(F.col("text"), F.col("found"))).alias("r")).select("key", "r.*")
    )
    runs = materialize(runs, "runs")
    words = runs.where("key = owner").agg(F.sum("n")).first()[0] or 0
    shard = F.pmod(F.xxhash64("owner"), F.lit(max(1, math.ceil(words / SHARD_WORDS))))
    runs = runs.withColumn("shard", shard)
    tasks = runs.where("key <> owner").groupBy("shard").agg(F.ceil(F.sum("n") / TASK_WORDS).alias("tasks"))
    tasks = materialize(tasks, "shard-tasks")
    references = runs.where("key = owner").join(tasks, "shard").select(
        F.col("shard").alias("ref_shard"), F.col("passage").alias("reference"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("tasks") - 1)).alias("ref_task"),
    )
    passages = runs.where("key <> owner").join(tasks, "shard").select(
        "shard", F.pmod(F.xxhash64("key", "start"), F.col("tasks")).alias("task"), "key", "start", "passage",
    )
    return references.groupBy("ref_shard", "ref_task").cogroup(passages.groupBy("shard", "task")).applyInPandas(
        _stream, "key bigint, start int, end int",
    )


def dedup_passages(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, n_words, n_removed, words_sha256 (of the whole text's words) and kept_text.

    ``kept_text`` is NULL where nothing was removed: the document stands as it is.
    """
    words = word_list(F.col("text"))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counted = rows.withColumn("words", words).withColumn("a", _anchors(F.transform("words", lambda w: F.xxhash64(w))))
    census = materialize(counted.select(
        "key", F.md5("text").alias("same"), F.size("words").cast("long").alias("n_words"),
        F.sha2(F.array_join("words", " "), 256).alias("words_sha256"), "a.*",
    ), "census")
    leads = materialize(census.where(f"n_words >= {LENGTH} and key is not null").groupBy("same").agg(F.min("key").alias("lead")), "leads")
    lead_rows = census.join(leads, "same").where("key = lead").select("key", "places", "hashes").dropDuplicates(["key"])
    held, windows = repeated_windows(lead_rows, rows)
    spans = matched_spans(held, materialize(windows, "windows"))
    listed = spans.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    cut = materialize(
        held.join(listed, "key").select("key", _cut(F.col("text"), F.col("spans")).alias("c")).select("key", "c.*"), "cut-texts",
    )
    # All windows of an exact copy start in the smaller id's text, too: it loses every word.
    told = census.drop("places", "hashes").join(leads, "same", "left").join(cut, "key", "left")
    copy = F.coalesce(F.col("key") > F.col("lead"), F.lit(False))
    return told.select(
        F.col("key").alias(key), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        "words_sha256", F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )
