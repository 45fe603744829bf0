"""MinHash near-duplicates verified through odd sketches.

Every text is a set of distinct word shingles. ``BANDS`` x ``ROWS`` MinHash samples
give band keys: texts that share one are candidates. One-permutation MinHash, a
sample from each of ``BINS`` bins, is folded into a parity bitmap; the population
count of two bitmaps' XOR tells how many samples differ, precisely where texts are
similar. Candidates whose bitmaps differ by ``DEVIATIONS`` standard deviations more
than those of a pair at the threshold are dropped, all others are confirmed on the
full shingle sets.

In a bucket of up to ``FEW`` members all pairs are made, by number only; each pair is
tested once, however many buckets it shares. In larger ones, the crowds, no pairs are
listed wholesale. In rounds, until one finds no link or there are ``FEW_PAIRS`` pairs
per member at most, every crowd has
three leaders (the member that shares most crowds, and two that change with the
round), and every member meets the ``MEETS`` leaders with which it shares most crowds,
however many crowds it is in; each text is confirmed against the nearest leader outside its component, and
confirmed links join components. Only members of different components that still
share a crowd are then compared with each other, inside a join whose condition holds
the sketch test, so a large group that has become one component adds nothing. A pair
that shares several crowds is made in that of its lowest common band only. With 56
bands of 6 rows a pair of similarity 0.8 is missed with probability 4e-8 and dropped
by the sketches with about 3e-7, while one of similarity 0.2 shares a bucket with
probability 0.004. Sets far smaller than ``BINS`` are held almost whole by their
samples, so for short texts the bitmaps tell nearly the exact difference.

Full sets are made for the texts of pairs that look alike and of crowds. Their texts
are found by a list of checksums that is broadcast up to ``LISTED`` of them, so that
the other texts are not shuffled. Up to ``LISTED`` pairs are broadcast, too: sketches and
sets are then shuffled once for each pair and second member, not those of all nodes.

Edge cases: a text without words is linked with nothing; texts equal up to letter
case are one node; a NULL id belongs to its text's component and is never its
smallest id (where no row of the component has an id, the rows of one of its texts are kept); rows with
equal ids are the same document, compared by the text whose checksum is least; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from reviewscope.llm.common import list_parts, word_list
from reviewscope.llm.components import connected_components, merged_components
from reviewscope.session import materialize

BANDS, ROWS = 56, 6
BINS = 2048
SKETCH_WORDS = 32         # 2048 parity bits
SHINGLE = 4
THRESHOLD = 80            # per cent
DEVIATIONS = 5.0          # of the bitmaps of a pair at the threshold
CHUNK_TOKENS = 1 << 17
FEW = 8                   # members of a bucket whose pairs are all made
FEW_PAIRS = 64            # per member of a crowd: from here on they are compared without further leaders
MEETS = 3                 # leaders that a member of crowds meets in a round
LISTED = 2_000_000        # checksums of texts, or pairs, that are broadcast at most
SEEN = ("n", "sketch")
NO_ID = 1 << 62           # nodes of texts without any id start here
LONGS = ArrayType(LongType())
SKETCHED = StructType([StructField("n", LongType()), StructField("bands", LONGS), StructField("sketch", LONGS)])

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _MIX
    return values ^ (values >> np.uint64(29))


def shingle_set(tokens: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` tokens; a shorter text is one run."""
    if not len(tokens):
        return tokens
    size = min(size, len(tokens))
    out = np.full(len(tokens) - size + 1, size, np.uint64)
    for i in range(size):
        out = out * _BASE + tokens[i:len(tokens) - size + 1 + i]
    return np.unique(mix(out))


_SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * _BASE)
_MASKS, _FACTORS = _SEEDS.astype(np.uint32)[:, None], (_SEEDS >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)


def minhashes(shingles: np.ndarray, block: int = 1 << 18) -> np.ndarray:
    """BANDS * ROWS samples of 32 bits; long sets are folded in blocks."""
    out = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    short = shingles.astype(np.uint32)
    step = max(1, block // len(_SEEDS))
    for at in range(0, len(short), step):
        values = short[at:at + step][None, :] ^ _MASKS
        values *= _FACTORS
        out = np.minimum(out, values.min(1))
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    out = mix(np.arange(BANDS, dtype=np.uint64) + _BASE)
    for row in samples.reshape(BANDS, ROWS).T:
        out = mix(out * _BASE + row)
    return out.view(np.int64)


def bin_samples(shingles: np.ndarray) -> np.ndarray:
    """The least hash in each bin that has one: sorted hashes fall into bins by their leading bits."""
    hashes = np.sort(mix(shingles * _BASE))
    bins = hashes >> np.uint64(64 - (BINS.bit_length() - 1))
    return hashes[np.concatenate([[True], bins[1:] != bins[:-1]])] if len(hashes) else hashes


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity of the samples that fall on each bit."""
    bits = mix(samples * _MIX) % np.uint64(64 * SKETCH_WORDS)
    parity = np.bincount(bits.astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").view(np.int64)


def look_alike(a: str, b: str, deviations: float = DEVIATIONS) -> Column:
    """Whether sets at the threshold could have sketches that differ so much.

    Columns are n (set size) and sketch, with the prefixes ``a`` and ``b``. Of the
    union's ``filled`` bins a part ``apart`` holds a least hash of one set only: the
    sets' samples differ there, once where that hash is ``alone`` in its bin, else
    twice. A sample toggles one bit; two on the same bit cancel out.
    """
    bits, apart = 64 * SKETCH_WORDS, 1 - THRESHOLD / 100
    load = (F.col(f"{a}n") + F.col(f"{b}n")) / ((1 + THRESHOLD / 100) * BINS)
    filled = BINS * (1 - F.exp(-load))
    alone = load / F.expm1(load)
    spread = 2 * filled * apart * (2 - alone) / bits
    expected = bits / 2 * (1 - F.exp(-spread))
    samples_vary = F.exp(-2 * spread) * filled * (1 - alone) * 4 * apart * (1 - apart)
    bits_vary = bits / 4 * (1 - F.exp(-2 * spread) * (1 + 2 * spread))
    return differing_bits(f"{a}sketch", f"{b}sketch") <= expected + deviations * F.sqrt(samples_vary + bits_vary) + 1


@F.arrow_udf(SKETCHED)
def _sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        n, bands, sketches = [], [], []
        for flat, starts in list_parts(batch, CHUNK_TOKENS):
            for a, b in zip(starts[:-1], starts[1:]):
                shingles = shingle_set(flat[a:b])
                n.append(len(shingles))
                bands.append(band_keys(minhashes(shingles)) if len(shingles) else [])
                sketches.append(odd_sketch(bin_samples(shingles)))
        yield pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64()))],
            ["n", "bands", "sketch"],
        )


@F.arrow_udf(LONGS)
def _shingles(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        out = [np.empty(0, np.int64)]
        for flat, starts in list_parts(batch, CHUNK_TOKENS):
            out += [shingle_set(flat[a:b]).view(np.int64) for a, b in zip(starts[:-1], starts[1:])]
        ends = np.cumsum([len(x) for x in out])  # the first, empty part is the start
        yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(out)))


def _lowered(text: str) -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)


def text_class(text: str) -> Column:
    """What rows with one text, up to letter case, have in common."""
    return F.md5(_lowered(text))


def _tokens(text: str) -> Column:
    return F.transform(word_list(_lowered(text)), lambda w: F.xxhash64(w))


def differing_bits(a: str, b: str) -> Column:
    return reduce(add, [F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(SKETCH_WORDS)])


def _sizes_fit(a: Column | str, b: Column | str) -> Column:
    """Sets of too unequal sizes cannot reach the threshold."""
    return 100 * F.least(a, b) >= THRESHOLD * F.greatest(a, b)


def _with_both(pairs: DataFrame, nodes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The pairs (a, b) of a written table, with these columns of both nodes under the prefixes ``a_`` and ``b_``."""
    pairs = pairs.select("a", "b")
    first, second = (nodes.select(F.col("node").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in columns]) for end in "ab")
    if pairs.count() > LISTED:
        return pairs.join(first, "a").join(second, "b")
    # Nodes without a pair stay where they are.
    second = second.join(F.broadcast(pairs.select("b")), "b", "left_semi")
    return first.join(F.broadcast(pairs), "a").join(second, "b")


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets (node, shingles) reach the threshold."""
    shared = F.size(F.array_intersect("a_shingles", "b_shingles"))
    return (
        _with_both(pairs, sets, ["shingles"])
        .select("a", "b", shared.alias("shared"), (F.size("a_shingles") + F.size("b_shingles")).alias("sum"))
        .where(100 * F.col("shared") >= THRESHOLD * (F.col("sum") - F.col("shared"))).select("a", "b")
    )


def _few_pairs(members: DataFrame) -> DataFrame:
    """All pairs (a, b) of buckets with up to FEW members whose sizes fit, each once."""
    few = members.where(F.col("size") <= FEW).groupBy("bucket").agg(F.collect_list(F.struct("node", "n")).alias("all"))
    pairs = F.flatten(F.transform("all", lambda a: F.transform(
        F.filter("all", lambda b: (a["node"] < b["node"]) & _sizes_fit(a["n"], b["n"])),
        lambda b: F.struct(a["node"].alias("a"), b["node"].alias("b")),
    )))
    return few.select(F.explode(pairs).alias("p")).select("p.a", "p.b").distinct()


def _with_sketches(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) with both sketches, of those that look alike."""
    return _with_both(pairs, nodes, SEEN).where(_sizes_fit("a_n", "b_n") & look_alike("a_", "b_"))


def _leader_pairs(members: DataFrame, nodes: DataFrame, turn: int) -> DataFrame:
    """One candidate pair per node at most: the look-alike leader outside its component whose sketch is nearest."""
    who = F.struct("node", "component")
    draw = F.xxhash64("node", F.lit(turn))
    leaders = members.groupBy("bucket").agg(F.array(
        F.max(F.struct("fame", who.alias("who")))["who"], F.min(F.struct(draw, who.alias("who")))["who"],
        F.max(F.struct(draw, who.alias("who")))["who"],
    ).alias("leaders"))
    leaders = materialize(leaders, "leaders")
    led = (
        members.join(leaders, "bucket").select("node", "component", F.explode(F.array_distinct("leaders")).alias("leader"))
        .where("component <> leader.component").groupBy("node", F.col("leader.node").alias("leader")).agg(F.count("*").alias("shared"))
    )
    most = F.slice(F.sort_array(F.collect_list(F.struct("shared", F.xxhash64("leader", F.lit(turn)), "leader")), False), 1, MEETS)
    met = led.groupBy("node").agg(most.alias("most")).select(F.col("node").alias("a"), F.explode("most.leader").alias("b"))
    met = materialize(met, "met")
    nearest = F.min(F.struct(differing_bits("a_sketch", "b_sketch").alias("bits"), F.col("b").alias("leader")))
    return _with_sketches(met, nodes).groupBy("a").agg(nearest.alias("best")).select("a", F.col("best.leader").alias("b"))


def _regrouped(members: DataFrame, component: DataFrame) -> DataFrame:
    """Members with their components, of those buckets that still hold several."""
    labelled = members.drop("component").join(component, "node", "left").select(
        "bucket", "node", "fame", F.coalesce("component", "node").alias("component"),
    )
    labelled = materialize(labelled, "bucket-components")
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return materialize(labelled.join(materialize(mixed.select("bucket"), "mixed"), "bucket"), "mixed-buckets")


def _crowding(members: DataFrame) -> float:
    """Pairs of one bucket per member, 0 without members."""
    sizes = members.groupBy("bucket").agg(F.count("*").cast("double").alias("size"))
    return sizes.agg(F.coalesce(F.sum(F.col("size") * F.col("size")) / F.sum("size"), F.lit(0.0))).first()[0]


def _owned(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """One row (key, same) of each node's own id and text, with the node; copies of a text under other ids stay where they are."""
    # Repeated rows leave where the join has dealt them: nothing is shuffled by node again.
    keyed = rows.where("key is not null").join(
        owners.where(F.col("node") < NO_ID).select("same", "node", F.col("node").alias("key")), ["same", "key"],
    ).dropDuplicates(["same", "key"])
    keyless = rows.where("key is null").dropDuplicates(["same"]).join(owners.where(F.col("node") >= NO_ID), "same")
    return keyed.unionByName(keyless.select(keyed.columns))


def _texts_of(docs: DataFrame, key: str, text: str, involved: DataFrame) -> DataFrame:
    """Rows (key, same, text) of the documents, without most texts that are not involved."""
    texts = docs.select(text_class(text).alias("same"), F.col(key).alias("key"), F.col(text).alias("text"))
    if involved.count() > LISTED:
        return texts
    marks = involved.select(F.xxhash64("same").alias("mark")).distinct()
    return texts.withColumn("mark", F.xxhash64("same")).join(F.broadcast(marks), "mark", "left_semi").drop("mark")


def _crowd_pairs(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of look-alikes that share a bucket but no component; each comes from its lowest common band."""
    sketched = members.join(nodes, "node")
    left, right = (sketched.select("bucket", *[F.col(c).alias(f"{side}_{c}") for c in ("node", "component", "bands", *SEEN)]) for side in "ab")
    return (
        left.join(right, "bucket")
        .where(
            (F.col("a_node") < F.col("b_node")) & (F.col("a_component") != F.col("b_component"))
            & _sizes_fit("a_n", "b_n") & look_alike("a_", "b_")
            & (F.get(F.array_intersect("a_bands", "b_bands"), F.lit(0)) == F.col("bucket"))
        )
        .select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, n_shingles, component_id (smallest id of the component), kept and text_class."""
    rows = materialize(
        docs.select(F.col(key).alias("key"), text_class(text).alias("same"), _sketch(_tokens(text)).alias("s"))
        .select("key", "same", "s.*"), "sketches",
    )
    worded = rows.where("n > 0")
    node = F.coalesce(F.min("key"), F.lit(NO_ID) + F.min(F.xxhash64("same").bitwiseAND(F.lit(NO_ID // 2 - 1))))
    classes = materialize(worded.groupBy("same").agg(node.alias("node"), F.min("key").alias("rep")), "classes")
    # A class is represented by the sketch of any of its rows: all are equal.
    owners = materialize(classes.groupBy("node").agg(F.min("same").alias("same")), "owners")
    nodes = materialize(_owned(worded, owners).select("node", *SEEN, "bands"), "nodes")

    every = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    crowded = materialize(every.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "crowded")
    members = materialize(every.join(crowded, "bucket"), "members")
    fame = F.sum("size").over(Window.partitionBy("node"))
    crowds = members.where(F.col("size") > FEW).select("bucket", "node", fame.alias("fame"), F.col("node").alias("component"))
    crowds = materialize(crowds, "crowds")

    few = materialize(_few_pairs(members), "few")
    met = materialize(_with_sketches(few, nodes).select("a", "b"), "few-pairs")
    involved = met.select(F.col("a").alias("node")).unionByName(met.select(F.col("b").alias("node"))).unionByName(crowds.select("node"))
    involved = materialize(owners.join(involved.distinct(), "node"), "involved")
    sets = _owned(_texts_of(docs, key, text, involved), involved)
    sets = materialize(sets.select("node", _shingles(_tokens("text")).alias("shingles")), "shingle-sets")

    apart, turn, crowded = crowds, 0, _crowding(crowds)
    if crowded:
        met = met.unionByName(materialize(_leader_pairs(crowds, nodes, turn), "leader-pairs"))
    links = materialize(confirm(met, sets), "links")
    component = materialize(connected_components(links), "components")
    if crowded:
        apart = _regrouped(crowds, component)
        crowded = _crowding(apart)
    while crowded > FEW_PAIRS:
        turn += 1
        found = materialize(confirm(materialize(_leader_pairs(apart, nodes, turn), "leader-pairs"), sets), "links")
        if found.isEmpty():
            break
        component = materialize(merged_components(component, found), "components")
        apart = _regrouped(apart, component)
        crowded = _crowding(apart)
    if crowded:
        found = materialize(confirm(materialize(_crowd_pairs(apart, nodes), "pairs"), sets), "links")
        component = merged_components(component, found)

    labelled = classes.join(component, "node", "left").select("same", "node", F.coalesce("component", "node").alias("component"))
    out = rows.select("key", "same", F.col("n").alias("n_shingles")).join(labelled, "same", "left")
    smallest = F.when(F.col("n_shingles") == 0, F.col("key")).when(F.col("component") < NO_ID, F.col("component"))
    kept = F.when(F.col("component") >= NO_ID, F.col("node") == F.col("component")).otherwise(F.col("key").eqNullSafe(smallest))
    return out.select(
        F.col("key").alias(key), "n_shingles", smallest.alias("component_id"), kept.alias("kept"), F.col("same").alias("text_class"),
    )
