"""Mixing sources to target weights by entropy balancing.

Each source gets a target of words. Among all ways to take documents at rates
between 0 and ``MOST``, the one closest in entropy to taking each once and with
the target met has rates exp(dual * size / mean size), cut at ``MOST``. The duals
solve one convex equation per source; Newton steps (bisection where one leaves
the bracket) run on each source's distinct sizes with their counts, in one task per
source: k distinct sizes need k * k / 2 words at least, so even a source of 10^12
words has fewer than 1.5 million. Rates become whole copies by systematic rounding in order
of size within the source, so the rounding error of a source stays near one
document's words.

Edge cases: a NULL text has size 0; the NULL source is a source, last in order;
documents of size 0 get no words, whatever their copies; repeated rows are
documents of their own; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewscope.llm.common import WORD
from reviewscope.operators.ordering import PART, POS, block_totals, stage_in_order
from reviewscope.session import materialize

WEIGHTS = (5, 2, 1)       # of the sources in order, repeating
SHARE = 1.5               # of all words that the mix takes
MOST = 2.0                # copies of a document at most
MICRO = 1_000_000
TOLERANCE = 1e-11
MAX_ROUNDS = 80


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(column: str) -> Column:
    """NULL sorts last and joins with itself."""
    return F.when(F.col(column).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(column)))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per source: source_size and target. ``sizes`` has source_key, size and n.

    Sources above ``most`` times their size are set to that, and the rest is
    shared again by weight until none is above. Only two sums per round reach
    the driver.
    """
    totals = sizes.groupBy("source_key").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least_size"),
        F.sum(F.when(F.col("size") > 0, F.col("n"))).alias("n_sized"),
    )
    staged = stage_in_order(totals, "source_key", name="sources")
    before = block_totals(staged, [], F.lit(1)).select(PART, "before")
    rank = F.col("before") + F.col(POS)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = materialize(
        staged.join(F.broadcast(before), PART)
        .select("source_key", "source_size", "least_size", "n_sized", F.get(cycle, rank % len(weights)).alias("weight")),
        "source-weights",
    )
    cap = F.col("source_size") * F.lit(most)
    level, capped_n = 0.0, -1
    wanted = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    while True:
        above = F.col("weight") * F.lit(level) >= cap
        row = ranked.agg(
            F.sum(F.when(above, cap)).alias("fixed"), F.sum(F.when(~above, F.col("weight"))).alias("open"),
            F.count(F.when(above, F.lit(1))).alias("n"),
        ).first()
        if row["n"] == capped_n or not row["open"]:
            break
        level, capped_n = (wanted - (row["fixed"] or 0.0)) / row["open"], row["n"]
    target = F.least(F.col("weight") * F.lit(level), cap)
    return ranked.select("source_key", "source_size", "least_size", "n_sized", target.alias("target"))


def _solver(cut: float):
    def solve(rows: pa.Table) -> pa.Table:
        size, n = (rows.column(c).to_numpy().astype(float) for c in ("size", "n"))
        order = np.argsort(size)  # sums in one order, whatever the layout
        size, n = size[order], n[order]
        source_size, least_size, target, mean_size = (rows.column(c)[0].as_py() for c in ("source_size", "least_size", "target", "mean_size"))
        x = size / mean_size
        low = min(math.log(target / source_size) * mean_size / least_size, 0.0) if target > 0 else 0.0
        high, dual = cut * mean_size / least_size, 0.0
        for _ in range(MAX_ROUNDS):
            tilt = dual * x
            words = n * size * np.exp(np.minimum(tilt, cut))
            gap, slope = words.sum() - target, (words * x)[tilt < cut].sum()
            low, high = (dual if gap < 0 else low), (dual if gap > 0 else high)
            if abs(gap) <= TOLERANCE * target or high - low <= 1e-13 * abs(dual):
                break
            newton = dual - gap / slope if slope else math.inf
            dual = newton if low < newton < high else (low + high) / 2
        return pa.table({"source_key": rows.column("source_key").slice(0, 1), "dual": pa.array([dual], pa.float64())})

    return solve


def solve_duals(sizes: DataFrame, targets: DataFrame, most: float = MOST) -> DataFrame:
    """Adds ``dual`` and ``mean_size`` per source; NULL dual: every document at ``most``."""
    mean = F.try_divide(F.col("source_size").cast("double"), F.col("n_sized"))  # NULL for a source without words
    fixed = targets.withColumn("mean_size", mean).select("source_key", "source_size", "least_size", "target", "mean_size")
    open_ = (F.col("source_size") > 0) & (F.col("target") < F.col("source_size") * most * (1 - 1e-12))
    steep = sizes.where("size > 0").join(fixed.where(open_), "source_key")
    solved = steep.groupBy("source_key").applyInArrow(_solver(math.log(most)), "source_key string, dual double")
    state = fixed.join(solved, "source_key", "left").withColumn("dual", F.coalesce("dual", F.lit(0.0)))
    full = F.col("target") >= F.col("source_size") * most * (1 - 1e-12)
    return state.select(
        "source_key", "source_size", "target", "mean_size",
        F.when(full, F.lit(None)).otherwise(F.round("dual", 9)).alias("dual"),
    )


def mix_sources(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per row: key, source, size, source_size, target, rate, copies and taken (size * copies)."""
    base = materialize(docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), _source_key(source).alias("source_key"),
        word_count(F.col(text)).alias("size"),
    ), "mix-base")
    sizes = materialize(base.groupBy("source_key", "size").agg(F.count("*").alias("n")), "mix-sizes")
    duals = materialize(solve_duals(sizes, source_targets(sizes)), "duals")
    rate = F.when(F.col("dual").isNull(), F.lit(MOST)).otherwise(
        F.exp(F.least(F.col("dual") * F.col("size") / F.col("mean_size"), F.lit(math.log(MOST)))),
    )
    rated = base.join(duals, "source_key").withColumns({
        "rate": F.when(F.col("size") > 0, rate).otherwise(1.0), "large": F.col("size") > F.col("mean_size"),
    })
    staged = stage_in_order(rated, "source_key", "large", "size", "key", name="mix-order")
    large = materialize(_rounded(staged.where("large"), F.col("rate")), "mix-large")
    # What rounding the large documents has missed is made up by the rates of the small ones.
    met = large.groupBy("source_key").agg(F.sum(F.col("size") * F.col("copies")).alias("met"))
    small = staged.where("not coalesce(large, false)")
    left = small.groupBy("source_key").agg(
        F.first("target").alias("goal"), F.sum(F.col("rate") * F.col("size")).alias("expected"),
    )
    factor = materialize(
        left.join(met, "source_key", "left")
        .select("source_key", F.greatest(F.try_divide(F.col("goal") - F.coalesce("met", F.lit(0)), F.col("expected")), F.lit(0.0)).alias("factor")),
        "mix-factor",
    )
    bent = F.when(F.col("dual").isNull(), F.col("rate")).otherwise(F.least(F.col("rate") * F.coalesce("factor", F.lit(1.0)), F.lit(MOST)))
    bent = F.when(F.col("size") > 0, F.round(bent, 6)).otherwise(F.col("rate"))
    both = large.unionByName(_rounded(small.join(factor, "source_key", "left"), bent))
    return both.select(
        F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", "rate", "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def _rounded(staged: DataFrame, rate: Column) -> DataFrame:
    """Copies by systematic rounding of ``rate`` in the staged order of each source.

    A block is one source's rows in one sort partition, so the running sum never spans more than that.
    """
    rows = staged.withColumn("micro", F.round(rate * MICRO).cast("long"))
    before = block_totals(rows, ["source_key"], F.col("micro")).select("source_key", PART, "before")
    block = Window.partitionBy("source_key", PART).orderBy(POS)
    running = F.sum("micro").over(block) + F.col("before") + MICRO // 2
    copies = F.floor(F.col("running") / MICRO) - F.floor((F.col("running") - F.col("micro")) / MICRO)
    return rows.join(before, ["source_key", PART]).withColumn("running", running).select(
        "key", "source", "source_key", "size", "source_size", "target", (F.col("micro") / MICRO).alias("rate"),
        copies.cast("int").alias("copies"),
    )
