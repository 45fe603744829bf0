"""Quality rules with robust multivariate outliers per language and source.

Text statistics are turned into five roughly normal numbers. For each (language,
source) group a minimum-covariance-determinant estimate of their centre and
spread is found by concentration steps from two deterministic starts (median
and MAD; mean and covariance of all rows), the one with the smaller determinant
wins. A text goes when its squared Mahalanobis distance passes the cutoff.

Every step is a grouped aggregation: rows are binned by log distance, the bins
of a group (a fixed range of numbers, whatever its rows) are added up in order
until ``KEEP`` of the group is covered, and the covered bins give the next
estimate. A group that holds a third of all rows is reduced to its bins before
the shuffle.

Edge cases: a NULL text has no words and fails the base rule; NULL language or
source is a group of its own; a group of any size is fitted (variance floors
keep the spread invertible); repeated rows are judged one by one, equal rows
alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewscope.llm.common import GAP, word_list
from reviewscope.session import materialize

DIM = 5
KEEP = 0.75               # share of a group's rows that the estimate rests on
CUTOFF_TAIL = 1e-9        # chance that a normal row is rejected
FLOORS = (1.5, 0.5, 1.0, 1.0, 1.0)   # least standard deviation of each number
STEPS = 6
BIN_WIDTH = 0.02          # of the natural logarithm of the squared distance
SALTS = 32
SYMBOLS = "#*$%&|<>"
SHRINK_WORDS = 400.0

X = [f"x{i}" for i in range(DIM)]
GROUP = ["g_lang", "g_source"]


def chi2_cdf(x: float, k: int) -> float:
    """Lower regularised gamma function as its power series."""
    a, half = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= half / n
        total += term
    return total * math.exp(a * math.log(half) - half - math.lgamma(a)) if x > 0 else 0.0


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return low


CONSISTENCY = KEEP / chi2_cdf(chi2_quantile(KEEP, DIM), DIM + 2)
CUTOFF = chi2_quantile(1 - CUTOFF_TAIL, DIM)


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and base_failed.

    Equal 3-word windows are found by sorting the text's window hashes, so the
    work per text is n log n.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    triple = F.transform("_words", lambda w, i: F.struct(
        F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("at"),
    ))
    repeated = F.filter("_triples", lambda t, i: (
        F.coalesce(F.get("_triples", i - 1)["h"] == t["h"], F.lit(False))
        | F.coalesce(F.get("_triples", i + 1)["h"] == t["h"], F.lit(False))
    ))

    def cover(state: Column, at: Column) -> Column:
        return F.struct(at.alias("last"), (state["n"] + F.least(at - state["last"], F.lit(3))).alias("n"))

    covered = F.aggregate(
        F.sort_array(F.transform(repeated, lambda t: t["at"])),
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")), cover, lambda state: state["n"],
    )
    counted = (
        docs.withColumns({
            "_words": word_list(F.col(text)),
            "_lines": F.filter(F.split(whole, "\n"), lambda line: F.regexp_replace(line, GAP, "") != ""),
        })
        .withColumn("_triples", F.sort_array(F.slice(triple, F.lit(1), F.greatest(F.size("_words") - 2, F.lit(0)))))
        .withColumns({
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.regexp_replace(whole, GAP, "")).cast("long"),
            "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": covered.cast("long"),
        })
        .drop("_words", "_lines", "_triples")
    )
    return counted.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _keyed(column: str) -> Column:
    return F.when(F.col(column).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(column)))


def statistic_vectors(stats: DataFrame) -> DataFrame:
    """Adds the transformed numbers x0..x4 and the group key, for rows with words.

    x0: mean word length against its group's median, scaled so that short texts
    spread as long ones do. x1 to x3: log rates of symbols, repeated lines and
    repeated words. x4: log length, which takes up how the others drift with it.
    """
    n = F.col("n_words").cast("double")
    keyed = stats.withColumns({"g_lang": _keyed("lang"), "g_source": _keyed("source")})
    mean = F.try_divide(F.col("word_chars").cast("double"), n)
    middles = (
        keyed.where("not base_failed").groupBy(*GROUP)
        .agg(F.percentile(F.round(mean, 2), 0.5).alias("middle"))
    )
    return (
        keyed.join(materialize(middles, "middles"), GROUP, "left")
        .withColumns({
            "x0": F.sqrt(n * SHRINK_WORDS / (n + SHRINK_WORDS)) * (mean - F.coalesce("middle", mean)),
            "x1": F.log1p(1000 * F.col("n_symbols") / (F.col("word_chars") + 1)),
            "x2": F.log1p(100 * F.col("n_dup_lines") / (F.col("n_lines") + 1)),
            "x3": F.log1p(100 * F.col("n_repeat_words") / (n + 1)),
            "x4": F.log1p(n),
        })
        .withColumns({x: F.round(F.coalesce(x, F.lit(0.0)), 4) for x in X})
        .drop("middle")
    )


def _moments() -> list[Column]:
    """Exact sums, so that no order of rows changes an estimate."""
    exact = {x: F.col(x).cast("decimal(12,4)") for x in X}
    sums = [F.sum(exact[x]).alias(f"s_{x}") for x in X]
    return [F.count("*").alias("n"), *sums, *[
        F.sum((exact[X[i]] * exact[X[j]]).cast("decimal(24,8)")).alias(f"s_{i}_{j}") for i in range(DIM) for j in range(i + 1)
    ]]


def _add_moments() -> list[Column]:
    names = ["n", *[f"s_{x}" for x in X], *[f"s_{i}_{j}" for i in range(DIM) for j in range(i + 1)]]
    return [F.sum(c).alias(c) for c in names]


def _estimate(moments: DataFrame, scale: float) -> DataFrame:
    """Mean m0.. and Cholesky factor l_i_j of the floored covariance, and its log determinant."""
    n = F.col("n").cast("double")
    out = moments.withColumns({f"m{i}": F.col(f"s_{X[i]}").cast("double") / n for i in range(DIM)})
    cov = {
        (i, j): (F.col(f"s_{i}_{j}").cast("double") / n - F.col(f"m{i}") * F.col(f"m{j}")) * scale
        + (FLOORS[i] ** 2 if i == j else 0.0)
        for i in range(DIM) for j in range(i + 1)
    }
    return _cholesky(out.withColumns({f"c_{i}_{j}": c for (i, j), c in cov.items()}))


def _cholesky(table: DataFrame) -> DataFrame:
    for i in range(DIM):
        for j in range(i + 1):
            rest = F.col(f"c_{i}_{j}") - reduce(add, [F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)], F.lit(0.0))
            value = F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l_{j}_{j}")
            table = table.withColumn(f"l_{i}_{j}", value)
    log_det = reduce(add, [F.log(f"l_{i}_{i}") for i in range(DIM)])
    keep = [c for c in table.columns if c in ("start", *GROUP)]
    return table.select(*keep, *[f"m{i}" for i in range(DIM)], *[f"l_{i}_{j}" for i in range(DIM) for j in range(i + 1)], log_det.alias("log_det"))


def _salted_join(rows: DataFrame, groups: DataFrame, how: str = "inner") -> DataFrame:
    """Join one row per group to many rows: a hot group's rows spread over ``SALTS`` keys, also before an aggregation."""
    salted = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(SALTS))).join(salted, [*GROUP, "_salt"], how).drop("_salt")


def _with_distance(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    """Adds the squared Mahalanobis distance ``d2``, by forward substitution."""
    joined = _salted_join(rows, estimates, how)
    for i in range(DIM):  # one column per solved number keeps the expression short
        rest = F.col(X[i]) - F.col(f"m{i}") - reduce(add, [F.col(f"l_{i}_{k}") * F.col(f"y{k}") for k in range(i)], F.lit(0.0))
        joined = joined.withColumn(f"y{i}", rest / F.col(f"l_{i}_{i}"))
    return joined.withColumn("d2", reduce(add, [F.col(f"y{i}") * F.col(f"y{i}") for i in range(DIM)]))


def _median_start(rows: DataFrame) -> DataFrame:
    centre = rows.groupBy(*GROUP).agg(*[F.percentile(x, 0.5).alias(f"m{i}") for i, x in enumerate(X)])
    apart = _salted_join(rows, materialize(centre, "mcd-centre"))
    spread = apart.groupBy(*GROUP).agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(DIM)],
        *[F.percentile(F.round(F.abs(F.col(x) - F.col(f"m{i}")), 4), 0.5).alias(f"mad{i}") for i, x in enumerate(X)],
    )
    flat = spread.withColumns({
        f"c_{i}_{j}": (F.col(f"mad{i}") * 1.4826) ** 2 + FLOORS[i] ** 2 if i == j else F.lit(0.0)
        for i in range(DIM) for j in range(i + 1)
    })
    return _cholesky(flat).withColumn("start", F.lit(0))


def fit_mcd(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """One estimate per group from ``rows`` (group keys and x0..x4), read ``steps`` + 3 times."""
    whole = _estimate(rows.groupBy(*GROUP).agg(*_moments()), 1.0).withColumn("start", F.lit(1))
    estimates = materialize(_median_start(rows).unionByName(whole), "mcd-start")
    bins = Window.partitionBy("start", *GROUP)
    for _ in range(steps):
        placed = _with_distance(rows, estimates).withColumn("bin", F.ceil(F.log(F.col("d2") + 1e-6) / BIN_WIDTH))
        binned = placed.groupBy("start", *GROUP, "bin").agg(*_moments())
        before = F.coalesce(F.sum("n").over(bins.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        covered = (
            binned.withColumns({"before": before, "all": F.sum("n").over(bins)})
            .where(F.col("before") < F.ceil(KEEP * F.col("all")))
            .groupBy("start", *GROUP).agg(*_add_moments())
        )
        estimates = materialize(_estimate(covered, CONSISTENCY), "mcd-step")
    best = F.min_by(F.struct(*[c for c in estimates.columns if c not in GROUP]), F.struct("log_det", "start"))
    return estimates.groupBy(*GROUP).agg(best.alias("best")).select(*GROUP, "best.*").drop("start")


def judge_quality(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Adds the statistics, ``base_failed``, ``d2`` (NULL where the base rule failed) and ``kept``.

    Further columns pass through under any name, but for those named like an added one, which are replaced.
    """
    shown = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "d2"]
    names = [c for c in docs.columns if c not in ("text", "kept", *shown)]
    # The whole row beside what is computed on, so that no column clashes with its names.
    packed = docs.select(F.struct(*names).alias("whole_row"), "text", "lang", "source")
    stats = materialize(text_statistics(packed).drop("text"), "text-statistics")
    vectors = statistic_vectors(stats)
    fit_rows = materialize(vectors.where("not base_failed").select(*GROUP, *X), "vectors")
    estimates = materialize(fit_mcd(fit_rows), "mcd")
    judged = _with_distance(vectors, estimates, "left").withColumn("d2", F.when(~F.col("base_failed"), F.col("d2")))
    return judged.select(
        *[F.col("whole_row")[c].alias(c) for c in names], *shown, (~F.col("base_failed") & F.coalesce(F.col("d2") <= cutoff, F.lit(True))).alias("kept"),
    )
