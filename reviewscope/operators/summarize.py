"""Tables behind the exploration charts: crosstabs, point clouds and box statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewscope.functions.calendar import MONTHS, WEEKDAYS, label_of
from reviewscope.functions.numbers import is_number
from reviewscope.operators.lookup import SMALL_LOOKUP_ROWS, broadcast_if_small, lookup_join
from reviewscope.operators.ordering import PART, block_totals, stage_in_order
from reviewscope.schema import ID_COLUMNS, RATINGS
from reviewscope.session import materialize

QUARTILES = [0.25, 0.5, 0.75]
WHISKER = 1.5


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def distinct_keys(df: DataFrame, columns: list[str] = ID_COLUMNS, exact: bool = True) -> DataFrame:
    """Number of distinct values of each id column, in one pass and one row."""
    count = F.count_distinct if exact else F.approx_count_distinct
    return df.agg(*[count(F.col(c)).alias(f"n_{c}") for c in columns])


def count_by_rating(df: DataFrame, label: str) -> DataFrame:
    """Rows per ``label`` (down) and star rating (across)."""
    counts = (
        df.where(F.col(label).isNotNull() & F.col("stars").isin(RATINGS))
        .groupBy(label).pivot("stars", RATINGS).agg(F.count(F.lit(1)))
    )
    return counts.select(
        label, *[F.coalesce(F.col(str(r)), F.lit(0)).alias(f"stars_{r}") for r in RATINGS],
    )


def _named_crosstab(df: DataFrame, number: Column, names: list[str], label: str) -> DataFrame:
    # Rows are counted by small integers; only the 7 or 12 results get names.
    counts = count_by_rating(df.select(number.alias("_number"), "stars"), "_number")
    name = label_of(names, F.col("_number"))
    return counts.select(name.alias(label), *[f"stars_{r}" for r in RATINGS]).orderBy(label)


def crosstab_day_stars(df: DataFrame, date: str = "date") -> DataFrame:
    return _named_crosstab(df, F.weekday(date), WEEKDAYS, "day")


def crosstab_month_stars(df: DataFrame, date: str = "date") -> DataFrame:
    return _named_crosstab(df, F.month(date) - 1, MONTHS, "month")


def scatter_counts(df: DataFrame, clouds: list[tuple[str, str]], hue: str = "stars") -> DataFrame:
    """Distinct points of x/y clouds per rating; ``n`` says how many rows lie on each.

    One pass counts the combinations of all columns involved, and every cloud
    is summed up from those.
    """
    columns = sorted({c for pair in clouds for c in pair})
    points = df.groupBy(*columns, hue).agg(F.count("*").alias("weight"))
    cloud = F.inline(F.array(*[
        F.struct(F.lit(f"{x} x {y}").alias("cloud"), F.col(x).alias("x"), F.col(y).alias("y")) for x, y in clouds
    ]))
    return points.select(hue, "weight", cloud).groupBy("cloud", "x", "y", hue).agg(F.sum("weight").alias("n"))


def _measured(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Groups and value ``y`` of the rows that a box can show: no NULL and no NaN."""
    y = F.col(value).cast("double")
    present = is_number(y)
    for g in groups:
        present &= F.col(g).isNotNull()
    return df.where(present).select(*groups, y.alias("y"))


def _value_counts(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    return _measured(df, groups, value).groupBy(*groups, "y").agg(F.count("*").alias("n"))


def _exact_quartiles(staged: DataFrame, groups: list[str]) -> DataFrame:
    """Linear-interpolated quartiles from sorted value counts.

    The rank of every quartile is known from the group totals, so only the
    blocks that hold one of those ranks are numbered row by row.
    """
    blocks = block_totals(staged, groups, F.col("n"))
    ranks = {}
    for i, q in enumerate(QUARTILES):
        place = (F.col("group_total") - 1) * F.lit(q)
        ranks[f"lo{i}"], ranks[f"hi{i}"] = F.floor(place), F.ceil(place)
    needed = F.lit(False)
    for rank in ranks.values():
        needed |= (F.col("before") <= rank) & (rank < F.col("before") + F.col("block_total"))
    blocks = blocks.where(needed).drop("block_first", "block_total")
    wanted = staged.join(broadcast_if_small(blocks, blocks.count()), [*groups, PART])

    running = Window.partitionBy(*groups, PART).orderBy("y").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    numbered = wanted.withColumn("upto", F.col("before") + F.sum("n").over(running))
    picks = [
        F.max(F.when((F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto")), F.col("y"))).alias(k)
        for k, rank in ranks.items()
    ]
    found = numbered.groupBy(*groups).agg(F.max("group_total").alias("n"), *picks)

    def interpolate(i: int) -> Column:
        place = (F.col("n") - 1) * F.lit(QUARTILES[i])
        low, high = F.col(f"lo{i}"), F.col(f"hi{i}")
        return low + (high - low) * (place - F.floor(place))

    return found.select(
        *groups, "n", *[interpolate(i).alias(k) for i, k in enumerate(("q1", "median", "q3"))],
    )


def _approx_quartiles(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Quartiles from a bounded summary per group, for when a rank error of 1/10000 is fine."""
    found = _measured(df, groups, value).groupBy(*groups).agg(
        F.count("*").alias("n"), F.percentile_approx("y", QUARTILES, 10_000).alias("q"),
    )
    return found.select(
        *groups, "n", *[F.col("q")[i].alias(k) for i, k in enumerate(("q1", "median", "q3"))],
    )


def _box_parts(df: DataFrame, groups: list[str], value: str, exact: bool) -> tuple[DataFrame, DataFrame]:
    """Value counts per group, and one row of quartiles and fences per group."""
    counts = _value_counts(df, groups, value)
    if exact:
        counts = stage_in_order(counts, *groups, "y", name="values")
        quartiles = _exact_quartiles(counts, groups)
    else:
        quartiles = _approx_quartiles(df, groups, value)
    spread = F.col("q3") - F.col("q1")
    fenced = quartiles.select(
        "*",
        (F.col("q1") - WHISKER * spread).alias("low_fence"),
        (F.col("q3") + WHISKER * spread).alias("high_fence"),
    )
    return counts, materialize(fenced, "quartiles")


def box_stats(
    df: DataFrame, groups: list[str], value: str, exact: bool = True, small: int = SMALL_LOOKUP_ROWS,
) -> DataFrame:
    """Quartiles, whiskers and number of outliers of ``value`` per group.

    Whiskers end at the last value within 1.5 times the quartile distance of
    the box, and never inside it.
    """
    counts, boxes = _box_parts(df, groups, value, exact)
    edges = boxes.select(*groups, "low_fence", "high_fence", F.col("n").alias("_weight"))
    y, inside = F.col("y"), F.col("y").between(F.col("low_fence"), F.col("high_fence"))
    whiskers = (
        lookup_join(counts.select(*groups, "y", "n"), edges, groups, "_weight", [*groups, "y"], small)
        .groupBy(*groups).agg(
            F.min(F.when(inside, y)).alias("_low"),
            F.max(F.when(inside, y)).alias("_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("n_outliers"),
        )
    )
    # Both sides have one row per group.
    return boxes.join(whiskers, groups).select(
        *groups, "n", "q1", "median", "q3",
        F.least(F.coalesce("_low", "q1"), F.col("q1")).alias("whisker_low"),
        F.greatest(F.coalesce("_high", "q3"), F.col("q3")).alias("whisker_high"),
        "n_outliers",
    )


def box_outliers(
    df: DataFrame, groups: list[str], value: str, spread_by: list[str],
    exact: bool = True, small: int = SMALL_LOOKUP_ROWS,
) -> DataFrame:
    """The rows of ``df`` that lie beyond the whiskers of their group."""
    _, boxes = _box_parts(df, groups, value, exact)
    edges = boxes.select(*groups, "low_fence", "high_fence", F.col("n").alias("_weight"))
    joined = lookup_join(df, edges, groups, "_weight", spread_by, small)
    y = F.col(value).cast("double")
    outside = is_number(y) & ((y < F.col("low_fence")) | (y > F.col("high_fence")))
    return joined.where(outside).select(*df.columns)


def melt(df: DataFrame, keep: list[str], measures: list[str], into: str = "value") -> DataFrame:
    """One row per measure, so that several charts come from one pass."""
    return df.select(*keep, *[F.col(m).cast("double").alias(m) for m in measures]).unpivot(
        keep, measures, "measure", into,
    )
