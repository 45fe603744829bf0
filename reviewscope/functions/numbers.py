"""Small numeric expressions shared by the models and the metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POSITIVE_ABOVE = 2


def binarize(stars: Column, above: float = POSITIVE_ABOVE) -> Column:
    """1.0 for more than two stars, else 0.0; NULL stays NULL."""
    return (stars > above).cast("double")


def is_number(value: Column) -> Column:
    """True where a prediction is neither NULL nor NaN."""
    return value.isNotNull() & ~F.isnan(value)


def round_abs(score: Column) -> Column:
    """Round half up to a whole number, then drop the sign (-0.6 becomes 1.0)."""
    return F.abs(F.round(score, 0))


def round_clip(score: Column) -> Column:
    """Round half up, then clip to the label range [0, 1]."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.round(score, 0)))
