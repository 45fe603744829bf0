"""Global positions without a single-task window.

Rows are range partitioned and sorted once, written to the shared folder with
the number of their partition, and numbered from per-partition totals. Only
those totals (one row per partition and group) are ever added up in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewscope.session import materialize

PART, POS = "_part", "_pos"
_POSITION_BITS = (1 << 33) - 1


def stage_in_order(df: DataFrame, *order_by: str, name: str = "ordered") -> DataFrame:
    """Write ``df`` sorted by ``order_by``; adds the partition number and the row's place in it.

    The numbers depend on how the sort was partitioned, so they are only used
    from the written table, where they no longer change.
    """
    placed = df.orderBy(*order_by).select(
        "*",
        F.spark_partition_id().alias(PART),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)).alias(POS),
    )
    return materialize(placed, name)


def block_totals(staged: DataFrame, group_by: list[str], weight: Column) -> DataFrame:
    """Per group and partition: total ``weight`` and what lies before it in the group.

    Because the rows are sorted by group first, there are at most (groups +
    partitions) blocks. ``group_by`` must lead the sort order.
    """
    blocks = staged.groupBy(*group_by, PART).agg(
        F.sum(weight).alias("block_total"), F.min(POS).alias("block_first"),
    )
    in_order = Window.partitionBy(*group_by).orderBy(PART)
    return blocks.select(
        *group_by, PART, "block_total", "block_first",
        F.coalesce(
            F.sum("block_total").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0),
        ).alias("before"),
        F.sum("block_total").over(Window.partitionBy(*group_by)).alias("group_total"),
    )
