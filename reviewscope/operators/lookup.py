"""Joins of many rows with a lookup table that has one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_LOOKUP_ROWS = 200_000
SMALL_LOOKUP_BYTES = 16 << 20
HOT_KEYS_AT_MOST = 1_000


def broadcast_if_small(df: DataFrame, rows: int, limit: int = SMALL_LOOKUP_ROWS) -> DataFrame:
    """Broadcast hint only for a table whose counted rows are within ``limit`` and whose texts are short enough."""
    return F.broadcast(df) if rows <= limit and text_bytes(df) <= SMALL_LOOKUP_BYTES else df


def text_bytes(df: DataFrame) -> int:
    """Bytes in the string columns of a table; 0 without a pass over one that has none."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    return df.agg(F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0)))).first()[0] or 0 if texts else 0


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    weight: str,
    spread_by: list[str],
    small: int = SMALL_LOOKUP_ROWS,
    size: tuple[int, int] | None = None,
) -> DataFrame:
    """Left join that stays balanced when one key holds a large share of ``rows``.

    ``lookup`` has one row per key; its ``weight`` column says how many rows
    carry the key and is dropped from the result. ``size`` gives its row count
    and total weight where they are known already.

    * A lookup of at most ``small`` rows whose texts take at most
      SMALL_LOOKUP_BYTES (both measured first) is broadcast.
    * Otherwise keys with at least 1/1000 of the total weight, so at most 1000
      of them, are broadcast, and all other keys are joined by a shuffle. Rows
      already served, and rows with a NULL key, carry no key into that shuffle
      and are spread over it by a hash of ``spread_by``.
    """
    values = [c for c in lookup.columns if c not in (*keys, weight)]
    if size is None:
        size = lookup.agg(F.count("*"), F.coalesce(F.sum(weight), F.lit(0))).first()
    n_keys, total_weight = size
    if n_keys <= small and text_bytes(lookup) <= SMALL_LOOKUP_BYTES:
        return rows.join(F.broadcast(lookup.drop(weight)), keys, "left").select(*rows.columns, *values)

    threshold = max(1, -(-total_weight // HOT_KEYS_AT_MOST))
    hot = lookup.where(F.col(weight) >= threshold).select(
        *keys, F.lit(True).alias("_hot"), *[F.col(v).alias(f"_hot_{v}") for v in values],
    )
    cold = lookup.where(F.col(weight) < threshold).select(
        *[F.col(k).alias(f"_cold_{k}") for k in keys], F.xxhash64(*keys).alias("_cold_salt"),
        *[F.col(v).alias(f"_cold_{v}") for v in values],
    )
    is_cold = F.col("_hot").isNull()
    for k in keys:
        is_cold &= F.col(k).isNotNull()
    # The salt follows the key for cold rows, so that it is equal on both sides,
    # and the row itself for all others. A constant on one side would be folded
    # into the condition and no longer take part in the placement.
    salt = F.when(is_cold, F.xxhash64(*keys)).otherwise(F.xxhash64(*spread_by))
    marked = rows.join(F.broadcast(hot), keys, "left").select(
        "*",
        salt.alias("_salt"),
        *[F.when(is_cold, F.col(k)).alias(f"_key_{k}") for k in keys],
    )
    on = [F.col("_salt") == F.col("_cold_salt")]
    on += [F.col(f"_key_{k}") == F.col(f"_cold_{k}") for k in keys]
    return marked.join(cold, on, "left").select(
        *rows.columns,
        *[F.coalesce(f"_hot_{v}", f"_cold_{v}").alias(v) for v in values],
    )
