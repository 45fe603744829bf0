"""Exact best items per user without comparing all users with all items.

A product of two factor vectors is never larger than the product of their lengths. Items are
therefore read in bands of falling length; a user is done when its length times that of the
longest item left is below its kth score. Each round sends one band of bounded size to
the users that are still open and keeps their ``k`` best so far; the others are final.
Bands double in size up to ``BAND_ITEMS``, so a long tail of items costs few rounds.

Equal scores go by the lower item id, for the last place too: a user stays open while the
bound equals its kth score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewscope.models.factors import FactorModel, factor_columns
from reviewscope.operators.ordering import PART, POS, stage_in_order
from reviewscope.session import materialize

FIRST_BAND = 256
BAND_ITEMS = 65_536
BLOCK_SCORES = 1 << 21
MARGIN = 1 + 1e-9   # of the bound, for rounding


@dataclass
class BestItems:
    """(user id, item id, score, rank) and the number of user-item pairs that were compared."""

    table: DataFrame
    compared: int


def _length(rank: int):
    return F.sqrt(sum((F.col(c) * F.col(c) for c in factor_columns(rank)), F.lit(0.0)))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` of each row by falling score, then rising id; missing ones have id -1."""
    order = np.lexsort((ids, np.where(ids < 0, np.inf, -scores)), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _search(band, k: int, rank: int, next_length: float | None):
    """Meets the users with one band; ``open`` tells whether the next band may still change their list."""
    columns = factor_columns(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = band.value
        step = max(1, BLOCK_SCORES // max(1, len(ids)))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                users = [part.column(c).to_numpy() for c in columns]
                scores = np.zeros((part.num_rows, len(ids)))
                for mine, theirs in zip(users, vectors):  # one factor after the other, so that equal vectors score equally
                    scores += mine[:, None] * theirs[None, :]
                held = [np.array(part.column(c).to_pylist(), kind).reshape(part.num_rows, -1) for c, kind in (("scores", float), ("items", np.int64))]
                scores, items = _best(
                    np.concatenate([held[0], scores], 1), np.concatenate([held[1], np.broadcast_to(ids, scores.shape)], 1), k,
                )
                length = part.column("length").to_numpy()
                kth = np.where(items[:, -1] < 0, -np.inf, scores[:, -1]) if items.shape[1] == k else np.full(part.num_rows, -np.inf)
                more = np.zeros(part.num_rows, bool) if next_length is None else length * next_length * MARGIN >= kth
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *[part.column(c) for c in columns], part.column("length"),
                     pa.array(list(scores), pa.list_(pa.float64())), pa.array(list(items), pa.list_(pa.int64())), pa.array(more)],
                    ["id", *columns, "length", "scores", "items", "open"],
                )

    return run


def best_items(model: FactorModel, k: int, user: str = "user_id", item: str = "business_id", first_band: int = FIRST_BAND) -> BestItems:
    """The ``k`` items with the highest score for every user that has factors. Item ids are whole numbers from 0."""
    rank, columns = model.rank, factor_columns(model.rank)
    spark = model.users.sparkSession
    ordered = stage_in_order(model.items.select((-_length(rank)).alias("minus_length"), "id", *columns), "minus_length", "id", name="items-by-length")
    parts = sorted((r[PART], r["n"]) for r in ordered.groupBy(PART).agg(F.count("*").alias("n")).collect())
    offsets, total = [], 0
    for part, n in parts:
        offsets.append((part, total))
        total += n
    numbered = ordered.join(F.broadcast(spark.createDataFrame(offsets, f"{PART} int, before long")), PART)
    numbered = materialize(numbered.select((F.col("before") + F.col(POS)).alias("place"), "minus_length", "id", *columns), "items-by-length")

    shape = f"id long, {', '.join(f'{c} double' for c in columns)}, length double, scores array<double>, items array<long>, open boolean"
    users = model.users.select(
        F.col("id").cast("long").alias("id"), *columns, _length(rank).alias("length"),
        F.array().cast("array<double>").alias("scores"), F.array().cast("array<long>").alias("items"), F.lit(True).alias("open"),
    )
    done, compared, at, size = [users.where("not open")], 0, 0, first_band
    while at < total:
        band = numbered.where((F.col("place") >= at) & (F.col("place") < at + size)).toArrow()
        ids, vectors = band.column("id").to_numpy().astype(np.int64), [band.column(c).to_numpy() for c in columns]
        at, size = at + size, min(2 * size, BAND_ITEMS)
        following = numbered.where(F.col("place") == at).select("minus_length").first()
        sent = spark.sparkContext.broadcast((ids, vectors))
        met = users.where("open").mapInArrow(_search(sent, k, rank, -following[0] if following else None), shape)
        met = materialize(met, "users-and-items")
        n_met, n_open = met.agg(F.count("*"), F.count_if("open")).first()
        compared += n_met * len(ids)
        done.append(met.where("not open"))
        users = met
        if not n_open:
            break
    found = reduce(DataFrame.unionByName, done).select(F.col("id").alias(user), F.posexplode(F.arrays_zip("items", "scores")).alias("place", "x"))
    table = found.select(user, F.col("x.items").alias(item), F.col("x.scores").alias("score"), (F.col("place") + 1).alias("rank"))
    return BestItems(table, compared)
