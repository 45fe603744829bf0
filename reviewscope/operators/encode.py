"""Dense id codes and min-max scaling."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewscope.operators.lookup import SMALL_LOOKUP_ROWS, lookup_join
from reviewscope.operators.ordering import PART, POS, stage_in_order
from reviewscope.session import materialize, scratch_path

FILE, ROW = "_file", "_row"
PIECE_ROWS, FILE_ROWS = SMALL_LOOKUP_ROWS, 25_000


class Codes(NamedTuple):
    """Code table (kind, key, n, code), and per kind its number of keys and of rows."""

    table: DataFrame
    sizes: dict[str, tuple[int, int]]

    def bounds(self) -> dict[str, tuple[float, float]]:
        """Smallest and largest code per kind."""
        return {kind: (0.0, max(0.0, keys - 1.0)) for kind, (keys, _) in self.sizes.items()}


def dense_codes(df: DataFrame, columns: list[str]) -> Codes:
    """Code table for all ``columns`` from one pass over ``df``.

    ``code`` numbers the distinct values of each column 0..n-1 in ascending
    order; ``n`` counts the rows that carry the value. Keys are compared as
    strings, NULLs get no code. Duplicates collapse before the shuffle.
    """
    return number_keys(distinct_keys(df, columns), {c: (0, 0) for c in columns})


def distinct_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """(kind, key, n) of the values of ``columns`` that are not NULL."""
    return (
        df.select([F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], columns, "kind", "key")
        .where(F.col("key").isNotNull())
        .groupBy("kind", "key").agg(F.count("*").alias("n"))
    )


def number_keys(keys: DataFrame, taken: Mapping[str, tuple[int, int]]) -> Codes:
    """Codes of ``keys`` (kind, key, n) in ascending order, from the number of keys on that each kind has ``taken``.

    ``taken`` has (keys, rows) per kind; the sizes returned include them.
    """
    staged = stage_in_order(keys, "kind", "key", name="keys")
    # One row per sort partition, and one more where a partition holds the end
    # of one kind and the start of the next: small whatever the data holds.
    blocks = staged.groupBy("kind", PART).agg(
        F.min(POS).alias("first"), F.count("*").alias("keys"), F.sum("n").alias("rows"),
    ).orderBy("kind", PART).collect()
    sizes = dict(taken)
    shifts = []
    for block in blocks:
        before, rows = sizes[block["kind"]]
        shifts.append((block["kind"], block[PART], before - block["first"]))
        sizes[block["kind"]] = (before + block["keys"], rows + block["rows"])
    shift = keys.sparkSession.createDataFrame(shifts, f"kind string, {PART} int, shift bigint")
    table = staged.join(F.broadcast(shift), ["kind", PART]).select(
        "kind", "key", "n", (F.col(POS) + F.col("shift")).alias("code"),
    )
    return Codes(table, sizes)


def apply_codes(
    df: DataFrame, codes: Codes, columns: list[str], row_key: str | None = None,
    spread_by: list[str] | None = None, small: int = SMALL_LOOKUP_ROWS,
) -> DataFrame:
    """Replace each id column by its code; column order stays.

    ``row_key`` names a column that is unique and never NULL. With it, when
    more than one code table is too large to broadcast, only the ids go through
    those joins, and the wide rows are shuffled once instead of once per id.
    ``spread_by`` names columns that tell the rows of a hot id apart; by
    default the other ids do.
    """
    large = [c for c in columns if codes.sizes[c][0] > small]
    if row_key is not None and len(large) > 1:
        ids = df.select(F.col(row_key).alias("_row_key"), *columns)
        coded = apply_codes(ids, codes, columns, None, spread_by, small)
        coded = coded.select("_row_key", *[F.col(c).alias(f"_code_{c}") for c in columns])
        out = df.join(coded, F.col(row_key) == F.col("_row_key"))
    else:
        out = df.select("*", *[F.col(c).cast("string").alias(f"_id_{c}") for c in columns])
        for column in columns:
            lookup = codes.table.where(F.col("kind") == column).select(
                F.col("key").alias(f"_id_{column}"), "n", F.col("code").alias(f"_code_{column}"),
            )
            out = lookup_join(
                out, lookup, [f"_id_{column}"], "n",
                spread_by or [f"_id_{c}" for c in columns], small, codes.sizes[column],
            )
    return out.select([F.col(f"_code_{c}").alias(c) if c in columns else F.col(c) for c in df.columns])


def located(table: DataFrame) -> DataFrame:
    """Rows of a parquet table with the file and the place in it that they are read from."""
    return table.select("*", F.col("_metadata.file_name").alias(FILE), F.col("_metadata.row_index").alias(ROW))


def apply_codes_in_place(
    rows: DataFrame, codes: Codes, columns: list[str], folder: str, small: int = SMALL_LOOKUP_ROWS,
) -> Iterator[DataFrame]:
    """``apply_codes`` to ``located`` rows of the parquet table in ``folder``, in parts whose rows stay in place and order.

    Ids and places alone are joined with the codes and written by piece: whole files with PIECE_ROWS rows at most. A
    part reads a few pieces and gets the codes of each by broadcast, so wide rows are never shuffled. The table's files
    must be bounded, which FILE_ROWS is for. Every row comes out once, whatever its ids are.
    """
    spark, shown = rows.sparkSession, [c for c in rows.columns if c not in (FILE, ROW)]
    schema = rows.select(shown).schema
    ids = rows.select(FILE, ROW, *columns)
    pieces: list[list[str]] = []
    held = PIECE_ROWS
    for file, n in ids.groupBy(FILE).agg(F.count("*")).orderBy(FILE).collect():
        if held + n > PIECE_ROWS:
            pieces.append([])
            held = 0
        pieces[-1].append(file)
        held += n
    numbers = [(file, piece, number) for piece, files in enumerate(pieces) for number, file in enumerate(files)]
    coded = apply_codes(ids, codes, columns, small=small).join(
        F.broadcast(spark.createDataFrame(numbers, f"{FILE} string, _piece int, _number int")), FILE)
    placed = coded.select("_piece", _place(F.col("_number"), F.col(ROW)).alias("_place"), *[F.col(c).alias(f"_code_{c}") for c in columns])
    path = scratch_path(spark, "coded")
    placed.repartition("_piece").write.partitionBy("_piece").parquet(path)
    lookup = placed.drop("_piece").schema

    def piece_rows(piece: int) -> DataFrame:
        files = pieces[piece]
        number = F.element_at(F.map_from_arrays(F.array(*map(F.lit, files)), F.array(*map(F.lit, range(len(files))))), F.col("_metadata.file_name"))
        wide = spark.read.schema(schema).parquet(*[f"{folder.rstrip('/')}/{file}" for file in files])
        found = wide.select("*", _place(number, F.col("_metadata.row_index")).alias("_place")).join(
            F.broadcast(spark.read.schema(lookup).parquet(f"{path}/_piece={piece}")), "_place")
        return found.select([F.col(f"_code_{c}").alias(c) if c in columns else F.col(c) for c in shown])

    at_once = min(8, max(2, spark.sparkContext.defaultParallelism * FILE_ROWS // PIECE_ROWS))
    for first in range(0, len(pieces), at_once):
        yield reduce(DataFrame.unionByName, map(piece_rows, range(first, min(first + at_once, len(pieces)))))


def _place(file: Column, row: Column) -> Column:
    return F.shiftleft(file.cast("bigint"), 33).bitwiseOR(row)


def encode_ids(
    df: DataFrame, columns: list[str], row_key: str | None = None,
    spread_by: list[str] | None = None, small: int = SMALL_LOOKUP_ROWS,
) -> DataFrame:
    return apply_codes(df, dense_codes(df, columns), columns, row_key, spread_by, small)


def _unit(value: Column, low: Column, high: Column) -> Column:
    scaled = F.try_divide(value.cast("double") - low, high - low)
    return F.when(value.isNotNull(), F.coalesce(scaled, F.lit(0.0)))


def minmax_scale(
    df: DataFrame, columns: list[str], bounds: Mapping[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Scale ``columns`` to [0, 1]; a constant column becomes 0 and NULL stays NULL.

    Without ``bounds`` all minima and maxima come from one aggregation, read as
    a scalar subquery.
    """
    if bounds is not None:
        return df.select([
            _unit(F.col(c), *map(F.lit, bounds[c])).alias(c) if c in columns else F.col(c) for c in df.columns
        ])
    edges = df.agg(F.struct(*[
        find(F.col(c).cast("double")).alias(f"{name}_{c}")
        for c in columns for name, find in (("low", F.min), ("high", F.max))
    ])).scalar()
    edge = F.col("_edges")
    return df.select("*", edges.alias("_edges")).select([
        _unit(F.col(c), edge[f"low_{c}"], edge[f"high_{c}"]).alias(c) if c in columns else F.col(c)
        for c in df.columns
    ])


def encode_and_scale(
    df: DataFrame, columns: list[str], row_key: str | None = None, small: int = SMALL_LOOKUP_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Encoded and scaled forms of ``df``; the encoded one is written once and shared."""
    codes = dense_codes(df, columns)
    encoded = materialize(apply_codes(df, codes, columns, row_key, small=small), "encoded")
    return encoded, minmax_scale(encoded, columns, codes.bounds())
