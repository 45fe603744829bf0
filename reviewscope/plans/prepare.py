"""Raw reviews to model-ready tables, every step under a name of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewscope.functions.cleaning import clean_reviews
from reviewscope.operators.encode import FILE_ROWS, apply_codes_in_place, dense_codes, located, minmax_scale
from reviewscope.operators.lookup import SMALL_LOOKUP_ROWS
from reviewscope.operators.slices import first_rows
from reviewscope.schema import ID_COLUMNS
from reviewscope.sources import write_parquet


def prepare_tables(
    raw: DataFrame, folder: str, working_rows: int | None = None, subset_rows: int | None = None,
    small: int = SMALL_LOOKUP_ROWS,
) -> dict[str, DataFrame]:
    """Write ``clean``, ``encoded``, ``scaled`` and ``subset`` below ``folder``.

    * clean: all reviews, typed
    * encoded: ids as whole numbers from 0, what the recommender needs
    * scaled: ids in [0, 1], what the trees need
    * subset: only with ``subset_rows``, that many first rows of ``scaled``

    All reviews are encoded, or with ``working_rows`` that many first ones by
    review id.

    Texts are never shuffled: every table keeps the order of ``raw``, so that what stands side by side there is
    compressed side by side.
    """
    spark = raw.sparkSession

    def path_of(name: str) -> str:
        return f"{folder.rstrip('/')}/{name}"

    def keep(df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
        write_parquet(df, path_of(name), mode, compression="zstd", maxRecordsPerFile=FILE_ROWS)
        return spark.read.schema(df.schema).parquet(path_of(name))

    clean = keep(clean_reviews(raw), "clean")
    working = located(clean)
    if working_rows is not None:
        working = first_rows(working, working_rows, "review_id")
    codes = dense_codes(working, ID_COLUMNS)
    # The empty table stands for what earlier runs left, and where no row is encoded.
    encoded = keep(clean.limit(0).select([F.col(c).cast("bigint") if c in ID_COLUMNS else F.col(c) for c in clean.columns]), "encoded")
    for part in apply_codes_in_place(working, codes, ID_COLUMNS, path_of("clean"), small):
        keep(part, "encoded", "append")
    encoded = open_table(spark, folder, "encoded", encoded.schema)
    scaled = keep(minmax_scale(encoded, ID_COLUMNS, codes.bounds()), "scaled")
    tables = {"clean": clean, "encoded": encoded, "scaled": scaled}
    if subset_rows is not None:
        # Codes ascend with the review id, so scaled ids do too.
        tables["subset"] = keep(first_rows(scaled, subset_rows, "review_id"), "subset")
    return tables


def open_table(spark: SparkSession, folder: str, name: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder.rstrip('/')}/{name}")
