"""Scans of review tables from CSV files, Parquet folders and the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewscope.schema import RAW_REVIEWS

# Review text may hold quotes, commas and line breaks. multiLine makes one CSV
# file one task, so large inputs should come as many files and be written to
# parquet once before anything else reads them.
CSV_DIALECT = {
    "header": True, "multiLine": True, "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    "nullValue": r"\N", "emptyValue": "",
}


def read_csv_reviews(spark: SparkSession, path: str, schema: T.StructType = RAW_REVIEWS) -> DataFrame:
    """CSV scan with a fixed schema: no extra pass, and only the selected columns are parsed."""
    return spark.read.options(**CSV_DIALECT).schema(schema).csv(path)


def read_csv_typed(spark: SparkSession, path: str) -> DataFrame:
    """CSV scan that finds column types by reading the files once more."""
    return spark.read.options(**CSV_DIALECT).option("inferSchema", True).csv(path)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql("SELECT * FROM IDENTIFIER(:name)", args={"name": name})


def load_reviews(spark: SparkSession, source: str, schema: T.StructType | None = None) -> DataFrame:
    """Load from a ``.csv`` path, a parquet path, or a table or view name.

    Anything with a slash or a ``.csv``/``.parquet`` ending is a path.
    """
    if source.rstrip("/").endswith(".csv"):
        return read_csv_typed(spark, source) if schema is None else read_csv_reviews(spark, source, schema)
    if "/" in source or source.endswith(".parquet"):
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(source)
    return scan_table(spark, source)


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema`` and fail on a NULL in a required column.

    File readers ignore "not null"; this puts it back. The check is a filter,
    so it costs no extra pass and holds also where the caller counts rows or
    selects other columns.
    """
    required = [f.name for f in schema.fields if not f.nullable]
    cast = df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    passes = F.lit(True)
    for name in required:
        missing = F.raise_error(F.lit(f"NULL in required column {name}")).cast("boolean")
        passes = F.when(F.col(name).isNull(), missing).otherwise(passes)
    return cast.where(passes) if required else cast
