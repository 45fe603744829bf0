"""Named outputs: CSV for exchange, Parquet between our own stages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from reviewscope.sources.readers import CSV_DIALECT


def write_csv(df: DataFrame, path: str, compression: str = "none", file_rows: int = 0) -> None:
    """Write a folder of CSV files with headers and no row-number column.

    NULL is written as \\N and an empty text as "", so ``readers`` tells them
    apart. A text that is \\N itself is read back as NULL.
    With ``compression`` (gzip) files are read whole by a task each, as ``read_csv_reviews`` does
    anyway; ``read_csv_split`` cuts plain files, and takes a compressed one as one split. ``file_rows``
    bounds the rows of a file, so that compressed files are small splits, too.
    """
    options = {k: v for k, v in CSV_DIALECT.items() if k != "multiLine"}
    options["emptyValue"] = '""'
    df.write.mode("overwrite").options(**options, compression=compression, maxRecordsPerFile=file_rows).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    df.write.mode(mode).options(**options).parquet(path)
