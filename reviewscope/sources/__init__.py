from reviewscope.sources.quoted_csv import read_csv_split
from reviewscope.sources.readers import (
    enforce_schema, load_reviews, read_csv_reviews, read_csv_typed, scan_table,
)
from reviewscope.sources.writers import write_csv, write_parquet

__all__ = [
    "enforce_schema", "load_reviews", "read_csv_reviews", "read_csv_split", "read_csv_typed", "scan_table",
    "write_csv", "write_parquet",
]
