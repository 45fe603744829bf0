"""Column names and schemas of the review table in its three forms."""

from __future__ import annotations

from pyspark.sql import types as T

REVIEW_COLUMNS = [
    "user_id", "text", "date", "review_id", "business_id", "funny", "cool", "useful", "stars",
]
ID_COLUMNS = ["user_id", "business_id", "review_id"]
VOTE_COLUMNS = ["funny", "cool", "useful"]
NUMERIC_COLUMNS = [*VOTE_COLUMNS, "stars"]
RATINGS = [1, 2, 3, 4, 5]

# Every raw cell is text, numbers included: b'...' or b"...".
RAW_REVIEWS = T.StructType([T.StructField(c, T.StringType()) for c in REVIEW_COLUMNS])


def _typed(id_type: T.DataType) -> T.StructType:
    kinds = {
        **dict.fromkeys(ID_COLUMNS, id_type),
        "text": T.StringType(),
        "date": T.TimestampType(),
        **dict.fromkeys(NUMERIC_COLUMNS, T.IntegerType()),
    }
    return T.StructType([T.StructField(c, kinds[c], nullable=False) for c in REVIEW_COLUMNS])


CLEAN_REVIEWS = _typed(T.StringType())
ENCODED_REVIEWS = _typed(T.LongType())
SCALED_REVIEWS = _typed(T.DoubleType())
