"""Cleaning of byte-literal cells such as ``b'text'``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewscope.schema import NUMERIC_COLUMNS


def strip_byte_prefix(value: Column) -> Column:
    """Remove a leading ``b`` when a quote follows it; other text stays as it is."""
    quoted = value.startswith("b'") | value.startswith('b"')
    return F.when(quoted, F.substr(value, F.lit(2))).otherwise(value)


def strip_quotes(value: Column) -> Column:
    """Remove runs of ``'`` at both ends, then runs of ``"``."""
    for quote in ("'", '"'):
        value = F.rtrim(F.ltrim(value, F.lit(quote)), F.lit(quote))
    return value


def clean_reviews(raw: DataFrame, numeric: list[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Clean every column in one projection; numeric cells that hold no whole number become NULL."""
    def cleaned(name: str) -> Column:
        value = strip_quotes(strip_byte_prefix(F.col(name)))
        if name in numeric:
            number = value.try_cast("double")
            value = F.when(number == F.floor(number), number.try_cast("int"))
        elif name == "date":
            value = F.try_to_timestamp(value, F.lit("yyyy-MM-dd HH:mm:ss"))
        return value.alias(name)

    return raw.select([cleaned(c) for c in raw.columns])
