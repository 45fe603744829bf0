"""Calendar labels of review dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English weekday and month names in calendar order.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_date(text: Column) -> Column:
    """Timestamp of a ``yyyy-MM-dd HH:mm:ss`` string, NULL when it does not parse."""
    return F.try_to_timestamp(text, F.lit(DATE_FORMAT))


def label_of(names: list[str], index: Column) -> Column:
    """``names[index]``, NULL for a NULL index.

    Not ``element_at``: Spark takes that for never NULL when all names are
    constants, and then gives the last name for a missing date.
    """
    return F.get(F.array(*[F.lit(n) for n in names]), index)


def weekday_name(date: Column) -> Column:
    return label_of(WEEKDAYS, F.weekday(date))


def month_name(date: Column) -> Column:
    return label_of(MONTHS, F.month(date) - 1)
