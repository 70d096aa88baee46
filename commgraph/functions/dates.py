"""Dates that come as text, padded or not."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(text: Column) -> Column:
    """A date from Y-M-D; null where it is none."""
    return F.try_to_timestamp(text, F.lit("yyyy-M-d")).cast("date")
