"""Small aggregate expressions that several operators share."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def share_where(condition: Column, places: int = 4) -> Column:
    """The share of rows that fulfil a condition, as a double; null without rows."""
    return F.round(count_where(condition).cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0)).cast("double"), places)
