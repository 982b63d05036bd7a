"""Quantiles over any range of days from sketches that are stored with each day.

A day's rows are sketched once (KLL, mergeable, of bounded size whatever the number of rows). A question about many days merges their sketches,
a few kilobytes a day, and reads no row again. The rank of an answer is off by about 1.7 / SKETCH_SIZE of the rows, with 99 % confidence.
Nulls aren't counted; a range without values answers null. Days are replaced one by one, as the decisions they stand for are.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The sketch's k.
SKETCH_SIZE = 4096
SHARES = (0.5, 0.95, 0.99)


def daily_sketches(rows: DataFrame, value: str, size: int = SKETCH_SIZE, date: str = "event_date") -> DataFrame:
    """(date, values, sketch) of each day that has values."""
    known = rows.where(F.col(value).isNotNull()).select(date, F.col(value).cast("double").alias("_v"))
    return known.groupBy(date).agg(F.count("*").alias("values"), F.kll_sketch_agg_double("_v", F.lit(size)).alias("sketch"))


def range_quantiles(sketches: DataFrame, ranges: DataFrame, shares: tuple[float, ...] = SHARES, date: str = "event_date", size: int = SKETCH_SIZE) -> DataFrame:
    """(first_day, last_day, values, and p50, p95, ... for each share) of each range of days.

    ``ranges``: (first_day, last_day), few rows. A day is sent to each range that holds it.
    """
    held = F.broadcast(ranges.select("first_day", "last_day").distinct())
    met = held.join(sketches, (F.col(date) >= F.col("first_day")) & (F.col(date) <= F.col("last_day")), "left")
    merged = met.groupBy("first_day", "last_day").agg(F.coalesce(F.sum("values"), F.lit(0)).alias("values"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("_all"))
    name = lambda s: "p" + f"{100 * s:g}".replace(".", "_")
    return merged.select("first_day", "last_day", "values", *(F.when(F.col("values") > 0, F.kll_sketch_get_quantile_double("_all", F.lit(float(s)))).alias(name(s)) for s in shares))


def refresh(store, day_rows: DataFrame, value: str, name: str = "score_sketches") -> None:
    """Sketch the days that ``day_rows`` holds whole and replace their sketches in a table of the store."""
    store.overwrite_days(name, daily_sketches(day_rows, value))


def days_to(last: datetime.date, lengths: tuple[int, ...]):
    """Rows (first_day, last_day) of the ranges of so many days that end on ``last``."""
    return [(last - datetime.timedelta(days=n - 1), last) for n in lengths]
