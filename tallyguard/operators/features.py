"""Point-in-time features of each client's transactions.

All windows lie on one hash partitioning by client, so Catalyst plans a single exchange. Frames are bounded or answered by
a row number; whether a device is new is a count over (client, device) instead of a set that grows with the client.
"Point in time" is to the second: a RANGE frame that ends now includes peers of the same second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VELOCITY_SECONDS = 300
SUM_SECONDS = 3600
PRIOR_ROWS = 30
DEVICE_SECONDS = 2592000


def seconds() -> Column:
    return F.unix_seconds(F.col("event_time"))


def sequence() -> Window:
    """A client's transactions one after the other; ties in time go by id."""
    return Window.partitionBy("client_id").orderBy("event_time", "transaction_id")


def within(before: int, after: int = 0) -> Window:
    return Window.partitionBy("client_id").orderBy(seconds()).rangeBetween(-before, after)


def device_is_new(lookback: int) -> Column:
    """The client has an earlier row, and none on this device in the lookback up to the second before."""
    seen = F.count(F.lit(1)).over(Window.partitionBy("client_id", "device_id").orderBy(seconds()).rangeBetween(-lookback, -1))
    return (F.row_number().over(sequence()) > 1) & (F.col("device_id").isNull() | (seen == 0))


def frames() -> dict[str, Column]:
    """The windows that features stand on, by name. Another way to compute the same columns gives add_features() their names."""
    amount, prior = F.col("amount_usd"), sequence().rowsBetween(-PRIOR_ROWS, -1)
    return {
        "_count_5m": F.count(F.lit(1)).over(within(VELOCITY_SECONDS)),
        "_sum_1h": F.sum(amount).over(within(SUM_SECONDS)),
        "_prior_sum": F.sum(amount).over(prior),
        "_prior_count": F.count(amount).over(prior),
        "_prior_deviation": F.stddev_pop(amount.cast("double")).over(prior),
        "_previous_seconds": F.lag(seconds()).over(sequence()),
        "_previous_country": F.lag("country_src").over(sequence()),
        "_new_30d": device_is_new(DEVICE_SECONDS),
    }


def add_features(silver: DataFrame, frame: dict[str, Column] | None = None) -> DataFrame:
    frame = frame or frames()
    amount, before, country = F.col("amount_usd"), frame["_previous_seconds"], frame["_previous_country"]
    wide = silver.select(
        "*",
        frame["_count_5m"].cast("double").alias("txn_count_5m"),
        F.coalesce(frame["_sum_1h"].cast("double"), F.lit(0.0)).alias("amount_sum_1h"),
        F.coalesce((frame["_prior_sum"].cast("double") / F.nullif(frame["_prior_count"], F.lit(0)).cast("double")), F.lit(0.0)).alias("avg_amount_prior_30"),
        F.coalesce(frame["_prior_deviation"], F.lit(0.0)).alias("stddev_amount_prior_30"),
        F.coalesce(F.greatest(seconds() - before, F.lit(0)).cast("double"), F.lit(0.0)).alias("seconds_since_prev_txn"),
        F.when(frame["_new_30d"], 1.0).otherwise(0.0).alias("device_new_30d"),
        F.when(country.isNotNull() & (F.col("country_src") != country), 1.0).otherwise(0.0).alias("country_changed"),
    )
    average = F.col("avg_amount_prior_30")
    return wide.withColumn("amount_to_prior_avg", F.when(average > 0, amount.cast("double") / average).otherwise(1.0))
