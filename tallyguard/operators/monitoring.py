"""Pipeline health from a table of one row a batch: rolling five-minute rates, the conditions on them, and how long they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

METRICS = "ts timestamp, batch_token string, pass_count bigint, flag_count bigint, block_count bigint, alerts bigint, quarantined bigint, feature_rows bigint, avg_ml_probability double, duration_seconds double, late_dropped bigint"
# The limits of the conditions.
MAX_P95_SECONDS = 30.0
MAX_QUARANTINE_RATE = 0.10
MAX_ALERT_RATE = 0.25
#: Seconds for which a condition must hold before it is told.
HOLDING = {"batch_slow": 300, "quarantine_high": 600, "alert_spike": 600, "features_stalled": 300}
#: Seconds between two evaluations.
SLIDE = 30


def rolling_rates(batches: DataFrame, window: str = "5 minutes", slide: str = "30 seconds", exact: bool = False) -> DataFrame:
    """Per-second rates and the p95 duration of each sliding window, from (ts, decisions, alerts, quarantined, feature_rows, duration_seconds)."""
    p95 = F.percentile("duration_seconds", 0.95) if exact else F.percentile_approx("duration_seconds", 0.95)
    summed = batches.groupBy(F.window("ts", window, slide).alias("w")).agg(F.sum("decisions").alias("decisions"), F.sum("alerts").alias("alerts"), F.sum("quarantined").alias("quarantined"), F.sum("feature_rows").alias("feature_rows"), p95.alias("p95_duration"))
    length = (F.unix_timestamp("w.end") - F.unix_timestamp("w.start")).cast("double")
    return summed.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *((F.col(c).cast("double") / length).alias(f"{c}_rate") for c in ("decisions", "alerts", "quarantined", "feature_rows")), "p95_duration")


def conditions(rates: DataFrame) -> DataFrame:
    """Which limits a window breaks. Ratios divide by at least one decision a second, as the rates are per second."""
    base = F.greatest(F.col("decisions_rate"), F.lit(1.0))
    return rates.select(
        "window_start", "window_end", (F.col("p95_duration") > MAX_P95_SECONDS).alias("batch_slow"), (F.col("quarantined_rate") / base > MAX_QUARANTINE_RATE).alias("quarantine_high"),
        (F.col("alerts_rate") / base > MAX_ALERT_RATE).alias("alert_spike"), ((F.col("feature_rows_rate") == 0) & (F.col("decisions_rate") > 0)).alias("features_stalled"),
    )


def sustained(flags: DataFrame, holding: dict[str, int] | None = None, slide: int = SLIDE) -> DataFrame:
    """The stretches over which a condition held: condition, started, ended, evaluations, fired, fired_at.

    ``flags``: window_end and a boolean for each condition, as from conditions(); windows end ``slide`` seconds apart. A window where the condition doesn't
    hold (or is null) ends its stretch, and so does a window without batches, which isn't there. A stretch fires at its first evaluation that comes
    ``holding`` seconds or more after its beginning. Evaluations that hold are numbered by time in each condition; in one stretch, time
    less number times ``slide`` stays the same, so that one aggregate finds all stretches.
    """
    holding = holding or HOLDING
    each = F.inline(F.array(*(F.struct(F.lit(c).alias("condition"), F.col(c).alias("holds"), F.lit(h).alias("holding")) for c, h in holding.items())))
    true = flags.select(F.unix_seconds("window_end").alias("at"), each).where("holds")
    number = F.row_number().over(Window.partitionBy("condition").orderBy("at"))
    runs = true.withColumn("run", F.col("at") - number * slide).groupBy("condition", "holding", "run").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("evaluations"))
    wait = F.ceil(F.col("holding") / slide) * slide
    fired = F.col("last") - F.col("first") >= F.col("holding")
    return runs.select("condition", F.timestamp_seconds("first").alias("started"), F.timestamp_seconds("last").alias("ended"), "evaluations", fired.alias("fired"), F.when(fired, F.timestamp_seconds(F.col("first") + wait)).alias("fired_at"))
