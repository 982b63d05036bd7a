"""Features and rules of clients that are too large for one window task.

Where no client has more than HOT_ROWS rows, everything is one window partition by client. The rows of larger ones take
another way to the same columns, on which no task holds a client:

* Time frames need no rows. A client's rows are first combined, before the shuffle, into one cell for each second. The frames run over
  cells, a window partition for each client and day with the cells of the neighbouring hours as a halo: at most one cell a second.
* Row frames (the last 30 rows, the row before) run over slices of a client's rows: a day, or a stretch of about SLICE_ROWS rows of it, cut
  between two seconds by the running count over the cells. Each slice takes over the last 30 rows before it, from the ends of the slices before.
* Whether a device is new depends on the second of its use before: a step back over the distinct seconds of (client, device, day), or the
  last of an earlier day.

What is left in one task is a single second of a client, the ends of its slices (PRIOR_ROWS rows in SLICE_ROWS), a day's seconds of it or of one of its
devices, and a row for each day. Rows whose client or time is null are not in Silver; here they stay with the small clients.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.config import RulesConfig
from tallyguard.operators import features, rules
from tallyguard.operators.history import BROADCAST_ROWS

#: A client with more rows is sliced, in slices of about so many.
HOT_ROWS, SLICE_ROWS = 1_000_000, 100_000
#: A window task sorts its rows several times, about a kilobyte a row: so many rows at most on average, however large the table.
WINDOW_ROWS = 100_000
DAY = 86400


def spread(df: DataFrame, rows: int, window_rows: int = 0) -> DataFrame:
    """``df`` of about ``rows`` rows by client, in as many partitions as keep a task's share of them small; few rows are left to Spark.
    A number that is asked for isn't coalesced, and windows by client need no other exchange."""
    window_rows = window_rows or WINDOW_ROWS
    return df if rows <= window_rows else df.repartition(max(-(-rows // window_rows), df.sparkSession.sparkContext.defaultParallelism), "client_id")


def client_rows(rows: DataFrame) -> DataFrame:
    """(client_id, _n, _timed): how many rows each client has, and how many of them windows over time apply to."""
    return rows.groupBy("client_id").agg(F.count("*").alias("_n"), F.count(F.when(F.col("client_id").isNotNull() & F.col("event_time").isNotNull(), 1)).alias("_timed"))


def hot_clients(rows: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(client_id) of the clients with more than ``hot_rows`` rows: at most one for each ``hot_rows`` of all rows."""
    return client_rows(rows).where(F.col("_timed") > hot_rows).select("client_id")


def _cells(rows: DataFrame, config: RulesConfig) -> DataFrame:
    """One row for each client and second."""
    return rows.groupBy("client_id", features.seconds().alias("_t")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("amount_usd").alias("_amount"), F.sum(F.when(rules.structured(config), 1).otherwise(0)).alias("_near"),
        F.max(rules.withdrawn()).alias("_out"), F.min(rules.large_deposit(config)).alias("_in"),
    )


def time_frames(rows: DataFrame, config: RulesConfig, slice_rows: int) -> DataFrame:
    """(client_id, _t, the time frames of that second, _day and _part of the slice that it lies in)."""
    behind, ahead = max(features.VELOCITY_SECONDS, features.SUM_SECONDS, config.velocity_seconds, config.structuring_seconds, config.mule_seconds), config.mule_seconds
    day = lambda t: F.floor(t / F.lit(DAY))
    cells = _cells(rows, config)
    # A halo longer than a day reaches over several; sequence() lists all days whose frames a cell can lie in.
    halo = cells.withColumn("_day", F.explode(F.sequence(day(F.col("_t") - ahead), day(F.col("_t") + behind)))).withColumn("_own", F.col("_day") == day(F.col("_t")))
    over = lambda before, after=0: Window.partitionBy("client_id", "_day").orderBy("_t").rangeBetween(-before, after)
    before = F.sum(F.when(F.col("_own"), F.col("_n")).otherwise(0)).over(Window.partitionBy("client_id", "_day").orderBy("_t").rowsBetween(Window.unboundedPreceding, -1))
    framed = halo.select(
        "client_id", "_t", "_day", "_own",
        F.sum("_n").over(over(features.VELOCITY_SECONDS)).alias("_count_5m"), F.sum("_amount").over(over(features.SUM_SECONDS)).alias("_sum_1h"),
        F.sum("_n").over(over(config.velocity_seconds)).alias("_rule_count"), F.sum("_near").over(over(config.structuring_seconds)).alias("_structured"),
        F.max("_out").over(over(0, ahead)).alias("_next_out"), F.min("_in").over(over(config.mule_seconds)).alias("_last_in"),
        F.floor(F.coalesce(before, F.lit(0)) / F.lit(slice_rows)).alias("_part"),
    )
    return framed.where("_own").drop("_own")


def device_gaps(rows: DataFrame) -> DataFrame:
    """(client_id, device_id, _t, seconds since the device's use before that second)."""
    uses = rows.where("device_id is not null").select("client_id", "device_id", features.seconds().alias("_t")).distinct().withColumn("_day", F.floor(F.col("_t") / F.lit(DAY)))
    days = uses.groupBy("client_id", "device_id", "_day").agg(F.max("_t").alias("_last"))
    days = days.select("client_id", "device_id", "_day", F.lag("_last").over(Window.partitionBy("client_id", "device_id").orderBy("_day")).alias("_before"))
    today = F.lag("_t").over(Window.partitionBy("client_id", "device_id", "_day").orderBy("_t"))
    known = uses.withColumn("_today", today).join(days, ["client_id", "device_id", "_day"])
    return known.select("client_id", "device_id", "_t", (F.col("_t") - F.coalesce("_today", "_before")).alias("_gap"))


#: What a slice takes over of the rows before it.
CARRIED = ("event_time", "transaction_id", "amount_usd", "country_src")


def carried(sliced: DataFrame) -> DataFrame:
    """For each slice the last PRIOR_ROWS rows of its client before it, under the slice's own name."""
    rows = sliced.select("client_id", "_day", "_part", *CARRIED)
    backwards = Window.partitionBy("client_id", "_day", "_part").orderBy(F.desc("event_time"), F.desc("transaction_id"))
    ends = rows.withColumn("_back", F.row_number().over(backwards)).where(F.col("_back") <= features.PRIOR_ROWS)
    # A slice's end goes to each slice that begins among the next PRIOR_ROWS ends: nearly always one.
    first = F.row_number().over(Window.partitionBy("client_id", "_day", "_part").orderBy("event_time", "transaction_id")) == 1
    order = Window.partitionBy("client_id").orderBy("_day", "_part", "event_time", "transaction_id")
    begun = F.collect_list(F.when(F.col("_first"), F.struct("_day", "_part"))).over(order.rowsBetween(1, features.PRIOR_ROWS))
    return ends.withColumn("_first", first).withColumn("_to", begun).select("client_id", *CARRIED, F.inline("_to"))


def sliced_frames(rows: DataFrame, config: RulesConfig, slice_rows: int = SLICE_ROWS) -> tuple[DataFrame, dict[str, Column]]:
    """``rows`` of large clients with the columns of features.frames() and rules.frames(), and these columns by name."""
    keyed = rows.withColumn("_t", features.seconds())
    sliced = keyed.join(time_frames(rows, config, slice_rows), ["client_id", "_t"]).join(device_gaps(rows), ["client_id", "device_id", "_t"], "left")
    # The ends need the slices only, so they are cut once more from the few columns that are carried.
    names = keyed.select("client_id", "_t", *CARRIED).join(time_frames(rows, config, slice_rows).select("client_id", "_t", "_day", "_part"), ["client_id", "_t"])
    both = sliced.withColumn("_own", F.lit(True)).unionByName(carried(names).withColumn("_own", F.lit(False)), allowMissingColumns=True)
    order = Window.partitionBy("client_id", "_day", "_part").orderBy("event_time", "transaction_id")
    prior = order.rowsBetween(-features.PRIOR_ROWS, -1)
    later = F.row_number().over(order) > 1  # a slice that isn't the first has taken rows over
    new = lambda lookback: later & (F.col("device_id").isNull() | F.col("_gap").isNull() | (F.col("_gap") > lookback))
    amount = F.col("amount_usd")
    framed = {
        "_prior_sum": F.sum(amount).over(prior), "_prior_count": F.count(amount).over(prior), "_prior_deviation": F.stddev_pop(amount.cast("double")).over(prior),
        "_previous_seconds": F.lag(features.seconds()).over(order), "_previous_country": F.lag("country_src").over(order), "_new_30d": new(features.DEVICE_SECONDS), "_rule_new": new(config.new_device_seconds),
    }
    wide = both.select("*", *(c.alias(n) for n, c in framed.items())).where("_own")
    found = [*framed, "_count_5m", "_sum_1h", "_rule_count", "_structured", "_next_out", "_last_in"]
    return wide, {n: F.col(n) for n in found} | {"_rule_seconds": F.col("_previous_seconds"), "_rule_country": F.col("_previous_country")}


def decide(silver: DataFrame, config: RulesConfig | None = None, hot_rows: int = HOT_ROWS, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Silver rows with features, matched_rules, risk_score and decision, whatever the number of a client's rows."""
    config = config or RulesConfig()
    hot = hot_clients(silver, hot_rows).select(F.col("client_id").alias("_hot"))
    total, found = client_rows(silver).agg(F.sum("_n"), F.count(F.when(F.col("_timed") > hot_rows, 1))).first()
    if not found:
        return rules.apply_rules(features.add_features(spread(silver, total or 0)), config)
    ids = F.broadcast(hot) if found <= BROADCAST_ROWS else hot
    client = F.when(F.col("event_time").isNotNull(), F.col("client_id")) == F.col("_hot")
    return decide_both(spread(silver.join(ids, client, "left_anti"), total), silver.join(ids, client, "left_semi"), config, slice_rows)


def decide_both(few: DataFrame, many: DataFrame, config: RulesConfig, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Decisions over the rows of small clients and those of large ones."""
    cold = rules.apply_rules(features.add_features(few), config)
    wide, frame = sliced_frames(many, config, slice_rows)
    return cold.unionByName(rules.apply_rules(features.add_features(wide, frame), config, frame).select(cold.columns))
