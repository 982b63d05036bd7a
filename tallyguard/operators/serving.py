"""What leaves the pipeline: alerts, and the latest state of each client."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ALERT_SCHEMA = "alert_id string, batch_token string, transaction_id bigint, client_id bigint, amount_usd decimal(18,4), currency string, decision string, risk_score int, matched_rules array<string>, event_time timestamp"
STATE_COLUMNS = ("client_id", "last_transaction_id", "last_decision", "last_risk_score", "last_matched_rules", "last_event_time", "updated_at")


def build_alerts(decided: DataFrame, token: str) -> DataFrame:
    """(key, value) of every decision other than PASS; the key is the same on every retry."""
    alert = decided.where("decision <> 'PASS'").withColumn("batch_token", F.lit(token)).withColumn("alert_id", F.concat_ws(":", F.lit(token), F.col("transaction_id")))
    fields = ("alert_id", "batch_token", "transaction_id", "client_id", "amount_usd", "currency", "decision", "risk_score", "matched_rules", "event_time")
    return alert.select(F.col("alert_id").alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def new_alerts(delivered: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Delivered alerts as columns, each id once, without those already stored."""
    rows = delivered.select(F.from_json("value", ALERT_SCHEMA).alias("a")).select("a.*").dropDuplicates(["alert_id"])
    return rows if stored is None else rows.join(stored.select("alert_id"), "alert_id", "left_anti")


def latest_per_client(decided: DataFrame) -> DataFrame:
    """The row of each client's latest transaction, ties by id; Catalyst limits each group before the shuffle."""
    latest = Window.partitionBy("client_id").orderBy(F.desc("event_time"), F.desc("transaction_id"))
    return decided.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n")


def client_state(decided: DataFrame) -> DataFrame:
    """The state rows that a batch of decisions asks for."""
    return latest_per_client(decided).select("client_id", F.col("transaction_id").alias("last_transaction_id"), F.col("decision").alias("last_decision"), F.col("risk_score").alias("last_risk_score"), F.array_join("matched_rules", ",").alias("last_matched_rules"), F.col("event_time").alias("last_event_time"), F.current_timestamp().alias("updated_at"))


def upsert_state(existing: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """The new version of the state table: a later event replaces an earlier one, never the other way round."""
    both = incoming if existing is None else existing.unionByName(incoming)
    latest = Window.partitionBy("client_id").orderBy(F.desc("last_event_time"), F.desc("last_transaction_id"))
    return both.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n")


def lookup(state: DataFrame, client_id: int) -> DataFrame:
    return state.where(F.col("client_id") == int(client_id))
