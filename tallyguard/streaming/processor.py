"""The micro-batch: raw layer, quality split, history, features, rules, model, tables, alerts, state, metrics, commit.

A batch has a token that depends only on its records. What an unfinished attempt left under the token is deleted first and
the commit marker is written last, so a batch takes effect once however often it is delivered. Raw rows and quarantine
are stored before duplicates go, so a batch of nothing but duplicates is still audited, and committed.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tallyguard.config import EnsembleConfig, RulesConfig
from tallyguard.functions.aggregates import count_where
from tallyguard.operators import history, models, rules, serving, silver, slices
from tallyguard.schemas import FEATURES, SILVER
from tallyguard.store import TableStore

WATERMARK = "2 hours"


def deduplicated(stream: DataFrame) -> DataFrame:
    """First delivery of each transaction within the watermark; its state is dropped once the watermark has passed.
    A delivery after that meets the committed filter of the batch."""
    return stream.withWatermark("kafka_timestamp", WATERMARK).dropDuplicatesWithinWatermark(["Trans_id"])


def together(*writes: Callable) -> list:
    """Results of writes that don't depend on each other, made at the same time. All have ended when an error is raised."""
    with ThreadPoolExecutor(len(writes)) as pool:
        return [made.result() for made in [pool.submit(inheritable_thread_target(w)) for w in writes]]


@dataclass
class BatchProcessor:
    store: TableStore
    rules: RulesConfig = field(default_factory=RulesConfig)
    ensemble: EnsembleConfig = field(default_factory=EnsembleConfig)
    #: Fitted members; without any, decisions come from rules alone.
    models: list = field(default_factory=list)
    #: Options of a Kafka alert sink; without them alerts are JSON files under their token.
    alert_options: dict | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> str | None:
        """Process one batch; the token, or None if there was nothing to do."""
        began, store = time.time(), self.store
        batch, judged = batch.persist(), None
        try:
            rows, most = batch.groupBy("Trans_id").agg(F.count("*").alias("n")).agg(F.sum("n"), F.max("n")).first()
            if not rows:
                return None
            token = history.batch_token(batch, batch_id)
            if store.is_committed(token):
                return token
            store.clear(token)
            # The stream has dropped repeats already; a batch without any isn't shuffled.
            judged = silver.add_dq_errors(silver.deduplicate(batch) if most > 1 else batch).persist()
            _, _, fresh = together(
                lambda: store.write_batch("bronze", batch.withColumn("ingest_date", F.to_date("kafka_timestamp")), token),
                lambda: store.write_batch("quarantine", silver.rejected(judged).withColumn("quarantine_date", F.to_date("quarantined_at")), token),
                lambda: store.stage(self._fresh(silver.to_silver(silver.accepted(judged)), token), f"fresh-{token}"),
            )
            counts = {"quarantined": store.read_batch("quarantine", token).count()}
            if not fresh.isEmpty():
                counts |= self._decide(fresh, token)
            store.unstage(f"fresh-{token}")
            store.unstage(f"scored-{token}")
            self._metrics(token, counts, time.time() - began)
            store.commit(token)
            store.unstage(f"state-{token}")
            return token
        finally:
            if judged is not None:
                judged.unpersist()
            batch.unpersist()

    def _fresh(self, batch: DataFrame, token: str) -> DataFrame:
        """The batch without transactions that another one has stored: only the id buckets that its ids fall into are read."""
        return history.drop_committed(batch, self.store.known_ids(batch.select("transaction_id")), token)

    def _decide(self, fresh: DataFrame, token: str) -> dict:
        store = self.store
        past = history.touched_history(fresh, store.read("silver", since=history.first_day(fresh))).select(*history.COLUMNS)
        scored = history.only_batch(slices.decide(history.with_history(fresh, past), self.rules))
        scored = models.score(scored, self.models, self.ensemble) if self.models else rules.without_model(scored)
        by = {f"{d.lower()}_count": count_where(F.col("decision") == d) for d in ("PASS", "FLAG", "BLOCK")}
        scored = store.stage(scored, f"scored-{token}")
        *_, counts = together(
            lambda: store.write_batch("decisions", scored, token),
            lambda: store.write_batch("silver", scored.select(*SILVER.fieldNames()), token),
            lambda: store.write_batch("features", scored.select(*FEATURES.fieldNames()), token),
            lambda: store.write_ids(scored, token),
            lambda: store.write_state(serving.client_state(scored), token),
            # One aggregate over the staged rows' few columns. (An Observation in a session breaks MLlib's evaluators there.)
            lambda: scored.agg(*(c.alias(n) for n, c in by.items()), F.avg("ml_probability").alias("avg_ml_probability"), F.count(F.lit(1)).alias("feature_rows")).first().asDict(),
        )
        counts["alerts"] = counts["flag_count"] + counts["block_count"]
        if counts["alerts"]:
            self._alert(serving.build_alerts(scored, token), token)
        return counts

    def _alert(self, alerts: DataFrame, token: str) -> None:
        if self.alert_options:
            alerts.write.format("kafka").options(**self.alert_options).save()
        else:
            alerts.write.mode("overwrite").json(f"{self.store.path('alerts')}/batch_part={token}")

    def _metrics(self, token: str, counts: dict, seconds: float | None) -> None:
        value = lambda k: F.lit(counts.get(k) or 0).cast("long").alias(k)
        row = self.store.spark.range(1).select(
            F.current_timestamp().alias("ts"), F.lit(token).alias("batch_token"), *map(value, ("pass_count", "flag_count", "block_count", "alerts", "quarantined", "feature_rows")),
            F.lit(counts.get("avg_ml_probability")).cast("double").alias("avg_ml_probability"), F.lit(seconds).cast("double").alias("duration_seconds"), value("late_dropped"),
        )
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.store.path('metrics')}/batch_part={token}")


def late_rows(progress) -> int:
    """Rows that the stateful operators of a progress report dropped as older than the watermark."""
    return sum(int(o["numRowsDroppedByWatermark"]) for o in progress["stateOperators"])


class LateRows(StreamingQueryListener):
    """Adds a row to the metrics for each batch of a query that dropped late rows. Their number is known only once a batch
    has ended, so it can't stand in the batch's own row."""

    def __init__(self, processor: BatchProcessor, name: str):
        self.processor, self.name, self.run = processor, name, None

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run = event.runId

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self.name and (dropped := late_rows(event.progress)):
            self.processor._metrics(f"late-{event.progress.id}-{event.progress.batchId}", {"late_dropped": dropped}, None)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run:
            self.processor.store.spark.streams.removeListener(self)


def run_stream(stream: DataFrame, processor: BatchProcessor, checkpoint: str, interval: str | None = "10 seconds"):
    """Start the query; with ``interval`` None it takes what is there and ends."""
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    name = f"decisions-{uuid.uuid4().hex}"
    processor.store.spark.streams.addListener(LateRows(processor, name))
    return deduplicated(stream).writeStream.queryName(name).foreachBatch(lambda df, i: processor(df, i)).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def alert_stream(alerts: DataFrame, target: str, checkpoint: str, watermark: str = "1 day"):
    """Consume delivered alerts, each id once within the watermark, into Parquet files."""
    parsed = alerts.select(F.from_json("value", serving.ALERT_SCHEMA).alias("a")).select("a.*").withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["alert_id"])
    return parsed.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
