"""Registered queries: each applies one operator to the transactions that the adapter derives from ``events``.

Results are flattened for comparison: decimals as doubles, times as epoch seconds, dates and lists as text.
"""

from __future__ import annotations

import datetime
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.config import QualityContract, RulesConfig
from tallyguard.operators import evaluate, features, gold, history, monitoring, quality, rules, scoring, serving, silver, sketches, slices
from tallyguard.operators.models import class_weights, dataset_signature, member_metrics, time_cutoff, time_split
from tallyguard.plans import oracles
from tallyguard.schemas import DECISIONS, FEATURE_NAMES
from tallyguard.sources import adapter, decode, readers
from tallyguard.store import TableStore, missing_tokens
from tallyguard.streaming import client_state
from tallyguard.streaming.processor import BatchProcessor, alert_stream, run_stream


def flat(df: DataFrame) -> DataFrame:
    def plain(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.unix_seconds(c)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("long")
        return c.alias(f.name)

    return df.select(*map(plain, df.schema.fields))


def rounded(df: DataFrame, **places: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in places.items()})


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared place that the cluster names; a session of one machine may do without."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    shared = shared or tempfile.mkdtemp(prefix="spark-scratch-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table, as a store holds them: what reads them several times doesn't derive them several times."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def raw(spark, sf_dir):
    return adapter.raw_transactions(spark, sf_dir)


def silver_of(spark, sf_dir):
    return silver.to_silver(silver.split_valid_invalid(raw(spark, sf_dir))[0])


WINDOW_ROWS = slices.WINDOW_ROWS


def featured(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()  # from the files' footers
    return features.add_features(slices.spread(silver_of(spark, sf_dir), events, WINDOW_ROWS))


def ruled(spark, sf_dir):
    return rules.apply_rules(featured(spark, sf_dir))


def decided(spark, sf_dir):
    """Rules and the ensemble's policy over given member probabilities."""
    offset = F.col("transaction_id") - 100001
    members = ruled(spark, sf_dir).withColumn("m0", F.when(offset % 13 != 0, offset % 101 / F.lit(100.0))).withColumn("m1", offset % 37 / F.lit(100.0))
    return rules.apply_policy(members, ["m0", "m1"])


def labelled(spark, sf_dir):
    return evaluate.joined(ruled(spark, sf_dir), adapter.fraud_labels(spark, sf_dir))


def flagship(spark, sf_dir):
    """Transactions, mean risk and amount by decision."""
    out = ruled(spark, sf_dir).groupBy("decision").agg(F.count("*").alias("transactions"), F.round(F.avg("risk_score"), 4).alias("mean_risk"), F.sum("amount_usd").alias("total_amount_usd"))
    return flat(out)


#: Queries over a batch and its history split the rows here, so that both together are all of them.
BATCH_FROM = datetime.date(2026, 9, 3)


def _sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Batch and history by event date."""
    late = F.col("event_date") >= F.lit(BATCH_FROM)
    return rows.where(late), rows.where(~late)


def _told(rows: DataFrame, key: str, taken: DataFrame, name: str, *more: str) -> DataFrame:
    """Each row's key (and ``more``) and whether it is among ``taken``, which must hold a key once."""
    return rows.select(key, *more).join(taken.select(key, F.lit(True).alias(name)), key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def a2_confluent_metadata(spark, sf_dir):
    lined = decode.extract_confluent_metadata(adapter.broker_records(spark, sf_dir))
    return flat(lined.select((F.col("offset") + 100001).alias("transaction_id"), "kafka_confluent_magic", "kafka_schema_id"))


def a3_strip_header(spark, sf_dir):
    bare = decode.strip_confluent_header(adapter.broker_records(spark, sf_dir))
    text = F.col("value").cast("string")
    return flat(bare.select(F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), F.get_json_object(text, "$.Trans_id").cast("long").alias("transaction_id"), F.get_json_object(text, "$.Currency").alias("currency")))


def a4_decode(spark, sf_dir):
    names = "Trans_id, Clt_id, Card_id, Dev_id, Trans_amount, Trans_date, Trans_type, Trans_status, Currency, Country_Src, kafka_partition, kafka_offset, kafka_timestamp, kafka_confluent_magic, kafka_schema_id"
    return flat(decode.decode_transactions(adapter.broker_records(spark, sf_dir)).select(*names.split(", ")))


#: A reader names a layer's columns and types, so that a changed file is an error and none has to be opened to learn them.
EVENTS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def a5_layer_scan(spark, sf_dir):
    layer = readers.read_layer(spark, f"{sf_dir}/events.parquet", EVENTS)
    return flat(layer.withColumn("ts", F.col("ts").cast("timestamp")))


def a6_table_scan(spark, sf_dir):
    silver_of(spark, sf_dir).createOrReplaceTempView("silver_transactions")
    return readers.read_table(spark, "silver_transactions").groupBy("currency").agg(F.count("*").alias("n"))


def a8_labels_csv(spark, sf_dir):
    path = scratch(spark, "labels")
    adapter.fraud_labels(spark, sf_dir).write.option("header", True).csv(path)
    return flat(readers.read_labels(spark, path))


def a9_replay(spark, sf_dir):
    path = scratch(spark, "replay")
    fixed = raw(spark, sf_dir).withColumn("Clt_id", F.coalesce("Clt_id", F.lit(0)))  # what an operator corrects before the replay
    fixed = fixed.select(*(c for c in fixed.columns if not c.startswith("kafka_")))
    lines = fixed.select(F.to_json(F.struct(*fixed.columns)).alias("value"))
    lines.union(lines.limit(1).select(F.lit("").alias("value"))).union(lines.limit(1).select(F.lit("{broken").alias("value"))).write.text(path)
    return flat(readers.read_replay(spark, path)[0].select("key", "Trans_id", "Trans_amount"))


#: What client_state() reads, and the day.
STATE_INPUTS = ("client_id", "transaction_id", "decision", "risk_score", "matched_rules", "event_time", "event_date")


def a14_upsert_state(spark, sf_dir):
    """The newer days first, then the older ones: no client's state goes back in time."""
    late, early = _sides(stored(decided(spark, sf_dir).select(*STATE_INPUTS), "decided"))
    return flat(serving.upsert_state(serving.client_state(late), serving.client_state(early)).drop("updated_at"))


def a14_state_buckets(spark, sf_dir):
    """The state table after a batch of the newer days and one of the older ones, each of which replaced the buckets of its clients."""
    store = TableStore(spark, scratch(spark, "lake"))
    late, early = _sides(stored(decided(spark, sf_dir).select(*STATE_INPUTS), "decided"))
    for token, batch in (("late", late), ("early", early)):
        store.write_state(serving.client_state(batch), token)
        store.unstage(f"state-{token}")
    return flat(store.state().drop("updated_at"))


def a13_retried_batches(spark, sf_dir):
    """Silver of two batches after a failed attempt, a retry and a repeat: (transaction_id, the batch that holds it)."""
    store, s = TableStore(spark, scratch(spark, "lake")), stored(silver_of(spark, sf_dir), "silver")
    late, early = _sides(s)
    store.write_batch("silver", early.where("card_id = 1"), "first")  # an attempt that ends before its last rows
    store.write_batch("silver", late, "second")
    store.clear("first")
    store.write_batch("silver", early, "first")
    store.write_batch("silver", late, "second")  # the same batch delivered again
    store.commit("second")
    return store.read("silver").select("transaction_id", "batch_token")


def a19_replaced_days(spark, sf_dir):
    """Gold rows written twice: wrong at first, then the newer days again; the older days that the second run doesn't hold stay, a day is deleted."""
    store = TableStore(spark, scratch(spark, "lake"))
    made = stored(gold.customer_daily_risk(decided(spark, sf_dir)), "gold")
    late, early = _sides(made)
    store.overwrite_days("customer_daily_risk", early.unionByName(late.withColumn("txn_count", F.col("txn_count") * 2)))
    store.overwrite_days("customer_daily_risk", late)
    store.clear_days("customer_daily_risk", [datetime.date(2026, 9, 2)])
    return flat(readers.read_layer(spark, store.path("customer_daily_risk"), made.schema))


def a26_compaction(spark, sf_dir):
    """Silver of four batches, one of them not committed, after each of its days is compacted: rows, and the part that holds them."""
    store, s = TableStore(spark, scratch(spark, "lake")), stored(silver_of(spark, sf_dir), "silver")
    for card in (1, 2, 3):
        store.write_batch("silver", s.where((F.col("card_id") == card) & (F.col("currency") != "EGP")), f"card{card}")
        store.commit(f"card{card}")
    store.write_batch("silver", s.where("currency = 'EGP'"), "open")
    for (day,) in s.select("event_date").distinct().collect():  # a row for each day
        store.compact("silver", day)
    parts = spark.read.schema(store.schema("silver")).parquet(store.path("silver"))
    return parts.select("transaction_id", "batch_token", "batch_part")


def a15_alert_stream(spark, sf_dir):
    """Alerts that are delivered twice, consumed by the stream that stores each once."""
    base = scratch(spark, "alerts")
    alerts = serving.build_alerts(decided(spark, sf_dir), "tok")
    for _ in range(2):
        alerts.write.mode("append").parquet(f"{base}/topic")
    topic = readers.read_stream(spark, f"{base}/topic", schema=alerts.schema, per_trigger=1_000_000)
    alert_stream(topic, f"{base}/inbox", f"{base}/checkpoint").awaitTermination()
    return flat(spark.read.parquet(f"{base}/inbox").select("alert_id", "client_id", "decision", "risk_score", "amount_usd"))


def _decisions_stored(spark, sf_dir) -> TableStore:
    store = TableStore(spark, scratch(spark, "lake"))
    for token, side in zip(("late", "early"), _sides(stored(decided(spark, sf_dir).select(*DECISIONS.fieldNames()), "decisions"))):
        store.write_batch("decisions", side, token)
        store.commit(token)
    return store


def a18_export(spark, sf_dir):
    """One day's decisions, exported."""
    store = _decisions_stored(spark, sf_dir)
    store.export_decisions("2026-09-02", store.path("export"))
    return flat(spark.read.parquet(store.path("export")).select("transaction_id", "decision", "risk_score", "batch_token"))


def a23_catalog_tables(spark, sf_dir):
    """The decisions as an external table of the catalog, by day and batch."""
    store, name = _decisions_stored(spark, sf_dir), f"lake_{uuid.uuid4().hex}"
    store.create_tables(name)
    found = stored(spark.table(f"{name}.decisions").groupBy("event_date", "batch_part").agg(F.count("*").alias("rows"), F.sum("risk_score").alias("risk")), "found")
    spark.sql(f"DROP DATABASE {name} CASCADE")
    return flat(found)


def a16_alert_dedup(spark, sf_dir):
    rows = decided(spark, sf_dir).withColumn("alert_id", F.concat_ws(":", F.lit("tok"), "transaction_id"))
    alerts = serving.build_alerts(rows.drop("alert_id"), "tok")
    return _told(rows, "alert_id", serving.new_alerts(alerts.union(alerts), _sides(rows)[1].select("alert_id")), "new", "client_id", "decision")


def a17_state_lookup(spark, sf_dir):
    return flat(serving.lookup(serving.client_state(decided(spark, sf_dir)), 7).select("client_id", "last_transaction_id", "last_decision"))


def a22_commit_markers(spark, sf_dir):
    tokens = raw(spark, sf_dir).select(F.concat(F.lit("p"), F.col("kafka_partition")).alias("batch_token"))
    return missing_tokens(tokens, tokens.where("batch_token = 'p1'"))


def a24_dead_letters(spark, sf_dir):
    r = raw(spark, sf_dir)
    good = F.to_json(F.struct(*(c for c in r.columns if not c.startswith("kafka_"))))
    lines = r.select(F.when(F.col("Trans_id") % 10 == 0, F.concat(F.lit("{broken "), F.col("Trans_id"))).otherwise(good).alias("value"))
    return decode.dead_letters(lines).select("reason", F.get_json_object("envelope", "$.record").alias("record"))


def a25_null_probability(spark, sf_dir):
    return rules.without_model(ruled(spark, sf_dir)).select("transaction_id", "decision", "ml_probability")


def b1_dq_errors(spark, sf_dir):
    return flat(silver.add_dq_errors(raw(spark, sf_dir)).select("Trans_id", "dq_errors"))


def b2_split(spark, sf_dir):
    valid, invalid = silver.split_valid_invalid(raw(spark, sf_dir))
    both = valid.select(F.lit("valid").alias("part"), "Trans_id").union(invalid.select(F.lit("invalid"), "Trans_id"))
    return both.groupBy("part").agg(F.count("*").alias("n"), F.sum("Trans_id").alias("ids"))


def b3_silver(spark, sf_dir):
    return flat(silver_of(spark, sf_dir).select("transaction_id", "client_id", "card_id", "device_id", "fx_rate", "amount_usd", "currency", "txn_type", "status", "country_src", "event_time", "event_date"))


def b4_fx_rate(spark, sf_dir):
    return flat(raw(spark, sf_dir).select("Trans_id", silver.fx_rate(F.col("Currency")).alias("fx_rate")))


def b5_amount_usd(spark, sf_dir):
    return flat(raw(spark, sf_dir).select("Trans_id", silver.to_usd(F.col("Trans_amount"), silver.fx_rate(F.col("Currency"))).alias("amount_usd")))


def b6_high_amount(spark, sf_dir):
    return silver_of(spark, sf_dir).where(rules.rule_flags(RulesConfig())["HIGH_AMOUNT"]).select("transaction_id")


def b7_non_pass(spark, sf_dir):
    return decided(spark, sf_dir).where("decision <> 'PASS'").select("transaction_id", "decision")


def b8_one_day(spark, sf_dir):
    return flat(decided(spark, sf_dir).where(F.col("event_date") == F.lit(datetime.date(2026, 9, 2))).select("transaction_id", "risk_score"))


def b9_history_bound(spark, sf_dir):
    s = silver_of(spark, sf_dir)
    return _told(s, "transaction_id", history.touched_history(*_sides(s), hours=24), "taken")


def b11_ranges(spark, sf_dir):
    return silver_of(spark, sf_dir).where(F.col("amount_usd").between(8000, 9999) | F.col("country_src").isin("USA", "Jordan")).select("transaction_id")


def b12_transaction_risk_view(spark, sf_dir):
    return flat(gold.fraud_transaction_risk(decided(spark, sf_dir).withColumn("batch_token", F.concat(F.lit("p"), F.col("card_id")))))


def c1_drop_committed(spark, sf_dir):
    s = stored(silver_of(spark, sf_dir).select("transaction_id", "card_id", "event_date"), "silver")
    there = _sides(s)[1].withColumn("batch_token", F.when(F.col("card_id") == 2, "own").otherwise("other"))
    return _told(s, "transaction_id", history.drop_committed(s, there, "own"), "kept")


def c1_id_ledger(spark, sf_dir):
    """The same decision from the id ledger of a store, in buckets with bloom filters, folded into one part a bucket."""
    s, store = stored(silver_of(spark, sf_dir).select("transaction_id", "card_id", "event_date"), "silver"), TableStore(spark, scratch(spark, "lake"))
    there = _sides(s)[1]
    store.write_ids(there.where("card_id = 2"), "own")
    store.write_ids(there.where("card_id <> 2"), "other")
    store.commit("other")
    store.compact_ids()
    return _told(s, "transaction_id", history.drop_committed(s, store.known_ids(s), "own"), "kept")


def c2_touched_history(spark, sf_dir):
    s = silver_of(spark, sf_dir)
    return _told(s, "transaction_id", history.touched_history(_sides(s)[0], s), "taken")


def c3_batch_of_history(spark, sf_dir):
    """Rules over a batch with its history; each side is the batch once, so that every row is decided."""
    late, early = _sides(silver_of(spark, sf_dir))
    made = [history.only_batch(rules.apply_rules(history.with_history(*x))) for x in ((late, early), (early, late))]
    return flat(made[0].unionByName(made[1]).select("transaction_id", "matched_rules", "risk_score", "decision"))


def c5_labelled_decisions(spark, sf_dir):
    return flat(labelled(spark, sf_dir).select("transaction_id", "decision", "is_fraud", "pattern"))


def d1_customer_daily_risk(spark, sf_dir):
    return flat(gold.customer_daily_risk(decided(spark, sf_dir)))


def d2_daily_kpis(spark, sf_dir):
    return flat(gold.daily_kpis(decided(spark, sf_dir), gold.calendar(spark, datetime.date(2026, 9, 6), 7)))


def d4_daily_kpis_view(spark, sf_dir):
    return flat(gold.daily_fraud_kpis(decided(spark, sf_dir)))


def d5_client_risk_view(spark, sf_dir):
    return flat(gold.client_risk_summary(decided(spark, sf_dir)))


def d6_feature_monitoring_view(spark, sf_dir):
    return rounded(flat(gold.fraud_feature_monitoring(featured(spark, sf_dir))), avg_txn_count_5m=6, avg_amount_sum_1h=4, avg_amount_to_prior_avg=4, new_device_rate=6, country_change_rate=6)


def d7_model_monitoring_view(spark, sf_dir):
    return rounded(flat(gold.model_decision_monitoring(decided(spark, sf_dir), exact=True)), avg_ml_probability=6, p50_ml_probability=6, p95_ml_probability=6)


def d8_decision_counts(spark, sf_dir):
    return decided(spark, sf_dir).groupBy("decision").agg(F.count("*").alias("n"), F.round(F.avg("ml_probability"), 6).alias("mean_probability"))


def d10_offset_summary(spark, sf_dir):
    return flat(history.offset_summary(adapter.raw_transactions(spark, sf_dir, duplicates=True)))


def d11_batch_token(spark, sf_dir):
    return history.token_frame(adapter.raw_transactions(spark, sf_dir, duplicates=True))


def d12_distinct_clients(spark, sf_dir):
    return silver_of(spark, sf_dir).select("client_id").distinct()


def d13_deduplicate(spark, sf_dir):
    return flat(silver.deduplicate(adapter.raw_transactions(spark, sf_dir, duplicates=True)).select("Trans_id", "kafka_partition", "kafka_offset"))


def d14_dataset_signature(spark, sf_dir):
    return dataset_signature(silver_of(spark, sf_dir).withColumn("label", (F.col("device_id") >= 900000).cast("double")))


def d15_class_counts(spark, sf_dir):
    return adapter.fraud_labels(spark, sf_dir).agg(F.count_if(F.col("is_fraud") == 1).alias("positives"), F.count_if(F.col("is_fraud") == 0).alias("negatives"))


def d16_time_cutoff(spark, sf_dir):
    return flat(time_cutoff(silver_of(spark, sf_dir), exact=True))


def d17_min_event_time(spark, sf_dir):
    return flat(silver_of(spark, sf_dir).agg(F.min("event_time").alias("first_event")))


def e1_features(spark, sf_dir):
    f = featured(spark, sf_dir).select("transaction_id", "txn_count_5m", "amount_sum_1h", "avg_amount_prior_30", "stddev_amount_prior_30", "seconds_since_prev_txn", "device_new_30d", "country_changed", "amount_to_prior_avg")
    return rounded(f, stddev_amount_prior_30=3)


def _flag(rule: str, name: str):
    def query(spark, sf_dir):
        s = silver_of(spark, sf_dir)
        return s.select("transaction_id", F.coalesce(rules.rule_flags(RulesConfig())[rule], F.lit(False)).alias(name))

    return query


#: Clients of so many rows count as large in the next two queries, and are cut into slices of so many.
LARGE, SLICE = 60, 16


def e1_sliced_features(spark, sf_dir):
    """Features with large clients cut into slices, the others in one window each."""
    f = slices.decide(stored(silver_of(spark, sf_dir), "silver"), None, LARGE, SLICE).select("transaction_id", *FEATURE_NAMES)
    return rounded(f, stddev_amount_prior_30=3)


def r1_sliced_rules(spark, sf_dir):
    return flat(slices.decide(stored(silver_of(spark, sf_dir), "silver"), None, LARGE, SLICE).select("transaction_id", "matched_rules", "risk_score", "decision"))


def st11_client_state(spark, sf_dir):
    """Features from state kept for each client: a stream that is started again for each day's rows, from its checkpoint."""
    base, s = scratch(spark, "stream"), silver_of(spark, sf_dir)
    for (day,) in s.select("event_date").distinct().orderBy("event_date").collect():  # a row for each day
        s.where(F.col("event_date") == F.lit(day)).write.mode("append").parquet(f"{base}/silver")
        source = readers.read_stream(spark, f"{base}/silver", schema=s.schema, per_trigger=1_000_000)
        client_state.run_features(spark, source, f"{base}/features", f"{base}/checkpoint").awaitTermination()
    f = spark.read.parquet(f"{base}/features").select("transaction_id", *FEATURE_NAMES)
    return rounded(f, stddev_amount_prior_30=3)


#: Of the stream's older rows every so-manieth is held back and delivered last, with its own old time.
HELD_BACK = 100


def st1_stream_run(spark, sf_dir):
    """A bounded stream through the whole micro-batch: every delivery with the day it came and what became of it.

    Days come one after the other, each in a run that goes on from the checkpoint, with their repeats; rows held back come last, behind the
    watermark. ``raw`` counts rows of the raw layer, ``decision`` is that of the decisions table.
    """
    base = scratch(spark, "stream")
    store = TableStore(spark, f"{base}/lake")
    sent = adapter.raw_transactions(spark, sf_dir, duplicates=True).withColumn("_day", F.to_date("kafka_timestamp"))
    sent = sent.withColumn("_day", F.when((F.col("Trans_id") % HELD_BACK == 3) & (F.col("_day") < F.lit(BATCH_FROM)), F.lit(datetime.date(2026, 12, 31))).otherwise(F.col("_day")))
    for (day,) in sent.select("_day").distinct().orderBy("_day").collect():  # a row for each day
        sent.where(F.col("_day") == F.lit(day)).drop("_day").write.mode("append").parquet(f"{base}/landing")
        source = readers.read_stream(spark, f"{base}/landing", schema=sent.drop("_day").schema, per_trigger=1_000_000)
        run_stream(source, BatchProcessor(store), f"{base}/checkpoint", interval=None).awaitTermination()
    rawest = store.read("bronze").groupBy(F.col("Trans_id").cast("long").alias("transaction_id")).agg(F.count("*").alias("raw"))
    quarantined = store.read("quarantine").select(F.col("Trans_id").cast("long").alias("transaction_id"), F.lit(True).alias("bad"))
    ids = sent.groupBy(F.col("Trans_id").cast("long").alias("transaction_id")).agg(F.count("*").alias("sent"))
    made = ids.join(rawest, "transaction_id", "left").join(store.read("decisions").select("transaction_id", "decision", "matched_rules", "risk_score"), "transaction_id", "left").join(quarantined, "transaction_id", "left")
    return flat(made.select("transaction_id", "sent", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("bad", F.lit(False)).alias("quarantined"), "decision", "matched_rules", "risk_score"))


def e15_latest_per_client(spark, sf_dir):
    return serving.latest_per_client(decided(spark, sf_dir)).select("client_id", "transaction_id")


def r1_apply_rules(spark, sf_dir):
    return flat(rules.apply_rules(silver_of(spark, sf_dir)).select("transaction_id", "matched_rules", "risk_score", "decision"))


#: Rules as a settings file may give them.
OTHER_RULES = RulesConfig(high_amount_usd=5000, structuring_min_usd=2000, structuring_max_usd=4000, structuring_count=2, structuring_seconds=7200, travel_seconds=86400, mule_ratio="0.50", mule_min_deposit_usd=1000, velocity_count=2, velocity_seconds=3600, new_device_usd=1000, far_countries=("Jordan",), severity={"HIGH_AMOUNT": "MEDIUM", "STRUCTURING": "HIGH", "IMPOSSIBLE_TRAVEL": "MEDIUM", "MULE": "HIGH", "VELOCITY": "MEDIUM", "NEW_DEVICE_HIGH_VALUE": "MEDIUM"}, weights={"HIGH": 60, "MEDIUM": 15})


def r6_configured_rules(spark, sf_dir):
    """Rules under other settings."""
    return flat(rules.apply_rules(silver_of(spark, sf_dir), OTHER_RULES).select("transaction_id", "matched_rules", "risk_score", "decision"))


def r5_ensemble_policy(spark, sf_dir):
    return flat(decided(spark, sf_dir).select("transaction_id", "ml_probability", "risk_score", "decision"))


def j1_alerts(spark, sf_dir):
    made = serving.build_alerts(decided(spark, sf_dir), "tok")
    parsed = made.select("key", F.from_json("value", serving.ALERT_SCHEMA).alias("a"))
    return flat(parsed.select("key", *(f"a.{c}" for c in ("transaction_id", "client_id", "amount_usd", "currency", "decision", "risk_score", "matched_rules", "event_time"))))


def u1_history_union(spark, sf_dir):
    late, early = _sides(silver_of(spark, sf_dir))
    return history.with_history(late, early.withColumn("batch_token", F.lit("old"))).select("transaction_id", F.col("_in_batch").alias("in_batch"))


def q4_quality_report(spark, sf_dir):
    return quality.validation_report(silver_of(spark, sf_dir))


def q6_daily_reports(spark, sf_dir):
    """The contract of every day, over raw rows with their faults."""
    rows = raw(spark, sf_dir).withColumn("event_date", F.to_date("kafka_timestamp"))
    return flat(quality.daily_reports(rows, QualityContract(("Clt_id", "Currency"), (("Trans_amount", 0, True), ("Trans_amount", 500, False)))))


def q2_raw_quality(spark, sf_dir):
    return quality.validation_report(raw(spark, sf_dir), QualityContract(("Clt_id",), (("Trans_amount", 0, True),)))


def q7_recovery_check(spark, sf_dir):
    return quality.recovery_check(silver_of(spark, sf_dir), (100001, 100500), (100501, 200000))


def v1_confusion(spark, sf_dir):
    return evaluate.precision_recall(evaluate.confusion(labelled(spark, sf_dir)))


def v3_recall_by_pattern(spark, sf_dir):
    return evaluate.recall_by_pattern(labelled(spark, sf_dir))


def v4_precision_by_rule(spark, sf_dir):
    return evaluate.precision_by_rule(labelled(spark, sf_dir))


def v5_report(spark, sf_dir):
    """The evaluation report as rows: (part, name, n, value)."""
    made = evaluate.report(stored(ruled(spark, sf_dir).select("transaction_id", "decision", "matched_rules"), "decided"), stored(adapter.fraud_labels(spark, sf_dir), "labels"))
    rows = [("counts", k, made["counts"][k], None) for k in ("tp", "fp", "fn", "tn")] + [("rates", k, None, made["counts"][k]) for k in ("precision", "recall", "f1")] + [("size", k, made[k], None) for k in ("n_matched", "n_decisions", "n_labels")]
    rows += [("pattern", r["pattern"], r["n"], r["recall"]) for r in made["per_pattern_recall"]] + [("rule", r["rule"], r["fired"], r["precision"]) for r in made["per_rule_precision"]]
    return rounded(spark.createDataFrame(rows, "part string, name string, n bigint, value double"), value=9)


def m3_time_split(spark, sf_dir):
    train, check = time_split(silver_of(spark, sf_dir), exact=True)
    both = train.select(F.lit(True).alias("early")).union(check.select(F.lit(False)))
    return both.agg(F.count_if("early").alias("training_rows"), F.count_if(~F.col("early")).alias("validation_rows"))


def m4_class_weights(spark, sf_dir):
    labels = adapter.fraud_labels(spark, sf_dir).select("Trans_id", F.col("is_fraud").cast("double").alias("label"))
    return class_weights(labels).select("Trans_id", F.round("weight", 9).alias("weight"))


#: A small given ensemble over these inputs: amount, rows in five minutes, new device, withdrawal.
GIVEN_INPUTS = (scoring.numeric_input("amount_usd"), scoring.numeric_input("txn_count_5m"), scoring.numeric_input("device_new_30d"), scoring.indicator_input("txn_type", "Withdrawal"))
GIVEN = {
    "logistic": scoring.Member("logistic", GIVEN_INPUTS, coefficients=(0.0004, 0.5, 1.25, 0.75), intercept=-3.0),
    "forest": scoring.Member("forest", GIVEN_INPUTS, (
        scoring.Node(0, 0, None, 1, 2, 0, 2500.0), scoring.Node(0, 1, 0.05), scoring.Node(0, 2, None, 3, 4, 3, None, (0.0,)), scoring.Node(0, 3, 0.4), scoring.Node(0, 4, 0.9),
        scoring.Node(1, 0, None, 1, 2, 2, 0.5), scoring.Node(1, 1, 0.15), scoring.Node(1, 2, 0.8),
    )),
    "boosted": scoring.Member("boosted", GIVEN_INPUTS, (scoring.Node(0, 0, None, 1, 2, 0, 4000.0), scoring.Node(0, 1, -1.0), scoring.Node(0, 2, 0.6), scoring.Node(1, 0, None, 1, 2, 1, 1.0), scoring.Node(1, 1, -0.25), scoring.Node(1, 2, 1.5)), {0: 1.0, 1: 0.5}),
}


def m9_exported_scores(spark, sf_dir):
    """A given release as expressions: members' probabilities, and the policy over them."""
    rows = scoring.probabilities(ruled(spark, sf_dir), GIVEN)
    made = rules.apply_policy(rows.withColumns({f"_{m}": F.col(m) for m in GIVEN}), [f"_{m}" for m in GIVEN])
    return rounded(flat(made.select("transaction_id", *GIVEN, "ml_probability", "risk_score", "decision")), **{m: 9 for m in (*GIVEN, "ml_probability")})


def m6_member_metrics(spark, sf_dir):
    """Two given members against the labels."""
    offset = F.col("transaction_id") - 100001
    scored = labelled(spark, sf_dir).select("transaction_id", F.col("is_fraud").cast("double").alias("label"), F.when(offset % 13 != 0, offset % 101 / F.lit(100.0)).alias("m0"), (offset % 37 / F.lit(100.0)).alias("m1"))
    made = member_metrics(stored(scored, "scored"), ["m0", "m1"], 0.7)
    return rounded(made, auc=9, auprc=9, precision=9, recall=9, f1=9)


def d7_approximate_view(spark, sf_dir):
    """The view's percentiles as they run in production."""
    return flat(gold.model_decision_monitoring(decided(spark, sf_dir)).select("event_date", "scored_rows", "p50_ml_probability", "p95_ml_probability"))


def d7_range_quantiles(spark, sf_dir):
    """Risk bands over ranges of days, from sketches that are stored day by day; the last two days are sketched once more."""
    store = TableStore(spark, scratch(spark, "lake"))
    bands = stored(decided(spark, sf_dir).select("event_date", (F.floor(F.col("risk_score") / 10) * 10).alias("band")), "bands")
    sketches.refresh(store, bands, "band")
    sketches.refresh(store, _sides(bands)[0], "band")
    ranges = spark.createDataFrame(sketches.days_to(datetime.date(2026, 9, 5), (1, 2, 3, 4, 30)), "first_day date, last_day date")
    return flat(sketches.range_quantiles(readers.read_layer(spark, store.path("score_sketches")), ranges, (0.25, 0.5, 0.75, 0.95)))


def d16_approximate_cutoff(spark, sf_dir):
    """The cutoff as training takes it: the share of rows before it, to the three places that its error leaves."""
    rows = stored(silver_of(spark, sf_dir).select("event_time"), "times")
    early = F.count_if(F.col("event_time") < F.lit(time_cutoff(rows).first()["cutoff"]))
    return rows.agg(F.count("*").alias("rows"), F.round(early / F.count("*"), 3).alias("early_share"))


def batches_of(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select(F.col("ts").cast("timestamp").alias("ts"), (F.col("event_id") % 7).alias("decisions"), (F.col("event_id") % 3).alias("alerts"), (F.col("event_id") % 97 == 96).cast("int").alias("quarantined"), (F.col("event_id") % 5).alias("feature_rows"), F.col("value").alias("duration_seconds"))


def mt2_rolling_rates(spark, sf_dir):
    rates = flat(monitoring.rolling_rates(batches_of(spark, sf_dir), exact=True))
    return rounded(rates, decisions_rate=6, alerts_rate=6, quarantined_rate=6, feature_rows_rate=6, p95_duration=6)


def mt3_conditions(spark, sf_dir):
    return flat(monitoring.conditions(monitoring.rolling_rates(batches_of(spark, sf_dir), exact=True)))


def mt3_sustained(spark, sf_dir):
    """How long each condition held, and whether that was long enough to be told."""
    return flat(monitoring.sustained(monitoring.conditions(monitoring.rolling_rates(batches_of(spark, sf_dir), exact=True))))


_FLAGS = {"e9_mule": ("MULE", "mule"), "e11_velocity": ("VELOCITY", "velocity"), "e12_structuring": ("STRUCTURING", "structuring"), "e13_impossible_travel": ("IMPOSSIBLE_TRAVEL", "impossible_travel"), "e14_new_device": ("NEW_DEVICE_HIGH_VALUE", "new_device")}

QUERIES = {
    f.__name__: f
    for f in (
        a2_confluent_metadata, a3_strip_header, a4_decode, a5_layer_scan, a6_table_scan, a8_labels_csv, a9_replay, a14_upsert_state, a16_alert_dedup, a17_state_lookup, a22_commit_markers, a24_dead_letters, a25_null_probability,
        b1_dq_errors, b2_split, b3_silver, b4_fx_rate, b5_amount_usd, b6_high_amount, b7_non_pass, b8_one_day, b9_history_bound, b11_ranges, b12_transaction_risk_view,
        c1_drop_committed, c2_touched_history, c3_batch_of_history, c5_labelled_decisions,
        d1_customer_daily_risk, d2_daily_kpis, d4_daily_kpis_view, d5_client_risk_view, d6_feature_monitoring_view, d7_model_monitoring_view, d8_decision_counts, d10_offset_summary, d11_batch_token, d12_distinct_clients, d13_deduplicate, d14_dataset_signature, d15_class_counts, d16_time_cutoff, d17_min_event_time,
        e1_features, e15_latest_per_client, r1_apply_rules, r5_ensemble_policy, j1_alerts, u1_history_union, q4_quality_report, q2_raw_quality, q7_recovery_check, v1_confusion, v3_recall_by_pattern, v4_precision_by_rule, m3_time_split, m4_class_weights, d7_approximate_view, d16_approximate_cutoff, mt2_rolling_rates, mt3_conditions,
        a13_retried_batches, a14_state_buckets, a19_replaced_days, a26_compaction, c1_id_ledger, e1_sliced_features, r1_sliced_rules, m6_member_metrics, mt3_sustained, st1_stream_run, st11_client_state, d7_range_quantiles, m9_exported_scores, a15_alert_stream, a18_export, a23_catalog_tables, q6_daily_reports, r6_configured_rules, v5_report,
    )
}
QUERIES |= {name: _flag(*x) for name, x in _FLAGS.items()} | {"k1_flagship": flagship}
ORACLES = {name: oracles.ORACLES[name] for name in QUERIES if name in oracles.ORACLES}
