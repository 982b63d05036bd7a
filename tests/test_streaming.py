"""The micro-batch end to end, on temporary tables."""

import datetime
import json
import time

import pytest
from pyspark.sql import functions as F

from tallyguard.operators import models
from tallyguard.plans import jobs
from tallyguard.sources import decode, readers
from tallyguard.store import TableStore
from tallyguard.streaming.processor import BatchProcessor, alert_stream, late_rows, run_stream
from tests.helpers import T0, raw_frame


def stamp(seconds):
    return (T0 + datetime.timedelta(seconds=seconds)).strftime("%Y-%m-%d %I:%M:%S %p")


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "lake"))


def test_routing_alerts_and_commit(spark, store):
    run = BatchProcessor(store)
    token = run(raw_frame(spark, [{"Trans_amount": 15000}, {"Trans_id": 2, "Clt_id": 11}, {"Trans_id": 3, "Currency": "GBP"}, {"Trans_id": 2, "Clt_id": 11}]), 0)
    assert store.read("bronze").count() == 4 and store.read("quarantine").count() == 1
    got = {r["transaction_id"]: r["decision"] for r in store.read("decisions").collect()}
    assert got == {1: "BLOCK", 2: "PASS"} and store.is_committed(token)
    assert spark.read.json(store.path("alerts")).count() == 1
    assert store.state().count() == 2
    m = spark.read.parquet(store.path("metrics")).first()
    assert (m["block_count"], m["pass_count"], m["alerts"], m["quarantined"], m["feature_rows"]) == (1, 1, 1, 1, 2)
    assert run(raw_frame(spark, [{"Trans_amount": 15000}]).limit(0), 1) is None


def test_replay_and_retry_take_effect_once(spark, store):
    batch = raw_frame(spark, [{"Trans_id": 1}, {"Trans_id": 2, "Clt_id": 11}])
    run = BatchProcessor(store)
    token = run(batch, 0)
    assert run(batch, 7) == token and store.read("decisions").count() == 2
    # The marker is lost: the same records are done again, without doubling.
    readers.delete_path(spark, store.path("ledger"))
    run(batch, 0)
    assert store.read("decisions").count() == 2 and store.read("bronze").count() == 2
    # The same transactions under other offsets: audited and committed, but not decided again.
    again = run(raw_frame(spark, [{"Trans_id": 1}, {"Trans_id": 2, "Clt_id": 11}], first_offset=100), 1)
    assert store.read("decisions").count() == 2 and store.read("bronze").count() == 4 and store.is_committed(again)


def test_history_across_batches(spark, store):
    run = BatchProcessor(store)
    run(raw_frame(spark, [{"Trans_id": i, "Trans_date": stamp(20 * i)} for i in range(1, 6)]), 0)
    run(raw_frame(spark, [{"Trans_id": 6, "Trans_date": stamp(120)}], first_offset=50), 1)
    got = {r["transaction_id"]: list(r["matched_rules"]) for r in store.read("decisions").collect()}
    assert got[6] == ["VELOCITY"] and got[5] == []
    assert store.read("decisions").count() == 6


def test_device_history_of_29_days(spark, store):
    run = BatchProcessor(store)
    run(raw_frame(spark, [{"Trans_id": 1, "Trans_date": stamp(0)}]), 0)
    run(raw_frame(spark, [{"Trans_id": 2, "Trans_amount": 5000, "Trans_date": stamp(29 * 86400)}], first_offset=9), 1)
    assert [list(r["matched_rules"]) for r in store.read("decisions").where("transaction_id = 2").collect()] == [[]]


def test_gold_job_and_empty_day(spark, store):
    BatchProcessor(store)(raw_frame(spark, [{"Trans_id": 1}, {"Trans_id": 2, "Clt_id": 11}]), 0)
    out = jobs.run_gold(store, datetime.date(2026, 9, 2), lookback=2)
    assert out["quality"]["success"]
    kpis = {str(r["event_date"]): r["total_txns"] for r in spark.read.parquet(store.path("daily_kpis")).collect()}
    assert kpis == {"2026-09-01": 2, "2026-09-02": 0}
    readers.delete_path(spark, store.path("decisions"))
    readers.delete_path(spark, store.path("silver"))
    jobs.run_gold(store, datetime.date(2026, 9, 1))
    assert not readers.path_exists(spark, f"{store.path('customer_daily_risk')}/event_date=2026-09-01")


def test_export_and_compaction(spark, store, tmp_path):
    run = BatchProcessor(store)
    for k in range(3):
        run(raw_frame(spark, [{"Trans_id": 10 * k + i, "Clt_id": i} for i in range(1, 4)], first_offset=100 * k), k)
    before = sorted(map(str, store.read("decisions").drop("ingest_time").collect()))
    assert store.compact("decisions", datetime.date(2026, 9, 1)) == 1
    assert sorted(map(str, store.read("decisions").drop("ingest_time").collect())) == before
    assert store.read("decisions").select("batch_token").distinct().count() == 3
    assert store.export_decisions("2026-09-01", str(tmp_path / "out")) == 9
    with pytest.raises(ValueError):
        store.export_decisions("2026-09-05", str(tmp_path / "out2"))
    with pytest.raises(ValueError):
        store.export_decisions("soon", str(tmp_path / "out3"))


def test_catalog_tables(spark, store):
    BatchProcessor(store)(raw_frame(spark, [{"Trans_id": 1}]), 0)
    store.create_tables("lake_test")
    assert spark.table("lake_test.silver").count() == 1 and readers.layer_exists(spark, "lake_test.silver")
    spark.sql("drop database lake_test cascade")


def test_stream_drops_repeats_and_late_rows(spark, store, tmp_path):
    folder = tmp_path / "landing"
    late = {"Trans_id": 9, "kafka_timestamp": T0 - datetime.timedelta(hours=5)}
    for k, rows in enumerate([[{"Trans_id": 1}, {"Trans_id": 1}, {"Trans_id": 2, "Clt_id": 11}], [{"Trans_id": 3, "Clt_id": 12, "kafka_timestamp": T0 + datetime.timedelta(hours=1)}], [late, {"Trans_id": 4, "Clt_id": 13}]]):
        raw_frame(spark, rows, first_offset=10 * k).coalesce(1).write.mode("append").parquet(str(folder))
        stream = readers.read_stream(spark, str(folder), schema=raw_frame(spark, [{}]).schema, per_trigger=1)
        q = run_stream(stream, BatchProcessor(store), str(tmp_path / "cp"), interval=None)
        q.awaitTermination(120)
        dropped = max([0, *(late_rows(p) for p in q.recentProgress)])
    assert {r["transaction_id"] for r in store.read("decisions").collect()} == {1, 2, 3, 4} and dropped == 1


def test_late_rows_reach_the_metrics(spark, store, tmp_path):
    folder = tmp_path / "landing"
    late = {"Trans_id": 9, "kafka_timestamp": T0 - datetime.timedelta(hours=5)}
    for k, rows in enumerate([[{"Trans_id": 1}], [{"Trans_id": 3, "kafka_timestamp": T0 + datetime.timedelta(hours=1)}], [late, {"Trans_id": 4}]]):
        raw_frame(spark, rows, first_offset=10 * k).coalesce(1).write.mode("append").parquet(str(folder))
        stream = readers.read_stream(spark, str(folder), schema=raw_frame(spark, [{}]).schema, per_trigger=1)
        run_stream(stream, BatchProcessor(store), str(tmp_path / "cp"), interval=None).awaitTermination(120)
    for _ in range(40):  # progress is reported a little later
        told = spark.read.parquet(store.path("metrics")).agg({"late_dropped": "sum"}).first()[0]
        if told:
            break
        time.sleep(0.5)
    assert told == 1


def test_alert_stream(spark, store, tmp_path):
    BatchProcessor(store)(raw_frame(spark, [{"Trans_amount": 15000}]), 0)
    alerts = spark.read.json(store.path("alerts")).select("key", "value")
    alerts.union(alerts).coalesce(1).write.parquet(str(tmp_path / "topic"))
    q = alert_stream(spark.readStream.schema("key string, value string").parquet(str(tmp_path / "topic")), str(tmp_path / "inbox"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "inbox")).count() == 1


def test_ensemble_in_a_batch(spark, sf_dir, store, tmp_path):
    from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier

    from tallyguard.plans import registry

    data = registry.featured(spark, sf_dir).withColumn("label", (F.col("amount_usd") > 2000).cast("double")).persist()
    common = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}
    quick = {"logistic_regression": LogisticRegression(maxIter=10, **common), "random_forest": RandomForestClassifier(numTrees=5, maxDepth=4, seed=1, **common), "gbt": GBTClassifier(maxIter=3, maxDepth=3, seed=1, **common)}
    manifest = models.train_ensemble(data, str(tmp_path / "release"), estimators=quick)
    assert set(manifest["metrics"]) == set(quick) and all(m["auc"] >= 0.65 for m in manifest["metrics"].values())
    noise = data.withColumn("label", (F.xxhash64("transaction_id") % 2 == 0).cast("double"))
    with pytest.raises(ValueError, match="nothing was saved"):
        models.train_ensemble(noise, str(tmp_path / "weak"), estimators=quick)
    assert not (tmp_path / "weak").exists()
    with pytest.raises(ValueError, match="both classes"):
        models.train_ensemble(data.withColumn("label", F.lit(0.0)), str(tmp_path / "none"), estimators=quick)
    held = models.load_ensemble(spark, str(tmp_path / "release"))
    run = BatchProcessor(store, models=held)
    run(raw_frame(spark, [{"Trans_amount": 9000}, {"Trans_id": 2, "Clt_id": 11, "Trans_amount": 5}]), 0)
    got = {r["transaction_id"]: r["ml_probability"] for r in store.read("decisions").collect()}
    assert got[1] > got[2]


def test_sources(spark, tmp_path):
    import pyspark.errors

    big = spark.createDataFrame([(bytearray.fromhex("00FFFFFFFFAABB"),), (bytearray.fromhex("000000002AAABB"),)], "value binary")
    got = decode.strip_confluent_header(decode.extract_confluent_metadata(big)).collect()
    assert [r["kafka_schema_id"] for r in got] == [None, 42] and bytes(got[1]["value"]) == b"\xaa\xbb"
    (tmp_path / "l.csv").write_text("Trans_id,is_fraud,pattern\n1,1,MULE\n")
    assert readers.read_labels(spark, str(tmp_path / "l.csv")).first()["pattern"] == "MULE"
    (tmp_path / "r.json").write_text('{"Trans_id":1,"Clt_id":5}\n\n{broken\n')
    good, bad = readers.read_replay(spark, str(tmp_path / "r.json"))
    assert [r["key"] for r in good.collect()] == ["5"] and bad.count() == 1
    letters = decode.dead_letters(spark.createDataFrame([("{x",), (json.dumps({"Trans_id": 1}),)], "value string"))
    assert [json.loads(r["envelope"])["record"] for r in letters.collect()] == ["{x"]
    assert not readers.layer_exists(spark, str(tmp_path / "none"))
    with pytest.raises(pyspark.errors.AnalysisException):
        readers.read_table(spark, "no_such_table").count()
