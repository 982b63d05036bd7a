"""Large clients in slices, the id ledger and the state in buckets, held conditions, exact areas, state of streams."""

import datetime
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from tallyguard.config import RulesConfig
from tallyguard.operators import features, history, models, monitoring, rules, serving, slices
from tallyguard.schemas import FEATURE_NAMES, SILVER
from tallyguard.store import TableStore, bucket_of
from tallyguard.streaming import client_state
from tests.helpers import T0, silver_frame


def rows_of(df):
    return sorted(map(str, df.drop("ingest_time").collect()))


def plain(df, config=None):
    return rules.apply_rules(features.add_features(df), config)


def busy(rng, n, client, seconds, start=0):
    """Rows of one client with seconds that tie, null amounts and devices, and all kinds."""
    return [(start + i, rng.randrange(seconds), rng.choice([100, 2900, 3000, 5000, 8000, 9500]), {"client_id": client, "device_id": rng.choice([None, 1, 2, 3, 4]), "txn_type": rng.choice(["Deposit", "Withdrawal", "Transfer"]), "country_src": rng.choice(["Egypt", "USA", None])}) for i in range(n)]


@pytest.mark.parametrize("hot_rows, slice_rows, seconds", [(100, 40, 3 * 86400), (100, 7, 5000), (0, 1, 40 * 86400), (100, 10_000, 900)])
def test_sliced_clients_get_the_same_decisions(spark, hot_rows, slice_rows, seconds):
    rng = random.Random(slice_rows)
    rows = busy(rng, 500, 1, seconds) + busy(rng, 300, 2, seconds, 1000) + [(2000 + i, 50 * i, 100, {"client_id": 3 + i}) for i in range(20)]
    df = silver_frame(spark, rows)
    df = df.withColumn("amount_usd", F.when(F.col("transaction_id") % 9 != 0, F.col("amount_usd"))).withColumn("event_time", F.when(F.col("transaction_id") != 2003, F.col("event_time"))).withColumn("client_id", F.when(F.col("transaction_id") != 2004, F.col("client_id"))).persist()
    want = rows_of(plain(df))
    assert rows_of(slices.decide(df, None, hot_rows, slice_rows)) == want
    config = RulesConfig(velocity_seconds=40, structuring_seconds=100_000, mule_seconds=90_000, new_device_seconds=1000)  # frames longer than a day
    assert rows_of(slices.decide(df, config, hot_rows, slice_rows)) == rows_of(plain(df, config))


def test_a_client_with_half_of_all_rows_spreads_over_tasks(spark, monkeypatch):
    """One client's rows, all in one hour: in one window task without slices, in many with them."""
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rng = random.Random(1)
        df = silver_frame(spark, busy(rng, 3000, 1, 3600) + [(10_000 + i, rng.randrange(86400), 100, {"client_id": 2 + i % 500}) for i in range(3000)])
        share = lambda made: [n for n in made.rdd.mapPartitions(lambda rows: [sum(r["client_id"] == 1 for r in rows)]).collect() if n]
        assert share(plain(df)) == [3000]
        made = slices.decide(df, None, 1000, 100)
        found = share(made)
        assert sum(found) == 3000 and len(found) >= 8 and max(found) < 1000
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(client_id" in plan and "_part" in plan
        # No window that the client's rows run through is dealt by the client alone.
        sliced = slices.sliced_frames(df.where("client_id = 1"), RulesConfig(), 100)[0]._jdf.queryExecution().optimizedPlan().toString()
        assert "_day" in sliced and rows_of(made) == rows_of(plain(df))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_no_large_client_means_one_exchange(spark):
    df = silver_frame(spark, [(i, i, 10, {"client_id": i % 3}) for i in range(30)])
    made = slices.decide(history.with_history(df.where("transaction_id > 20"), df.where("transaction_id <= 22").withColumn("batch_token", F.lit("t"))))
    plan = made._jdf.queryExecution().executedPlan().toString()
    by_rows = [x for x in plan.split("\n") if "Exchange hashpartitioning(client_id" in x]
    assert len(by_rows) == 1 and "hashpartitioning(transaction_id" not in plan.split("BroadcastExchange")[0]
    assert sorted(r["transaction_id"] for r in made.collect()) == list(range(30))


def test_batch_takes_the_place_of_stored_rows(spark):
    old = silver_frame(spark, [(1, 0, 10, {}), (2, 5, 20, {})]).withColumn("batch_token", F.lit("t"))
    new = silver_frame(spark, [(2, 5, 99, {}), (3, 9, 30, {})])
    got = {r["transaction_id"]: (float(r["amount_usd"]), r["_in_batch"]) for r in history.with_history(new, old).collect()}
    assert got == {1: (10, False), 2: (99, True), 3: (30, True)} and history.with_history(new, old.limit(0)).count() == 2 == history.with_history(new.limit(0), old).count()


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "lake"), id_buckets=8, state_buckets=8)


def files(store, table):
    """{bucket: names of its files}."""
    out = {}
    for folder, _, names in os.walk(store.path(table)):
        bucket = next((p.split("=")[1] for p in folder.split(os.sep) if p.startswith("bucket=")), None)
        if bucket is not None:
            out.setdefault(int(bucket), set()).update(x for x in names if x.endswith(".parquet"))
    return {b: x for b, x in out.items() if x}


def states(spark, rows):
    return serving.client_state(rules.apply_rules(silver_frame(spark, rows)))


def test_untouched_state_buckets_keep_their_files(spark, store):
    store.write_state(states(spark, [(i, 100, 10, {"client_id": i}) for i in range(40)]), "a")
    before = files(store, "state")
    assert len(before) == 8
    touched = states(spark, [(100, 500, 10, {"client_id": 3}), (101, 50, 10, {"client_id": 4})])
    store.write_state(touched, "b")
    own = {r[0] for r in touched.select(bucket_of(F.col("client_id"), 8)).collect()}
    after = files(store, "state")
    assert {b for b in after if after[b] != before[b]} == own and len(own) < 8
    got = {r["client_id"]: r["last_transaction_id"] for r in store.state().collect()}
    assert got == {i: i for i in range(40)} | {3: 100}  # client 4's row is older than what is there
    assert store.state_of(3).first()["last_transaction_id"] == 100 and store.state_of(999) is None or store.state_of(999).isEmpty()
    opened = store.state_of(3).inputFiles()
    assert len({p.split("bucket=")[1].split("/")[0] for p in opened}) == 1


def test_state_that_was_replaced_in_part_is_finished(spark, store):
    """A crash after a bucket was deleted: the staged copy brings its clients back."""
    store.write_state(states(spark, [(i, 100, 10, {"client_id": i}) for i in range(40)]), "a")
    store.unstage("state-a")
    new = states(spark, [(100 + i, 500, 10, {"client_id": i}) for i in range(0, 40, 3)])
    store.write_state(new, "b")
    from tallyguard.sources.readers import delete_path

    delete_path(spark, f"{store.path('state')}/bucket=2")
    store.write_state(new, "b")
    assert {r["client_id"]: r["last_transaction_id"] for r in store.state().collect()} == {i: 100 + i if i % 3 == 0 else i for i in range(40)}


def test_a_batch_opens_only_its_id_buckets(spark, store):
    store.write_ids(silver_frame(spark, [(i, 0, 1, {}) for i in range(0, 4000, 2)]), "old")
    store.write_ids(silver_frame(spark, [(i, 0, 1, {}) for i in range(5000, 5100)]), "more")
    batch = silver_frame(spark, [(i, 0, 1, {}) for i in (10, 11, 5001)])
    own = {r[0] for r in batch.select(bucket_of(F.col("transaction_id"), 8)).collect()}
    known = store.known_ids(batch)
    assert {int(p.split("bucket=")[1].split("/")[0]) for p in known.inputFiles()} <= own and len(own) < 8
    kept = lambda token: sorted(r["transaction_id"] for r in history.drop_committed(batch, known, token).collect())
    assert kept("new") == [11] and kept("old") == [10, 11]
    assert store.known_ids(batch.limit(0)).count() == 0
    many = silver_frame(spark, [(i, 0, 1, {}) for i in range(1000)])  # too many to be looked up one by one
    assert sorted(r["transaction_id"] for r in history.drop_committed(many, store.known_ids(many), "new").collect()) == list(range(1, 1000, 2))


def test_bloom_filters_skip_files(spark, store):
    """The files have filters that know their own ids and few others."""
    base = 1 << 40
    store.write_ids(silver_frame(spark, [(base + i, 0, 1, {}) for i in range(0, 4000, 2)]), "old")
    misses = store.known_ids(silver_frame(spark, [(base + i, 0, 1, {}) for i in range(1, 200, 2)]))
    assert misses.count() == 0 and store.known_ids(silver_frame(spark, [(base + 100, 0, 1, {})])).count() == 1
    footer = spark._jvm.org.apache.parquet.hadoop.ParquetFileReader
    path = next(os.path.join(d, n) for d, _, names in os.walk(store.path("ids")) for n in names if n.endswith(".parquet"))
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    reader = footer.open(spark._jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(spark._jvm.org.apache.hadoop.fs.Path(path), hadoop))
    block = reader.getFooter().getBlocks().get(0)
    column = next(c for c in block.getColumns() if "transaction_id" in c.getPath().toDotString())
    bloom = reader.readBloomFilter(column)
    reader.close()
    assert bloom is not None
    held = {r[0] for r in spark.read.parquet(path).select("transaction_id").collect()}
    assert all(bloom.findHash(bloom.hash(i)) for i in held) and sum(bloom.findHash(bloom.hash(base + i)) for i in range(1, 4000, 2)) < 200


def test_ids_are_folded_and_rebuilt(spark, store):
    for k in range(3):
        rows = silver_frame(spark, [(100 * k + i, 0, 1, {}) for i in range(50)])
        store.write_batch("silver", rows, f"t{k}")
        store.write_ids(rows, f"t{k}")
        if k < 2:
            store.commit(f"t{k}")
    want = sorted((100 * k + i, f"t{k}") for k in range(3) for i in range(50))
    held = lambda: sorted(tuple(r) for r in spark.read.parquet(store.path("ids")).select("transaction_id", "batch_token").collect())
    store.compact_ids()
    assert held() == want and {p for d in os.listdir(store.path("ids")) if d.startswith("bucket") for p in os.listdir(f"{store.path('ids')}/{d}") if p.startswith("batch")} == {"batch_part=compacted", "batch_part=t2"}
    store.clear("t2")
    assert held() == [x for x in want if x[1] != "t2"]
    store.write_batch("silver", silver_frame(spark, [(200 + i, 0, 1, {}) for i in range(50)]), "t2")
    store.rebuild_ids()
    assert held() == want


def test_compaction_that_was_cut_short_is_finished(spark, store):
    """The day's folder is lost after it was staged, and a batch has written since: nothing is lost or doubled."""
    day = datetime.date(2026, 9, 1)
    for k in range(3):
        store.write_batch("silver", silver_frame(spark, [(10 * k + i, 0, 1, {}) for i in range(5)]), f"t{k}")
        if k < 2:
            store.commit(f"t{k}")
    want = {(10 * k + i, f"t{k}") for k in range(3) for i in range(5)}
    folder = f"{store.path('silver')}/event_date={day}"
    store._fold(folder, store.path("silver"), store.schema("silver"), f"compact-silver-{day}")
    from tallyguard.sources.readers import delete_path

    delete_path(spark, folder)
    store.write_batch("silver", silver_frame(spark, [(90, 0, 1, {})]), "t9")
    store.commit("t9")
    store.compact("silver", day)
    got = [(r["transaction_id"], r["batch_token"]) for r in store.read("silver").collect()]
    assert set(got) == want | {(90, "t9")} and len(got) == 16
    assert {p for p in os.listdir(folder) if p.startswith("batch")} == {"batch_part=compacted", "batch_part=t2"}
    assert not store._found("_staging/compact*")
    store.compact("silver", day)
    assert store.read("silver").count() == 16 and store.compact("silver", datetime.date(2026, 9, 9)) == 0


def test_sustained_conditions(spark):
    def flags(*on):
        return spark.createDataFrame([(T0 + datetime.timedelta(seconds=30 * i), bool(i in on), None, bool(i % 2), False) for i in range(60) if i not in (20, 21)], "window_end timestamp, batch_slow boolean, quarantine_high boolean, alert_spike boolean, features_stalled boolean")

    at = lambda i: T0 + datetime.timedelta(seconds=30 * i)
    got = sorted((r["started"], r["ended"], r["evaluations"], r["fired"], r["fired_at"]) for r in monitoring.sustained(flags(*range(0, 11), *range(15, 40), 50)).where("condition = 'batch_slow'").collect())
    # 0 to 10 is exactly five minutes; the gap at 20 ends a stretch of two minutes; 22 to 39 is long enough.
    assert got == [(at(0), at(10), 11, True, at(10)), (at(15), at(19), 5, False, None), (at(22), at(39), 18, True, at(32)), (at(50), at(50), 1, False, None)]
    others = monitoring.sustained(flags()).collect()
    assert {r["condition"] for r in others} == {"alert_spike"} and not any(r["fired"] for r in others)
    assert monitoring.sustained(flags().limit(0)).count() == 0


@pytest.mark.parametrize("ranges", [1, 3, 64])
def test_areas_with_ties(spark, ranges):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = random.Random(7)
    rows = [(float(rng.random() < 0.3), rng.choice([0.1, 0.1, 0.25, 0.5, rng.random()]), rng.random(), 0.5) for _ in range(700)]
    df = spark.createDataFrame(rows, "label double, a double, b double, c double").persist()
    got = {r["member"]: r for r in models.score_areas(df, ["a", "b", "c"], ranges=ranges).collect()}
    for m in "abc":
        for name, key in (("areaUnderROC", "auc"), ("areaUnderPR", "auprc")):
            assert got[m][key] == pytest.approx(BinaryClassificationEvaluator(labelCol="label", rawPredictionCol=m, metricName=name, numBins=0).evaluate(df), abs=1e-12)
    assert got["c"]["auc"] == 0.5
    one = models.score_areas(df.where("label = 1"), ["a"], ranges=ranges).first()
    assert one["auc"] is None and one["auprc"] is None and models.score_areas(df.limit(0), ["a"]).count() == 0


def feed(spark, tmp_path, batches, watermark="2 hours"):
    out = []
    for rows in batches:
        silver_frame(spark, rows).write.mode("append").parquet(f"{tmp_path}/in")
        q = client_state.run_features(spark, spark.readStream.schema(SILVER).parquet(f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp", watermark=watermark)
        q.awaitTermination(180)
        out.append(q)
    return {r["transaction_id"]: r for r in spark.read.parquet(f"{tmp_path}/out").collect()}, out


def test_client_state_equals_windows_and_expires(spark, tmp_path):
    rng = random.Random(4)
    day = 86400
    first = busy(rng, 120, 1, 20_000) + busy(rng, 60, 2, 20_000, 500)
    second = [(i, s + day, a, x) for i, s, a, x in busy(rng, 60, 1, 20_000, 1000)]
    third = [(2000, 45 * day, 10, {"client_id": 3})]  # the watermark passes the others' 30 days
    fourth = [(3000, 45 * day + 60, 10, {"client_id": 1, "device_id": 1}), (3001, 45 * day + 70, 10, {"client_id": 3})]
    got, queries = feed(spark, tmp_path, [first, second, third, fourth])
    want = {r["transaction_id"]: r for r in features.add_features(silver_frame(spark, first + second)).collect()}
    for i, r in want.items():
        assert [got[i][c] for c in FEATURE_NAMES] == pytest.approx([r[c] for c in FEATURE_NAMES], abs=1e-6), i
    # Client 1 begins anew: no average, no row before, and a device that it had used isn't told from others.
    assert (got[3000]["avg_amount_prior_30"], got[3000]["seconds_since_prev_txn"], got[3000]["device_new_30d"]) == (0, 0, 0)
    assert got[3001]["seconds_since_prev_txn"] == 70 and got[3001]["avg_amount_prior_30"] == 10
    totals = [max(o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"]) for q in queries]
    assert totals[-1] < totals[0]


class FakeState:
    """A state handle in memory that counts its calls."""

    def __init__(self):
        self.held, self.value, self.timers, self.calls = {}, None, [], 0

    getValueState = getMapState = lambda self, *x: self

    def _call(self, made):
        self.calls += 1
        return made

    def get(self):
        return self._call(self.value)

    def update(self, value):
        self.value = self._call(value)

    def getValue(self, key):
        return self._call(self.held.get(key))

    def updateValue(self, key, value):
        self.held[key] = self._call(value)

    def removeKey(self, key):
        self._call(self.held.pop(key))

    def iterator(self):
        return self._call(iter(list(self.held.items())))

    def registerTimer(self, end):
        self._call(self.timers.append(end))


def test_client_state_calls_do_not_grow_with_rows():
    def batch(state, uses):
        made, rows = client_state.ClientFeatures(), [{"transaction_id": i, "_seconds": s, "device_id": d, "amount_usd": 1, "country_src": "Egypt", "event_time": None} for i, (s, d) in enumerate(uses)]
        made.init(state)
        state.calls = 0
        return [r["device_new_30d"] for r in made.handleInputRows((1,), iter(rows), None)]

    state, rng, day = FakeState(), random.Random(5), 86400
    batch(state, [(s, s % 5) for s in range(100)])
    assert batch(state, [(day + s, s % 5) for s in range(100)]) == [0] * 100 and state.calls == 2 and len(state.timers) == 1
    # More devices than the value holds, some of them unused for longer than 30 days.
    state, last, first = FakeState(), {}, True
    for k in range(40):
        uses = [(k * 2 * day + s, rng.randrange(120)) for s in sorted(rng.sample(range(day), 30))]
        want = []
        for s, d in uses:
            want.append(float(not first and (d not in last or s - last[d] > features.DEVICE_SECONDS)))
            last[d], first = s, False
        assert batch(state, uses) == want
    assert len(state.value[7]) == client_state.NEAR_DEVICES
    assert all(last[d] >= last[uses[-1][1]] - features.DEVICE_SECONDS - 3 * day for (d,) in state.held)


def test_window_tasks_keep_their_size(spark, sf_dir, monkeypatch):
    """The window's one exchange has partitions for its rows, whatever number the session has for all shuffles."""
    from tallyguard.plans import registry

    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    plain_rows = rows_of(registry.a14_upsert_state(spark, sf_dir))
    monkeypatch.setattr(registry, "WINDOW_ROWS", events // 20)
    made = registry.featured(spark, sf_dir)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and made.rdd.getNumPartitions() >= 20
    assert rows_of(registry.a14_upsert_state(spark, sf_dir)) == plain_rows


def test_compaction_writes_without_a_sort(spark, store, monkeypatch):
    """No file's rows are sorted by part: each part is a job of its own."""
    day, writes = datetime.date(2026, 9, 1), []
    for k in range(2):
        store.write_batch("silver", silver_frame(spark, [(10 * k + i, 0, 1, {}) for i in range(5)]), f"t{k}")
        store.commit(f"t{k}")
    from pyspark.sql import DataFrameWriter

    made = DataFrameWriter.partitionBy
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda self, *c: (writes.append(c), made(self, *c))[1])
    assert store.compact("silver", day) == 1 and not writes and store.read("silver").count() == 10


def test_more_ids_than_a_broadcast_leave_history_where_it_is(spark, monkeypatch):
    """of a batch with very many ids the ids alone are compared; stored rows are joined only if one of them has such an id."""
    monkeypatch.setattr(history, "BROADCAST_ROWS", 0)
    old, new = silver_frame(spark, [(1, 0, 10, {}), (2, 10, 20, {})]), silver_frame(spark, [(3, 30, 99, {}), (4, 40, 30, {})])
    made = history.with_history(new, old)
    assert "Join" not in made._jdf.queryExecution().executedPlan().toString() and made.count() == 4
    both = history.with_history(silver_frame(spark, [(2, 30, 99, {}), (4, 40, 30, {})]), old)
    assert {r["transaction_id"]: (float(r["amount_usd"]), r["_in_batch"]) for r in both.collect()} == {1: (10, False), 2: (99, True), 4: (30, True)}


def test_decisions_of_a_batch_keep_the_size_of_their_tasks(spark, monkeypatch):
    """a batch's window has partitions for its rows, whatever number the session has for all shuffles."""
    df = silver_frame(spark, [(i, 10 * i, 100 + i, {"client_id": i % 40}) for i in range(1, 401)])
    plain_rows = rows_of(slices.decide(df))
    monkeypatch.setattr(slices, "WINDOW_ROWS", 20)
    made = slices.decide(df)
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert made.rdd.getNumPartitions() == 20 and rows_of(made) == plain_rows


def test_writes_of_a_batch_all_end_before_an_error():
    """writes made at the same time."""
    from tallyguard.streaming.processor import together

    ended = []
    with pytest.raises(ZeroDivisionError):
        together(lambda: 1 / 0, lambda: (time.sleep(0.3), ended.append(1)))
    assert ended == [1] and together(lambda: 1, lambda: 2) == [1, 2]


def test_a_batch_of_few_days_is_written_without_a_sort(spark, store, monkeypatch):
    """no task sorts its rows by day; a batch of many days, or of rows without one, is written in one job."""
    from tallyguard import store as stores
    from pyspark.sql import DataFrameWriter

    made, writes = DataFrameWriter.partitionBy, []
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda self, *c: (writes.append(c), made(self, *c))[1])
    rows = silver_frame(spark, [(i, 86400 * (i % 3), 5, {}) for i in range(9)])
    for _ in range(2):  # a retry takes the place of the first attempt
        store.write_batch("silver", rows, "t1")
    assert not writes and rows_of(store.read_batch("silver", "t1").select(*SILVER.fieldNames())) == rows_of(rows)
    monkeypatch.setattr(stores, "FEW_DAYS", 2)
    store.write_batch("silver", rows, "t2")
    assert len(writes) == 1 and rows_of(store.read_batch("silver", "t2").select(*SILVER.fieldNames())) == rows_of(rows)
    store.write_batch("silver", silver_frame(spark, [(20, 0, 5, {"event_date": None})]), "t3")
    assert store.read_batch("silver", "t3").count() == 1
