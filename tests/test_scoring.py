"""Exported members against the fitted pipelines and DuckDB; sketches against ranks."""

import datetime
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyguard.operators import models, scoring, sketches
from tallyguard.store import TableStore


def test_exported_members_score_as_the_fitted_ones(spark, sf_dir, tmp_path):
    from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier

    from tallyguard.plans import registry

    data = registry.featured(spark, sf_dir).withColumn("label", F.expr("cast((amount_usd > 2000) <> (txn_type = 'Deposit' and currency <> 'EGP') as double)")).persist()
    common = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}
    quick = {"logistic_regression": LogisticRegression(maxIter=10, **common), "random_forest": RandomForestClassifier(numTrees=6, maxDepth=5, seed=1, **common), "gbt": GBTClassifier(maxIter=4, maxDepth=4, seed=1, **common)}
    manifest = models.train_ensemble(data, str(tmp_path / "release"), estimators=quick)
    assert all(0.65 <= m["auc"] <= 1 and 0 < m["auprc"] <= 1 for m in manifest["metrics"].values())
    # Levels that weren't seen, and nulls, have a place too.
    odd = data.withColumn("txn_type", F.when(F.col("transaction_id") % 7 == 0, "it's new").when(F.col("transaction_id") % 7 != 1, F.col("txn_type"))).withColumn("currency", F.when(F.col("transaction_id") % 5 != 0, F.col("currency")))
    exported = scoring.load_members(spark, str(tmp_path / "release"))
    assert {m.kind for m in exported.values()} == {"logistic", "forest", "boosted"} and any(n.categories or n.threshold is not None for n in exported["gbt"].nodes)
    fitted, names = models.probabilities(odd, models.load_ensemble(spark, str(tmp_path / "release")))
    want = {r["transaction_id"]: [r[c] for c in names] for r in fitted.collect()}
    members = list(exported)
    got = {r["transaction_id"]: [r[c] for c in members] for r in scoring.probabilities(odd, exported).collect()}
    assert len(got) == len(want) == odd.count() and len({round(x[1], 6) for x in want.values()}) > 10
    for i, p in want.items():
        assert got[i] == pytest.approx(p, abs=1e-9)
    table = odd.withColumn("amount_usd", F.col("amount_usd").cast("double")).drop("event_date", "ingest_time", "event_time").toPandas()
    there = duckdb.query_df(table, "rows", f"SELECT transaction_id, {', '.join(f'{scoring.probability_sql(m)} AS {name}' for name, m in exported.items())} FROM rows").fetchall()
    for i, *p in there:
        assert p == pytest.approx(want[i], abs=1e-9)
    from tallyguard.operators.rules import apply_rules

    decided = apply_rules(odd)
    a, b = (sorted((r["transaction_id"], r["decision"], r["risk_score"]) for r in x.collect()) for x in (models.score(decided, models.load_ensemble(spark, str(tmp_path / "release"))), scoring.score(decided, exported)))
    assert a == b
    with pytest.raises(ValueError):
        scoring.score(decided, {})


def test_quantiles_of_ranges_keep_their_rank_error(spark, tmp_path):
    """100,000 rows over four days, far above a sketch's size; a day is replaced."""
    rng = random.Random(8)
    day = lambda k: datetime.date(2026, 9, 1 + k)
    values = {k: [rng.gauss(k, 1 + k) for _ in range(25_000)] for k in range(4)}
    frame = lambda ks: spark.createDataFrame([(day(k), v) for k in ks for v in values[k]] + [(day(0), None)], "event_date date, v double")
    store = TableStore(spark, str(tmp_path / "lake"))
    sketches.refresh(store, frame([0, 1, 2, 3]), "v")
    values[3] = [rng.gauss(50, 1) for _ in range(25_000)]
    sketches.refresh(store, frame([3]), "v")
    held = spark.read.parquet(store.path("score_sketches"))
    assert held.count() == 4 and held.agg(F.max(F.length("sketch"))).first()[0] < 16 * sketches.SKETCH_SIZE
    ranges = spark.createDataFrame([(day(0), day(3)), (day(1), day(2)), (day(3), day(3)), (day(9), day(9))], "first_day date, last_day date")
    got = {(r["first_day"], r["last_day"]): r for r in sketches.range_quantiles(held, ranges, (0.5, 0.95, 0.999)).collect()}
    for a, b in ((0, 3), (1, 2), (3, 3)):
        r, all_ = got[day(a), day(b)], sorted(v for k in range(a, b + 1) for v in values[k])
        assert r["values"] == len(all_)
        for name, share in (("p50", 0.5), ("p95", 0.95), ("p99_9", 0.999)):
            assert abs(sum(v <= r[name] for v in all_) / len(all_) - share) < 1.7 / sketches.SKETCH_SIZE * 1.5
    assert got[day(9), day(9)]["values"] == 0 and got[day(9), day(9)]["p50"] is None


def test_view_percentiles_above_their_accuracy(spark):
    """40,000 different values a day: the view's percentiles and the training cutoff stay within one in ten thousand."""
    from tallyguard.operators import gold

    rng = random.Random(9)
    rows = [(rng.random(),) for _ in range(40_000)]
    df = spark.createDataFrame(rows, "ml_probability double").withColumn("event_date", F.lit(datetime.date(2026, 9, 1))).withColumn("decision", F.lit("PASS")).withColumn("event_time", F.timestamp_seconds(F.floor(F.col("ml_probability") * 1e9)))
    r = gold.model_decision_monitoring(df).first()
    for name, share in (("p50_ml_probability", 0.5), ("p95_ml_probability", 0.95)):
        assert abs(sum(x <= r[name] for (x,) in rows) / len(rows) - share) <= 2e-4
    early, late = models.time_split(df)
    assert abs(early.count() / 40_000 - 0.8) <= 2e-4 and early.count() + late.count() == 40_000
