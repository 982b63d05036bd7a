import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyguard.config import QualityContract, RulesConfig, load_contract, load_rules
from tallyguard.operators import evaluate, features, gold, history, quality, rules, serving, silver
from tests.helpers import raw_frame, silver_frame


def decide(spark, rows, config=None):
    out = rules.apply_rules(silver_frame(spark, rows), config).select("transaction_id", "matched_rules", "risk_score", "decision").collect()
    return {r["transaction_id"]: (list(r["matched_rules"]), r["risk_score"], r["decision"]) for r in out}


@pytest.mark.parametrize("change, error", [
    ({"Trans_amount": -5}, "invalid:Trans_amount<=0"), ({"Trans_amount": 0}, "invalid:Trans_amount<=0"), ({"Trans_status": "PENDING"}, "invalid:Trans_status"), ({"Trans_type": "POS"}, "invalid:Trans_type"),
    ({"Currency": "GBP"}, "invalid:Currency"), ({"Trans_date": "not-a-date"}, "invalid:Trans_date_unparseable"), ({"Clt_id": None}, "null:Clt_id"), ({"Trans_date": "2026-09-01 13:00:00 PM"}, "invalid:Trans_date_unparseable"),
    ({"Trans_date": None}, "null:Trans_date,invalid:Trans_date_unparseable"), ({"Trans_amount": None}, "null:Trans_amount"), ({"Trans_status": None, "Currency": None, "Trans_type": None}, ""),
])
def test_dq_errors(spark, change, error):
    assert ",".join(silver.add_dq_errors(raw_frame(spark, [change])).first()["dq_errors"]) == error


def test_silver_values(spark):
    rows = [{"Trans_id": 1, "Trans_amount": 1000, "Currency": "EUR", "Trans_date": "2026-09-01 11:30:00 PM"}, {"Trans_id": 2, "Currency": "JPY", "Trans_date": "2026-09-01 12:10:00 AM"}]
    one, two = silver.to_silver(raw_frame(spark, rows)).orderBy("transaction_id").collect()
    assert float(one["amount_usd"]) == 1080.0 and one["event_time"].hour == 23
    assert float(two["amount_usd"]) == 500.0 and two["event_time"].hour == 0


def test_deduplicate_keeps_the_first_offset(spark):
    df = raw_frame(spark, [{"Trans_amount": 1}, {"Trans_amount": 2}])
    assert [r["Trans_amount"] for r in silver.deduplicate(df).collect()] == [1]


def test_high_amount(spark):
    got = decide(spark, [(1, 0, 15000, {}), (2, 86400, 3000, {})])
    assert got[1] == (["HIGH_AMOUNT"], 45, "BLOCK") and got[2][2] == "PASS"


def test_velocity(spark):
    got = decide(spark, [(i, 30 * i, 10, {}) for i in range(1, 8)])
    assert got[6] == (["VELOCITY"], 20, "FLAG") and got[1][2] == "PASS"


def test_structuring_and_its_upper_bound(spark):
    got = decide(spark, [(i, 600 * i, 8500, {}) for i in (1, 2, 3)])
    assert got[3][2] == "BLOCK" and got[1][2] == "PASS"
    assert decide(spark, [(i, 600 * i, "9999.50", {}) for i in (1, 2, 3)])[3][0] == []


def test_travel(spark):
    far = lambda country, s: decide(spark, [(1, 0, 10, {}), (2, s, 10, {"country_src": country})])[2][2]
    assert far("USA", 1200) == "BLOCK" and far("Jordan", 1200) == "PASS" and far("USA", 18000) == "PASS"


def test_mule_pairs(spark):
    pair = lambda a, b: decide(spark, [(1, 0, a, {"txn_type": "Deposit"}), (2, 600, b, {})])
    assert pair(9000, 8300)[1][0] == ["MULE"] and pair(9000, 8300)[2][0] == ["MULE"]
    assert not pair(500, 480)[2][0] and not pair(6000, 1800)[2][0]


def test_new_device(spark):
    got = decide(spark, [(1, 0, 6000, {}), (2, 86400, 6000, {"device_id": 8}), (3, 90000, 6000, {"device_id": 7})])
    assert got[1][0] == [] and got[2][0] == ["NEW_DEVICE_HIGH_VALUE"] and got[3][0] == []


def test_same_second_counts_as_now_and_not_as_seen(spark):
    rows = [(1, 0, 10, {}), (2, 100, 10, {"device_id": 8}), (3, 100, 10, {"device_id": 8})]
    got = {r["transaction_id"]: r for r in features.add_features(silver_frame(spark, rows)).collect()}
    assert got[2]["txn_count_5m"] == 3.0 and got[3]["txn_count_5m"] == 3.0
    assert got[2]["device_new_30d"] == 1.0 and got[3]["device_new_30d"] == 1.0


def test_feature_values(spark):
    rows = [(1, 0, 100, {}), (2, 30, 200, {"country_src": "USA"}), (3, 120, 300, {"device_id": 8, "country_src": "USA"}), (4, 7200, 400, {})]
    got = {r["transaction_id"]: r for r in features.add_features(silver_frame(spark, rows)).collect()}
    assert [got[i]["txn_count_5m"] for i in (1, 2, 3, 4)] == [1, 2, 3, 1]
    assert [got[i]["amount_sum_1h"] for i in (1, 2, 3, 4)] == [100, 300, 600, 400]
    assert [got[i]["avg_amount_prior_30"] for i in (1, 2, 3, 4)] == [0, 100, 150, 200]
    assert got[4]["stddev_amount_prior_30"] == pytest.approx(81.6497, abs=1e-3)
    assert [got[i]["seconds_since_prev_txn"] for i in (1, 2, 3, 4)] == [0, 30, 90, 7080]
    assert [got[i]["country_changed"] for i in (1, 2, 3, 4)] == [0, 1, 0, 1]
    assert [got[i]["device_new_30d"] for i in (1, 2, 3, 4)] == [0, 0, 1, 0]
    assert [got[i]["amount_to_prior_avg"] for i in (1, 2, 3, 4)] == [1, 2, 2, 2]


def test_rewritten_windows_equal_the_lists_of_rows(spark):
    rng = random.Random(5)
    rows = [(i, rng.randrange(20000), rng.choice([100, 2900, 3000, 5000, 8000]), {"client_id": rng.randrange(4), "device_id": rng.choice([None, 1, 2, 3]), "txn_type": rng.choice(["Deposit", "Withdrawal", "Transfer"])}) for i in range(1200)]
    s = silver_frame(spark, rows)
    w = lambda a, b: Window.partitionBy("client_id").orderBy(features.seconds()).rangeBetween(a, b)
    pair = F.struct("txn_type", "amount_usd")
    listed = s.withColumn("ahead", F.collect_list(pair).over(w(0, 1800))).withColumn("behind", F.collect_list(pair).over(w(-1800, 0))).withColumn("seen", F.array_contains(F.collect_set("device_id").over(w(-2592000, -1)), F.col("device_id"))).withColumn("n", F.row_number().over(features.sequence()))
    slow = listed.select("transaction_id", F.expr("(txn_type = 'Deposit' and amount_usd >= 3000 and exists(ahead, x -> x.txn_type = 'Withdrawal' and x.amount_usd >= amount_usd * 0.85)) or (txn_type = 'Withdrawal' and exists(behind, x -> x.txn_type = 'Deposit' and x.amount_usd >= 3000 and amount_usd >= x.amount_usd * 0.85))").alias("mule"), ((F.col("n") > 1) & ~F.coalesce("seen", F.lit(False))).alias("fresh"))
    fast = s.select("transaction_id", F.coalesce(rules.rule_flags(RulesConfig())["MULE"], F.lit(False)).alias("mule2"), features.device_is_new(2592000).alias("fresh2"))
    both = slow.join(fast, "transaction_id")
    assert both.where("mule <> mule2 or fresh <> fresh2").count() == 0 and both.where("mule").count() > 10 and both.where("fresh").count() > 10


def test_one_exchange_for_all_windows(spark):
    plan = rules.apply_rules(features.add_features(silver_frame(spark, [(1, 0, 10, {})])))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_policy(spark):
    df = spark.createDataFrame([(1, 0, "PASS", 0.8, None), (2, 45, "BLOCK", 0.9, 0.1), (3, 20, "FLAG", None, None), (4, 0, "PASS", 0.69, 0.2)], "id int, risk_score int, decision string, a double, b double")
    got = {r["id"]: (r["risk_score"], r["decision"], r["ml_probability"]) for r in rules.apply_policy(df, ["a", "b"]).collect()}
    assert got == {1: (80, "FLAG", 0.8), 2: (90, "BLOCK", 0.9), 3: (20, "FLAG", 0.0), 4: (69, "PASS", 0.69)}
    with pytest.raises(ValueError):
        rules.apply_policy(df, [])


def test_batch_token(spark):
    a, b = raw_frame(spark, [{}, {}]), raw_frame(spark, [{}, {}]).orderBy(F.desc("kafka_offset"))
    token = history.batch_token(a, 1)
    assert len(token) == 20 and token == history.batch_token(b, 2) != history.batch_token(raw_frame(spark, [{}, {}, {}]), 1)
    assert history.batch_token(a.drop("kafka_offset"), 11) == "spark-11" == history.batch_token(a.limit(0), 11)


def test_gold(spark):
    day = datetime.date(2026, 9, 1)
    s = silver_frame(spark, [(1, 0, 15000, {}), (2, 90000, 10, {"event_date": day}), (3, 180000, 140, {"device_id": 9, "event_date": day})])
    d = s.withColumn("decision", F.expr("case transaction_id when 1 then 'BLOCK' when 2 then 'FLAG' else 'PASS' end")).withColumn("risk_score", F.expr("cast(case transaction_id when 1 then 45 else 0 end as int)"))
    r = gold.customer_daily_risk(d).first()
    assert (r["txn_count"], float(r["total_amount_usd"]), r["flagged_count"], r["blocked_count"], r["max_risk_score"], r["distinct_devices"]) == (3, 15150.0, 1, 1, 45, 2)
    k = {x["event_date"]: x for x in gold.daily_kpis(d, gold.calendar(spark, day, 2)).collect()}
    assert k[day]["flagged_rate"] == 0.3333 and k[day - datetime.timedelta(days=1)]["total_txns"] == 0
    assert gold.calendar(spark, day, 0).count() == 1


def test_views(spark):
    s = silver_frame(spark, [(1, 0, 15000, {}), (2, 60, 10, {})])
    f = features.add_features(s)
    d = rules.without_model(rules.apply_rules(f)).withColumn("batch_token", F.lit("t"))
    gold.create_views(spark, d, f)
    assert spark.sql("select last_decision from client_risk_summary").first()[0] == "PASS"
    assert all(spark.table(v).count() for v in gold.VIEWS)


def test_contract(spark, tmp_path):
    bad = silver_frame(spark, [(1, 0, -1, {}), (2, 0, 5, {"currency": None})])
    report = {(r["expectation"], r["column"]): r for r in quality.validation_report(bad).collect()}
    assert len(report) == 6 and not report[("bounded_below", "amount_usd")]["success"] and report[("not_null", "currency")]["unexpected_count"] == 1
    with pytest.raises(ValueError, match="bounded_below:amount_usd"):
        quality.gate(quality.validation_report(bad))
    with pytest.raises(ValueError, match="no rows"):
        quality.gate(quality.validation_report(bad.limit(0)))
    good = silver_frame(spark, [(1, 0, 0, {})])
    assert '"success": true' in quality.validate_day(good, datetime.date(2026, 9, 1))
    with pytest.raises(ValueError):
        QualityContract((), ())
    (tmp_path / "q.toml").write_text('[quality]\nnot_null = ["client_id"]\nbounded = [["amount_usd", 1, true]]\n')
    assert load_contract(tmp_path / "q.toml").bounded == (("amount_usd", 1, True),)


def test_rules_config(spark, tmp_path):
    (tmp_path / "r.toml").write_text("[rules]\nhigh_amount_usd = 50\n")
    assert decide(spark, [(1, 0, 60, {})], load_rules(tmp_path / "r.toml"))[1][2] == "BLOCK"
    (tmp_path / "bad.toml").write_text("[rules]\nnope = 1\n")
    with pytest.raises(ValueError):
        load_rules(tmp_path / "bad.toml")
    with pytest.raises(ValueError):
        RulesConfig(severity={"HIGH_AMOUNT": "HIGH"})


def test_evaluation(spark):
    d = spark.createDataFrame([(1, "BLOCK", ["A"]), (2, "FLAG", ["A", "B"]), (3, "FLAG", None), (4, "PASS", []), (5, "PASS", [])], "transaction_id long, decision string, matched_rules array<string>")
    labels = spark.createDataFrame([(1, 1, "X"), (2, 1, "X"), (3, 0, "N"), (4, 1, "Y"), (5, 0, "N")], "Trans_id long, is_fraud int, pattern string")
    out = evaluate.report(d, labels)
    assert {k: out["counts"][k] for k in ("tp", "fp", "fn", "tn")} == {"tp": 2, "fp": 1, "fn": 1, "tn": 1}
    assert out["per_pattern_recall"] == [{"pattern": "X", "n": 2, "recall": 1.0}, {"pattern": "Y", "n": 1, "recall": 0.0}]
    assert out["per_rule_precision"][0] == {"rule": "A", "fired": 2, "precision": 1.0}
    with pytest.raises(ValueError):
        evaluate.report(d, labels.limit(0))
    assert evaluate.precision_recall(evaluate.confusion(evaluate.joined(d.where("decision = 'PASS'"), labels))).first()["precision"] is None


def test_alerts_and_state(spark):
    d = rules.apply_rules(silver_frame(spark, [(1, 0, 15000, {}), (2, 60, 10, {"client_id": 2})]))
    alert = serving.build_alerts(d, "tok").collect()
    assert [a["key"] for a in alert] == ["tok:1"] and '"event_time":"2026-09-01T12:00:00.000Z"' in alert[0]["value"]
    late = serving.client_state(rules.apply_rules(silver_frame(spark, [(3, 300, 10, {})])))
    early = serving.client_state(rules.apply_rules(silver_frame(spark, [(4, 200, 15000, {})])))
    kept = serving.upsert_state(late, early).collect()
    assert [(r["last_transaction_id"], r["last_decision"]) for r in kept] == [(3, "PASS")]
    tie = serving.client_state(rules.apply_rules(silver_frame(spark, [(9, 300, 10, {})])))
    assert serving.upsert_state(late, tie).first()["last_transaction_id"] == 9


def test_batch_and_history_queries_decide_about_every_row(spark, sf_dir):
    from tallyguard.plans import registry

    made = {name: registry.QUERIES[name](spark, sf_dir) for name in ("a5_layer_scan", "b9_history_bound", "c1_drop_committed", "c2_touched_history", "c3_batch_of_history", "u1_history_union", "a16_alert_dedup")}
    events, silver = spark.read.parquet(f"{sf_dir}/events.parquet").count(), registry.silver_of(spark, sf_dir).count()
    assert {name: df.count() for name, df in made.items()} == {name: events if name == "a5_layer_scan" else silver for name in made}
    assert {r["in_batch"] for r in made["u1_history_union"].collect()} == {True, False}
