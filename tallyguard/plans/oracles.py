"""DuckDB SQL for the registered queries, written from the tables up as a chain of common table expressions."""

# Each step names the ones it stands on; sql() puts the needed ones in order.
STEPS = {
    "ev": ("", "SELECT *, 1788220800 + (epoch_us(ts) - 1704067200000000) // 200000000 + 86400 * (user_id % 3) + CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 86400 ELSE 0 END AS sec FROM events"),
    "raw": ("ev", """SELECT event_id + 100001 AS Trans_id, CASE WHEN event_id % 71 = 70 THEN NULL ELSE user_id + 1 END AS Clt_id, event_id % 3 + 1 AS Card_id,
        CASE WHEN event_id % 40 = 7 THEN 900000 + event_id % 11 ELSE user_id * 10 + event_id % 2 END AS Dev_id,
        CASE WHEN event_id % 97 = 96 THEN -1 ELSE CAST(floor(value * 60) AS BIGINT) + 1 END AS Trans_amount,
        CASE WHEN event_id % 73 = 72 THEN 'not-a-date' ELSE strftime(make_timestamp(sec * 1000000), '%Y-%m-%d %I:%M:%S %p') END AS Trans_date,
        CASE WHEN event_id % 83 = 82 THEN 'POS' WHEN event_type IN ('purchase', 'error') THEN 'Withdrawal' WHEN event_type = 'signup' THEN 'Deposit' ELSE 'Transfer' END AS Trans_type,
        CASE WHEN event_id % 79 = 78 THEN 'PENDING' WHEN event_id % 25 = 24 THEN 'Rejected' ELSE 'Successful' END AS Trans_status,
        CASE WHEN event_id % 89 = 88 THEN 'GBP' WHEN event_id % 10 < 6 THEN 'USD' WHEN event_id % 10 < 8 THEN 'EUR' ELSE 'EGP' END AS Currency,
        CASE event_id % 20 WHEN 3 THEN 'USA' WHEN 11 THEN 'Jordan' ELSE 'Egypt' END AS Country_Src,
        user_id % 3 AS kafka_partition, event_id AS kafka_offset, sec AS kafka_sec FROM ev"""),
    "doubled": ("raw", "SELECT * FROM raw UNION ALL SELECT * REPLACE (kafka_offset + 1000000000 AS kafka_offset) FROM raw WHERE kafka_offset % 50 = 0"),
    "checked": ("raw", """SELECT *, list_filter([CASE WHEN Trans_id IS NULL THEN 'null:Trans_id' END, CASE WHEN Clt_id IS NULL THEN 'null:Clt_id' END, CASE WHEN Card_id IS NULL THEN 'null:Card_id' END,
        CASE WHEN Dev_id IS NULL THEN 'null:Dev_id' END, CASE WHEN Trans_amount IS NULL THEN 'null:Trans_amount' END, CASE WHEN Trans_date IS NULL THEN 'null:Trans_date' END,
        CASE WHEN Trans_status NOT IN ('Successful', 'Rejected') THEN 'invalid:Trans_status' END, CASE WHEN Trans_type NOT IN ('Withdrawal', 'Deposit', 'Transfer') THEN 'invalid:Trans_type' END,
        CASE WHEN Currency NOT IN ('USD', 'EUR', 'EGP') THEN 'invalid:Currency' END, CASE WHEN Trans_amount <= 0 THEN 'invalid:Trans_amount<=0' END,
        CASE WHEN try_strptime(Trans_date, '%Y-%m-%d %I:%M:%S %p') IS NULL THEN 'invalid:Trans_date_unparseable' END], lambda x: x IS NOT NULL) AS errs FROM raw"""),
    "valid": ("checked", "SELECT * FROM checked WHERE len(errs) = 0"),
    "silver": ("valid", """SELECT Trans_id AS transaction_id, Clt_id AS client_id, Card_id AS card_id, Dev_id AS device_id, CASE Currency WHEN 'EUR' THEN 1.08 WHEN 'EGP' THEN 0.02 ELSE 1 END::DECIMAL(18,8) AS fx_rate,
        round(Trans_amount::DECIMAL(18,4) * CASE Currency WHEN 'EUR' THEN 1.08 WHEN 'EGP' THEN 0.02 ELSE 1 END::DECIMAL(18,8), 2)::DECIMAL(18,4) AS amount_usd,
        Currency AS currency, Trans_type AS txn_type, Trans_status AS status, Country_Src AS country_src, 'Egypt' AS country_dest, epoch(strptime(Trans_date, '%Y-%m-%d %I:%M:%S %p'))::BIGINT AS t,
        strftime(strptime(Trans_date, '%Y-%m-%d %I:%M:%S %p'), '%Y-%m-%d') AS event_date, kafka_offset FROM valid"""),
    "wide": ("silver", """SELECT *, count(*) OVER (c ORDER BY t RANGE BETWEEN 300 PRECEDING AND CURRENT ROW) AS n5, sum(amount_usd) OVER (c ORDER BY t RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS s1h,
        sum(amount_usd) OVER p AS psum, count(amount_usd) OVER p AS pn, stddev_pop(amount_usd::DOUBLE) OVER p AS psd, lag(t) OVER s AS pt, lag(country_src) OVER s AS pc, row_number() OVER s AS rn,
        count(*) OVER (PARTITION BY client_id, device_id ORDER BY t RANGE BETWEEN 2592000 PRECEDING AND 1 PRECEDING) AS seen,
        sum(CASE WHEN amount_usd BETWEEN 8000 AND 9999 THEN 1 ELSE 0 END) OVER (c ORDER BY t RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS nstruct,
        max(CASE WHEN txn_type = 'Withdrawal' THEN amount_usd END) OVER (c ORDER BY t RANGE BETWEEN CURRENT ROW AND 1800 FOLLOWING) AS nextout,
        min(CASE WHEN txn_type = 'Deposit' AND amount_usd >= 3000 THEN amount_usd END) OVER (c ORDER BY t RANGE BETWEEN 1800 PRECEDING AND CURRENT ROW) AS lastin
        FROM silver WINDOW c AS (PARTITION BY client_id), s AS (PARTITION BY client_id ORDER BY t, transaction_id), p AS (PARTITION BY client_id ORDER BY t, transaction_id ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"""),
    "features": ("wide", """SELECT *, n5::DOUBLE AS txn_count_5m, coalesce(s1h::DOUBLE, 0) AS amount_sum_1h, coalesce(psum::DOUBLE / nullif(pn, 0), 0) AS avg_amount_prior_30, coalesce(psd, 0) AS stddev_amount_prior_30,
        coalesce(greatest(t - pt, 0), 0)::DOUBLE AS seconds_since_prev_txn, CASE WHEN rn > 1 AND seen = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS device_new_30d,
        CASE WHEN pc IS NOT NULL AND country_src <> pc THEN 1.0 ELSE 0.0 END::DOUBLE AS country_changed,
        CASE WHEN psum > 0 THEN amount_usd::DOUBLE / (psum::DOUBLE / pn) ELSE 1.0 END AS amount_to_prior_avg FROM wide"""),
    "flags": ("features", """SELECT *, amount_usd >= 10000 AS r1, amount_usd BETWEEN 8000 AND 9999 AND nstruct >= 3 AS r2,
        coalesce(pc = 'Egypt' AND country_src IN ('USA', 'Canada', 'Australia', 'UK', 'Germany', 'France', 'Italy', 'Spain') AND t - pt <= 1800, false) AS r3,
        coalesce(txn_type = 'Deposit' AND amount_usd >= 3000 AND nextout >= amount_usd * 0.85, false) OR coalesce(txn_type = 'Withdrawal' AND amount_usd >= lastin * 0.85, false) AS r4,
        n5 >= 6 AS r5, rn > 1 AND seen = 0 AND amount_usd >= 4000 AS r6 FROM features"""),
    "ruled": ("flags", """SELECT *, list_filter([CASE WHEN r1 THEN 'HIGH_AMOUNT' END, CASE WHEN r2 THEN 'STRUCTURING' END, CASE WHEN r3 THEN 'IMPOSSIBLE_TRAVEL' END, CASE WHEN r4 THEN 'MULE' END, CASE WHEN r5 THEN 'VELOCITY' END,
        CASE WHEN r6 THEN 'NEW_DEVICE_HIGH_VALUE' END], lambda x: x IS NOT NULL) AS matched, least(45 * (r1::INT + r2::INT + r3::INT + r4::INT) + 20 * (r5::INT + r6::INT), 100) AS risk_score,
        CASE WHEN r1 OR r2 OR r3 OR r4 THEN 'BLOCK' WHEN r5 OR r6 THEN 'FLAG' ELSE 'PASS' END AS decision FROM flags"""),
    "decided": ("ruled", """SELECT * REPLACE (greatest(risk_score, round(p * 100)::INTEGER) AS risk_score, CASE WHEN decision = 'BLOCK' THEN 'BLOCK' WHEN p >= 0.7 THEN 'FLAG' ELSE decision END AS decision), p AS ml_probability
        FROM (SELECT *, greatest(CASE WHEN kafka_offset % 13 = 0 THEN 0 ELSE (kafka_offset % 101) / 100.0::DOUBLE END, (kafka_offset % 37) / 100.0::DOUBLE) AS p FROM ruled)"""),
    "labels_": ("raw", """SELECT Trans_id, CASE WHEN pattern = 'NORMAL' THEN 0 ELSE 1 END::BIGINT AS is_fraud, pattern FROM (SELECT Trans_id, CASE WHEN Trans_amount >= 10000 THEN 'HIGH_AMOUNT' WHEN Dev_id >= 900000 THEN 'NEW_DEVICE_HIGH_VALUE'
        WHEN kafka_offset % 101 = 0 THEN 'MULE' ELSE 'NORMAL' END AS pattern FROM raw)"""),
    "matched_": ("ruled labels_", "SELECT * FROM ruled JOIN labels_ ON transaction_id = Trans_id"),
    "member_scores": ("matched_", """SELECT 'm0' AS member, is_fraud, CASE WHEN kafka_offset % 13 = 0 THEN 0 ELSE (kafka_offset % 101) / 100.0::DOUBLE END AS s FROM matched_
        UNION ALL SELECT 'm1', is_fraud, (kafka_offset % 37) / 100.0::DOUBLE FROM matched_"""),
    "batches": ("", "SELECT epoch_us(ts) // 1000000 AS s, event_id % 7 AS decisions, event_id % 3 AS alerts, CASE WHEN event_id % 97 = 96 THEN 1 ELSE 0 END AS quarantined, event_id % 5 AS feature_rows, value AS d FROM events"),
    "rates": ("batches", """SELECT w AS window_start, w + 300 AS window_end, sum(decisions) / 300.0::DOUBLE AS decisions_rate, sum(alerts) / 300.0::DOUBLE AS alerts_rate, sum(quarantined) / 300.0::DOUBLE AS quarantined_rate,
        sum(feature_rows) / 300.0::DOUBLE AS feature_rows_rate, quantile_cont(d, 0.95) AS p95_duration FROM (SELECT *, s // 30 * 30 - 30 * i AS w FROM batches, range(10) r(i)) GROUP BY w"""),
}

#: A stream's rows: those that are held back come behind the watermark, two hours before the latest time of all others.
STEPS["st_sent"] = ("doubled checked", """SELECT Trans_id AS transaction_id, count(*) AS sent, bool_or(len(errs) > 0) AS bad, bool_or(Trans_id % 100 = 3 AND d.kafka_sec < epoch(TIMESTAMP '2026-09-03') AND d.kafka_sec <= (SELECT max(kafka_sec) FROM raw WHERE Trans_id % 100 <> 3) - 7200) AS late
        FROM doubled d JOIN checked USING (Trans_id) GROUP BY 1""")
STEPS["st_silver"] = ("silver st_sent", "SELECT silver.* FROM silver JOIN st_sent USING (transaction_id) WHERE NOT late")
# Rules over them, as over Silver, but a deposit sees the withdrawals of its own day's run only.
for _step, _below in (("wide", "silver"), ("features", "wide"), ("flags", "features"), ("ruled", "flags")):
    _text = STEPS[_step][1].replace(f"FROM {_below}", f"FROM st_{_below}").replace("(c ORDER BY t RANGE BETWEEN CURRENT ROW AND 1800 FOLLOWING)", "(PARTITION BY client_id, event_date ORDER BY t RANGE BETWEEN CURRENT ROW AND 1800 FOLLOWING)")
    STEPS[f"st_{_step}"] = (f"st_{_below}", _text)

# Rules under other settings.
_text = STEPS["wide"][1].replace("sum(CASE WHEN amount_usd BETWEEN 8000 AND 9999 THEN 1 ELSE 0 END) OVER (c ORDER BY t RANGE BETWEEN 3600 PRECEDING", "sum(CASE WHEN amount_usd BETWEEN 2000 AND 4000 THEN 1 ELSE 0 END) OVER (c ORDER BY t RANGE BETWEEN 7200 PRECEDING")
STEPS["other_wide"] = ("silver", _text.replace("RANGE BETWEEN 300 PRECEDING", "RANGE BETWEEN 3600 PRECEDING").replace("amount_usd >= 3000", "amount_usd >= 1000"))
STEPS["other_flags"] = ("other_wide", """SELECT *, amount_usd >= 5000 AS r1, amount_usd BETWEEN 2000 AND 4000 AND nstruct >= 2 AS r2, coalesce(pc = 'Egypt' AND country_src = 'Jordan' AND t - pt <= 86400, false) AS r3,
        coalesce(txn_type = 'Deposit' AND amount_usd >= 1000 AND nextout >= amount_usd * 0.5, false) OR coalesce(txn_type = 'Withdrawal' AND amount_usd >= lastin * 0.5, false) AS r4, n5 >= 2 AS r5, rn > 1 AND seen = 0 AND amount_usd >= 1000 AS r6 FROM other_wide""")
_text = STEPS["ruled"][1].replace("45 * (r1::INT + r2::INT + r3::INT + r4::INT) + 20 * (r5::INT + r6::INT)", "60 * (r2::INT + r4::INT) + 15 * (r1::INT + r3::INT + r5::INT + r6::INT)")
STEPS["other_ruled"] = ("other_flags", _text.replace("WHEN r1 OR r2 OR r3 OR r4 THEN 'BLOCK' WHEN r5 OR r6", "WHEN r2 OR r4 THEN 'BLOCK' WHEN r1 OR r3 OR r5 OR r6").replace("FROM flags", "FROM other_flags"))

MONEY = "round(sum(amount_usd), 2)::DOUBLE"
FLAGGED, BLOCKED = "count(*) FILTER (decision = 'FLAG')", "count(*) FILTER (decision = 'BLOCK')"
SILVER_OUT = "transaction_id, client_id, card_id, device_id, fx_rate::DOUBLE AS fx_rate, amount_usd::DOUBLE AS amount_usd, currency, txn_type, status, country_src, t AS event_time, event_date"
RULE_OUT = "transaction_id, array_to_string(matched, ',') AS matched_rules, risk_score::BIGINT AS risk_score, decision"

#: query name: (the steps it stands on, its SELECT)
#: A batch, as against its history: both together are all rows.
LATE = "event_date >= '2026-09-03'"
SELECTS = {
    "a2_confluent_metadata": ("raw", "SELECT Trans_id AS transaction_id, '00' AS kafka_confluent_magic, 1 + kafka_offset % 3 AS kafka_schema_id FROM raw"),
    "a3_strip_header": ("raw", "SELECT kafka_partition, kafka_offset, Trans_id AS transaction_id, Currency AS currency FROM raw"),
    "a4_decode": ("raw", "SELECT Trans_id, Clt_id, Card_id, Dev_id, Trans_amount, Trans_date, Trans_type, Trans_status, Currency, Country_Src, kafka_partition, kafka_offset, kafka_sec AS kafka_timestamp, '00' AS kafka_confluent_magic, 1 + kafka_offset % 3 AS kafka_schema_id FROM raw"),
    "a5_layer_scan": ("", "SELECT * REPLACE (epoch_us(ts) // 1000000 AS ts) FROM events"),
    "a6_table_scan": ("silver", "SELECT currency, count(*) AS n FROM silver GROUP BY 1"),
    "a8_labels_csv": ("labels_", "SELECT Trans_id, is_fraud, pattern FROM labels_"),
    "a9_replay": ("raw", "SELECT coalesce(Clt_id, 0)::VARCHAR AS key, Trans_id, Trans_amount FROM raw"),
    "a14_upsert_state": ("decided", "SELECT client_id, arg_max(transaction_id, (t, transaction_id)) AS last_transaction_id, arg_max(decision, (t, transaction_id)) AS last_decision, arg_max(risk_score, (t, transaction_id))::BIGINT AS last_risk_score, arg_max(array_to_string(matched, ','), (t, transaction_id)) AS last_matched_rules, max(t) AS last_event_time FROM decided GROUP BY client_id"),
    "a16_alert_dedup": ("decided", f"SELECT 'tok:' || transaction_id AS alert_id, client_id, decision, decision <> 'PASS' AND {LATE} AS new FROM decided"),
    "a17_state_lookup": ("decided", "SELECT client_id, arg_max(transaction_id, (t, transaction_id)) AS last_transaction_id, arg_max(decision, (t, transaction_id)) AS last_decision FROM decided WHERE client_id = 7 GROUP BY client_id"),
    "a22_commit_markers": ("raw", "SELECT DISTINCT 'p' || kafka_partition AS batch_token FROM raw WHERE kafka_partition <> 1"),
    "a24_dead_letters": ("raw", "SELECT 'schema' AS reason, '{broken ' || Trans_id AS record FROM raw WHERE Trans_id % 10 = 0"),
    "a25_null_probability": ("ruled", "SELECT transaction_id, decision, ml_probability FROM (SELECT *, NULL::DOUBLE AS ml_probability FROM ruled)"),
    "b1_dq_errors": ("checked", "SELECT Trans_id, array_to_string(errs, ',') AS dq_errors FROM checked"),
    "b2_split": ("checked", "SELECT CASE WHEN len(errs) = 0 THEN 'valid' ELSE 'invalid' END AS part, count(*) AS n, sum(Trans_id)::BIGINT AS ids FROM checked GROUP BY 1"),
    "b3_silver": ("silver", f"SELECT {SILVER_OUT} FROM silver"),
    "b4_fx_rate": ("raw", "SELECT Trans_id, CASE Currency WHEN 'EUR' THEN 1.08 WHEN 'EGP' THEN 0.02 ELSE 1 END::DOUBLE AS fx_rate FROM raw"),
    "b5_amount_usd": ("raw", "SELECT Trans_id, round(Trans_amount::DECIMAL(18,4) * CASE Currency WHEN 'EUR' THEN 1.08 WHEN 'EGP' THEN 0.02 ELSE 1 END::DECIMAL(18,8), 2)::DOUBLE AS amount_usd FROM raw"),
    "b6_high_amount": ("silver", "SELECT transaction_id FROM silver WHERE amount_usd >= 10000"),
    "b7_non_pass": ("decided", "SELECT transaction_id, decision FROM decided WHERE decision <> 'PASS'"),
    "b8_one_day": ("decided", "SELECT transaction_id, risk_score::BIGINT AS risk_score FROM decided WHERE event_date = '2026-09-02'"),
    "b9_history_bound": ("silver", f"SELECT transaction_id, t >= (SELECT min(t) FROM silver WHERE {LATE}) - 3600 * 24 AND client_id IN (SELECT client_id FROM silver WHERE {LATE}) AND NOT ({LATE}) AS taken FROM silver"),
    "b11_ranges": ("silver", "SELECT transaction_id FROM silver WHERE amount_usd BETWEEN 8000 AND 9999 OR country_src IN ('USA', 'Jordan')"),
    "b12_transaction_risk_view": ("decided", "SELECT transaction_id, client_id, event_date, t AS event_time, amount_usd::DOUBLE AS amount_usd, currency, txn_type, status, country_src, country_dest, decision, risk_score::BIGINT AS risk_score, ml_probability, array_to_string(matched, ',') AS matched_rules, 'p' || card_id AS batch_token FROM decided"),
    "c1_drop_committed": ("silver", f"SELECT transaction_id, {LATE} OR card_id = 2 AS kept FROM silver"),
    "c2_touched_history": ("silver", f"SELECT transaction_id, client_id IN (SELECT client_id FROM silver WHERE {LATE}) AND t >= (SELECT min(t) FROM silver WHERE {LATE}) - 3600 * 720 AS taken FROM silver"),
    "c3_batch_of_history": ("ruled", f"SELECT {RULE_OUT} FROM ruled"),
    "c5_labelled_decisions": ("matched_", "SELECT transaction_id, decision, is_fraud, pattern FROM matched_"),
    "d1_customer_daily_risk": ("decided", f"SELECT event_date, client_id, count(*) AS txn_count, {MONEY} AS total_amount_usd, {FLAGGED} AS flagged_count, {BLOCKED} AS blocked_count, max(risk_score)::BIGINT AS max_risk_score, count(DISTINCT country_src) AS distinct_countries, count(DISTINCT device_id) AS distinct_devices FROM decided GROUP BY 1, 2"),
    "d2_daily_kpis": ("decided", f"SELECT d.event_date, coalesce(total_txns, 0) AS total_txns, coalesce(total_amount_usd, 0) AS total_amount_usd, coalesce(flagged_rate, 0) AS flagged_rate, coalesce(blocked_rate, 0) AS blocked_rate, coalesce(avg_risk_score, 0) AS avg_risk_score FROM (SELECT strftime(DATE '2026-09-06' - i::INTEGER, '%Y-%m-%d') AS event_date FROM range(7) r(i)) d LEFT JOIN (SELECT event_date, count(*) AS total_txns, {MONEY} AS total_amount_usd, round({FLAGGED}::DOUBLE / count(*), 4) AS flagged_rate, round({BLOCKED}::DOUBLE / count(*), 4) AS blocked_rate, round(avg(risk_score), 2) AS avg_risk_score FROM decided GROUP BY 1) USING (event_date)"),
    "d4_daily_kpis_view": ("decided", f"SELECT event_date, count(*) AS total_transactions, sum(amount_usd)::DOUBLE AS total_amount_usd, {FLAGGED} AS flagged_transactions, {BLOCKED} AS blocked_transactions, round({FLAGGED}::DOUBLE / count(*), 4) AS flagged_rate, round({BLOCKED}::DOUBLE / count(*), 4) AS blocked_rate, round(avg(risk_score), 2) AS avg_risk_score, round(avg(ml_probability), 4) AS avg_ml_probability FROM decided GROUP BY 1"),
    "d5_client_risk_view": ("decided", f"SELECT client_id, max(t) AS last_event_time, count(*) AS transaction_count, sum(amount_usd)::DOUBLE AS total_amount_usd, max(risk_score)::BIGINT AS max_risk_score, {FLAGGED} AS flagged_count, {BLOCKED} AS blocked_count, arg_max(decision, (t, transaction_id)) AS last_decision, arg_max(ml_probability, (t, transaction_id)) AS last_ml_probability FROM decided GROUP BY 1"),
    "d6_feature_monitoring_view": ("features", "SELECT event_date, count(*) AS feature_rows, round(avg(txn_count_5m), 6) AS avg_txn_count_5m, round(avg(amount_sum_1h), 4) AS avg_amount_sum_1h, round(avg(amount_to_prior_avg), 4) AS avg_amount_to_prior_avg, round(avg(device_new_30d), 6) AS new_device_rate, round(avg(country_changed), 6) AS country_change_rate FROM features GROUP BY 1"),
    "d7_model_monitoring_view": ("decided", "SELECT event_date, count(*) AS scored_rows, round(avg(ml_probability), 6) AS avg_ml_probability, round(quantile_cont(ml_probability, 0.5), 6) AS p50_ml_probability, round(quantile_cont(ml_probability, 0.95), 6) AS p95_ml_probability, count(*) FILTER (decision IN ('FLAG', 'BLOCK')) AS alerting_decisions FROM decided GROUP BY 1"),
    "d8_decision_counts": ("decided", "SELECT decision, count(*) AS n, round(avg(ml_probability), 6) AS mean_probability FROM decided GROUP BY 1"),
    "d10_offset_summary": ("doubled", "SELECT kafka_partition, min(kafka_offset) AS min_offset, max(kafka_offset) AS max_offset, count(*) AS row_count FROM doubled GROUP BY 1"),
    "d11_batch_token": ("doubled", "SELECT substr(sha256(string_agg(kafka_partition || ':' || lo || ':' || hi || ':' || n, '|' ORDER BY kafka_partition)), 1, 20) AS batch_token FROM (SELECT kafka_partition, min(kafka_offset) AS lo, max(kafka_offset) AS hi, count(*) AS n FROM doubled GROUP BY 1)"),
    "d12_distinct_clients": ("silver", "SELECT DISTINCT client_id FROM silver"),
    "d13_deduplicate": ("doubled", "SELECT Trans_id, kafka_partition, kafka_offset FROM doubled QUALIFY row_number() OVER (PARTITION BY Trans_id ORDER BY kafka_partition, kafka_offset) = 1"),
    "d15_class_counts": ("labels_", "SELECT count(*) FILTER (is_fraud = 1) AS positives, count(*) FILTER (is_fraud = 0) AS negatives FROM labels_"),
    "d16_time_cutoff": ("silver", "SELECT quantile_disc(t, 0.8) AS cutoff FROM silver"),
    "d17_min_event_time": ("silver", "SELECT min(t) AS first_event FROM silver"),
    "e1_features": ("features", "SELECT transaction_id, txn_count_5m, amount_sum_1h, avg_amount_prior_30, round(stddev_amount_prior_30, 3) AS stddev_amount_prior_30, seconds_since_prev_txn, device_new_30d, country_changed, amount_to_prior_avg FROM features"),
    "e9_mule": ("flags", "SELECT transaction_id, r4 AS mule FROM flags"),
    "e11_velocity": ("flags", "SELECT transaction_id, r5 AS velocity FROM flags"),
    "e12_structuring": ("flags", "SELECT transaction_id, r2 AS structuring FROM flags"),
    "e13_impossible_travel": ("flags", "SELECT transaction_id, r3 AS impossible_travel FROM flags"),
    "e14_new_device": ("flags", "SELECT transaction_id, r6 AS new_device FROM flags"),
    "e15_latest_per_client": ("decided", "SELECT client_id, transaction_id FROM decided QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY t DESC, transaction_id DESC) = 1"),
    "r1_apply_rules": ("ruled", f"SELECT {RULE_OUT} FROM ruled"),
    "r5_ensemble_policy": ("decided", "SELECT transaction_id, ml_probability, risk_score::BIGINT AS risk_score, decision FROM decided"),
    "j1_alerts": ("decided", "SELECT 'tok:' || transaction_id AS key, transaction_id, client_id, amount_usd::DOUBLE AS amount_usd, currency, decision, risk_score::BIGINT AS risk_score, array_to_string(matched, ',') AS matched_rules, t AS event_time FROM decided WHERE decision <> 'PASS'"),
    "u1_history_union": ("silver", f"SELECT transaction_id, {LATE} AS in_batch FROM silver"),
    "q4_quality_report": ("silver", "SELECT * FROM (SELECT 'not_null' AS expectation, c AS \"column\", true AS success, 0 AS unexpected_count FROM (VALUES ('transaction_id'), ('client_id'), ('event_time'), ('currency'), ('country_src')) v(c) UNION ALL SELECT 'bounded_below', 'amount_usd', count(*) FILTER (amount_usd < 0) = 0, count(*) FILTER (amount_usd < 0) FROM silver), (SELECT count(*) AS element_count FROM silver)"),
    "q2_raw_quality": ("raw", "SELECT 'not_null' AS expectation, 'Clt_id' AS \"column\", count(*) FILTER (Clt_id IS NULL) = 0 AS success, count(*) FILTER (Clt_id IS NULL) AS unexpected_count, count(*) AS element_count FROM raw UNION ALL SELECT 'bounded_below', 'Trans_amount', count(*) FILTER (Trans_amount <= 0) = 0, count(*) FILTER (Trans_amount <= 0), count(*) FROM raw"),
    "q7_recovery_check": ("silver", "SELECT *, first_range >= 1 AND second_range >= 1 AND row_count = distinct_ids AS ok FROM (SELECT count(*) FILTER (transaction_id BETWEEN 100001 AND 100500) AS first_range, count(*) FILTER (transaction_id BETWEEN 100501 AND 200000) AS second_range, count(*) AS row_count, count(DISTINCT transaction_id) AS distinct_ids FROM silver)"),
    "v1_confusion": ("matched_", "SELECT tp, fp, fn, tn, tp / nullif(tp + fp, 0)::DOUBLE AS precision, tp / nullif(tp + fn, 0)::DOUBLE AS recall, 2 * (tp / nullif(tp + fp, 0)::DOUBLE) * (tp / nullif(tp + fn, 0)::DOUBLE) / nullif(tp / nullif(tp + fp, 0)::DOUBLE + tp / nullif(tp + fn, 0)::DOUBLE, 0) AS f1 FROM (SELECT count(*) FILTER (decision <> 'PASS' AND is_fraud = 1) AS tp, count(*) FILTER (decision <> 'PASS' AND is_fraud = 0) AS fp, count(*) FILTER (decision = 'PASS' AND is_fraud = 1) AS fn, count(*) FILTER (decision = 'PASS' AND is_fraud = 0) AS tn FROM matched_)"),
    "v3_recall_by_pattern": ("matched_", "SELECT pattern, count(*) AS n, avg(CASE WHEN decision <> 'PASS' THEN 1.0 ELSE 0 END)::DOUBLE AS recall FROM matched_ WHERE is_fraud = 1 GROUP BY 1"),
    "v4_precision_by_rule": ("matched_", "SELECT rule, count(*) AS fired, avg(is_fraud)::DOUBLE AS precision FROM (SELECT is_fraud, unnest(matched) AS rule FROM matched_) GROUP BY 1"),
    "m4_class_weights": ("labels_", "SELECT Trans_id, round(CASE WHEN is_fraud = 1 THEN (SELECT count(*) FILTER (is_fraud = 0) / count(*) FILTER (is_fraud = 1) FROM labels_) ELSE 1.0 END, 9)::DOUBLE AS weight FROM labels_"),
    "d7_approximate_view": ("decided", "SELECT event_date, count(*) AS scored_rows, quantile_disc(ml_probability, 0.5) AS p50_ml_probability, quantile_disc(ml_probability, 0.95) AS p95_ml_probability FROM decided GROUP BY event_date"),
    "d7_range_quantiles": ("decided", """SELECT strftime(DATE '2026-09-05' - (n - 1), '%Y-%m-%d') AS first_day, '2026-09-05' AS last_day, count(b) AS "values", min(b) FILTER (r * 4 >= k) AS p25, min(b) FILTER (r * 2 >= k) AS p50, min(b) FILTER (r * 4 >= 3 * k) AS p75, min(b) FILTER (r * 100 >= 95 * k) AS p95
        FROM (SELECT n, b, count(*) OVER (PARTITION BY n ORDER BY b) AS r, count(b) OVER (PARTITION BY n) AS k
              FROM (VALUES (1), (2), (3), (4), (30)) v(n) LEFT JOIN (SELECT event_date, (risk_score // 10 * 10)::DOUBLE AS b FROM decided) ON event_date BETWEEN strftime(DATE '2026-09-05' - (n - 1), '%Y-%m-%d') AND '2026-09-05') GROUP BY n"""),
    "d16_approximate_cutoff": ("silver", "SELECT count(*) AS rows, round(count(*) FILTER (t < c) / count(*), 3) AS early_share FROM silver, (SELECT quantile_disc(t, 0.8) AS c FROM silver)"),
    "m3_time_split": ("silver", "SELECT count(*) FILTER (t < c) AS training_rows, count(*) FILTER (t >= c) AS validation_rows FROM silver, (SELECT quantile_disc(t, 0.8) AS c FROM silver)"),
    "mt2_rolling_rates": ("rates", "SELECT window_start, window_end, round(decisions_rate, 6) AS decisions_rate, round(alerts_rate, 6) AS alerts_rate, round(quarantined_rate, 6) AS quarantined_rate, round(feature_rows_rate, 6) AS feature_rows_rate, round(p95_duration, 6) AS p95_duration FROM rates"),
    "mt3_conditions": ("rates", "SELECT window_start, window_end, p95_duration > 30 AS batch_slow, quarantined_rate / greatest(decisions_rate, 1.0) > 0.1 AS quarantine_high, alerts_rate / greatest(decisions_rate, 1.0) > 0.25 AS alert_spike, feature_rows_rate = 0 AND decisions_rate > 0 AS features_stalled FROM rates"),
    "a13_retried_batches": ("silver", f"SELECT transaction_id, CASE WHEN {LATE} THEN 'second' ELSE 'first' END AS batch_token FROM silver"),
    "a19_replaced_days": ("decided", f"SELECT event_date, client_id, count(*) AS txn_count, {MONEY} AS total_amount_usd, {FLAGGED} AS flagged_count, {BLOCKED} AS blocked_count, max(risk_score)::BIGINT AS max_risk_score, count(DISTINCT country_src) AS distinct_countries, count(DISTINCT device_id) AS distinct_devices FROM decided WHERE event_date <> '2026-09-02' GROUP BY 1, 2"),
    "a15_alert_stream": ("decided", "SELECT 'tok:' || transaction_id AS alert_id, client_id, decision, risk_score::BIGINT AS risk_score, amount_usd::DOUBLE AS amount_usd FROM decided WHERE decision <> 'PASS'"),
    "a18_export": ("decided", f"SELECT transaction_id, decision, risk_score::BIGINT AS risk_score, CASE WHEN {LATE} THEN 'late' ELSE 'early' END AS batch_token FROM decided WHERE event_date = '2026-09-02'"),
    "a23_catalog_tables": ("decided", f"SELECT event_date, CASE WHEN {LATE} THEN 'late' ELSE 'early' END AS batch_part, count(*) AS rows, sum(risk_score)::BIGINT AS risk FROM decided GROUP BY 1, 2"),
    "q6_daily_reports": ("raw", """SELECT strftime(make_timestamp(kafka_sec * 1000000), '%Y-%m-%d') AS event_date, kind AS expectation, c AS "column", count(*) FILTER (bad) = 0 AS success, count(*) FILTER (bad) AS unexpected_count, count(*) AS element_count
        FROM (SELECT kafka_sec, unnest([{'kind': 'not_null', 'c': 'Clt_id', 'k': 1, 'bad': Clt_id IS NULL}, {'kind': 'not_null', 'c': 'Currency', 'k': 2, 'bad': Currency IS NULL}, {'kind': 'bounded_below', 'c': 'Trans_amount', 'k': 3, 'bad': Trans_amount <= 0}, {'kind': 'bounded_below', 'c': 'Trans_amount', 'k': 4, 'bad': Trans_amount < 500}], recursive := true) FROM raw) GROUP BY 1, kind, c, k"""),
    "r6_configured_rules": ("other_ruled", f"SELECT {RULE_OUT} FROM other_ruled"),
    "v5_report": ("matched_", """WITH k AS (SELECT count(*) FILTER (decision <> 'PASS' AND is_fraud = 1) AS tp, count(*) FILTER (decision <> 'PASS' AND is_fraud = 0) AS fp, count(*) FILTER (decision = 'PASS' AND is_fraud = 1) AS fn, count(*) FILTER (decision = 'PASS' AND is_fraud = 0) AS tn FROM matched_)
        SELECT 'counts' AS part, name, n, NULL::DOUBLE AS value FROM k UNPIVOT (n FOR name IN (tp, fp, fn, tn))
        UNION ALL SELECT 'rates', unnest(['precision', 'recall', 'f1']), NULL, unnest([round(tp / (tp + fp)::DOUBLE, 9), round(tp / (tp + fn)::DOUBLE, 9), round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 9)]) FROM k
        UNION ALL SELECT 'size', unnest(['n_matched', 'n_decisions', 'n_labels']), unnest([(SELECT count(*) FROM matched_), (SELECT count(*) FROM ruled), (SELECT count(*) FROM labels_)]), NULL
        UNION ALL SELECT 'pattern', pattern, count(*), round(avg(CASE WHEN decision <> 'PASS' THEN 1.0 ELSE 0 END)::DOUBLE, 9) FROM matched_ WHERE is_fraud = 1 GROUP BY pattern
        UNION ALL SELECT 'rule', rule, count(*), round(avg(is_fraud)::DOUBLE, 9) FROM (SELECT is_fraud, unnest(matched) AS rule FROM matched_) GROUP BY rule"""),
    "a26_compaction": ("silver", "SELECT transaction_id, CASE WHEN currency = 'EGP' THEN 'open' ELSE 'card' || card_id END AS batch_token, CASE WHEN currency = 'EGP' THEN 'open' ELSE 'compacted' END AS batch_part FROM silver"),
    "m6_member_metrics": ("member_scores", """SELECT member, round(auc, 9) AS auc, round(auprc, 9) AS auprc, round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 9) AS precision, round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 9) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 9) AS f1
        FROM (SELECT member, count(*) FILTER (s >= 0.7 AND is_fraud = 1) AS tp, count(*) FILTER (s >= 0.7 AND is_fraud = 0) AS fp, count(*) FILTER (s < 0.7 AND is_fraud = 1) AS fn,
                     (sum(r) FILTER (is_fraud = 1) - count(*) FILTER (is_fraud = 1) * (count(*) FILTER (is_fraud = 1) + 1) / 2.0)::DOUBLE / (count(*) FILTER (is_fraud = 1) * count(*) FILTER (is_fraud = 0)) AS auc
              FROM (SELECT *, rank() OVER (PARTITION BY member ORDER BY s) + (count(*) OVER (PARTITION BY member, s) - 1) / 2.0 AS r FROM member_scores) GROUP BY member)
        JOIN (SELECT member, sum(dr * (p + coalesce(pp, p)) / 2) AS auprc
              FROM (SELECT *, lag(p) OVER (PARTITION BY member ORDER BY s DESC) AS pp
                    FROM (SELECT member, s, sum(y) OVER down / sum(n) OVER down AS p, y / sum(y) OVER (PARTITION BY member) AS dr
                          FROM (SELECT member, s, sum(is_fraud)::DOUBLE AS y, count(*)::DOUBLE AS n FROM member_scores GROUP BY 1, 2) WINDOW down AS (PARTITION BY member ORDER BY s DESC)))
              GROUP BY member) USING (member)"""),
    "m9_exported_scores": ("ruled", """SELECT transaction_id, round(l, 9) AS logistic, round(f, 9) AS forest, round(g, 9) AS boosted, round(greatest(l, f, g), 9) AS ml_probability, greatest(risk_score, round(greatest(l, f, g) * 100)::INTEGER)::BIGINT AS risk_score,
        CASE WHEN decision = 'BLOCK' THEN 'BLOCK' WHEN greatest(l, f, g) >= 0.7 THEN 'FLAG' ELSE decision END AS decision
        FROM (SELECT *, 1 / (1 + exp(3.0::DOUBLE - 0.0004::DOUBLE * a - 0.5 * n5 - 1.25 * device_new_30d - CASE WHEN w THEN 0.75 ELSE 0 END)) AS l,
                     (CASE WHEN a <= 2500 THEN 0.05::DOUBLE WHEN w THEN 0.9 ELSE 0.4 END + CASE WHEN device_new_30d > 0.5 THEN 0.8::DOUBLE ELSE 0.15 END) / 2 AS f,
                     1 / (1 + exp(-2 * (CASE WHEN a > 4000 THEN 0.6::DOUBLE ELSE -1 END + CASE WHEN n5 > 1 THEN 0.75::DOUBLE ELSE -0.125 END))) AS g
              FROM (SELECT *, amount_usd::DOUBLE AS a, txn_type = 'Withdrawal' AS w FROM ruled))"""),
    "mt3_sustained": ("rates", """SELECT condition, min(w) AS started, max(w) AS ended, count(*) AS evaluations, max(w) - min(w) >= any_value(hold) AS fired, CASE WHEN max(w) - min(w) >= any_value(hold) THEN min(w) + any_value(hold) END AS fired_at
        FROM (SELECT *, count(*) FILTER (NOT joined) OVER (PARTITION BY condition ORDER BY w) AS run
              FROM (SELECT condition, hold, w, coalesce(w - lag(w) OVER (PARTITION BY condition ORDER BY w) = 30, false) AS joined
                    FROM (SELECT 'batch_slow' AS condition, 300 AS hold, window_end AS w FROM rates WHERE p95_duration > 30
                          UNION ALL SELECT 'quarantine_high', 600, window_end FROM rates WHERE quarantined_rate / greatest(decisions_rate, 1.0) > 0.1
                          UNION ALL SELECT 'alert_spike', 600, window_end FROM rates WHERE alerts_rate / greatest(decisions_rate, 1.0) > 0.25
                          UNION ALL SELECT 'features_stalled', 300, window_end FROM rates WHERE feature_rows_rate = 0 AND decisions_rate > 0)))
        GROUP BY condition, run"""),
    "st1_stream_run": ("st_ruled st_sent", """SELECT s.transaction_id, s.sent, CASE WHEN late THEN 0 ELSE 1 END::BIGINT AS raw, NOT late AND bad AS quarantined, decision, CASE WHEN decision IS NOT NULL THEN array_to_string(matched, ',') END AS matched_rules, risk_score::BIGINT AS risk_score
        FROM st_sent s LEFT JOIN st_ruled r ON r.transaction_id = s.transaction_id"""),
    "k1_flagship": ("ruled", "SELECT decision, count(*) AS transactions, round(avg(risk_score), 4) AS mean_risk, sum(amount_usd)::DOUBLE AS total_amount_usd FROM ruled GROUP BY 1"),
}
#: Other ways to the same results.
SELECTS |= {name: SELECTS[like] for name, like in {"a14_state_buckets": "a14_upsert_state", "c1_id_ledger": "c1_drop_committed", "e1_sliced_features": "e1_features", "r1_sliced_rules": "r1_apply_rules", "st11_client_state": "e1_features"}.items()}


def sql(name: str) -> str:
    needs, select = SELECTS[name]
    order: list[str] = []

    def visit(step: str) -> None:
        if step not in order:
            for below in STEPS[step][0].split():
                visit(below)
            order.append(step)

    for step in needs.split():
        visit(step)
    head = ", ".join(f"{s} AS ({STEPS[s][1]})" for s in order)
    if head and select.startswith("WITH "):
        return f"WITH {head}, {select[5:]}"
    return f"WITH {head} {select}" if head else select


ORACLES = {name: sql(name) for name in SELECTS}
