"""Column lists of the wire format and of the layered tables."""

from pyspark.sql import types as T

_RAW = "Trans_id int, Clt_id int, Card_id int, Dev_id int, Trans_amount int, Trans_date string, Trans_type string, Trans_status string, Trans_destination string, Dev_Ip_Location string, Trans_Ref_No string, Currency string, Trans_Reason string, Dest_account_No int, Country_Dest string, Country_Src string"
_LINEAGE = "kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp, kafka_confluent_magic string, kafka_schema_id int"
_SILVER = "transaction_id bigint, client_id bigint, card_id bigint, device_id bigint, fx_rate decimal(18,8), amount_usd decimal(18,4), currency string, txn_type string, status string, destination_bank string, device_location string, ref_no string, reason string, dest_account_no bigint, country_src string, country_dest string, event_time timestamp, event_date date, ingest_time timestamp"
_FEATURES = "txn_count_5m double, amount_sum_1h double, avg_amount_prior_30 double, stddev_amount_prior_30 double, seconds_since_prev_txn double, device_new_30d double, country_changed double, amount_to_prior_avg double"

_KINDS = {"int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType(), "double": T.DoubleType(), "timestamp": T.TimestampType(), "date": T.DateType(), "decimal(18,8)": T.DecimalType(18, 8), "decimal(18,4)": T.DecimalType(18, 4), "array<string>": T.ArrayType(T.StringType())}


def _schema(text: str) -> T.StructType:
    """A schema without a session, which StructType.fromDDL() would need."""
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in (x.split() for x in text.split(", "))])


#: One transaction as it arrives; every field may be null.
RAW = _schema(_RAW)
#: With its place in the stream.
DECODED = _schema(f"{_RAW}, {_LINEAGE}")
QUARANTINE = _schema(f"{_RAW}, {_LINEAGE}, dq_errors array<string>, quarantined_at timestamp")
SILVER = _schema(_SILVER)
FEATURES = _schema(f"{_SILVER}, {_FEATURES}")
DECISIONS = _schema(f"{_SILVER}, {_FEATURES}, matched_rules array<string>, risk_score int, decision string, ml_probability double")
LABELS = _schema("Trans_id bigint, is_fraud int, pattern string")
CUSTOMER_DAILY = _schema("event_date date, client_id bigint, txn_count bigint, total_amount_usd decimal(18,4), flagged_count bigint, blocked_count bigint, max_risk_score int, distinct_countries bigint, distinct_devices bigint")
DAILY_KPIS = _schema("event_date date, total_txns bigint, total_amount_usd decimal(18,4), flagged_rate double, blocked_rate double, avg_risk_score double")
LEDGER = _schema("batch_token string, committed_at timestamp")
FEATURE_NAMES = [x.split()[0] for x in _FEATURES.split(", ")]
SILVER_NAMES = SILVER.fieldNames()
