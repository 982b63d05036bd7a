"""Card transactions derived from the ``events`` table: the same 16-field records as on the wire, deterministic by event id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SEC = "1788220800 + (unix_micros(cast(ts as timestamp)) - 1704067200000000) div 200000000 + 86400 * (user_id % 3) + if(ts >= timestamp_ntz'2024-01-16 00:00:00', 86400, 0)"
_RAW = """
cast(event_id + 100001 as int) Trans_id
cast(if(event_id % 71 = 70, null, user_id + 1) as int) Clt_id
cast(event_id % 3 + 1 as int) Card_id
cast(if(event_id % 40 = 7, 900000 + event_id % 11, user_id * 10 + event_id % 2) as int) Dev_id
if(event_id % 97 = 96, -1, cast(floor(value * 60) as int) + 1) Trans_amount
if(event_id % 73 = 72, 'not-a-date', date_format(timestamp_seconds(sec), 'yyyy-MM-dd hh:mm:ss a')) Trans_date
case when event_id % 83 = 82 then 'POS' when event_type in ('purchase', 'error') then 'Withdrawal' when event_type = 'signup' then 'Deposit' else 'Transfer' end Trans_type
case when event_id % 79 = 78 then 'PENDING' when event_id % 25 = 24 then 'Rejected' else 'Successful' end Trans_status
'CIB' Trans_destination
'Cairo' Dev_Ip_Location
concat('R', event_id + 100001) Trans_Ref_No
case when event_id % 89 = 88 then 'GBP' when event_id % 10 < 6 then 'USD' when event_id % 10 < 8 then 'EUR' else 'EGP' end Currency
'Shopping' Trans_Reason
cast(event_id as int) Dest_account_No
'Egypt' Country_Dest
case event_id % 20 when 3 then 'USA' when 11 then 'Jordan' else 'Egypt' end Country_Src
cast(user_id % 3 as int) kafka_partition
cast(event_id as bigint) kafka_offset
timestamp_seconds(sec) kafka_timestamp
""".strip().split("\n")


def raw_transactions(spark: SparkSession, sf_dir: str, duplicates: bool = False) -> DataFrame:
    """Decoded stream rows; with ``duplicates`` every fiftieth event is delivered again at a later offset."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("sec", F.expr(_SEC))
    raw = events.selectExpr(*(" as ".join(x.rsplit(" ", 1)) for x in _RAW))
    raw = raw.withColumn("kafka_confluent_magic", F.lit("00")).withColumn("kafka_schema_id", F.expr("cast(1 + kafka_offset % 3 as int)"))
    if not duplicates:
        return raw
    again = raw.where("kafka_offset % 50 = 0").withColumn("kafka_offset", F.expr("kafka_offset + 1000000000"))
    return raw.unionByName(again)


def broker_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value, partition, offset, timestamp): the record as JSON behind a five-byte registry header."""
    raw = raw_transactions(spark, sf_dir)
    record = F.struct(*[c for c in raw.columns if not c.startswith("kafka_")])
    header = F.unhex(F.concat(F.lit("00"), F.lpad(F.hex("kafka_schema_id"), 8, "0")))
    value = F.concat(header, F.to_json(record).cast("binary"))
    return raw.select(value.alias("value"), F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"), F.col("kafka_timestamp").alias("timestamp"))


def fraud_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(Trans_id, is_fraud, pattern) by the injected patterns; the first that fits names it."""
    raw = raw_transactions(spark, sf_dir)
    pattern = F.when(F.col("Trans_amount") >= 10000, "HIGH_AMOUNT").when(F.col("Dev_id") >= 900000, "NEW_DEVICE_HIGH_VALUE").when(F.col("kafka_offset") % 101 == 0, "MULE").otherwise("NORMAL")
    return raw.select(F.col("Trans_id").cast("long").alias("Trans_id"), pattern.alias("pattern")).select("Trans_id", (F.col("pattern") != "NORMAL").cast("int").alias("is_fraud"), "pattern")
