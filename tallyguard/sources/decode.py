"""From broker records to transactions: registry header, payload, and the dead letters of what doesn't parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.schemas import RAW


def confluent_magic(value: Column) -> Column:
    return F.hex(F.substring(value, 1, 1))


def confluent_schema_id(value: Column) -> Column:
    """The big-endian schema id; null where it doesn't fit an int, instead of an overflow error."""
    wide = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long")
    return F.when(wide <= 2147483647, wide).cast("int")


def extract_confluent_metadata(df: DataFrame, value_col: str = "value") -> DataFrame:
    return df.withColumn("kafka_confluent_magic", confluent_magic(F.col(value_col))).withColumn("kafka_schema_id", confluent_schema_id(F.col(value_col)))


def strip_confluent_header(df: DataFrame, value_col: str = "value") -> DataFrame:
    """The payload without its first five bytes; shorter values are empty."""
    return df.withColumn(value_col, F.expr(f"substring({value_col}, 6, greatest(length({value_col}) - 5, 0))"))


def decode_transactions(df: DataFrame, avro_schema: str | None = None, value_col: str = "value") -> DataFrame:
    """The 16 record fields, then partition, offset, timestamp, magic byte and schema id.

    With ``avro_schema`` (and spark-avro on the class path) the payload is Avro, else JSON; a payload that doesn't parse
    gives nulls, which the quality rules quarantine.
    """
    lined = strip_confluent_header(extract_confluent_metadata(df, value_col), value_col)
    if avro_schema is None:
        record = F.from_json(F.col(value_col).cast("string"), RAW, {"mode": "PERMISSIVE"})
    else:
        from pyspark.sql.avro.functions import from_avro

        record = from_avro(F.col(value_col), avro_schema, {"mode": "PERMISSIVE"})
    fields = [F.col(f"_record.{c}").alias(c) for c in RAW.fieldNames()]
    lineage = [F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), F.col("timestamp").alias("kafka_timestamp"), "kafka_confluent_magic", "kafka_schema_id"]
    return lined.withColumn("_record", record).select(*fields, *lineage)


def dead_letters(lines: DataFrame, column: str = "value") -> DataFrame:
    """(reason, envelope) of JSON lines that don't fit the ingest schema; the others go on."""
    from pyspark.sql.types import StringType, StructType

    schema = StructType(list(RAW.fields)).add("_corrupt_record", StringType())
    parsed = lines.select(F.col(column).alias("line"), F.from_json(column, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    bad = parsed.where("r._corrupt_record is not null").select(F.lit("schema").alias("reason"), F.col("line").alias("record"))
    return bad.select("reason", F.to_json(F.struct("reason", "record")).alias("envelope"))
