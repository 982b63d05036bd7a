"""Session with the settings that results depend on: UTC, ANSI, adaptive execution. Lists of up to 256 values reach Parquet's bloom
filters (Spark's default is 10); state of streams that keeps lists and timers for each key lies in RocksDB."""

from pyspark.sql import SparkSession


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName("tallyguard")
    if master:
        builder = builder.master(master)
    base = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.parquet.pushdown.inFilterThreshold": "256"}
    return builder.config(map=base | conf).getOrCreate()
