"""Sources: streams, layers, catalog tables, labels, and the replay of corrected dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyguard.schemas import LABELS, RAW


def read_stream(spark: SparkSession, source: str, fmt: str = "parquet", schema: StructType | None = None, topic: str | None = None, starting: str = "earliest", per_trigger: int = 5000) -> DataFrame:
    """A stream of records. ``fmt`` kafka (with its jar): ``source`` is the broker list; else a folder of files."""
    if fmt == "kafka":
        options = {"kafka.bootstrap.servers": source, "subscribe": topic, "startingOffsets": starting, "maxOffsetsPerTrigger": per_trigger}
        return spark.readStream.format("kafka").options(**options).load()
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", per_trigger).load(source)


def read_layer(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Only a missing path is False; any other failure of the file system is raised."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def layer_exists(spark: SparkSession, name_or_path: str) -> bool:
    return path_exists(spark, name_or_path) if "/" in name_or_path else spark.catalog.tableExists(name_or_path)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LABELS).option("header", True).csv(path)


def read_replay(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Corrected dead letters, one JSON object a line: (records with key ``Clt_id``, lines that still don't parse)."""
    schema = StructType([*RAW.fields, StructField("_corrupt_record", StringType())])
    lines = spark.read.text(path).where(F.trim("value") != "").select(F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r")).select("r.*")
    good = lines.where("_corrupt_record is null").select(F.col("Clt_id").cast("string").alias("key"), *RAW.fieldNames())
    return good, lines.where("_corrupt_record is not null").select(F.col("_corrupt_record").alias("line"))
