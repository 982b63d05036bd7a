"""Layered Parquet tables that micro-batches replace as a whole, a commit ledger, ids and client state in buckets, compaction.

A table is a folder, partitioned by a date and ``batch_part``: a reader of some days lists their folders alone. A batch writes its
rows under its own token, so that a retry first deletes exactly what an earlier attempt left. ``batch_token`` is also a data column: compaction moves the rows of many
committed tokens into one part and still knows whose they are.

Stored transaction ids have a narrow table of their own, partitioned by a bucket of the id; its files are sorted by id and have bloom filters. Client
state is partitioned by a bucket of the client. A batch reads and writes the buckets of its own ids and clients, no others.
"""

from __future__ import annotations

import datetime
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard import schemas
from tallyguard.operators import serving
from tallyguard.sources.readers import delete_path, path_exists

#: table: (schema, date column)
TABLES = {
    "bronze": (schemas.DECODED, "ingest_date"),
    "quarantine": (schemas.QUARANTINE, "quarantine_date"),
    "silver": (schemas.SILVER, "event_date"),
    "features": (schemas.FEATURES, "event_date"),
    "decisions": (schemas.DECISIONS, "event_date"),
}
TARGET_BYTES = 512 << 20
#: Buckets of the id ledger and of the state; they stay the same for the life of a store. A batch's share of the state is rewritten, so a store
#: of many clients wants more buckets than a batch has clients.
ID_BUCKETS, STATE_BUCKETS = 16, 64
#: So many ids of a batch are looked up one by one in the bloom filters, as many as the session lets through to Parquet.
FEW_IDS = 256
#: A batch of so many days is written day by day, one of more days in one job that sorts a task's rows by day.
FEW_DAYS = 8
IDS = "transaction_id bigint, batch_token string, bucket int, batch_part string"
COMPACTED = "compacted"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("long")), F.lit(buckets)).cast("int")


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a schema, without the Python tasks that createDataFrame() of an empty list starts."""
    return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))


def missing_tokens(incoming: DataFrame, ledger: DataFrame) -> DataFrame:
    """Tokens that the ledger doesn't hold yet, each once."""
    return incoming.select("batch_token").distinct().join(ledger.select("batch_token"), "batch_token", "left_anti")


class TableStore:
    def __init__(self, spark: SparkSession, base: str, id_buckets: int = ID_BUCKETS, state_buckets: int = STATE_BUCKETS):
        self.spark, self.base = spark, base.rstrip("/")
        self.id_buckets, self.state_buckets = id_buckets, state_buckets

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def schema(self, name: str) -> T.StructType:
        held, date = TABLES[name]
        fields = [f for f in held.fields if f.name != date]
        return T.StructType([*fields, T.StructField("batch_token", T.StringType()), T.StructField(date, T.DateType()), T.StructField("batch_part", T.StringType())])

    def _found(self, pattern: str) -> list[str]:
        """Paths that match a pattern under the store's folder."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{pattern}")
        found = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
        return [x.getPath().toString() for x in found or ()]

    def _parts(self, name: str, since: datetime.date | None = None, token: str | None = None) -> DataFrame:
        """The rows of a table's parts: of the days from ``since`` on, or of one batch. Other folders aren't listed."""
        _, date = TABLES[name]
        if since is None and token is None:
            paths = [self.path(name)] if path_exists(self.spark, self.path(name)) else []
        else:
            paths = self._found(f"{name}/{date}=*" + (f"/batch_part={token}" if token else ""))
            if since is not None:
                paths = [p for p in paths if p.split(f"{date}=")[-1][:10] >= since.isoformat()]
        if not paths:
            return empty(self.spark, self.schema(name)).drop("batch_part")
        return self.spark.read.schema(self.schema(name)).option("basePath", self.path(name)).parquet(*paths).drop("batch_part")

    def read(self, name: str, since: datetime.date | None = None) -> DataFrame:
        """The table's rows with batch_token and date, or those of the days from ``since`` on; empty before the first write."""
        return self._parts(name, since=since)

    def read_batch(self, name: str, token: str) -> DataFrame:
        """The rows that a batch has written."""
        return self._parts(name, token=token)

    def _drop_batch(self, name: str, token: str) -> None:
        _, date = TABLES[name]
        for path in self._found(f"{name}/{date}=*/batch_part={token}"):
            delete_path(self.spark, path)

    def clear(self, token: str) -> None:
        """Delete what an unfinished attempt of this batch left, in every table."""
        for name in TABLES:
            self._drop_batch(name, token)
        for name in ("alerts", "metrics"):
            delete_path(self.spark, f"{self.path(name)}/batch_part={token}")
        for path in self._found(f"ids/bucket=*/batch_part={token}"):
            delete_path(self.spark, path)

    def write_batch(self, name: str, rows: DataFrame, token: str) -> None:
        """Replace this token's rows; other tokens stay."""
        _, date = TABLES[name]
        self._drop_batch(name, token)
        tagged = rows.withColumn("batch_token", F.lit(token))
        days = [r[0] for r in rows.select(date).distinct().limit(FEW_DAYS + 1).collect()]
        if len(days) > FEW_DAYS or None in days:
            tagged.withColumn("batch_part", F.lit(token)).write.mode("append").partitionBy(date, "batch_part").parquet(self.path(name))
            return
        for day in days:  # no task sorts its rows by day
            tagged.where(F.col(date) == F.lit(day)).drop(date).write.mode("overwrite").parquet(f"{self.path(name)}/{date}={day}/batch_part={token}")

    def stage(self, rows: DataFrame, name: str) -> DataFrame:
        """Rows written aside and read back: later writes to the tables that they came from don't touch them."""
        rows.write.mode("overwrite").parquet(f"{self.base}/_staging/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.base}/_staging/{name}")

    def unstage(self, name: str) -> None:
        delete_path(self.spark, f"{self.base}/_staging/{name}")

    def overwrite_days(self, name: str, rows: DataFrame, date: str = "event_date") -> None:
        """Replace the days that ``rows`` holds, and no other."""
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(self.path(name))

    def clear_days(self, name: str, days: list[datetime.date], date: str = "event_date") -> None:
        for day in days:
            delete_path(self.spark, f"{self.path(name)}/{date}={day}")

    # Ledger: written last, so that a batch without its marker is done again.
    def committed(self) -> DataFrame:
        path = self.path("ledger")
        return self.spark.read.schema(schemas.LEDGER).parquet(path) if path_exists(self.spark, path) else empty(self.spark, schemas.LEDGER)

    def is_committed(self, token: str) -> bool:
        return not self.committed().where(F.col("batch_token") == token).isEmpty()

    def commit(self, token: str) -> None:
        new = self.spark.range(1).select(F.lit(token).alias("batch_token"))
        missing_tokens(new, self.committed()).withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(self.path("ledger"))

    # Ids: (transaction_id, batch_token) in buckets, for the committed filter.
    def write_ids(self, rows: DataFrame, token: str) -> None:
        """Store a batch's transaction ids under its token; clear() has deleted what an earlier attempt left."""
        ids = rows.select("transaction_id", F.lit(token).alias("batch_token"), bucket_of(F.col("transaction_id"), self.id_buckets).alias("bucket"), F.lit(token).alias("batch_part"))
        self._write_ids(ids, "append", rows.count())

    def _write_ids(self, ids: DataFrame, mode: str, rows: int) -> None:
        ids.repartition("bucket").sortWithinPartitions("bucket", "batch_part", "transaction_id").write.mode(mode).options(**self._blooms(rows // self.id_buckets)).partitionBy("bucket", "batch_part").parquet(self.path("ids"))

    def _blooms(self, rows: int) -> dict[str, str]:
        """Options of files of about ``rows`` ids; twice as many still find a useful filter."""
        return {"parquet.bloom.filter.enabled#transaction_id": "true", "parquet.bloom.filter.expected.ndv#transaction_id": str(max(1000, 2 * rows))}

    def rebuild_ids(self) -> None:
        """The ids once more from Silver, for a store that has lost them or never had them."""
        rows = self.read("silver").select("transaction_id", "batch_token", bucket_of(F.col("transaction_id"), self.id_buckets).alias("bucket"), F.col("batch_token").alias("batch_part"))
        self._write_ids(rows, "overwrite", rows.count())

    def known_ids(self, ids: DataFrame) -> DataFrame:
        """(transaction_id, batch_token) of stored transactions, among them all that have one of ``ids``. Only these ids' buckets are listed and
        read; of few ids each is looked up in the files' bloom filters."""
        own = ids.select("transaction_id", bucket_of(F.col("transaction_id"), self.id_buckets).alias("bucket")).distinct()
        counted = own.groupBy("bucket").agg(F.count("*").alias("n")).collect()  # a row for each bucket
        paths = [p for r in counted if path_exists(self.spark, p := f"{self.path('ids')}/bucket={r['bucket']}")]
        if not paths:
            return empty(self.spark, T.StructType.fromDDL(IDS)).select("transaction_id", "batch_token")
        found = self.spark.read.schema(IDS).option("basePath", self.path("ids")).parquet(*paths).select("transaction_id", "batch_token")
        if sum(r["n"] for r in counted) <= FEW_IDS:
            found = found.where(F.col("transaction_id").isin([r["transaction_id"] for r in own.collect()]))
        return found

    def compact_ids(self) -> None:
        """The ids of committed tokens in one part a bucket, one bucket after the other."""
        for path in self._found("ids/bucket=*"):
            name = f"ids-{path.rsplit('=', 1)[-1]}"
            held = self._fold(path, self.path("ids"), IDS, name).drop("bucket")
            self._replace(path, held.repartition(1).sortWithinPartitions("batch_part", "transaction_id"), self._blooms(held.count()), name)

    def _fold(self, folder: str, base: str, schema, name: str) -> DataFrame:
        """A staged copy of all rows of a folder, those of committed tokens under one part.

        Copies are numbered. A call that ended early has left one, and perhaps a folder that is replaced in part: the copy counts, with the
        rows of tokens that it doesn't know yet, which then make the next copy.
        """
        read = lambda k: self.spark.read.schema(schema).parquet(f"{self.base}/_staging/{name}-{k}")
        last = max([0, *(int(p.rstrip("/").split("-")[-1]) for p in self._found(f"_staging/{name}-*") if path_exists(self.spark, f"{p}/_SUCCESS"))])
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(folder) if path_exists(self.spark, folder) else None
        if rows is not None:
            if last:
                rows = rows.join(read(last).select("batch_token").distinct(), "batch_token", "left_anti").select(rows.columns)
            if not last or not rows.isEmpty():
                done = self.committed().select("batch_token", F.lit(True).alias("_done")).distinct()
                parted = rows.join(done, "batch_token", "left").withColumn("batch_part", F.when(F.col("_done"), COMPACTED).otherwise(F.col("batch_part"))).select(rows.columns)
                self.stage(parted.unionByName(read(last)) if last else parted, f"{name}-{last + 1}")
                last += 1
        return read(last)

    def _replace(self, folder: str, rows: DataFrame, options: dict[str, str], name: str) -> None:
        """Overwrite a folder of parts in one job from its staged copy, and let the copies go."""
        rows.write.mode("overwrite").options(**options).option("partitionOverwriteMode", "static").partitionBy("batch_part").parquet(folder)
        for path in self._found(f"_staging/{name}-*"):
            delete_path(self.spark, path)

    # State: the latest row of each client, in buckets.
    def state(self) -> DataFrame | None:
        path = self.path("state")
        return self.spark.read.parquet(path).drop("bucket") if path_exists(self.spark, path) else None

    def state_of(self, client_id: int) -> DataFrame | None:
        """The state row of one client: one bucket is read, sorted by client."""
        bucket = self.spark.range(1).select(bucket_of(F.lit(int(client_id)), self.state_buckets)).first()[0]
        path = f"{self.path('state')}/bucket={bucket}"
        return serving.lookup(self.spark.read.parquet(path), client_id) if path_exists(self.spark, path) else None

    def write_state(self, incoming: DataFrame, token: str) -> None:
        """Merge a batch's client rows into the buckets that they fall into; other buckets keep their files.

        The merged buckets are staged as a whole before any is replaced. An attempt that ended in between has left that copy, and
        the next one under the same token writes it again; unstage it when the token is committed.
        """
        path, name = self.path("state"), f"state-{token}"
        if not path_exists(self.spark, f"{self.base}/_staging/{name}/_SUCCESS"):
            bucket = bucket_of(F.col("client_id"), self.state_buckets)
            touched = [r[0] for r in incoming.select(bucket.alias("b")).distinct().collect()]  # STATE_BUCKETS at most
            held = [p for b in touched if path_exists(self.spark, p := f"{path}/bucket={b}")]
            merged = serving.upsert_state(self.spark.read.parquet(*held) if held else None, incoming)
            self.stage(merged.withColumn("bucket", bucket), name)
        staged = self.spark.read.parquet(f"{self.base}/_staging/{name}")
        staged.repartition("bucket").sortWithinPartitions("bucket", "client_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)

    def export_decisions(self, day: str | datetime.date, target: str) -> int:
        """One day's decisions as Parquet; an empty day or a malformed date is an error."""
        day = day if isinstance(day, datetime.date) else datetime.date.fromisoformat(day)
        rows = self.read("decisions").where(F.col("event_date") == F.lit(day))
        if rows.isEmpty():
            raise ValueError(f"no decisions on {day}")
        rows.write.mode("overwrite").parquet(target)
        return self.spark.read.parquet(target).count()

    def compact(self, name: str, day: datetime.date, target_bytes: int = TARGET_BYTES) -> int:
        """Rewrite one day of a table in files of about the target size; uncommitted tokens keep their parts.

        The whole day is staged, then its folder is written anew from the copy, part by part: a job that writes one part needn't sort the rows of a
        file by part, which it would do in memory. If that is cut short the day is incomplete until the next
        call, which begins with the copy: no row is lost or doubled. Run it while nothing else reads or writes that day. Returns the number of
        files asked for.
        """
        _, date = TABLES[name]
        folder, staging = f"{self.path(name)}/{date}={day}", f"compact-{name}-{day}"
        parts, begun = self._found(f"{name}/{date}={day}/batch_part=*"), self._found(f"_staging/{staging}-*")
        if len(parts) < 2 and not begun:
            return 0
        held = self._fold(folder, self.path(name), self.schema(name), staging).drop(date)
        files = max(1, math.ceil(sum(self._size(p) for p in parts or begun) / target_bytes))
        delete_path(self.spark, folder)
        for (part,) in held.select("batch_part").distinct().collect():  # a row for each token that isn't committed, and one for the others
            rows = held.where(F.col("batch_part") == part).drop("batch_part")
            rows.repartition(files).write.mode("overwrite").parquet(f"{folder}/batch_part={part}")
        for path in self._found(f"_staging/{staging}-*"):
            delete_path(self.spark, path)
        return files

    def _size(self, path: str) -> int:
        jvm = self.spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(target).getLength()

    def create_tables(self, database: str) -> None:
        """External tables of the catalog over the folders, with their partitions."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name, (_, date) in TABLES.items():
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema(name).fields)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet PARTITIONED BY ({date}, batch_part) LOCATION '{self.path(name)}'")
            if path_exists(self.spark, self.path(name)):
                self.spark.sql(f"MSCK REPAIR TABLE {database}.{name}")
