"""Helpers that the operators share: checkpoints, checked broadcasts, word patterns."""

from __future__ import annotations

import pickle
import re
import tempfile

import numpy as np
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Java and DuckDB form of a word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: The six characters that WORD leaves out.
SPACES = " \t\n\x0b\x0c\r"
#: Rows of a few numbers that a broadcast may hold: under 16 MB.
BROADCAST_ROWS = 200_000
#: Rows of a checkpoint that one task should read at least.
ROWS_PER_PARTITION = 50_000
TEXTS_PER_BATCH = 1000


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder that spark.checkpoint.dir names.

    A session of one machine may do without that setting and gets a folder of its own; a cluster may not.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        shared = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    held = df.checkpoint()
    # Few rows in many partitions would make as many files of every later shuffle.
    parts = held.rdd.getNumPartitions()
    if parts > context.defaultParallelism:
        held = held.coalesce(max(context.defaultParallelism, min(parts, held.count() // ROWS_PER_PARTITION + 1)))
    return held


def map_texts(df: DataFrame, run, schema: str | StructType) -> DataFrame:
    """mapInArrow() over rows with whole texts: batches of fewer rows than the default, unless the session says otherwise."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if df.sparkSession.conf.get(name) == "10000":
        df.sparkSession.conf.set(name, str(TEXTS_PER_BATCH))
    return df.mapInArrow(run, schema)


def maybe_broadcast(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Hint a broadcast when ``df``, rows of a few numbers, is counted to be small; else leave the join to shuffle."""
    counted = df.count() if rows is None else rows
    return F.broadcast(df) if counted <= BROADCAST_ROWS else df


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def send(spark: SparkSession, model) -> Broadcast:
    """Broadcast an object of bounded size together with its class, so that executors need not import it."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def received(sent: Broadcast):
    return pickle.loads(sent.value)


def kept(sent: Broadcast):
    """received(), loaded once in each Python worker: its later tasks find the object again, with what it remembers."""
    if not hasattr(sent, "loaded"):
        sent.loaded = received(sent)
    return sent.loaded


#: A bit filter has BITS_PER_ENTRY bits for each entry, rounded up to a power of two, and 2 to the FILTER_BITS (64 MB) at most. Beyond
#: that it lets more pass; joins behind it stay exact.
FILTER_BITS, BITS_PER_ENTRY = 29, 16
#: A key that holds more than one in so many rows is one of fewer than so many keys.
HEAVY = 1000


def bit_filter(values: DataFrame, column: str) -> np.ndarray:
    """A bitmap over a column of well-spread longs, for in_filter(), as large as their number asks for."""
    bits = int(np.clip(np.ceil(np.log2(BITS_PER_ENTRY * values.count() + 1)), 15, max(15, FILTER_BITS)))
    slot = F.col(column).bitwiseAND(F.lit((1 << bits) - 1)) + 1  # the bitmap functions count from 1
    parts = values.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    table = np.zeros((1 << bits) // 8, np.uint8)
    for row in parts.collect():  # at most 2**FILTER_BITS bits in all
        at = (int(row["bucket"]) - 1) * 4096
        table[at : at + 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return table


def crowded(table: np.ndarray) -> bool:
    """Whether a filter lets more than a quarter of all values pass."""
    return int(np.bitwise_count(table).sum()) > 2 * len(table)


def in_filter(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """True for every value that the filter was built over, and for few others."""
    at = np.asarray(values).astype(np.int64) & (8 * len(table) - 1)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def semi_join(rows: DataFrame, keys: DataFrame, on: list[str], total: int) -> DataFrame:
    """Rows whose key is in ``keys``: distinct keys with ``n``, the number of rows that each has of ``total``.

    Keys with more than one in HEAVY of the rows are fewer than HEAVY, so they are broadcast and their rows stay where they are.
    """
    heavy = F.broadcast(keys.where(F.col("n") * HEAVY > total).select(*on))
    light = keys.where(F.col("n") * HEAVY <= total).select(*on)
    return rows.join(heavy, on, "left_semi").union(rows.join(heavy, on, "left_anti").join(light, on, "left_semi"))
