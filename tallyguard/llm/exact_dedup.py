"""Exact de-duplication by an exchange of Golomb-coded fingerprints.

1. Each sender, a partition or several of ROWS_PER_SENDER rows, fingerprints its normalised texts, sorts the distinct fingerprints
   and sends them, as Golomb codes of their gaps, to the owners of the fingerprint ranges. No text moves. Both sides grow with the rows of
   all, so that a message holds many codes however many partitions there are.
2. An owner merges what it got and answers every sender with a bitmap: which of your fingerprints exist elsewhere.
3. A sender marks its rows by the bitmaps and by repeats of its own. Only the texts of such suspects are shuffled
   (a bit filter sized by their number lets nearly no other text pass; where its largest size is too small, a semi-join
   by fingerprint takes its place) and compared byte for byte.

Texts are equal when they are identical without ASCII white space. Of equal texts the one with the most code
points stays, then the smallest doc_id (a null id comes last). A null text counts as empty. Rows that repeat an id and
a text are judged alike; drop_exact_duplicates() leaves one of them. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.llm.common import SPACES, bit_filter, checkpoint, crowded, in_filter, maybe_broadcast, semi_join

#: Bits of a fingerprint. More senders mean smaller gaps; a chance collision costs one text comparison.
FINGERPRINT_BITS = 48
#: Rows whose fingerprints one owner merges, and of one sender: about 32 MB.
ROWS_PER_OWNER = ROWS_PER_SENDER = 4_000_000


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def golomb_encode(values: np.ndarray) -> bytes:
    """Rising distinct integers as Golomb-Rice codes of their gaps.

    Count, shift and first value lead; then all remainders, ``shift`` bits each; then all quotients in unary.
    """
    values = np.asarray(values, np.uint64)
    n = len(values)
    if not n:
        return b""
    gaps = np.diff(values)
    shift = max(0, int(np.log2(max(1.0, float(gaps.mean()) * 0.69)))) if n > 1 else 0
    quotients = (gaps >> np.uint64(shift)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + n - 1, np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    low = ((gaps[:, None] >> np.arange(shift, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return np.array([n, shift, values[0]], np.uint64).tobytes() + np.packbits(low.ravel()).tobytes() + np.packbits(unary).tobytes()


def golomb_decode(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint64)
    n, shift, first = (int(x) for x in np.frombuffer(blob, np.uint64, 3))
    body = np.frombuffer(blob, np.uint8, offset=24)
    held = ((n - 1) * shift + 7) // 8
    low = np.unpackbits(body[:held], count=(n - 1) * shift).reshape(n - 1, shift).astype(np.uint64)
    remainders = (low << np.arange(shift, dtype=np.uint64)).sum(axis=1, dtype=np.uint64) if shift else np.zeros(n - 1, np.uint64)
    ends = np.flatnonzero(np.unpackbits(body[held:]))[: n - 1]
    quotients = np.diff(ends, prepend=-1) - 1
    gaps = (quotients.astype(np.uint64) << np.uint64(shift)) + remainders
    return np.concatenate([np.array([first], np.uint64), first + np.cumsum(gaps, dtype=np.uint64)])


def _sender(owners: int):
    """Of each sender: one row per owner with the coded distinct fingerprints that fall to it."""
    width = np.uint64(-(-(1 << FINGERPRINT_BITS) // owners))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in batches if b.num_rows]
        senders, fps = np.concatenate(held, axis=1) if held else np.zeros((2, 0), np.int64)
        for sender in np.unique(senders):  # one, a few, or part of one
            own = np.unique(fps[senders == sender].astype(np.uint64))
            targets, at = np.unique((own // width).astype(np.int64), return_index=True)
            bounds = np.append(at, len(own))
            blobs = [golomb_encode(own[bounds[i] : bounds[i + 1]]) for i in range(len(targets))]
            yield pa.RecordBatch.from_arrays([pa.array(targets, pa.int64()), pa.array(np.full(len(targets), sender), pa.int64()), pa.array(blobs, pa.binary())], names=["owner", "sender", "codes"])

    return send


def _answer(codes: pd.DataFrame) -> pd.DataFrame:
    """An owner's answer to each sender: a bit for every fingerprint, set if there is more than one message with it."""
    decoded = [golomb_decode(x) for x in codes["codes"]]
    values, counts = np.unique(np.concatenate(decoded), return_counts=True)
    shared, out = values[counts > 1], []
    for sender, at in codes.groupby("sender").indices.items():
        own = np.unique(np.concatenate([decoded[i] for i in at]))
        out.append((codes["owner"].iloc[0], sender, np.packbits(np.isin(own, shared)).tobytes()))
    return pd.DataFrame(out, columns=["owner", "sender", "bitmap"])


def _marker(owners: int):
    width = np.uint64(-(-(1 << FINGERPRINT_BITS) // owners))

    def mark(rows: pd.DataFrame, bitmaps: pd.DataFrame) -> pd.DataFrame:
        """The sender's distinct fingerprints that occur elsewhere."""
        own = np.unique(rows["fp"].to_numpy().astype(np.uint64))
        to = (own // width).astype(np.int64)
        found = [np.zeros(0, np.uint64)]
        for owner, bitmap in zip(bitmaps["owner"], bitmaps["bitmap"], strict=True):
            mine = own[to == owner]
            found.append(mine[np.unpackbits(np.frombuffer(bitmap, np.uint8), count=len(mine)).astype(bool)])
        shared = np.concatenate(found).astype(np.int64)
        repeated = rows["fp"][rows["times"] > 1].to_numpy()
        return pd.DataFrame({"fp": np.union1d(shared, repeated)})

    return mark


def _passing(table: np.ndarray, spark):
    """A column function that is true for suspect fingerprints and few others."""
    bits = spark.sparkContext.broadcast(table.tobytes())

    @F.pandas_udf("boolean")
    def passes(fp: pd.Series) -> pd.Series:
        return pd.Series(in_filter(np.frombuffer(bits.value, np.uint8), fp.to_numpy()))

    return passes


def suspect_texts(docs: DataFrame, rows: DataFrame, suspects: DataFrame, total: int) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, fp) that have a suspect fingerprint, and few others."""
    table = bit_filter(suspects, "fp")
    if not crowded(table):
        return docs.where(_passing(table, docs.sparkSession)(F.col("fp")))
    counted = rows.groupBy("fp").agg(F.count("*").alias("n")).join(suspects, "fp", "left_semi")
    return semi_join(docs, checkpoint(counted), ["fp"], total)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    fingerprint = F.shiftrightunsigned(F.xxhash64(normalised(F.col("text"))), 64 - FINGERPRINT_BITS)
    rows = checkpoint(
        docs.select("doc_id", fingerprint.alias("fp"), F.length(F.coalesce("text", F.lit(""))).alias("n"), F.sha2(normalised(F.col("text")), 256).alias("sha"), F.spark_partition_id().cast("long").alias("sender"))
    )
    total, parts = rows.agg(F.count("*"), F.coalesce(F.max("sender"), F.lit(0)) + 1).first()
    owners, senders = max(32, total // ROWS_PER_OWNER), min(parts, max(32, total // ROWS_PER_SENDER))
    rows = rows.withColumn("sender", F.floor(F.col("sender") * F.lit(senders) / F.lit(parts)).cast("long"))
    codes = rows.select("sender", "fp").coalesce(senders).mapInArrow(_sender(owners), "owner long, sender long, codes binary")
    bitmaps = codes.groupBy("owner").applyInPandas(_answer, "owner long, sender long, bitmap binary")
    counted = rows.groupBy("sender", "fp").agg(F.count("*").alias("times"))
    suspects = checkpoint(counted.groupBy("sender").cogroup(bitmaps.groupBy("sender")).applyInPandas(_marker(owners), "fp long").distinct())
    if suspects.isEmpty():
        return rows.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    # Byte verification: suspects' texts grouped by the text itself, combined before the shuffle.
    best = F.struct((-F.length(F.coalesce("text", F.lit("")))).alias("n"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    groups = (
        suspect_texts(docs.select("doc_id", "text", fingerprint.alias("fp")), rows, suspects, total)
        .groupBy(normalised(F.col("text")).alias("body")).agg(F.min(best).alias("best"), F.count("*").alias("group_size"))
        .where("group_size > 1").select(F.sha2("body", 256).alias("sha"), F.col("best.id").alias("keep_id"), "group_size")
    )
    joined = rows.join(checkpoint(groups), "sha", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), F.coalesce(F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id")), F.lit(False)).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, without exact copies.

    Where one id stands on several rows of a group of copies, the longest text stays, then the first by code points.
    """
    verdicts = checkpoint(exact_duplicates(docs.select("doc_id", "text")))
    gone = verdicts.where("not kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.sha2(normalised(F.col("text")), 256).alias("sha"))
    stays = keyed.join(maybe_broadcast(gone), F.col("row.doc_id").eqNullSafe(F.col("__id")) & (F.col("sha") == F.col("__sha")), "left_anti")
    if not verdicts.where("kept").groupBy("doc_id", "text_sha256").count().where("count > 1").isEmpty():
        order = Window.partitionBy("row.doc_id", "sha").orderBy(F.length("row.text").desc_nulls_last(), "row.text")
        stays = stays.withColumn("first", F.row_number().over(order)).where("first = 1")
    return stays.select("row.*")
