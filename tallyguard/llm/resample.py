"""Importance resampling towards a target distribution of hashed word n-grams.

1. Every text's features (runs of one to NGRAM words, by the crc32 of their bytes modulo BUCKETS) are counted over all documents and
   over all target texts. A task holds one array of BUCKETS counts, whatever it reads, and sends that.
2. The gain of each bucket is an array of BUCKETS numbers that goes to every task; a document's weight is the sum of its
   features' gains. Scores (weight and a Gumbel draw from the id) are persisted; texts aren't read again.
3. The lowest score to be drawn is found by bisection: each job counts exactly how many scores reach each of WAYS values between
   two bounds. Rows that tie with it are told apart by doc_id, and rows that tie there too by their place in the persisted table,
   with the same counts.
4. Only drawn rows are partitioned by range of (score, doc_id), for their ranks. No task holds all of them.

Words are runs of ASCII letters (A-Z lower-cased), digits and whatever is not ASCII; a null text has none, weight 0 and no
rank. A null doc_id is hashed as an empty one and comes last in a tie. Rows count one by one, repeated or not; which of two rows
with equal id and score is drawn first changes no value of the result. Without documents of LEAST_WORDS words, nothing is drawn. Further columns are
ignored. Memory is proportional to the longest text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import checkpoint, map_texts, received, send
from tallyguard.llm.mixing import ranked
from tallyguard.llm.textops import chunks, words

BUCKETS = 10_000
NGRAM = 3
LEAST_WORDS = 20
#: Drawn documents in a hundred of those with LEAST_WORDS words.
PERCENT = 5
SEED = 42
#: Values that one job of the bisection counts at.
WAYS = 32

#: Upper case to lower, all that is no part of a word to a space.
_WORD = np.full(256, 32, np.uint8)
_WORD[48:58] = np.arange(48, 58)
_WORD[97:123] = _WORD[65:91] = np.arange(97, 123)
_WORD[128:] = np.arange(128, 256)

# The reflected polynomial of the standard crc32, a fixed value.
_POLYNOMIAL = 0xEDB88320
#: Words of more bytes than this go through zlib one by one.
_LONG = 48
_table: list[np.ndarray] = []
_shifts: dict[int, np.ndarray] = {}


def _crc_table() -> np.ndarray:
    if not _table:
        crc = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            crc = (crc >> np.uint32(1)) ^ np.where(crc & np.uint32(1), np.uint32(_POLYNOMIAL), np.uint32(0))
        _table.append(crc)
    return _table[0]


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the crc's, in its reflected form."""
    out = 0
    for i in range(31, -1, -1):
        if (a >> i) & 1:
            out ^= b
        b = (b >> 1) ^ (_POLYNOMIAL if b & 1 else 0)
    return out


def _shift(n: int) -> np.ndarray:
    """Four tables of 256: the crc of a string before ``n`` more bytes is what they give for its bytes, combined."""
    if n not in _shifts:
        if len(_shifts) >= 4096:
            _shifts.clear()
        factor, square, left = 1 << 31, 1 << 23, n  # 1 and x to the 8
        while left:
            factor = _times(factor, square) if left & 1 else factor
            square, left = _times(square, square), left >> 1
        basis = [_times(factor, 1 << i) for i in range(32)]
        table = np.zeros((4, 256), np.uint32)
        for byte in range(4):
            for bit in range(8):
                table[byte, 1 << bit : 2 << bit] = table[byte, : 1 << bit] ^ np.uint32(basis[8 * byte + bit])
        _shifts[n] = table
    return _shifts[n]


def shifted(crc: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What crc32 values contribute to those of their strings with ``sizes`` more bytes behind them."""
    values, at = np.unique(sizes, return_inverse=True)
    tables = np.stack([_shift(int(n)) for n in values]) if len(values) else np.zeros((0, 4, 256), np.uint32)
    out = np.zeros(len(crc), np.uint32)
    for byte in range(4):
        out ^= tables[at, byte, (crc >> np.uint32(8 * byte)) & np.uint32(255)]
    return out


def word_crcs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The crc32 of each word, byte after byte for all words at once."""
    table = _crc_table()
    order = np.argsort(-sizes, kind="stable")
    begin, size = starts[order], sizes[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    long_ = int(np.searchsorted(-size, -_LONG, "left"))  # these have more bytes
    for i in range(_LONG):
        last = int(np.searchsorted(-size, -i, "left"))
        if last <= long_:
            break
        own = crc[long_:last]
        crc[long_:last] = table[(own ^ data[begin[long_:last] + i]) & np.uint32(255)] ^ (own >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for j in range(long_):
        crc[j] = zlib.crc32(data[begin[j] : begin[j] + size[j]].tobytes())
    out = np.zeros(len(order), np.uint32)
    out[order] = crc
    return out


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(for each text the words before it, and one more; for each length the bucket of the run that begins at each word, -1 where the text
    ends before)."""
    plain = _WORD[data]
    starts, ends, bounds = words(plain, offsets)
    n = len(starts)
    sizes = ends - starts
    own = word_crcs(plain, starts, sizes)
    behind = own ^ shifted(np.full(n, zlib.crc32(b" "), np.uint32), sizes)  # the crc of a space and the word
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    out, crc = [(own % np.uint32(BUCKETS)).astype(np.int64)], own
    for k in range(1, NGRAM):
        m = max(0, n - k)
        crc = shifted(crc[:m], sizes[k:] + 1) ^ behind[k:]
        found = np.full(n, -1, np.int64)
        found[:m] = np.where(doc[:m] == doc[k:], (crc % np.uint32(BUCKETS)).astype(np.int64), -1)
        out.append(found)
    return bounds, out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, data, offsets in chunks(batch):
            for bucket in features(data, offsets)[1]:
                held += np.bincount(bucket[bucket >= 0], minlength=BUCKETS)
    at = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many features of all ``texts`` fall into each bucket."""
    rows = map_texts(texts.select("text"), _counts, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # BUCKETS rows at most
    out = np.zeros(BUCKETS, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed rates, rounded down."""
    s, t = source.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weighed(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each row."""
    held = send(docs.sparkSession, gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = np.append(received(held), 0)  # the last is for runs that aren't there
        for batch in batches:
            for rows, data, offsets in chunks(batch):
                bounds, found = features(data, offsets)
                sums = np.concatenate([[0], np.cumsum(sum(gain[b] for b in found))]).astype(np.int64)
                n = np.diff(bounds)
                features_ = sum(np.maximum(0, n - k) for k in range(NGRAM))
                columns = [rows.column(0), pa.array(n.astype(np.int64)), pa.array(features_.astype(np.int64)), pa.array(sums[bounds[1:]] - sums[bounds[:-1]])]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), weigh, "doc_id long, n_words long, n_features long, weight long")


def gumbel(seed: int):
    """Thousandths of a Gumbel draw by the id's hash, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296))).cast("long")


def smallest(rows: DataFrame, column: str, need: int) -> tuple[int, int]:
    """(the least value v such that ``need`` rows or more have ``column`` <= v, how many have less). ``need`` is at least 1 and at most the number of rows."""
    low, high = (int(x) for x in rows.agg(F.min(column), F.max(column)).first())
    below = 0  # rows under low
    while low < high:
        step = max(1, -(-(high - low) // WAYS))
        values = list(range(low, high, step))
        counts = rows.where(F.col(column).between(low, high)).agg(*(F.count_if(F.col(column) <= v).alias(f"c{i}") for i, v in enumerate(values))).first()
        reached = [below + c for c in counts]
        at = next((i for i, c in enumerate(reached) if c >= need), len(values))
        if at:
            below, low = reached[at - 1], values[at - 1] + 1
        high = values[at] if at < len(values) else high
    return low, below


def drawn(scored: DataFrame, n: int):
    """The condition that ``n`` rows fulfil: the highest scores, then the smaller id, then the place in the table."""
    left, rows, condition = n, scored.withColumn("__down", -F.col("score")), F.lit(False)
    tied = F.lit(True)
    for column in ("__down", "__id", "__place"):
        value, less = smallest(rows, column, left)
        name = -F.col("score") if column == "__down" else F.col(column)
        condition, tied = condition | (tied & (name < value)), tied & (name == value)
        rows, left = rows.where(F.col(column) == value), left - less
        if rows.count() == left:
            break
    return condition | tied


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_features, weight, score, rank (from 1 on; null if not drawn).

    ``target``: the texts (column text) whose distribution is wanted.
    """
    gains = bucket_gains(bucket_counts(docs), bucket_counts(target))
    scored = weighed(docs, gains).withColumn("score", F.col("weight") + gumbel(seed))
    scored = checkpoint(scored.withColumns({"__id": F.coalesce("doc_id", F.lit(2**63 - 1)), "__place": F.monotonically_increasing_id()}))
    out = ["doc_id", "n_features", "weight", "score"]
    able = F.col("n_words") >= least_words
    wanted = scored.where(able).count() * percent // 100
    none = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scored.select(*out, none)
    chosen = able & drawn(scored.where(able), wanted)
    order = F.struct((-F.col("score")).alias("down"), F.col("__id"), F.col("__place"))
    ranks = ranked(scored.where(chosen), order).select(*out, (F.col("rank") + 1).cast("long").alias("rank"))
    return scored.where(~chosen).select(*out, none).unionByName(ranks)
