"""Quality classifier: random-indexing word vectors pooled per document, a two-layer network, calibrated by temperature.

Tokens are runs of letters, digits and non-ASCII, and runs of other characters between them; case counts. Each token has an index
vector of DIMENSIONS with SPARSE signed ones, by its hash. The context vector of a token is the sum of the index vectors of the tokens up
to WINDOW places around it, itself included, over every place of every whole text of the corpus. Tokens are hashed into
CELLS cells, so that the table of all context vectors is of fixed size and no token is left out; tokens of one cell share a vector.
A task adds up the cells of what it reads and sends them once, whatever it has read.

A word vector is a context vector over its count, less the corpus's mean, of length one. A document is pooled into the mean of its tokens'
word vectors, their spread, and the logarithm of their number. The network (HIDDEN tanh units, numpy, full-batch Adam
with a fixed seed) learns from a bounded, documented sample of the labelled rows: EXAMPLES of each label on average, weighted so that both count
as in the labelled rows. One in FOLDS of them is kept for the temperature by which the logits are divided.

Whole texts are read; labels, lang, source and doc_id are no inputs of a score. A text without tokens (a null or empty one too) is
pooled to zeros and scored like any other. Without labelled rows of both labels nothing is learned, and every score is the share of label 1,
0 without labels. Rows are scored one by one, repeated or not; further columns are ignored. Where a document is labelled more than once the
larger label holds; where a labelled id stands on several texts, the one whose pooled vector sorts first is the example.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import checkpoint, held_out, map_texts, received, send
from tallyguard.llm.textops import IS_SPACE, chunks, mix, prefix_hash, span_hash

CELLS, DIMENSIONS, SPARSE, WINDOW = 1 << 13, 64, 2, 2
EXAMPLES = 4000
HIDDEN, STEPS, RATE, DECAY, SEED = 24, 400, 0.02, 1e-3, 7
FOLDS = 5
THRESHOLD = 0.3
#: Bytes of text that are pooled at once.
CHUNK = 1 << 19
#: Decimals of a pooled value and a score: equal texts get equal ones, in any batch.
DIGITS = 9

#: 0 white space, 1 letters, digits and non-ASCII, 2 anything else.
_KIND = np.where(IS_SPACE, 0, 2).astype(np.uint8)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _KIND[_a:_b] = 1


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token, for each text the tokens before it and one more)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    kind = _KIND[data]
    new = np.ones(len(data), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(data))
    real = kind[starts] != 0
    starts, ends = starts[real], ends[real]
    return span_hash(prefix_hash(data), starts, ends), np.searchsorted(starts, offsets)


def cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(CELLS)).astype(np.int64)


def index_vectors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(components, signs) of each token's index vector, SPARSE of each."""
    parts, signs = [], []
    for k in range(SPARSE):
        h = mix(hashes + np.uint64(k + 1))
        parts.append(((h >> np.uint64(8)) % np.uint64(DIMENSIONS)).astype(np.int64))
        signs.append(1 - 2 * (h & np.uint64(1)).astype(np.int64))
    return np.stack(parts), np.stack(signs)


def context_sums(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums of index vectors around the tokens of each cell, tokens of each cell)."""
    n = len(hashes)
    at, doc = cell(hashes), np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    part, sign = index_vectors(hashes)
    places, values = [], []
    for away in range(-WINDOW, WINDOW + 1):
        own = slice(max(0, -away), max(0, n - max(0, away)))
        other = slice(max(0, away), max(0, n + min(0, away)))
        same = doc[own] == doc[other]
        for k in range(SPARSE):
            places.append((at[own] * DIMENSIONS + part[k][other])[same])
            values.append(sign[k][other][same])
    sums = np.bincount(np.concatenate(places), weights=np.concatenate(values), minlength=CELLS * DIMENSIONS)
    return sums.astype(np.int64).reshape(CELLS, DIMENSIONS), np.bincount(at, minlength=CELLS)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums, counts = np.zeros((CELLS, DIMENSIONS), np.int64), np.zeros(CELLS, np.int64)
    for batch in batches:
        for _, data, offsets in chunks(batch, size=CHUNK):
            s, c = context_sums(*tokens(data, offsets))
            sums += s
            counts += c
    held = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held]), *(pa.array(sums[held, d]) for d in range(DIMENSIONS))], names=["cell", "n", *(f"d{d}" for d in range(DIMENSIONS))])


def gathered(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Context sums and counts of all cells, over all texts."""
    names = ["n", *(f"d{d}" for d in range(DIMENSIONS))]
    rows = map_texts(docs.select("text"), _gather, ", ".join(f"{c} long" for c in ["cell", *names]))
    table = rows.groupBy("cell").agg(*(F.sum(c).alias(c) for c in names)).toArrow()  # CELLS rows at most
    at = table["cell"].to_numpy()
    sums, counts = np.zeros((CELLS, DIMENSIONS), np.int64), np.zeros(CELLS, np.int64)
    counts[at] = table["n"].to_numpy()
    for d in range(DIMENSIONS):
        sums[at, d] = table[f"d{d}"].to_numpy()
    return sums, counts


def word_vectors(sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A vector of length one for each cell; zeros where no token fell."""
    total = max(1, int(counts.sum()))
    centred = sums / np.maximum(counts, 1)[:, None] - sums.sum(0) / total
    centred[counts == 0] = 0
    return np.round(centred / np.maximum(1e-12, np.sqrt((centred**2).sum(1, keepdims=True))), DIGITS)


def pooled(hashes: np.ndarray, bounds: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Of each text the mean of its tokens' vectors, their standard deviation, and log(1 + tokens)."""
    docs = len(bounds) - 1
    n = np.diff(bounds)
    out = np.zeros((docs, 2 * DIMENSIONS + 1))
    out[:, -1] = np.log1p(n)
    if len(hashes):
        both, times = np.unique(np.repeat(np.arange(docs), n) * CELLS + cell(hashes), return_counts=True)
        owner, found = both // CELLS, vectors[both % CELLS]
        some = np.flatnonzero(n)
        begin = np.searchsorted(owner, some)
        size = n[some][:, None]
        weighted = found * times[:, None]
        mean = np.add.reduceat(weighted, begin, axis=0) / size
        square = np.add.reduceat(weighted * found, begin, axis=0) / size
        out[some, :DIMENSIONS] = mean
        out[some, DIMENSIONS:-1] = np.sqrt(np.maximum(0, square - mean**2))
    return np.round(out, DIGITS)


class Network:
    """Standardised inputs, HIDDEN tanh units, one logit over a temperature."""

    def __init__(self, inputs: int):
        rng = np.random.default_rng(SEED)
        self.shift, self.scale, self.temperature = np.zeros(inputs), np.ones(inputs), 1.0
        self.w1, self.b1 = rng.normal(0, 1 / np.sqrt(inputs), (inputs, HIDDEN)), np.zeros(HIDDEN)
        self.w2, self.b2 = rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.shift) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2[0]

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """Adam over all rows at once on the weighted cross entropy, with a decay of both layers' weights."""
        weight = weight / weight.sum()
        self.shift = weight @ x
        self.scale = np.sqrt(weight @ (x - self.shift) ** 2) + 1e-6
        z = (x - self.shift) / self.scale
        values = [self.w1, self.b1, self.w2, self.b2]
        first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
        for step in range(1, STEPS + 1):
            hidden = np.tanh(z @ self.w1 + self.b1)
            error = weight * (sigmoid(hidden @ self.w2 + self.b2[0]) - y)
            back = np.outer(error, self.w2) * (1 - hidden**2)
            slopes = [z.T @ back + DECAY * self.w1, back.sum(0), hidden.T @ error + DECAY * self.w2, np.array([error.sum()])]
            rate = RATE * (1 - step / (STEPS + 1))
            for v, s, m, u in zip(values, slopes, first, second, strict=True):
                m += 0.1 * (s - m)
                u += 0.001 * (s * s - u)
                v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(u / (1 - 0.999**step)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """The temperature with the least cross entropy: a golden-section search over its logarithm. Labels count as if each
        had been seen once more than it was, and missed, so that a few rows told apart without error make no score certain."""
        logit, ones = self.logits(x), int((y == 1).sum())
        wanted = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))
        loss = lambda t: float(weight @ (np.logaddexp(0, logit * np.exp(-t)) - wanted * logit * np.exp(-t)))
        low, high, ratio = -3.0, 3.0, (np.sqrt(5) - 1) / 2
        for _ in range(60):
            a, b = high - ratio * (high - low), low + ratio * (high - low)
            low, high = (low, b) if loss(a) <= loss(b) else (a, high)
        self.temperature = float(np.exp((low + high) / 2))

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.round(sigmoid(self.logits(x) / self.temperature), DIGITS)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class Model:
    def __init__(self, vectors: np.ndarray, network: Network | None, share: float):
        self.vectors, self.network, self.share = vectors, network, share

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.network is None:
            return np.full(len(offsets) - 1, self.share)
        return self.network.score(pooled(*tokens(data, offsets), self.vectors))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    known = labels.where("quality is not null and doc_id is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").cast("int").alias("label")).where("label in (0, 1)")
    known = checkpoint(known.join(docs.where("doc_id is not null").select("doc_id").distinct(), "doc_id", "left_semi"))
    shares = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(shares) < 2:
        return Model(np.zeros((CELLS, DIMENSIONS)), None, float(sum(k for k in shares)))
    # Of each label the rows whose id's hash is small: EXAMPLES on average, twice as many in all at most.
    turn = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53)) * F.when(F.col("label") == 1, shares[1]).otherwise(shares[0])
    sample = checkpoint(known.withColumn("turn", turn).where(F.col("turn") < EXAMPLES).orderBy("turn", "doc_id").limit(2 * EXAMPLES).select("doc_id", "label"))
    vectors = word_vectors(*gathered(docs))
    held = send(docs.sparkSession, vectors)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = received(held)
        for batch in batches:
            for rows, data, offsets in chunks(batch, size=CHUNK):
                found = [v.astype(">f8").tobytes() for v in pooled(*tokens(data, offsets), own)]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), pa.array(found, pa.binary())], names=["doc_id", "label", "vector"])

    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", "label")
    rows = map_texts(texts, pool, "doc_id long, label int, vector binary").groupBy("doc_id").agg(F.min(F.struct("vector", "label")).alias("v")).orderBy("doc_id").collect()  # a row for each id of the sample
    y = np.array([r["v"]["label"] for r in rows])
    x = np.array([np.frombuffer(r["v"]["vector"], ">f8") for r in rows]).astype(float)
    weight = np.array([shares[c] / max(1, (y == c).sum()) for c in (0, 1)])[y] / sum(shares.values())
    turns = np.random.default_rng(SEED).permutation(len(y))
    turn = np.argsort(np.argsort(y * len(y) + turns, kind="stable"), kind="stable") % FOLDS  # both labels in each fold
    network = Network(x.shape[1])
    fitted = turn > 0 if min((y[turn == 0] == c).sum() for c in (0, 1)) else np.ones(len(y), bool)
    network.fit(x[fitted], y[fitted], weight[fitted])
    if not fitted.all():
        network.calibrate(x[~fitted], y[~fitted], weight[~fitted])
    return Model(vectors, network, shares[1] / sum(shares.values()))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 from ``threshold`` on)."""
    held = send(docs.sparkSession, train(docs, labels))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = received(held)
        for batch in batches:
            for rows, data, offsets in chunks(batch, size=CHUNK):
                found = model.score(data, offsets)
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), pa.array(found, pa.float64()), pa.array((found >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return map_texts(rows, score, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose texts score ``threshold`` or more."""
    held = send(docs.sparkSession, train(docs, labels))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = received(held)
        for batch in batches:
            for rows, data, offsets in chunks(batch, size=CHUNK):
                yield rows.filter(pa.array(model.score(data, offsets) >= threshold))

    return map_texts(docs, keep, docs.schema)
