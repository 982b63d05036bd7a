"""Language identification by string kernels: Nystroem landmarks and one-versus-rest kernel ridge regression.

Two texts' kernel is the number of byte n-grams (one to three, ASCII letters lower-cased, other ASCII read as a space)
that both hold, over the root of the product of their own numbers: a blended-spectrum presence kernel, with n-grams
hashed into FEATURES cells. Training texts are a bounded sample of labelled rows, about the same number for each language:
PER_LANGUAGE on average, TRAINED in all at most, drawn by a hash of id and text; LANDMARKS of them span the Nystroem features. Scoring a batch of texts
is two matrix products. Whole texts are read; a text's n-grams take one bit each, however long it is.

A text without a letter (null, empty) is ``und`` with score 0, and so is everything if nothing can be learned. The score is
the softmax of the regression values. Ties go to the language that sorts first. An id on several texts is as many
examples; a repeated row is one. The model depends on the rows alone, not on their partitions. lang, source and doc_id are not inputs of a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import checkpoint, held_out, map_texts, maybe_broadcast, received, send
from tallyguard.llm.textops import chunks

FEATURES = 1 << 16
PER_LANGUAGE = 300
TRAINED = 3000
LANDMARKS = 192
RIDGE = 1e-3
SHARPNESS = 6.0
#: Decimals of a regression value and a score: equal texts get equal ones, in any batch.
DIGITS = 9
BATCH = 256

FOLD = np.arange(256, dtype=np.uint8)
FOLD[:128] = 32
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
LETTER = FOLD.copy()
LETTER = (LETTER != 32) & (np.arange(256) < 128)


def cells(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cells of the one-, two- and three-byte strings that begin at each byte."""
    b = FOLD[data].astype(np.uint32)
    two = (b[:-1] << 8) | b[1:]
    three = (two[:-1] << 8) | b[2:] if len(b) > 2 else np.zeros(0, np.uint32)
    spread = lambda x, odd: ((x * np.uint32(odd)) >> np.uint32(16)).astype(np.int64)
    return spread(b + np.uint32(1), 0x9E3779B1), spread(two + np.uint32(1), 0x85EBCA77), spread(three + np.uint32(1), 0xC2B2AE3D)


def presence(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For each text the flags of the cells it holds; the array is used again for the next text."""
    one, two, three = cells(data)
    flags = np.zeros(FEATURES, bool)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        flags[:] = False
        flags[one[a:b]] = True
        flags[two[a : max(a, b - 1)]] = True
        flags[three[a : max(a, b - 2)]] = True
        yield flags


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts with a letter of any script."""
    sums = np.concatenate([[0], np.cumsum(LETTER[data])])
    found = sums[offsets[1:]] > sums[offsets[:-1]]
    high = np.concatenate([[0], np.cumsum(data >= 128)])
    for i in np.flatnonzero(~found & (high[offsets[1:]] > high[offsets[:-1]])):
        found[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return found


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in chunks(batch):
            packed = [np.packbits(f).tobytes() for f in presence(data, offsets)]
            keep = pa.array(has_letter(data, offsets))
            yield pa.RecordBatch.from_arrays([rows.column(1), rows.column(2), pa.array(packed, pa.binary())], names=["lang", "draw", "bits"]).filter(keep)


def _digest():
    return F.xxhash64("text")


def training_sample(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, lang, draw) to learn from: of each language the (id, text) pairs whose hash is small, PER_LANGUAGE on average, the first TRAINED
    of all in the order of their draws. A pair counts once, however often it is repeated; one id may stand on many texts. How many pairs a
    language has is counted by a sketch that doesn't depend on the order of rows."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "lang", _digest().alias("digest")).withColumn("draw", F.xxhash64("doc_id", "digest"))
    counts = usable.groupBy("lang").agg(F.approx_count_distinct("draw", 0.02).alias("n"))
    share = F.shiftrightunsigned("draw", 11) / F.lit(float(1 << 53)) * F.col("n")
    drawn = usable.join(maybe_broadcast(checkpoint(counts)), "lang").withColumn("turn", share).where(F.col("turn") < PER_LANGUAGE).distinct()
    return checkpoint(drawn.orderBy("turn", "doc_id", "digest", "lang").limit(TRAINED).select("doc_id", "digest", "lang", "draw"))


class Model:
    """Landmarks and weights; small enough to send to every task (LANDMARKS times the landmarks' cells)."""

    def __init__(self, langs: list[str], bits: np.ndarray):
        """``langs``, ``bits``: languages and flags (rows by cells) of the training texts."""
        self.langs = sorted(set(langs))
        if not self.langs:
            return
        target = np.array([[1.0 if x == y else -1.0 for y in self.langs] for x in langs])
        sizes = np.sqrt(np.maximum(1, bits.sum(1)))
        order = np.argsort([langs[:i].count(x) for i, x in enumerate(langs)], kind="stable")[:LANDMARKS]  # by turns from each language
        self.columns = np.flatnonzero(bits[order].any(0))
        self.landmarks, self.sizes = np.ascontiguousarray(bits[order][:, self.columns].T.astype(np.float32)), sizes[order]
        kernel = self.kernel(bits[:, self.columns], sizes)
        values, vectors = np.linalg.eigh((kernel[order] + kernel[order].T) / 2)
        use = values > 1e-8 * values[-1]
        whiten = vectors[:, use] / np.sqrt(values[use])
        mapped = np.hstack([kernel @ whiten, np.ones((len(langs), 1))])
        weights = np.linalg.solve(mapped.T @ mapped + RIDGE * len(langs) * np.eye(mapped.shape[1]), mapped.T @ target)
        self.weights, self.bias = whiten @ weights[:-1], weights[-1]

    def kernel(self, flags: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Counts of shared cells, exact in 32 bits, over the roots: the same whatever other texts are in the batch."""
        return (flags.astype(np.float32) @ self.landmarks).astype(np.float64) / sizes[:, None] / self.sizes

    def predict(self, flags: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, score) of each row of flags."""
        value = np.round(self.kernel(flags, sizes) @ self.weights + self.bias, DIGITS)
        e = np.exp(SHARPNESS * (value - value.max(1, keepdims=True)))
        best = value.argmax(1)
        return best, np.round(e[np.arange(len(best)), best] / e.sum(1), DIGITS)


def _predictor(held):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = received(held)
        for batch in batches:
            for rows, data, offsets in chunks(batch):
                known = has_letter(data, offsets) if model.langs else np.zeros(rows.num_rows, bool)
                lang, score = np.full(rows.num_rows, "und", object), np.zeros(rows.num_rows)
                at, flags, sizes = [], np.zeros((BATCH, len(model.columns)), np.float32) if model.langs else None, []
                for i, found in enumerate(presence(data, offsets)):
                    if known[i]:
                        flags[len(at)] = found[model.columns]
                        at.append(i)
                        sizes.append(np.count_nonzero(found))
                    if at and (len(at) == BATCH or i + 1 == rows.num_rows):
                        best, score[at] = model.predict(flags[: len(at)], np.sqrt(np.array(sizes, float)))
                        lang[at] = np.array(model.langs, object)[best]
                        at, sizes = [], []
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    return predict


def train(docs: DataFrame) -> Model:
    chosen = training_sample(docs)
    rows = docs.select("doc_id", "text", "lang", _digest().alias("digest")).join(F.broadcast(chosen), ["doc_id", "digest", "lang"])
    made = map_texts(rows.select("text", "lang", "draw"), _bits, "lang string, draw long, bits binary").groupBy("lang", "draw").agg(F.max("bits").alias("bits"))
    held = sorted((r["draw"], r["lang"], bytes(r["bits"])) for r in made.collect())  # TRAINED rows of 8 KB at most
    bits = np.array([np.unpackbits(np.frombuffer(x[2], np.uint8)).astype(bool) for x in held]).reshape(len(held), FEATURES)
    return Model([x[1] for x in held], bits)


def identify(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score."""
    held = send(docs.sparkSession, train(docs))
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return map_texts(rows, _predictor(held), "doc_id long, held_out boolean, lang_pred string, score double")
