"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are strings of WINDOW bytes (ASCII letters lower-cased, other ASCII read as a space, so that a word's beginning and
end belong to its terms). The vocabulary is every term of LEAST_TEXTS examples or more whose rates under the two labels differ, either
way, at the level that CHI_SQUARED stands for and by an EFFECT that doesn't depend on how many examples there are; there is no cap on it. Examples are a bounded, documented sample of the
labelled rows: EXAMPLES of each label on average. Postings lie by term and block of BLOCK examples, each with the largest weight of
the term in the block. A query reads its FIRST most promising blocks, and then only those blocks that may still hold one of its
NEIGHBOURS nearest, so the neighbours are those of a full scan. Their votes, weighted by
similarity, pass through an isotonic calibration fitted on the examples themselves, each left out of its own vote
and weighted so that both labels count as in the labelled rows.

Whole texts are read. A text without any term of the vocabulary (a null or empty one too) has no neighbours and gets the calibrated
score of such examples. Ties in similarity go to the smaller example id. Without labelled rows of both
labels, or a term that tells them apart, nothing is learned and every score is 0. Rows are scored one by one, repeated or not; further
columns are ignored. Where a document is labelled more than once the larger label holds; where a labelled id stands on several
texts, each counts for the terms, and the one with the least vector is the example.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import checkpoint, held_out, map_texts, received, send
from tallyguard.llm.langid import FOLD
from tallyguard.llm.textops import chunks

EXAMPLES = 4000
WINDOW = 5
#: A term must occur in so many examples, its rates under the labels must differ at the level of one in twenty, and the squared
#: difference must be so large a part of the variance of its presence.
LEAST_TEXTS, CHI_SQUARED, EFFECT = 5, 3.84, 0.02
BLOCK = 256
#: Blocks that a query reads before any is left out.
FIRST = 4
NEIGHBOURS = 31
#: A neighbour's vote is its cosine to this power; the prior's weighs as much as one with a cosine of a third.
SHARPNESS = 4
PRIOR_WEIGHT = 0.01


def codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code of the WINDOW bytes from each place on, where each text begins and the last ends). Texts stand with
    WINDOW - 1 spaces before, between and behind them, so that a window holds bytes of one text only."""
    gap = WINDOW - 1
    n = len(offsets) - 1
    padded = np.insert(FOLD[data], np.repeat(offsets, gap), np.uint8(32))
    code = np.zeros(max(0, len(padded) - WINDOW + 1), np.uint64)
    for i in range(WINDOW):
        code = (code << np.uint64(8)) | padded[i : len(code) + i]
    return code, offsets + gap * np.arange(n + 1)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(code, texts with label 1, texts with label 0), once for each code of a chunk."""
    for batch in batches:
        for rows, data, offsets in chunks(batch, size=1 << 19):
            code, begin = codes(data, offsets)
            doc = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
            code = code[: len(doc)]
            order = np.lexsort((code, doc))
            doc, code = doc[order], code[order]
            new = np.ones(len(code), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])
            values, at = np.unique(code[new], return_inverse=True)
            toxic = rows.column(2).to_numpy(zero_copy_only=False).astype(np.int64)[doc[new]]
            ones = np.bincount(at, weights=toxic, minlength=len(values)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(values.astype(np.int64)), pa.array(ones), pa.array(np.bincount(at, minlength=len(values)) - ones)], names=["code", "ones", "zeros"])


class Terms:
    """The vocabulary, and how often each text of a chunk holds each of its terms."""

    SLOTS = 20

    def __init__(self, chosen: np.ndarray):
        self.codes = np.sort(np.asarray(chosen, np.uint64))
        self.low = np.zeros(1 << self.SLOTS, bool)
        self.low[self._slot(self.codes)] = True

    def _slot(self, code: np.ndarray) -> np.ndarray:
        return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.SLOTS)).astype(np.int64)

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(terms, counts) of each text."""
        n = len(offsets) - 1
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        out = [empty] * n
        if not len(self.codes):
            return out
        code, begin = codes(data, offsets)
        place = np.flatnonzero(self.low[self._slot(code)])
        code, doc = code[place], np.clip(np.searchsorted(begin, place, "right") - 1, 0, n - 1)
        term = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        hit = self.codes[term] == code
        both, count = np.unique(doc[hit] * len(self.codes) + term[hit], return_counts=True)
        owner = both // len(self.codes)
        cuts = np.searchsorted(owner, np.arange(n + 1))
        for i in np.unique(owner):
            a, b = cuts[i], cuts[i + 1]
            out[i] = (both[a:b] % len(self.codes), count[a:b])
        return out


class Index:
    """A block-max inverted index over the examples' normalised TF-IDF vectors."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int, ids: np.ndarray, labels: np.ndarray):
        """``vectors``: (terms, counts) of each example. Examples are laid out by their heaviest term, so that blocks differ."""
        n = len(vectors)
        df = np.bincount(np.concatenate([v[0] for v in vectors]) if n else np.zeros(0, np.int64), minlength=terms)
        self.idf = np.log((1 + n) / (1 + df)) + 1
        weighed = [self.weigh(*v) for v in vectors]
        lead = [int(v[0][w.argmax()]) if len(w) else terms for v, w in zip(vectors, weighed, strict=True)]
        order = np.lexsort((ids, lead)) if n else np.zeros(0, np.int64)
        self.ids, self.labels, self.blocks = ids[order], labels[order].astype(float), -(-n // BLOCK)
        term = np.concatenate([vectors[i][0] for i in order]) if n else np.zeros(0, np.int64)
        at = np.repeat(np.arange(n), [len(vectors[i][0]) for i in order])
        weight = np.concatenate([weighed[i] for i in order]) if n else np.zeros(0)
        list_ = term * self.blocks + at // BLOCK
        laid = np.lexsort((at, list_))
        #: Postings (example, weight), term by term and in each term block by block; where each such list begins.
        self.at, self.weight = at[laid].astype(np.int32), weight[laid]
        self.begin = np.searchsorted(list_[laid], np.arange(terms * self.blocks + 1)).astype(np.int32)
        #: The largest weight of each term in each block, rounded up.
        most = np.zeros((terms, self.blocks))
        np.maximum.at(most, (term, at // BLOCK), weight)
        self.most = np.nextafter(most.astype(np.float32), np.float32(2)) * (most > 0)

    def weigh(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weight = (1 + np.log(np.maximum(counts, 1))) * self.idf[terms]
        return weight / np.sqrt((weight**2).sum()) if len(weight) else weight

    def _cosines(self, terms: np.ndarray, query: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(example positions, cosines) of the examples of ``blocks`` that share a term."""
        lists = (terms[:, None] * self.blocks + blocks[None, :]).ravel()
        first, size = self.begin[lists], self.begin[lists + 1] - self.begin[lists]
        held = np.flatnonzero(size)
        first, size = first[held], size[held]
        ends = np.cumsum(size)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)
        found = self.at[place]
        cosine = np.bincount(found, weights=self.weight[place] * np.repeat(query[held // len(blocks)], size), minlength=len(self.ids))
        near = np.flatnonzero(cosine > 0)
        return near, cosine[near]

    def nearest(self, terms: np.ndarray, counts: np.ndarray, k: int, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(example positions, cosines) of the k nearest with a cosine over 0, best first, ties by id."""
        if not len(terms) or not self.blocks:
            return np.zeros(0, np.int64), np.zeros(0)
        query = self.weigh(terms, counts)
        bound = query @ self.most[terms]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]

        def best(at: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if len(at) > k:  # all that tie with the k-th stay for the order by id
                tie = np.partition(cosine, len(at) - k)[len(at) - k] - 1e-11
                at, cosine = at[cosine >= tie], cosine[cosine >= tie]
            first = np.lexsort((self.ids[at], -np.round(cosine, 12)))[:k]
            return at[first], cosine[first]

        at, cosine = self._cosines(terms, query, order[:FIRST])
        if without is not None:
            at, cosine = at[at != without], cosine[at != without]
        at, cosine = best(at, cosine)
        rest = order[FIRST:]
        if len(at) >= k:
            rest = rest[bound[rest] >= cosine[-1] - 1e-6]
        if len(rest):
            more, close = self._cosines(terms, query, rest)
            if without is not None:
                more, close = more[more != without], close[more != without]
            at, cosine = best(np.concatenate([at, more]), np.concatenate([cosine, close]))
        return at, cosine


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rising step function closest to (x, y) with weights w: (where steps begin, their heights). Equal x share a step."""
    values, at = np.unique(x, return_inverse=True)
    mass = np.bincount(at, weights=w)
    height = np.bincount(at, weights=w * y) / mass
    blocks: list[list[float]] = []
    for v, h, m in zip(values, height, mass, strict=True):
        blocks.append([v, h, m])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            v2, h2, m2 = blocks.pop()
            v1, h1, m1 = blocks[-1]
            blocks[-1] = [v1, (h1 * m1 + h2 * m2) / (m1 + m2), m1 + m2]
    return np.array([b[0] for b in blocks]), np.array([b[1] for b in blocks])


class Model:
    def __init__(self, terms: Terms, index: Index, weights: np.ndarray, prior: float):
        """``weights``: of label 0 and 1 in the calibration."""
        self.terms, self.index, self.prior, self.class_weights = terms, index, prior, weights
        self.steps = self.heights = None

    def vote(self, terms: np.ndarray, counts: np.ndarray, without: int | None = None) -> tuple[float, np.ndarray]:
        at, near = self.index.nearest(terms, counts, NEIGHBOURS, without)
        heavy = near**SHARPNESS * self.class_weights[self.index.labels[at].astype(int)]
        return float((heavy @ self.index.labels[at] + PRIOR_WEIGHT * self.prior) / (heavy.sum() + PRIOR_WEIGHT)), self.index.ids[at]

    def calibrate(self, vectors: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, labels: np.ndarray) -> None:
        place = {int(x): i for i, x in enumerate(self.index.ids)}
        votes = np.array([self.vote(*v, without=place[int(x)])[0] for v, x in zip(vectors, ids, strict=True)])
        self.steps, self.heights = isotonic(np.round(votes, 9), labels.astype(float), self.class_weights[labels])

    def score(self, terms: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray]:
        if self.steps is None:
            return self.prior, np.zeros(0, np.int64)
        vote, evidence = self.vote(terms, counts)
        step = max(0, int(np.searchsorted(self.steps, round(vote, 9), "right")) - 1)
        return float(self.heights[step]), evidence


def train(docs: DataFrame, labels: DataFrame) -> Model:
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
    known = known.join(docs.where("doc_id is not null").select("doc_id").distinct(), "doc_id", "left_semi")
    shares = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    total = sum(shares.values())
    none = Model(Terms(np.zeros(0)), Index([], 0, np.zeros(0, np.int64), np.zeros(0)), np.ones(2), 0.0)
    if len(shares) < 2:
        return none
    # Of each label the rows whose id's hash is small: EXAMPLES on average, twice as many in all at most.
    turn = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53)) * F.when(F.col("toxic") == 1, shares[1]).otherwise(shares[0])
    sample = checkpoint(known.withColumn("turn", turn).where(F.col("turn") < EXAMPLES).orderBy("turn", "doc_id").limit(2 * EXAMPLES).select("doc_id", "toxic"))
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", "toxic")
    held = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(held) < 2:
        return none
    counted = map_texts(texts, _document_counts, "code long, ones long, zeros long").groupBy("code").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    rate1, rate0 = F.col("ones") / held[1], F.col("zeros") / held[0]
    pooled = (F.col("ones") + F.col("zeros")) / (held[0] + held[1])
    effect = (rate1 - rate0) ** 2 / (pooled * (1 - pooled) + 1e-12)
    least = max(EFFECT, CHI_SQUARED * (1 / held[0] + 1 / held[1]))
    wanted = counted.where((F.col("ones") + F.col("zeros") >= LEAST_TEXTS) & (effect >= least)).select("code")
    terms = Terms(wanted.toArrow()["code"].to_numpy().astype(np.uint64))  # terms of LEAST_TEXTS of the sample's texts or more
    width = len(terms.codes)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in chunks(batch):
                found = terms.counts(data, offsets)
                packed = [pa.array([x[i].astype(">i4").tobytes() for x in found], pa.binary()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), *packed], names=["doc_id", "toxic", "terms", "counts"])

    got = map_texts(texts, vectors, "doc_id long, toxic int, terms binary, counts binary")
    got = got.groupBy("doc_id").agg(F.min(F.struct("terms", "counts", "toxic")).alias("v")).orderBy("doc_id").collect()  # a row for each id of the sample
    ids, toxic = np.array([r["doc_id"] for r in got], np.int64), np.array([r["v"]["toxic"] for r in got], np.int64)
    held_vectors = [tuple(np.frombuffer(r["v"][c], ">i4").astype(np.int64) for c in ("terms", "counts")) for r in got]
    if not width or not len(ids):
        return none
    weights = np.array([shares[c] / total / max(1, (toxic == c).sum()) for c in (0, 1)]) * len(ids)
    model = Model(terms, Index(held_vectors, width, ids, toxic), weights, shares[1] / total)
    model.calibrate(held_vectors, ids, toxic)
    return model


def _scored(model: Model, seen: dict, data: np.ndarray, offsets: np.ndarray) -> list[tuple[float, np.ndarray]]:
    """(score, evidence) of each text of a chunk; ``seen`` holds what equal term counts have got before."""
    out = []
    for terms, counts in model.terms.counts(data, offsets):
        known = terms.astype(np.int32).tobytes() + counts.astype(np.int32).tobytes()
        if known not in seen:
            if len(seen) > 10_000:
                seen.clear()
            seen[known] = model.score(terms, counts)
        out.append(seen[known])
    return out


def _scorer(held):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = received(held), {}
        for batch in batches:
            for rows, data, offsets in chunks(batch):
                out = _scored(model, seen, data, offsets)
                score_ = np.array([x[0] for x in out])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(2), pa.array(score_, pa.float64()), pa.array((score_ >= 0.5).astype(np.int32)), pa.array([x[1][:3] for x in out], pa.list_(pa.int64()))],
                    names=["doc_id", "held_out", "score", "predicted", "evidence"],
                )

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, evidence (ids of the nearest examples).

    ``learn_from``: where the labelled documents' texts are, if not in ``docs``.
    """
    model = train(docs if learn_from is None else learn_from, labels)
    held = send(docs.sparkSession, model)
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return map_texts(rows, _scorer(held), "doc_id long, held_out boolean, score double, predicted int, evidence array<long>")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose texts are not predicted toxic. Texts stay in their partitions."""
    model = train(docs, labels)
    held = send(docs.sparkSession, model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = received(held), {}
        for batch in batches:
            for rows, data, offsets in chunks(batch):
                yield rows.filter(pa.array([x[0] < 0.5 for x in _scored(own, seen, data, offsets)], pa.bool_()))

    return map_texts(docs, keep, docs.schema)
