"""Quality classifier: context vectors and pooling against plain loops, the network's slopes, calibration, held-out rows, odd rows."""

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyguard.llm import quality, queries
from tallyguard.llm.textops import prefix_hash, span_hash

TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff \t\n\x0b\x0c\r]+")


def hashed(token: bytes):
    return span_hash(prefix_hash(np.frombuffer(token, np.uint8)), np.array([0]), np.array([len(token)]))


def plain_pools(texts):
    """(context sums, counts, pooled vector of each text), token by token."""
    found = [TOKEN.findall((t or "").encode()) for t in texts]
    known = {w: hashed(w) for w in {w for f in found for w in f}}
    index = {w: quality.index_vectors(h) for w, h in known.items()}
    at = {w: int(h[0] % np.uint64(quality.CELLS)) for w, h in known.items()}
    sums, counts = np.zeros((quality.CELLS, quality.DIMENSIONS), int), np.zeros(quality.CELLS, int)
    for f in found:
        for i, w in enumerate(f):
            counts[at[w]] += 1
            for x in f[max(0, i - quality.WINDOW) : i + quality.WINDOW + 1]:
                for part, sign in zip(*index[x]):
                    sums[at[w], part[0]] += sign[0]
    mean = sums.sum(0) / max(1, counts.sum())
    pools = []
    for f in found:
        rows = []
        for w in f:
            v = sums[at[w]] / counts[at[w]] - mean
            rows.append(v / max(1e-12, math.sqrt((v**2).sum())))
        both = np.array(rows) if rows else np.zeros((1, quality.DIMENSIONS))
        pools.append(np.concatenate([both.mean(0), both.std(0), [math.log1p(len(f))]]))
    return sums, counts, np.array(pools)


def test_context_vectors_and_pools(spark, sf_dir):
    texts = [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(25).collect() for r in [(r["text"][:3000],)]] + ["", None, "é!! b  c\nB", "one", "x" * 5000 + " ,,, y"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    sums, counts, pools = plain_pools(texts)
    got = quality.gathered(df)
    assert (got[0] == sums).all() and (got[1] == counts).all()
    vectors = quality.word_vectors(*got)
    data = "".join(t or "" for t in texts).encode()
    offsets = np.cumsum([0, *(len((t or "").encode()) for t in texts)])
    assert quality.pooled(*quality.tokens(np.frombuffer(data, np.uint8), offsets), vectors) == pytest.approx(pools, abs=2e-6)
    alone = np.frombuffer((texts[0] or "").encode(), np.uint8)  # in another batch: the very same
    one = quality.pooled(*quality.tokens(alone, np.array([0, len(alone)])), vectors)
    assert (one[0] == quality.pooled(*quality.tokens(np.frombuffer(data, np.uint8), offsets), vectors)[0]).all()


def test_network_learns_and_its_steps_follow_the_slope(monkeypatch):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] * x[:, 1] > 0) | (x[:, 2] > 1)).astype(int)  # no line tells these apart
    net = quality.Network(5)
    net.fit(x, y, np.ones(400))
    assert ((net.logits(x) > 0) == y).mean() > 0.95
    again = quality.Network(5)
    again.fit(x, y, np.ones(400))
    assert (again.score(x) == net.score(x)).all()
    monkeypatch.setattr(quality, "STEPS", 1)
    monkeypatch.setattr(quality, "DECAY", 0.0)
    z = (x - x.mean(0)) / (x.std(0) + 1e-6)
    loss = lambda w1, w2: np.mean(np.logaddexp(0, np.where(y == 1, -1, 1) * (np.tanh(z @ w1) @ w2)))
    start, end = quality.Network(5), quality.Network(5)
    end.fit(x, y, np.ones(400))
    for i, j in ((0, 0), (4, 7), (2, 23)):  # the first Adam step goes against the slope's sign
        up = start.w1.copy()
        up[i, j] += 1e-6
        slope = (loss(up, start.w2) - loss(start.w1, start.w2)) / 1e-6
        assert np.sign(end.w1[i, j] - start.w1[i, j]) == -np.sign(slope)


def test_temperature():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 1))
    net = quality.Network(1)
    net.logits = lambda v: 5.0 * v[:, 0]
    y = (rng.random(4000) < quality.sigmoid(x[:, 0] * 2.0)).astype(int)
    net.calibrate(x, y, np.ones(4000))
    assert net.temperature == pytest.approx(2.5, rel=0.1)
    net.calibrate(np.array([[-1.0], [1.0]]), np.array([0, 1]), np.ones(2))  # told apart without error
    assert 0.05 < net.score(np.array([[-1.0]]))[0] < 0.5 < net.score(np.array([[1.0]]))[0] < 0.95


def test_op11_quality(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op11_quality(spark, sf).toPandas()
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet").toPandas() for t in ("documents", "labels"))
    assert sorted(out.doc_id) == sorted(docs.doc_id) and out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.3)).all()
    assert (out.held_out == out.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    held = out[out.held_out].merge(labels, on="doc_id")
    assert (held[held.quality == 1].predicted == 1).mean() > 0.95 and (held[held.quality == 0].predicted == 0).mean() > 0.8
    assert abs(held.score.mean() - held.quality.mean()) < 0.05


SCHEMA = "doc_id long, text string, lang string, source string, quality string, label string, score string, turn string"
ODD = [(i, f"calm words number {i} flow on and on and on" if i % 3 else f"LOUD!! ### WORDS {i} $$$ !!", "en", "a") for i in range(60)] + [(100, None, None, None), (101, "", "en", "b"), (102, " \n", "en", "b"), (103, "é 😀 " * 20_000, "xx", "c"), (None, "no id at all", "en", "a"), (1, "LOUD!! again", "en", "a"), (2, "calm words number 2 flow on and on and on", "en", "a")]


def odd(spark):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in ODD], SCHEMA)


def test_odd_rows(spark):
    d = odd(spark)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(60)] + [(None, 1), (5, None), (7, 0), (500, 1), (100, 0)], "doc_id long, quality int")
    rows = lambda df: sorted(map(str, df.collect()))
    got = rows(quality.score_quality(d, labels))
    assert len(got) == len(ODD) and rows(quality.score_quality(d.repartition(5), labels.repartition(3))) == got
    scores = {r["doc_id"]: r["score"] for r in quality.score_quality(d, labels).where("held_out and doc_id < 60 and doc_id > 2").collect()}
    assert scores and all((s > 0.5) == (i % 3 > 0) for i, s in scores.items())
    assert quality.score_quality(d.limit(0), labels).count() == 0
    kept = quality.keep_good(d, labels)
    assert kept.columns == d.columns and 0 < kept.count() < len(ODD) and quality.keep_good(d.limit(0), labels).count() == 0


def test_nothing_to_learn(spark):
    d = odd(spark)
    for rows, want in (([], 0.0), ([(1, 1), (2, 1), (3, 1)], 1.0), ([(1, 0), (2, 0)], 0.0)):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        assert {r["score"] for r in quality.score_quality(d, labels).collect()} == {want}


def test_one_id_on_many_texts(spark):
    """A labelled id with most of the rows gives one example, whichever partition its texts are in."""
    rows = [(1, f"text {i} of one id") for i in range(300)] + [(i, f"LOUD {i} !!" if i % 2 else f"calm {i} words") for i in range(2, 60)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, (i + 1) % 2) for i in range(2, 60)] + [(1, 1)], "doc_id long, quality int")
    a, b = ({(r["doc_id"], r["score"]) for r in quality.score_quality(x, labels).collect()} for x in (d.repartition(2), d.orderBy(F.rand(3)).repartition(7)))
    assert a == b
