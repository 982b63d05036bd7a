"""Importance resampling: crc32 of runs, weights, bisection with ties, odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyguard.llm import queries, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def plain(rows, target, percent=5, least=20, seed=42):
    """[(doc_id, features, weight, score, rank)], sorted."""
    held = [(i, *runs(t)) for i, t in rows]
    s, t = collections.Counter(b for *_, f in held for b in f), collections.Counter(b for x in target for b in runs(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    out = []
    for i, n, f in held:
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def rows_of(df):
    return sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect()), key=str)


def test_op13_resampling(spark, sf_dir):
    read = lambda t: [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{t}.parquet").select("doc_id" if t == "documents" else "item_id", "text").collect()]
    want = plain(read("documents"), [t for _, t in read("benchmark")])
    assert rows_of(queries.op13_resampling(spark, sf_dir)) == want and any(r[4] for r in want)


ODD = [(1, "Alpha BETA gamma " * 9), (2, None), (3, ""), (4, " \n--"), (5, "é😀à Ünder_score x1 " * 8), (6, "word " * 50_000), (7, "z" * 70_000 + " " + "long " * 30), (None, "no id " * 12), (None, "no id " * 12), (8, "same text of many words " * 5), (8, "same text of many words " * 5), (9, "nineteen " * 19), (10, "twenty " * 20), (11, "KK İx " * 30)]


@pytest.mark.parametrize("percent", [5, 50, 100])
def test_odd_rows(spark, percent):
    d = spark.createDataFrame(ODD, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("score", "rank", "weight", "__id", "__place", "n_words")})
    target = spark.createDataFrame([("alpha beta",), (None,), ("twenty words",)], "text string")
    assert rows_of(resample.resample(d, target, percent)) == plain(ODD, ["alpha beta", None, "twenty words"], percent)


def test_empty_tables(spark):
    d = spark.createDataFrame(ODD, "doc_id long, text string")
    none = spark.createDataFrame([], "text string")
    assert rows_of(resample.resample(d, none, 50)) == plain(ODD, [], 50)
    assert resample.resample(d.limit(0), none).count() == 0
    assert {r[4] for r in rows_of(resample.resample(d.where("doc_id < 5"), none, 1))} == {None}


@pytest.mark.parametrize("ways, parts", [(2, 1), (5, 7), (32, 3)])
def test_bisection_with_ties(spark, monkeypatch, ways, parts):
    """One id with a third of all rows, scores that tie, rows that are equal in all."""
    monkeypatch.setattr(resample, "WAYS", ways)
    rng = random.Random(ways)
    made = [(rng.choice([5, rng.randrange(60)]), rng.choice([-7, 0, 3, 10**9])) for _ in range(300)]
    scored = spark.createDataFrame(made, "__id long, score long").repartition(parts).withColumn("__place", F.monotonically_increasing_id()).persist()
    order = sorted(made, key=lambda r: (-r[1], r[0]))
    for n in (1, 2, 37, 75, 150, 299, 300):
        got = [(r["__id"], r["score"]) for r in scored.where(resample.drawn(scored, n)).collect()]
        assert sorted(got) == sorted(order[:n])


def test_crc32_of_runs():
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("abÅé9Z") for _ in range(rng.choice([1, 2, 7, 47, 48, 49, 300]))) for _ in range(rng.randrange(0, 40))) for _ in range(30)] + ["", "one", "a b"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    bounds, found = resample.features(np.frombuffer(data, np.uint8), offsets)
    for i, t in enumerate(texts):
        own = [b[bounds[i] : bounds[i + 1]] for b in found]
        assert [int(x) for b in own for x in b if x >= 0] == runs(t)[1]
    assert all(resample.shifted(np.array([zlib.crc32(b"ab")], np.uint32), np.array([n]))[0] ^ zlib.crc32(b"x" * n) == zlib.crc32(b"ab" + b"x" * n) for n in (0, 1, 5, 48, 70_001))


def test_gains():
    s, t = np.zeros(10000, int), np.zeros(10000, int)
    s[1], t[2] = 9, 4
    g = resample.bucket_gains(s, t)
    assert g[0] == math.floor(1000 * math.log(10009 / 10004)) and g[1] == math.floor(1000 * math.log(10009 / (10 * 10004))) and g[2] == math.floor(1000 * math.log(5 * 10009 / 10004))
