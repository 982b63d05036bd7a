"""The registered queries on a small data set, against SQL or plain versions."""

import hashlib
import math

import pytest

from tallyguard.llm import mixing, queries, toxicity
from tests.helpers import oracle, same
from tests.llm import brute


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, sf_dir, name):
    same(queries.QUERIES[name](spark, sf_dir).toPandas(), oracle(sf_dir, queries.ORACLES[name]))


def test_op1_toxicity(spark, sf_dir, docs):
    out = queries.op1_toxicity(spark, sf_dir).toPandas()
    assert sorted(out.doc_id) == sorted(docs.doc_id) and out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.5)).all()
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    want = brute.toxicity(dict(zip(docs.doc_id, docs.text)), list(zip(marks.doc_id, marks.toxic)))
    assert dict(zip(out.doc_id, out.score)) == pytest.approx(want, abs=1e-9) and len(set(want.values())) > 2
    larger = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{larger}/labels.parquet").toPandas()
    scored = queries.op1_toxicity(spark, larger).toPandas().merge(labels, on="doc_id")
    said = scored[scored.predicted == 1]
    assert (said.toxic == 1).mean() > 0.9 and len(said) > 0.5 * (scored.toxic == 1).sum() and (scored.evidence.map(len) > 0).mean() > 0.95


def test_op2_minhash(spark, sf_dir, docs):
    got = queries.op2_minhash(spark, sf_dir).toPandas()
    texts = dict(zip(docs.doc_id, docs.text))
    assert dict(zip(got.doc_id, got.component_id)) == brute.components(texts, 3, 85)
    assert dict(zip(got.doc_id, got.n_shingles)) == {i: len(brute.shingles(t, 3)) for i, t in texts.items()}
    assert (got.kept == (got.doc_id == got.component_id)).all()


def test_op5_repetition(spark, sf_dir, docs):
    got = queries.op5_repetition(spark, sf_dir).toPandas().set_index("doc_id")
    for d in docs.itertuples():
        r = got.loc[d.doc_id]
        want = brute.repetition(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.longest_repeat) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.kept and r.base_failed)


def test_op7_sentencepiece(spark, sf_dir, docs):
    out = queries.op7_sentencepiece(spark, sf_dir).toPandas()
    assert len(out) == len(docs) and out.round_trip.all() and (out.n_tokens == out.ids.map(len)).all()


def test_op8_language(spark, sf_dir, docs):
    out = queries.op8_language_id(spark, sf_dir).toPandas().merge(docs, on="doc_id")
    held = out[out.held_out]
    assert len(held) > 20 and (held.lang_pred == held.lang).mean() > 0.95 and out.score.between(0, 1).all()


def test_op9_mixing(spark, sf_dir, docs):
    out = queries.op9_mixing(spark, sf_dir).toPandas()
    again = queries.op9_mixing(spark, sf_dir).toPandas()
    same(out, again)
    m = out.merge(docs[["doc_id", "source"]], on="doc_id")
    assert (m["size"] == m.doc_id.map({d.doc_id: len(brute.WORD.findall(d.text)) for d in docs.itertuples()})).all()
    assert (m.taken <= 2 * m["size"]).all()
    by = m.groupby("source").agg(size=("size", "sum"), taken=("taken", "sum"), target=("target", "first"), median=("size", "median"))
    want, caps, weights, left = {}, (2.0 * by["size"]).to_dict(), {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(sorted(by.index))}, 1.5 * by["size"].sum()
    rest = dict(weights)
    while rest:  # share, cap, share the excess again
        level = left / sum(rest.values())
        over = [s for s in rest if rest[s] * level > caps[s] * (1 + 1e-12)]
        if not over:
            want |= {s: w * level for s, w in rest.items()}
            break
        for s in over:
            want[s] = caps[s]
            left -= caps[s]
            del rest[s]
    for s, r in by.iterrows():
        assert r.target == pytest.approx(want[s]) and r.taken <= r.target + 1e-6
        more = m[(m.source == s) & (m.taken < 2 * m["size"])]["size"]  # no further copy fits
        assert more.empty or more.min() > r.target - r.taken
    # The tilted rates, against plain bisection on each source's dual.
    found = {r["source"]: r for r in mixing.plan(spark.read.parquet(f"{sf_dir}/documents.parquet"))[1].collect()}
    for s, own in m.groupby("source")["size"]:
        mean, low, high = max(1, own.sum()) / len(own), -50.0, 50.0
        taken = lambda dual: sum(n * min(2.0, math.exp(min(50.0, dual * n / mean))) for n in own)  # noqa: B023, E731
        for _ in range(200):
            low, high = (low, (low + high) / 2) if taken((low + high) / 2) > want[s] else ((low + high) / 2, high)
        assert want[s] >= caps[s] or found[s]["dual"] == pytest.approx(low, abs=1e-5)


def test_op9_mixing_is_close_to_its_targets(spark):
    m = queries.op9_mixing(spark, "/root/testdata/sf0.01").toPandas().merge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source").toPandas(), on="doc_id")
    for _, r in m.groupby("source", dropna=False).agg(taken=("taken", "sum"), target=("target", "first"), median=("size", "median")).iterrows():
        assert abs(r.taken - r.target) <= max(0.01 * r.target, r["median"])


def test_op10_run_length_index(spark, sf_dir, docs):
    got = queries.op10_run_length_index(spark, sf_dir).toPandas().set_index("doc_id")
    for d, want in zip(docs.itertuples(), brute.removed(list(docs.text), 400)):
        r = got.loc[d.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want


def test_pipeline(spark, sf_dir, docs):
    """Each stage against its plain version on what the stage before it kept."""
    import corpus_pipeline

    now = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = now.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf_dir).persist()
        kept[name] = now.toPandas()
        assert name == "sentencepiece" or now.columns == columns
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = toxicity.score_toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels).toPandas()
    a, b, c = kept["toxicity"], kept["exact_dedup"], kept["near_dedup"]
    assert sorted(a.doc_id) == sorted(scores[scores.predicted == 0].doc_id)
    best = {}
    for d in a.itertuples():
        key = "".join(brute.WORD.findall(d.text))
        best[key] = min(best.get(key, (0, 1 << 60)), (-len(d.text), d.doc_id))
    assert sorted(b.doc_id) == sorted(i for _, i in best.values())
    comp = brute.components(dict(zip(b.doc_id, b.text)), 5, 80)
    assert sorted(c.doc_id) == sorted(i for i, x in comp.items() if i == x)
    texts = dict(zip(docs.doc_id, docs.text))
    copies = mixing.mix(spark.createDataFrame(c)).toPandas()
    mixed = kept["mixing"].groupby("doc_id").size()
    assert mixed.to_dict() == {r.doc_id: r.copies for r in copies.itertuples() if r.copies}
    assert all(texts[r.doc_id] == r.text for r in kept["mixing"].itertuples())
    assert len(kept["sentencepiece"]) == mixed.sum() and kept["sentencepiece"].round_trip.all()
    assert corpus_pipeline.run(spark, sf_dir).count() == mixed.sum()


def test_sha_of_op6(spark, sf_dir, docs):
    got = queries.op6_exact_dedup(spark, sf_dir).toPandas().set_index("doc_id")
    for d in docs.head(20).itertuples():
        assert got.loc[d.doc_id].text_sha256 == hashlib.sha256("".join(brute.WORD.findall(d.text)).encode()).hexdigest()
