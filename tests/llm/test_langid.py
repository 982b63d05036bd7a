"""Language identification: a sample that depends on the rows alone, and the regression against its plain form."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyguard.llm import langid

WORDS = {"en": "the cat sat on a mat while rain fell".split(), "es": "el gato duerme en la mesa verde hoy".split(), "de": "die katze sitzt ruhig auf dem tisch".split()}


def texts(n, seed=0):
    rng = np.random.default_rng(seed)
    langs = list(WORDS)
    return [(" ".join(rng.choice(WORDS[langs[i % 3]], 12)), langs[i % 3]) for i in range(n)]


@pytest.mark.parametrize("per_language, trained", [(300, 3000), (20, 40), (1000, 60)])
def test_one_id_on_hundreds_of_texts(spark, monkeypatch, per_language, trained):
    """One id with most of the rows, repeated rows, more of them than the bound: the same result in any partitioning."""
    monkeypatch.setattr(langid, "PER_LANGUAGE", per_language)
    monkeypatch.setattr(langid, "TRAINED", trained)
    rows = [(1 if i % 3 else i // 40, t, lang) for i, (t, lang) in enumerate(texts(900))]
    rows += rows[:200] * 2 + [(1, "both", "en"), (1, "both", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    result = lambda d: sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(d).collect())
    a = result(df.repartition(2))
    assert a == result(df.orderBy(F.rand(5)).repartition(7)) and len(a) == len(rows)
    sample = langid.training_sample(df)
    assert sample.count() <= trained and sample.distinct().count() == sample.count()
    # Repeats of rows change nothing.
    assert set(result(df.distinct())) == set(a)


def test_predictions_are_those_of_plain_kernel_ridge_regression(spark, monkeypatch):
    """With every training row a landmark, scores are those of the dual form over the whole kernel, worked out with sets of n-grams."""
    known = texts(60, 1)
    monkeypatch.setattr(langid, "LANDMARKS", 200)
    learn = [(i, t, lang) for i, (t, lang) in enumerate(known)]
    ask = [(1000 + i, t, None) for i, (t, _) in enumerate(texts(30, 2))] + [(2000, "katze the gato", None), (2001, "zzz", None)]
    df = spark.createDataFrame(learn + ask, "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(df).collect()}
    import zlib

    used = [(t, lang) for i, t, lang in learn if zlib.crc32(str(i).encode()) % 5]
    cells = lambda t: {int(x) for part in langid.cells(np.frombuffer(t.encode(), np.uint8)) for x in part}
    sets = {t: cells(t) for t, *_ in [*used, *((t, 0) for _, t, _ in learn + ask)]}
    kernel = lambda a, b: len(sets[a] & sets[b]) / np.sqrt(len(sets[a]) * len(sets[b]))
    used = sorted(set(used))
    langs = sorted(WORDS)
    k = np.array([[kernel(a, b) for b, _ in used] for a, _ in used]) + 1  # the constant is one more feature
    y = np.array([[1.0 if lang == x else -1.0 for x in langs] for _, lang in used])
    dual = np.linalg.solve(k + langid.RIDGE * len(used) * np.eye(len(used)), y)
    for i, t, _ in learn + ask:
        value = np.array([kernel(t, b) + 1 for b, _ in used]) @ dual
        e = np.exp(langid.SHARPNESS * (value - value.max()))
        assert got[i][0] == langs[int(value.argmax())] and got[i][1] == pytest.approx(e.max() / e.sum(), abs=1e-5), t
