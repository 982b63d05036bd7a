"""Fill-in-the-middle by a piece table: forms, exact restoring, odd rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tallyguard.llm import fim

ROWS = [(1, "alpha beta gamma"), (2, None), (3, ""), (4, "with <S> inside"), (5, "é😀à"), (6, "x" * 300_000 + "é"), (None, "no id"), (7, "one"), (7, "one"), (7, "<"), (8, "<P"), (9, "S><"), (10, " \n"), (11, "áb")]


def plain(i, text, seed=1, rate=90, spm=20):
    text = text or ""
    n, h = len(text), hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < spm else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("form", "output", "n", "middle_chars")})


@pytest.mark.parametrize("rate, spm", [(90, 20), (100, 0), (100, 100), (0, 50)])
def test_outputs_and_restored_texts(spark, rate, spm):
    made = fim.transform(frame(spark), rate=rate, spm=spm)
    key = lambda r: tuple(map(str, r))
    got = sorted([(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in made.collect()], key=key)
    assert got == sorted([(i, *plain(i, t, 1, rate, spm)) for i, t in ROWS], key=key)
    back = sorted([(r["doc_id"], r["text"]) for r in fim.restore(made).collect()], key=key)
    assert back == sorted([(i, t or "") for i, t in ROWS], key=key)
    assert {f for _, _, f, *_ in got} == {"plain"} | ({"spm"} if rate and spm else set()) | ({"psm"} if rate and spm < 100 else set())


def test_digests_and_every_cut(spark):
    rows = [(i, "añ<😀>") for i in range(400)] + [(i, None) for i in range(400, 410)]
    got = {r["doc_id"]: r for r in fim.digests(fim.transform(frame(spark, rows))).collect()}
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    cuts = set()
    for i, t in rows:
        n, form, a, m, out = plain(i, t)
        assert (got[i]["n"], got[i]["form"], got[i]["prefix_chars"], got[i]["middle_chars"]) == (n, form, a, m)
        assert got[i]["output_sha256"] == sha(out) and got[i]["restored_sha256"] == sha(t)
        cuts.add((form, a, m))
    assert len(cuts) > 35  # nearly all of 2 forms, 21 cuts, and plain


def test_columns_stay_and_empty_tables(spark):
    d = frame(spark)
    out = fim.transform_column(d)
    assert out.columns == d.columns and sorted(r["text"] or "" for r in out.collect()) == sorted(plain(i, t)[4] for i, t in ROWS)
    for f in (fim.transform, fim.transform_column, lambda x: fim.restore(fim.transform(x)), lambda x: fim.digests(fim.transform(x))):
        assert f(d.limit(0)).count() == 0


def test_pieces():
    marks = fim.Sentinels(fim.SENTINELS)
    whole = fim.Piece(fim.TEXT, 10, 20)
    parts = fim.cut(whole, (12, 30))
    assert parts == [(0, 10, 2), (0, 12, 18), (0, 30, 0)]
    for form in ("psm", "spm"):
        arranged = fim.arrange(parts, form, marks)
        own = [p for p in arranged if p.buffer == fim.TEXT]
        assert fim.restored(own, form) == parts and len(arranged) == 6
    assert fim.arrange([whole], "plain", marks) == [whole]
    with pytest.raises(ValueError):
        fim.parted(b"<P>a<M>b", 0, 8, "psm", marks)
    for bad in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("ab", "bc", "x"), ("abc", "b", "x"), ("aa", "aba", "x")):
        with pytest.raises(ValueError):
            fim.Sentinels(bad)


def test_other_sentinels(spark):
    marks = ("[pre]", "[suf]", "[mid]")
    rows = [(i, f"text {i} <P> of [some] kind") for i in range(50)] + [(60, "has [mid]")]
    made = fim.transform(frame(spark, rows), sentinels=marks)
    assert {r["doc_id"]: r["text"] for r in fim.restore(made, marks).collect()} == dict(rows)
    assert made.where("form <> 'plain'").count() > 30 and made.where("doc_id = 60").first()["form"] == "plain"
