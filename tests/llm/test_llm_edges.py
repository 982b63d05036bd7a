"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns; and the parts of each operator."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyguard.llm import chat, common, components, exact_dedup, langid, minhash, mixing, queries, repetition, rindex, sentencepiece, textops, toxicity, urls
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i * 7919 % 5003}" for i in range(30_000))
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "a", 1), (2, "alpha beta\ngamma delta epsilon zeta eta theta", "en", "a", 1), (3, None, None, None, None), (4, "", "en", "b", 0), (5, " \n\t", "en", "b", 0),
    (6, LONG, "de", "a", 9), (7, LONG + " end", "de", None, 9), (None, "no id here at all", "fr", "c", 1), (8, "alpha beta gamma delta epsilon zeta eta theta", "en", "a", 1), (8, "alpha beta gamma delta epsilon zeta eta theta", "en", "a", 1),
    (9, "é à ü ñ 😀 ▁ x", "es", "b", 3), (10, "one", "en", "c", 1), (11, "one", None, "c", 1),
]


def frame(spark, rows=ROWS, clash=True):
    df = spark.createDataFrame(rows, SCHEMA)
    names = ["kept", "score", "size", "target", "set", "key", "component_id", "ids", "copies", "__key", "sha", "n", "u", "mean", "level"]
    return df.withColumns({c: F.lit(f"clash {c}") for c in names}) if clash else df


@pytest.mark.parametrize("run", [
    lambda s, d: toxicity.score_toxicity(d, s.createDataFrame([(1, 1), (2, 0), (1, 0), (None, 1), (4, None)], "doc_id long, toxic int")), lambda s, d: minhash.near_duplicates(d), lambda s, d: repetition.repetition_rules(d), lambda s, d: exact_dedup.exact_duplicates(d),
    lambda s, d: sentencepiece.encode(d), lambda s, d: langid.identify(d), lambda s, d: mixing.mix(d), lambda s, d: rindex.remove_repeats(d, 60),
])
def test_every_row_comes_back_once(spark, run):
    d = frame(spark)
    got = run(spark, d).toPandas()
    assert sorted(map(str, got.doc_id.astype("Int64"))) == sorted(map(str, d.toPandas().doc_id.astype("Int64")))
    assert run(spark, d.limit(0)).count() == 0


def test_stages_keep_columns_and_take_empty_tables(spark):
    d = frame(spark)
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    for f in (lambda x: toxicity.drop_toxic(x, labels), exact_dedup.drop_exact_duplicates, minhash.drop_near_duplicates, mixing.take):
        out = f(d)
        assert out.columns == d.columns and out.count() and f(d.limit(0)).count() == 0


def test_pipeline_of_odd_tables(spark, tmp_path):
    """Null, empty, long and repeated rows and a clashing column pass all stages; so does a table without rows."""
    import corpus_pipeline

    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1)], "doc_id long, toxic int")
    for name, d in (("odd", frame(spark).select("doc_id", "text", "lang", "source", "n_chars", "key")), ("none", frame(spark, clash=False).limit(0))):
        d.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        if name == "none":
            assert out.count() == 0
        else:
            assert {r["doc_id"] for r in out.collect()} <= {None, *range(1, 12)} and out.count() and out.where("not round_trip").count() == 0


def test_exact_duplicates(spark):
    got = {(r["doc_id"], r["text_sha256"]): r for r in exact_dedup.exact_duplicates(frame(spark)).collect()}
    by = {k[0]: r for k, r in got.items()}
    assert by[1]["keep_id"] == 1 and by[2]["keep_id"] == 1 and by[8]["group_size"] == 4 and not by[8]["kept"]
    assert by[5]["keep_id"] == 5 and by[4]["keep_id"] == 5 and by[3]["group_size"] == 3
    assert by[6]["kept"] and by[7]["kept"] and by[10]["kept"] and not by[11]["kept"]
    left = [r["doc_id"] for r in exact_dedup.drop_exact_duplicates(frame(spark)).collect()]
    assert sorted(x for x in left if x is not None) == [1, 5, 6, 7, 9, 10] and None in left
    twice = spark.createDataFrame([(1, "same"), (1, "same"), (1, "sa me")], "doc_id long, text string")
    assert [r["text"] for r in exact_dedup.drop_exact_duplicates(twice).collect()] == ["sa me"]


def test_exact_duplicates_across_many_senders(spark):
    rows = [(i, f"text {i % 400}") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(23)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.exact_duplicates(df).collect()}
    assert got == {i: (i % 400, 3 if i % 400 < 200 else 2) for i in range(1000)}


@pytest.mark.parametrize("bits, heavy", [(15, 1000), (29, 1000), (15, 3)])
def test_suspects_by_filter_and_by_join(spark, monkeypatch, bits, heavy):
    """A filter that is too small gives way to a join: the same result, and no more texts than have copies."""
    monkeypatch.setattr(common, "FILTER_BITS", bits)
    monkeypatch.setattr(common, "HEAVY", heavy)
    monkeypatch.setattr(exact_dedup, "ROWS_PER_SENDER", 700)
    monkeypatch.setattr(exact_dedup, "ROWS_PER_OWNER", 200)
    taken, made = [], exact_dedup.suspect_texts
    monkeypatch.setattr(exact_dedup, "suspect_texts", lambda *args: taken.append(made(*args)) or taken[-1])
    texts = [f"one {i}" for i in range(2000)] + [f"two {i // 2}" for i in range(20_000)] + ["many"] * 12_000
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(40)
    got = exact_dedup.exact_duplicates(df).groupBy("group_size").agg(F.count("*"), F.sum(F.col("kept").cast("int"))).collect()
    assert sorted(map(tuple, got)) == [(1, 2000, 2000), (2, 20_000, 10_000), (12_000, 12_000, 1)]
    assert taken[0].count() <= (32_000 if bits == 15 else 32_500)


def test_golomb_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 3000):
        values = np.unique(rng.integers(0, 1 << 48, n, dtype=np.uint64))
        coded = exact_dedup.golomb_encode(values)
        assert np.array_equal(exact_dedup.golomb_decode(coded), values)
        assert n < 3000 or len(coded) < 8 * len(values)
    dense = np.arange(1000, dtype=np.uint64)
    assert np.array_equal(exact_dedup.golomb_decode(exact_dedup.golomb_encode(dense)), dense)


def test_near_duplicates_of_odd_rows(spark):
    got = {r["doc_id"]: r for r in minhash.near_duplicates(frame(spark), k=3, threshold=85).collect()}
    assert got[1]["component_id"] == got[2]["component_id"] == got[8]["component_id"] == 1
    assert got[3]["n_shingles"] == got[4]["n_shingles"] == 0 and got[3]["kept"] and got[4]["kept"]
    assert got[6]["component_id"] == got[7]["component_id"] == 6 and got[11]["component_id"] == 10 and got[10]["n_shingles"] == 1
    assert got[None]["component_id"] is None and got[None]["kept"]


def test_near_duplicates_in_crowded_buckets(spark, monkeypatch):
    """A large group of near copies around one text, in blocks of four."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    texts = {}
    for i in range(60):
        w = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 5])):
            w[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        texts[i] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, k=3, threshold=75).collect()}
    want = brute.components(texts, 3, 75)
    assert got == want and len(set(want.values())) > 3


def test_texts_that_share_a_passage_are_not_compared_in_pairs(spark, monkeypatch):
    """A large bucket of texts with half their words in common: few of their sets are moved again."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    asked, made = [], minhash._compared
    monkeypatch.setattr(minhash, "_compared", lambda groups, *more: asked.append(groups.count()) or made(groups, *more))
    rng = random.Random(15)
    passage = " ".join(f"p{i}" for i in range(80))
    texts = {i: f"{passage} " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for i in range(300)}
    texts |= {300 + i: texts[7 * i] + f" z{i}" for i in range(20)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, k=3, threshold=85).collect()}
    assert got == brute.components(texts, 3, 85) and len(set(got.values())) == 300
    assert sum(asked) <= 2 * len(texts)


@pytest.mark.parametrize("block_sets, block_bytes", [(1024, 16 << 20), (64, 16 << 20), (1024, 4000)])
def test_near_copies_just_under_the_threshold_move_few_sets(spark, monkeypatch, block_sets, block_bytes):
    """300 copies of one text, most of them a little too far apart: the group of their large buckets is compared whole."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "BLOCK_SETS", block_sets)
    monkeypatch.setattr(minhash, "BLOCK_BYTES", block_bytes)
    asked, made = [], minhash._compared
    monkeypatch.setattr(minhash, "_compared", lambda groups, *more: asked.append(groups.count()) or made(groups, *more))
    rng = random.Random(16)
    texts = {}
    for i in range(300):
        w = [f"w{k}" for k in range(90)]
        for _ in range(rng.choice([1, 2, 3, 3, 3, 4])):
            w[rng.randrange(90)] = f"x{rng.randrange(10**6)}"
        texts[i] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, k=3, threshold=85).collect()}
    want = brute.components(texts, 3, 85)
    assert got == want and len(set(want.values())) > 3
    assert asked[-1] == len(texts)  # the group of large buckets, once; small buckets come before


def test_near_duplicates_of_a_large_table_move_sets_once(spark, monkeypatch):
    """Without any broadcast, as in large tables: texts aren't shuffled, sets are once by id, few keys meet those of shared buckets."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    inputs, joined, keyed = [], [], []
    mapped, by, cut = minhash.map_texts, minhash._by, minhash.checkpoint
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    monkeypatch.setattr(minhash, "map_texts", lambda df, *more: inputs.append(plan(df)) or mapped(df, *more))
    monkeypatch.setattr(minhash, "_by", lambda rows, *keys: joined.append(plan(rows)) or by(rows, *keys))

    def watched(df):
        if set(df.columns) == {"key", "rep", "n", "c", "pivot", "pivot_n"}:
            keyed.append(plan(df))
        return cut(df)

    monkeypatch.setattr(minhash, "checkpoint", watched)
    rng = random.Random(18)
    base = [f"w{i}" for i in range(90)]
    texts = {}
    for i in range(120):
        w = list(base)
        for _ in range(rng.choice([1, 2, 3, 3, 4])):
            w[rng.randrange(90)] = f"x{rng.randrange(10**6)}"
        texts[i] = " ".join(w)
    texts |= {1000 + i: " ".join(f"y{rng.randrange(10**6)}" for _ in range(60)) for i in range(100)}
    df = spark.createDataFrame([*texts.items(), (None, texts[0])], "doc_id long, text string").repartition(5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(df, k=3, threshold=85).collect() if r["doc_id"] is not None}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == brute.components(texts, 3, 85)
    assert len(inputs) == 2 and not any("Join" in x for x in inputs)
    assert len(joined) > 1 and all(x.count("Exchange hashpartitioning(doc#") <= 1 for x in joined)
    assert len(keyed) == 1 and "Generate explode" not in keyed[0]


def test_bit_filters_of_keys_and_ids(spark):
    values = np.arange(-4000, 4000, 2)
    table = minhash.filter_of(spark.createDataFrame([(int(x),) for x in values], "v long"))
    assert minhash.passing(table, values).all()
    assert minhash.passing(table, np.arange(10**6, 10**6 + 50_000)).mean() < 0.01


def test_one_id_on_two_texts(spark):
    rows = [(1, "a b c d e f g"), (1, "h i j k l m n"), (2, "h i j k l m n"), (3, "a b c d e f g"), (4, "a b c d e f g h")]
    df = spark.createDataFrame(rows * 2, "doc_id long, text string")
    runs = [sorted(map(tuple, minhash.near_duplicates(df.repartition(n), k=3, threshold=80).collect())) for n in (1, 4)]
    assert runs[0] == runs[1] and {(r[0], r[2]) for r in runs[0]} >= {(1, 1), (2, 1), (3, 1)}


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(2)
    for n, shared in ((1, 1), (3, 2), (40, 30), (500, 400), (5000, 4500)):
        a = np.unique(textops.mix(rng.integers(0, 1 << 60, n, dtype=np.uint64)))
        b = np.unique(np.concatenate([a[:shared], textops.mix(rng.integers(0, 1 << 60, n - shared, dtype=np.uint64))]))
        one, two = minhash.sketch(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        assert (one != np.uint64(2**64 - 1)).all()
        assert abs((one == two).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.2
    assert minhash.sketch(np.zeros(0, np.uint64), np.array([0, 0])).shape == (1, minhash.BINS)


def test_words_and_shingles_of_a_chunk():
    texts = ["a b  c", "", "\n x\ty ", "é ü", "b c"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    starts, ends, bounds = textops.words(data, offsets)
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends)] == ["a", "b", "c", "x", "y", "é", "ü", "b", "c"]
    assert bounds.tolist() == [0, 3, 3, 5, 7, 9]
    hashes = textops.span_hash(textops.prefix_hash(data), starts, ends)
    assert hashes[1] == hashes[7] and hashes[2] == hashes[8] and len(set(hashes.tolist())) == 7
    values, at = textops.shingles(hashes, bounds, 2)
    assert np.diff(at).tolist() == [2, 0, 1, 1, 1] and values[at[4]] in values[:2]


@pytest.mark.parametrize("heavy", [1000, 12, 1])
def test_components(spark, monkeypatch, heavy):
    """With all, some and no nodes broadcast."""
    monkeypatch.setattr(components, "HEAVY", heavy)
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(500, i) for i in range(501, 560)] + [(i, i + 1) for i in range(600, 640)] + [(1, 1), (None, 2)]
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    assert got == {x: find(x) for x in up}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_repetition_verdicts(spark):
    words = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (2, " ".join(words + words[:40])), (3, " ".join(words[:49])), (4, None), (5, " ".join(words[:10] * 12)), (6, " ".join(words + words[:8]))]
    got = {r["doc_id"]: r for r in repetition.repetition_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["kept"] and got[6]["kept"] and not got[2]["kept"] and got[2]["longest_repeat"] == 40 and got[2]["n_covered_words"] == 80
    assert got[3]["base_failed"] and got[4]["base_failed"] and got[5]["base_failed"] and got[6]["n_covered_words"] == 16


def test_verdicts_that_only_the_method_gives(spark):
    """Texts that pass the base rules: repeats of any length, overlapping ones, at both sides of either limit."""
    rng = random.Random(17)
    texts = []
    for i in range(400):
        w = [f"w{rng.randrange(60 if i % 5 == 0 else 5000)}" for _ in range(rng.randrange(60, 1600))]
        for _ in range(rng.randrange(4)):
            n, at = rng.choice([5, 7, 8, 9, 30, 149, 150, 151, 200]), rng.randrange(len(w))
            put = rng.randrange(len(w))
            w[put:put] = w[at : at + n]
        texts.append(" ".join(w))
    got = {r["doc_id"]: r for r in repetition.repetition_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    by_method = set()
    for i, t in enumerate(texts):
        n_words, *_, n_repeat, longest = brute.repetition(t)
        cover = brute.covered(t, repetition.MIN_REPEAT)
        good = cover <= repetition.MAX_COVERED * n_words and longest <= repetition.MAX_LONGEST
        failed = 100 * n_repeat > 50 * n_words
        assert (got[i]["n_covered_words"], got[i]["longest_repeat"], got[i]["base_failed"], got[i]["kept"]) == (cover, longest, failed, good and not failed)
        if not failed and not good:
            by_method.add((cover > repetition.MAX_COVERED * n_words, longest > repetition.MAX_LONGEST))
    assert by_method == {(True, False), (False, True), (True, True)}


def test_suffix_arrays():
    rng = np.random.default_rng(3)
    for size, letters in ((1, 2), (50, 2), (400, 3), (300, 50)):
        x = rng.integers(1, letters + 1, size)
        want = sorted(range(size), key=lambda i: x[i:].tolist())
        assert rindex.suffix_array(x).tolist() == want == repetition.suffix_array(x)[0].tolist()


@pytest.mark.parametrize("step", [1, 7, 512])
def test_index_against_plain_search(monkeypatch, step):
    monkeypatch.setattr(rindex, "STEP", step)
    rng = random.Random(6)
    base = bytes(rng.choice(b"abc") for _ in range(200))
    parts = [base, base[50:150] + b"zz" + base[:70], b"q" * 90, bytes(rng.choice(b"abc") for _ in range(120)), base[20:90]]
    index = rindex.RunLengthIndex([np.frombuffer(p, np.uint8) for p in parts])
    got, above = index.matching_statistics()
    assert all(0 <= x <= y for x, y in zip(above, got))
    for k, p in enumerate(parts):
        for i in range(len(p)):
            longest = 0
            for m, q in enumerate(parts):
                for j in range(len(q)):
                    n = 0
                    while (m, j) != (k, i) and i + n < len(p) and j + n < len(q) and p[i + n] == q[j + n]:
                        n += 1
                    longest = max(longest, n)
            assert got[index.begin[k] + i] == longest
    assert index.runs < index.size


def test_each_string_has_one_anchor():
    import pyarrow as pa

    rng = random.Random(11)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(200))) for _ in range(30)] + ["a" * 150, "ab" * 80, "", "abc" * 90]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    for length in (20, 60):
        c = rindex.Chunk(pa.array(range(len(texts))), data, offsets, length)
        held = [s for a, b in zip(c.low, c.high) for s in range(a, b + 1)]
        assert sorted(held) == [s for a, b in zip(offsets, offsets[1:]) for s in range(a, b - length + 1)]
        anchor = {}
        for a, b, p in zip(c.low, c.high, c.at):
            for s in range(a, b + 1):
                text = data[s : s + length].tobytes()
                assert s <= p <= s + length - length // 2 and anchor.setdefault(text, p - s) == p - s


@pytest.mark.parametrize("share", [2000, 4, 1])
def test_removal_of_repeats(spark, share):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randrange(2, 7)))
    passage = " ".join(word() for _ in range(30))
    texts = [" ".join(word() for _ in range(rng.randrange(5, 60))) for _ in range(25)]
    for i in range(0, 25, 2):
        cut = rng.randrange(len(passage) // 2)
        texts[i] += passage[cut:] + word()
    texts += [passage, passage, "é" * 150, "ab" * 90, None, "", passage[:59], passage[:60], texts[3], texts[3]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rindex.remove_repeats(df, 60, share).collect()}
    assert [got[i] for i in range(len(texts))] == brute.removed(texts, 60)
    again = df.union(df.where("doc_id = 5"))
    assert {r["n_removed"] for r in rindex.remove_repeats(again, 60, share).where("doc_id = 5").collect()} == {len(texts[5].encode()) if len(texts[5]) >= 60 else 0}


@pytest.mark.parametrize("levels", [8, 2, 1])
def test_only_chosen_contexts_are_shipped(spark, monkeypatch, levels):
    """Hundreds of exact copies meet a small filter: contexts that weren't chosen stay where they are."""
    monkeypatch.setattr(common, "FILTER_BITS", 15)
    monkeypatch.setattr(rindex, "LEVELS", levels)
    shipped, made = [], rindex.chosen_contexts
    monkeypatch.setattr(rindex, "chosen_contexts", lambda texts, places, *more: shipped.append((places, made(texts, places, *more))) or shipped[-1][1])
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randrange(2, 7)))
    passages = [" ".join(word() for _ in range(25)) for _ in range(20)]
    texts = [word() + " ".join(word() for _ in range(9)) + rng.choice(passages) + word() for _ in range(300)]
    long = " ".join(word() for _ in range(300))
    rows = list(enumerate(texts + [long] * 300)) + [(-1, texts[0])] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = rindex.remove_repeats(df, 60).collect()
    assert sorted((r["doc_id"], r["n_removed"], r["kept_sha256"]) for r in got) == sorted((i, n, sha) for (i, _), (_, n, _, sha) in zip(rows, brute.removed([t for _, t in rows], 60)))
    ((places, contexts),) = shipped
    want = {(r["fp"], r["place"]) for r in places.collect()}
    rows = [(r["fp"], r["place"]) for r in contexts.collect()]
    assert len(want) > 300 and set(rows) == want and len(rows) <= 3 * len(want)


def test_sentencepiece_pieces():
    pieces = sentencepiece.Pieces()
    encoder, table = sentencepiece.Encoder(pieces), pieces.decoded()
    for text in ["", "a", " a", "a  b \n\n\tc ▁ d▁▁e 😀𝒳\x00é", " \n ", "   ", " " * 40, "▁", "執の\r\nx", "The cat sat on the mat.", "x" * 300]:
        assert sentencepiece.decode(encoder.encode(text), table) == text
    small = sentencepiece.Pieces.__new__(sentencepiece.Pieces)
    small.text = dict(enumerate(["a", "b", "ab", "abb", "▁", "▁a", "ba"]))
    small.score = {0: -3.0, 1: -3.5, 2: -4.0, 3: -8.0, 4: -1.0, 5: -4.5, 6: -3.2}
    small.bytes = {b: 100 + b for b in range(256)}
    e = sentencepiece.Encoder(small)
    rng = random.Random(8)
    for _ in range(200):
        text = "▁" + "".join(rng.choice("abc") for _ in range(rng.randrange(9)))
        ids = e.viterbi(text)
        score = sum(small.score.get(i, 0.0) for i in ids) + sum(e.fallback for i in ids if i >= 100)

        def best(t):
            if not t:
                return 0.0
            options = [small.score[i] + best(t[len(p) :]) for i, p in small.text.items() if t.startswith(p)]
            return max(options + ([e.fallback + best(t[1:])] if t[0] not in e.single else []))

        assert score == pytest.approx(best(text))
    with pytest.raises(ValueError):
        small.text = {0: "a▁b"}
        small.check()


def test_ids_are_those_of_the_public_library(spark, sf_dir):
    import sentencepiece as public

    model = public.SentencePieceProcessor(model_file=sentencepiece.MODEL)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = {r["doc_id"]: r["ids"] for r in sentencepiece.encode(docs).collect()}
    assert got == {i: model.encode(t) for i, t in texts.items()}
    encoder = sentencepiece.Encoder(sentencepiece.Pieces())
    assert [model.id_to_piece(i) for i in encoder.encode("The cat sat on the mat")] == ["▁The", "▁cat", "▁sat", "▁on", "▁the", "▁mat"]
    rng = random.Random(12)
    for alphabet in ("ab ", "aabbcc  \n", "etaoin shrdlu  ", "日本語の中執x ", "\x00é😀𝒳 \tz\r\n", "abcdefghijklmnopqrstuvwxyzABC 019.,-_()=\"'/"):
        for _ in range(500):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
            assert encoder.encode(text) == model.encode(text), text
    for text in (" " * 500, "x" * 3000 + "ab" * 3000):
        assert encoder.encode(text) == model.encode(text)


def test_decoded_table(spark):
    d = frame(spark, clash=False)
    back = sentencepiece.decode_table(sentencepiece.encode(d)).collect()
    assert sorted(r["text"] for r in back) == sorted((r[1] or "") for r in ROWS)


@pytest.mark.parametrize("first", [1, 4, 100])
def test_nearest_examples_are_those_of_a_full_scan(monkeypatch, first):
    monkeypatch.setattr(toxicity, "BLOCK", 16)
    monkeypatch.setattr(toxicity, "FIRST", first)
    rng = np.random.default_rng(9)
    vectors = [(np.sort(rng.choice(60, rng.integers(0, 6), replace=False)), None) for _ in range(700)]
    vectors = [(t, rng.integers(1, 5, len(t))) for t, _ in vectors]
    index = toxicity.Index(vectors, 60, np.arange(700) * 3, rng.integers(0, 2, 700))
    dense = np.zeros((700, 60))
    for i, (t, c) in enumerate(vectors):
        dense[i, t] = index.weigh(t, c)
    place = {int(x): i for i, x in enumerate(index.ids)}
    for t, c in vectors[:60]:
        q = np.zeros(60)
        q[t] = index.weigh(t, c)
        cosine = np.round(dense @ q, 12)
        want = [i for i in sorted(range(700), key=lambda i: (-cosine[i], i)) if cosine[i] > 0][:15]
        at, near = index.nearest(t, c, 15)
        assert [place[int(x)] for x in index.ids[at]] == at.tolist() and (index.ids[at] // 3).tolist() == want
        assert np.allclose(near, cosine[want])
        without = place[want[0] * 3] if want else None
        assert (index.ids[index.nearest(t, c, 14, without)[0]] // 3).tolist() == want[1:]


def test_toxicity_learns_and_calibrates(spark):
    rng = random.Random(10)
    docs, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        w = [f"plain{rng.randrange(300)}" for _ in range(30)]
        if bad:
            w[rng.randrange(30)] = rng.choice(["nasty", "awful"])
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    d, y = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score_toxicity(d, y).toPandas().sort_values("doc_id")
    assert (got.predicted.to_numpy() == np.array([x for _, x in labels])).mean() > 0.98
    assert got.evidence.map(lambda x: all(i % 4 == 0 for i in x)).all()
    one = toxicity.score_toxicity(d.limit(5), y.where("toxic = 1"), learn_from=d).toPandas()
    assert (one.score == 0).all() and (toxicity.score_toxicity(d, y.limit(0)).toPandas().score == 0).all()


def test_isotonic():
    x, h = toxicity.isotonic(np.array([0.1, 0.2, 0.2, 0.3, 0.4]), np.array([0, 1, 0, 0, 1.0]), np.ones(5))
    assert x.tolist() == [0.1, 0.2, 0.4] and h.tolist() == pytest.approx([0, 1 / 3, 1])


def test_language_kernel_and_odd_rows(spark):
    a, b = "The cat", "the catalog é"
    data = np.frombuffer((a + b).encode(), np.uint8)
    offsets = np.array([0, len(a), len(a) + len(b.encode())])
    one, two = (f.copy() for f in langid.presence(data, offsets))

    def grams(t):
        folded = bytes(langid.FOLD[np.frombuffer(t.encode(), np.uint8)])
        return {folded[i : i + n] for n in (1, 2, 3) for i in range(len(folded) - n + 1)}

    assert abs(one.sum() - len(grams(a))) <= 1 and abs((one & two).sum() - len(grams(a) & grams(b))) <= 1
    got = {r["doc_id"]: r for r in langid.identify(frame(spark)).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (3, 4, 5)) and got[1]["lang_pred"] != "und"
    assert langid.identify(frame(spark).withColumn("lang", F.lit(None).cast("string"))).where("lang_pred <> 'und'").count() == 0


def test_ties_and_repeated_rows_of_the_classifiers(spark):
    """Equal texts get equal scores whatever their ids, labels that contradict each other and repeated rows change nothing but the vote."""
    texts = ["the cat sat on the mat and slept", "el gato se sienta en la mesa", "die katze sitzt auf dem tisch"]
    rows = [(i, texts[i % 3], ["en", "es", "de"][i % 3], "s", 1) for i in range(90)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(df).collect()}
    assert len(set(want.values())) == 3 and all(want[i] == want[i % 3] and want[i][0] == rows[i][2] for i in want)
    halves = spark.createDataFrame([(i, texts[0], ["en", "de"][i % 2], "s", 1) for i in range(60)], SCHEMA)
    assert len({(r["lang_pred"], r["score"]) for r in langid.identify(halves).collect()}) == 1
    labels = spark.createDataFrame([(i, int(i % 3 == 1)) for i in range(90)], "doc_id long, toxic int")
    told = {r["doc_id"]: (r["score"], r["predicted"]) for r in toxicity.score_toxicity(df, labels).collect()}
    assert all(told[i] == told[i % 3] and told[i][1] == int(i % 3 == 1) for i in told)
    again = {r["doc_id"]: (r["score"], r["predicted"]) for r in toxicity.score_toxicity(df, labels.union(labels)).collect()}
    assert again == told


def test_mixing_of_odd_sources(spark):
    got = mixing.mix(frame(spark)).toPandas()
    assert (got.taken <= 2 * got["size"]).all() and got.target.notna().all()
    one = spark.createDataFrame([(i, "a b c", "s", "x", 0) for i in range(40)], SCHEMA)
    out = mixing.mix(one).toPandas()
    assert out.target.iloc[0] == 180 and abs(out.taken.sum() - 180) <= 3
    assert mixing.take(one).count() == out.copies.sum()


@pytest.mark.parametrize("heavy", [1000, 12, 1])
def test_urls(spark, monkeypatch, heavy):
    """With all, some and no urls and components broadcast."""
    monkeypatch.setattr(urls, "HEAVY", heavy)
    monkeypatch.setattr(common, "HEAVY", heavy)
    page = lambda i, url, html="": (i, url, html)
    rows = [
        page(1, "http://Sub.Example.com/en/1"), page(2, "http://www.example.com/en/1#a"), page(3, "http://x.net/es/1"), page(4, "no scheme"), page(5, None), page(6, "http://example.com?x=/en/"),
        page(7, "http://a.org/1", '<link href="http://x.net/fr/9" rel="canonical">'), page(8, "http://b.org/1", "<META http-equiv='Refresh' content='0; url=http://a.org/1'>"), page(9, "http://b.org/1"),
        page(10, "http://c.org/1", '<link rel=canonical href="//d.org/2">'), page(11, "http://d.org/2", '<link rel=canonical href="http://ok.com/1">'), page(12, "http://ok.com/1", '<link rel="canonical" href="http://y.net/es/2">'), page(13, "http://e.org/a/b", '<link rel="canonical" href="c?d#e">'), page(14, "http://e.org/a/c?d"),
        page(15, "http://f.org/x/?utm_source=a&b=1"), page(16, "HTTPS://F.org/x/?b=1", '<link rel="canonical" href="http://x.net/es/">'), page(17, "http://f.org/y/"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("verdict", F.lit("clash"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.filter_urls(df).collect()}
    assert got[1] == ("sub.example.com", "/en/1", "example.com/en/", "block") and got[2][2:] == ("www.example.com/en/", "allow") and got[3][2:] == ("net/es/", "block")
    assert got[4] == got[5] == ("", "", None, "allow") and got[6] == ("example.com", "", None, "allow")
    assert [got[i][3] for i in (7, 8, 9)] == ["block"] * 3 and got[7][2] is None
    assert [got[i][3] for i in (10, 11, 12)] == ["allow"] * 3
    assert [got[i][3] for i in (15, 16)] == ["block"] * 2 and got[17][3] == "allow"
    # The registered SQL follows the same edges; rows that repeat and very long ones change nothing.
    con, seen = duckdb.connect(), df.select("page_id", "url", "html").toPandas()
    con.execute("create table pages as select * from seen")
    assert {r[0]: r[1:] for r in con.sql(queries.ORACLES["op3_url_filter"]).fetchall()} == got
    again = df.union(df).union(spark.createDataFrame([(90, "http://b.org/1?" + "x" * 300_000, "<p>" * 300_000, "clash")], df.schema))
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.filter_urls(again).where("page_id <> 90").collect()} == got
    more = spark.createDataFrame([("http://e.org/a/c?d", "http://z.net/es/3")], "a string, b string")
    both = {r["page_id"]: r["verdict"] for r in urls.filter_urls(df, redirects=more).collect()}
    assert both[13] == both[14] == "block" and got[13][3] == "allow"
    rules = spark.createDataFrame(urls.RULES, "verdict string, host string, path string")
    table = {r["url"]: (r["rule"], r["verdict"]) for r in urls.judge_by_table(df, rules).collect()}
    assert table["http://Sub.Example.com/en/1"] == ("example.com/en/", "block") and table["http://x.net/es/1"][1] == "block" and "http://a.org/1" not in table
    assert urls.filter_urls(df.limit(0)).count() == 0


def test_chat(spark):
    rows = [(1, 0, "user", "hi <|im_end|>\\e \\l"), (1, 1, "assistant", "a\\<|x"), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, "us\ner", "tail"), (2, 0, None, "only"), (None, None, "assistant", "é"), (1, 1, "assistant", "a\\<|x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("example", F.lit("clash"))
    made = chat.examples(df)
    got = {r["conv_id"]: r for r in chat.digests(made).collect()}
    assert got[1]["n_turns"] == 6 and got[1]["loss_chars"] == 10 and got[2]["loss_chars"] == 0 and got[None]["loss_chars"] == 1
    texts = [r["text"] for r in made.where("conv_id = 1").orderBy("example").collect()]
    assert len(texts) == 4 and all(b.startswith(a) for a, b in zip(texts, texts[1:]))
    turns = made.where("conv_id = 1").orderBy(F.desc("example")).select(chat.parse(F.col("text")).alias("t")).first()["t"]
    assert [(t["role"], t["text"]) for t in turns] == [("user", rows[0][3]), ("assistant", "a\\<|x"), ("assistant", "a\\<|x"), ("user", ""), ("assistant", ""), ("us\ner", "tail")]
    assert chat.digests(chat.examples(df.limit(0))).count() == 0
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    control = "<|im_end|><|im_start|>assistant ok"
    long = [(7, i, "assistant" if i % 2 else "user", (control + "\\ é ") * 15_000) for i in range(4)]
    made = chat.examples(spark.createDataFrame(long, "conv_id long, turn long, role string, text string"))
    one = chat.digests(made).first()
    assert one["n_turns"] == 4 and one["loss_chars"] == 2 * len(long[0][3]) and made.count() == 2
    assert one["loss_sha256"] == hashlib.sha256((long[1][3] + long[3][3]).encode()).hexdigest()


def test_targets_and_ranks(spark, monkeypatch):
    rng = random.Random(14)
    names = [f"s{i:03d}" for i in range(200)] + [None]
    sizes = [(s, rng.choice([0, 1, 5, 40, 900])) for s in names for _ in range(rng.randrange(1, 4))]
    df = spark.createDataFrame(sizes, "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    total = {s: sum(n for x, n in sizes if x == s) for s in names}
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(names)}
    low, high = 0.0, 1e6
    for _ in range(200):
        level = (low + high) / 2
        low, high = (low, level) if sum(min(2 * total[s], weight[s] * level) for s in names) > 1.5 * sum(total.values()) else (level, high)
    assert got == pytest.approx({s: min(2.0 * total[s], weight[s] * low) for s in names}, abs=1e-6)
    assert mixing.targets(df.where("size = 0")).where("target <> 0").count() == 0


@pytest.mark.parametrize("share", [2000, 100_000])
def test_an_anchor_with_very_many_contexts(spark, share):
    """In dozens of indexes, and in one of more segments than symbols of 16 bits."""
    rng = random.Random(16)
    near = lambda n: "".join(rng.choices("abcdefgh", k=n))
    middle = near(45)
    texts = [near(25) + middle + near(25) for _ in range(70_000)]
    texts += [texts[i][:80] + near(20) for i in range(0, 70_000, 1000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rindex.remove_repeats(df, 60, share).collect()}
    assert [got[i] for i in range(len(texts))] == brute.removed(texts, 60)


def test_a_word_is_merged_once_whatever_marks_follow_it(monkeypatch):
    """op7: a segment is cut where no piece holds two characters side by side; ids are those of merging it whole."""
    encoder, calls = sentencepiece.Encoder(sentencepiece.Pieces()), []
    whole = encoder.merged
    monkeypatch.setattr(encoder, "merged", lambda part: (calls.append(part), whole(part))[1])
    text = "zyrtha zyrtha&&& zyrtha%%% zyrtha, zyr\u5e9ctha\U0001f600$$$ zyrtha.%%%"
    ids = encoder.encode(text)
    assert calls.count("\u2581zyrtha") == 1 and len(calls) == len(set(calls))
    assert ids == [i for x in encoder.cuts.findall(" " + text) for i in whole(x.replace(" ", sentencepiece.SPACE))]
