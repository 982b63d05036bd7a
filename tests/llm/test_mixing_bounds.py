"""Mixing with more sources than a broadcast may hold, and with duals that don't settle."""

import pytest
from pyspark.sql import functions as F

from tallyguard.llm import common, mixing


def docs(spark, n=400, sources=9):
    return spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 4, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % sources)).alias("source"), F.repeat(F.lit("word "), (F.col("id") * 7 % 40).cast("int")).alias("text"))


@pytest.mark.parametrize("rows", [0, 4, 100])
def test_sources_beyond_a_broadcast(spark, monkeypatch, rows):
    want = sorted(map(tuple, mixing.mix(docs(spark)).collect()))
    monkeypatch.setattr(common, "BROADCAST_ROWS", rows)
    assert sorted(map(tuple, mixing.mix(docs(spark)).collect())) == want
    taken = mixing.take(docs(spark)).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in taken} == {r[0]: r[5] for r in want if r[5]}


def test_fills_are_counted_before_they_are_sent(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 100)
    few = spark.createDataFrame([("a", [0.5] * 10)], "source string, fill array<double>")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(few.join(mixing._sent(few.select(F.col("source").alias("s"), "fill")), F.col("source") == F.col("s")))
    many = spark.createDataFrame([("a", [0.5] * 1000)], "source string, fill array<double>")
    assert "broadcast" not in plan(many.join(mixing._sent(many.select(F.col("source").alias("s"), "fill")), F.col("source") == F.col("s")))


def test_duals_that_do_not_settle_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_STEPS", 1)
    with pytest.raises(ValueError, match="no dual variable"):
        mixing.mix(docs(spark)).collect()
