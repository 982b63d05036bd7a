"""Decisions against labels: confusion counts, precision and recall, by pattern and by rule. A zero denominator gives null."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.functions.aggregates import count_where


def joined(decisions: DataFrame, labels: DataFrame) -> DataFrame:
    return decisions.join(labels, decisions["transaction_id"] == labels["Trans_id"], "inner")


def confusion(matched: DataFrame) -> DataFrame:
    said, true = F.col("decision") != "PASS", F.col("is_fraud") == 1
    return matched.agg(count_where(said & true).alias("tp"), count_where(said & ~true).alias("fp"), count_where(~said & true).alias("fn"), count_where(~said & ~true).alias("tn"))


def precision_recall(counts: DataFrame) -> DataFrame:
    ratio = lambda a, b: F.col(a).cast("double") / F.nullif(F.col(a) + F.col(b), F.lit(0)).cast("double")
    rated = counts.withColumn("precision", ratio("tp", "fp")).withColumn("recall", ratio("tp", "fn"))
    return rated.withColumn("f1", 2 * F.col("precision") * F.col("recall") / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0)))


def recall_by_pattern(matched: DataFrame) -> DataFrame:
    return matched.where("is_fraud = 1").groupBy("pattern").agg(F.count("*").alias("n"), F.avg((F.col("decision") != "PASS").cast("double")).alias("recall")).orderBy("pattern")


def precision_by_rule(matched: DataFrame) -> DataFrame:
    fired = matched.select("is_fraud", F.explode(F.coalesce("matched_rules", F.array().cast("array<string>"))).alias("rule"))
    return fired.groupBy("rule").agg(F.count("*").alias("fired"), F.avg(F.col("is_fraud").cast("double")).alias("precision")).orderBy("rule")


def report(decisions: DataFrame, labels: DataFrame) -> dict:
    """All of the above as one document; raises when no decision has a label."""
    matched = joined(decisions, labels).select("decision", "is_fraud", "pattern", "matched_rules").persist()
    try:
        counts = precision_recall(confusion(matched)).first().asDict()
        total = counts["tp"] + counts["fp"] + counts["fn"] + counts["tn"]
        if not total:
            raise ValueError("no decision has a label: are these the right tables?")
        return {"n_matched": total, "n_decisions": decisions.count(), "n_labels": labels.count(), "counts": counts, "per_pattern_recall": [r.asDict() for r in recall_by_pattern(matched).collect()], "per_rule_precision": [r.asDict() for r in precision_by_rule(matched).collect()]}
    finally:
        matched.unpersist()
