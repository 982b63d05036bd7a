"""Risk rules, score and decision.

The pairing of a large deposit with its withdrawal needs no list of the window's rows: some withdrawal of the next half
hour reaches the ratio if the largest does, and some large deposit of the last half hour is matched if the smallest is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.config import RulesConfig
from tallyguard.operators.features import device_is_new, seconds, sequence, within

#: The order in which matched rules are listed.
RULE_ORDER = ("HIGH_AMOUNT", "STRUCTURING", "IMPOSSIBLE_TRAVEL", "MULE", "VELOCITY", "NEW_DEVICE_HIGH_VALUE")


def structured(config: RulesConfig) -> Column:
    return F.col("amount_usd").between(config.structuring_min_usd, config.structuring_max_usd)


def withdrawn() -> Column:
    """The amount of a withdrawal."""
    return F.when(F.col("txn_type") == "Withdrawal", F.col("amount_usd"))


def large_deposit(config: RulesConfig) -> Column:
    """The amount of a deposit that a withdrawal may match."""
    return F.when((F.col("txn_type") == "Deposit") & (F.col("amount_usd") >= config.mule_min_deposit_usd), F.col("amount_usd"))


def frames(config: RulesConfig) -> dict[str, Column]:
    """The windows that rules stand on, by name."""
    return {
        "_rule_count": F.count(F.lit(1)).over(within(config.velocity_seconds)),
        "_structured": F.sum(F.when(structured(config), 1).otherwise(0)).over(within(config.structuring_seconds)),
        "_next_out": F.max(withdrawn()).over(within(0, config.mule_seconds)),
        "_last_in": F.min(large_deposit(config)).over(within(config.mule_seconds)),
        "_rule_seconds": F.lag(seconds()).over(sequence()),
        "_rule_country": F.lag("country_src").over(sequence()),
        "_rule_new": device_is_new(config.new_device_seconds),
    }


def rule_flags(config: RulesConfig, frame: dict[str, Column] | None = None) -> dict[str, Column]:
    """One condition for each rule; a null counts as not matched."""
    frame, amount, kind = frame or frames(config), F.col("amount_usd"), F.col("txn_type")
    ratio = F.lit(config.mule_ratio).cast("decimal(4,2)")
    travelled = (frame["_rule_country"] == config.home_country) & F.col("country_src").isin(*config.far_countries) & (seconds() - frame["_rule_seconds"] <= config.travel_seconds)
    mule = (large_deposit(config).isNotNull() & (frame["_next_out"] >= amount * ratio)) | ((kind == "Withdrawal") & (amount >= frame["_last_in"] * ratio))
    return {
        "HIGH_AMOUNT": amount >= config.high_amount_usd,
        "STRUCTURING": structured(config) & (frame["_structured"] >= config.structuring_count),
        "IMPOSSIBLE_TRAVEL": travelled,
        "MULE": mule,
        "VELOCITY": frame["_rule_count"] >= config.velocity_count,
        "NEW_DEVICE_HIGH_VALUE": frame["_rule_new"] & (amount >= config.new_device_usd),
    }


def apply_rules(history: DataFrame, config: RulesConfig | None = None, frame: dict[str, Column] | None = None) -> DataFrame:
    """``history`` (Silver rows, with or without features) plus matched_rules, risk_score and decision."""
    config = config or RulesConfig()
    flags = rule_flags(config, frame)
    wide = history.select("*", *(F.coalesce(flags[r], F.lit(False)).alias(f"_{r}") for r in RULE_ORDER))
    points = sum((F.when(F.col(f"_{r}"), config.weights[config.severity[r]]).otherwise(0) for r in RULE_ORDER), F.lit(0))
    severe = [F.col(f"_{r}") for r in RULE_ORDER if config.severity[r] == "HIGH"] or [F.lit(False)]
    any_severe = severe[0]
    for s in severe[1:]:
        any_severe = any_severe | s
    out = wide.withColumn("matched_rules", F.array_compact(F.array(*(F.when(F.col(f"_{r}"), F.lit(r)) for r in RULE_ORDER))))
    out = out.withColumn("risk_score", F.least(points, F.lit(100)).cast("int")).withColumn("decision", F.when(any_severe, "BLOCK").when(F.size("matched_rules") > 0, "FLAG").otherwise("PASS"))
    return out.select(*history.columns, "matched_rules", "risk_score", "decision")


def apply_policy(decided: DataFrame, members: list[str], threshold: float = 0.70) -> DataFrame:
    """Raise scores and decisions by the largest member probability (a missing one is 0): PASS becomes FLAG from the
    threshold on, BLOCK stays. The member columns go, ml_probability comes."""
    if not members:
        raise ValueError("the ensemble has no members")
    probability = F.greatest(*(F.coalesce(F.col(c), F.lit(0.0)) for c in members), F.lit(0.0))
    out = decided.withColumn("ml_probability", probability).drop(*members)
    out = out.withColumn("risk_score", F.greatest(F.col("risk_score"), F.round(F.col("ml_probability") * 100).cast("int")))
    return out.withColumn("decision", F.when(F.col("decision") == "BLOCK", "BLOCK").when(F.col("ml_probability") >= threshold, "FLAG").otherwise(F.col("decision")))


def without_model(decided: DataFrame) -> DataFrame:
    """Rules-only decisions in the full layout: a null probability."""
    return decided.withColumn("ml_probability", F.lit(None).cast("double"))
