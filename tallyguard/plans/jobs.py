"""Batch jobs: the daily Gold tables behind the quality gate."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tallyguard.config import QualityContract
from tallyguard.operators import gold, quality
from tallyguard.store import TableStore


def run_gold(store: TableStore, run_date: datetime.date, lookback: int = 1, contract: QualityContract | None = None) -> dict:
    """Gold for run_date and the days before it in one job. A day without decisions gets a row of zeros and loses the
    customer rows of an earlier run. Raises before anything is written if the day's Silver rows break the contract."""
    spark = store.spark
    days = gold.calendar(spark, run_date, lookback)
    wanted = [run_date - datetime.timedelta(days=i) for i in range(max(1, lookback))]
    checked = store.read("silver").where(F.col("event_date").isin(wanted))
    report = None if checked.isEmpty() else quality.gate(quality.validation_report(checked, contract))
    decisions = store.read("decisions").where(F.col("event_date").isin(wanted))
    store.clear_days("customer_daily_risk", wanted)
    store.overwrite_days("customer_daily_risk", gold.customer_daily_risk(decisions))
    store.overwrite_days("daily_kpis", gold.daily_kpis(decisions, days))
    return {"days": [str(d) for d in wanted], "quality": report}
