"""Quality contract over Silver: all expectations in one aggregate, a report, and a gate. Also recovery checks."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.config import QualityContract
from tallyguard.functions.aggregates import count_where


def validation_report(df: DataFrame, contract: QualityContract | None = None) -> DataFrame:
    """(expectation, column, success, unexpected_count, element_count), one row for each expectation."""
    return _reported(df.groupBy(), contract or QualityContract())


def daily_reports(df: DataFrame, contract: QualityContract | None = None, date: str = "event_date") -> DataFrame:
    """The report of each day that has rows, all days in one aggregate: the day, then the report's columns."""
    return _reported(df.groupBy(date), contract or QualityContract(), date)


def _reported(groups, contract: QualityContract, *keys: str) -> DataFrame:
    checks = [("not_null", c, F.col(c).isNull()) for c in contract.not_null]
    checks += [("bounded_below", c, F.col(c) <= low if strict else F.col(c) < low) for c, low, strict in contract.bounded]
    counts = groups.agg(F.count("*").alias("n"), *(count_where(bad).alias(f"b{i}") for i, (_, _, bad) in enumerate(checks)))
    rows = F.array(*(F.struct(F.lit(kind).alias("expectation"), F.lit(c).alias("column"), (F.col(f"b{i}") == 0).alias("success"), F.col(f"b{i}").alias("unexpected_count"), F.col("n").alias("element_count")) for i, (kind, c, _) in enumerate(checks)))
    return counts.select(*keys, F.inline(rows))


def gate(report: DataFrame) -> dict:
    """The report as a document; raises with the names of what failed, or when there were no rows."""
    rows = [r.asDict() for r in report.collect()]  # one row for each expectation
    failed = [f"{r['expectation']}:{r['column']}" for r in rows if not r["success"]]
    if not rows or not rows[0]["element_count"]:
        raise ValueError("nothing to validate: the source has no rows")
    if failed:
        raise ValueError(f"failed expectations: {', '.join(failed)}")
    return {"success": True, "row_count": rows[0]["element_count"], "expectations": rows}


def validate_day(silver: DataFrame, event_date, contract: QualityContract | None = None) -> str:
    """Gate one day's Silver rows; the report as JSON."""
    return json.dumps(gate(validation_report(silver.where(F.col("event_date") == F.lit(event_date)), contract)), default=str)


def recovery_check(df: DataFrame, first: tuple[int, int], second: tuple[int, int], least: int = 1, column: str = "transaction_id") -> DataFrame:
    """One row: counts in two id ranges, rows and distinct ids, and whether nothing was lost or doubled."""
    counted = df.agg(count_where(F.col(column).between(*first)).alias("first_range"), count_where(F.col(column).between(*second)).alias("second_range"), F.count("*").alias("row_count"), F.countDistinct(column).alias("distinct_ids"))
    return counted.withColumn("ok", (F.col("first_range") >= least) & (F.col("second_range") >= least) & (F.col("row_count") == F.col("distinct_ids")))
