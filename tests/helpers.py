"""Rows of transactions for tests, and the comparison of a query with its oracle."""

from __future__ import annotations

import datetime
import os

import duckdb
import pandas as pd
from pyspark.sql import Row

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
T0 = datetime.datetime(2026, 9, 1, 12, 0, 0)
RAW_ROW = dict(Trans_id=1, Clt_id=10, Card_id=100, Dev_id=1000, Trans_amount=500, Trans_date="2026-09-01 01:00:00 PM", Trans_type="Withdrawal", Trans_status="Successful", Trans_destination="CIB", Dev_Ip_Location="Cairo", Trans_Ref_No="R1", Currency="USD", Trans_Reason="Shopping", Dest_account_No=123, Country_Dest="Egypt", Country_Src="Egypt")


def silver_frame(spark, rows):
    """rows: (id, seconds after T0, amount, {changes})."""
    from decimal import Decimal

    from tallyguard.schemas import SILVER

    out = []
    for i, seconds, amount, more in rows:
        t = T0 + datetime.timedelta(seconds=seconds)
        base = dict(transaction_id=i, client_id=1, card_id=1, device_id=7, fx_rate=Decimal(1), amount_usd=Decimal(str(amount)), currency="USD", txn_type="Withdrawal", status="Successful", destination_bank="CIB", device_location="Cairo", ref_no=f"R{i}", reason="x", dest_account_no=1, country_src="Egypt", country_dest="Egypt", event_time=t, event_date=t.date(), ingest_time=t)
        out.append(Row(**(base | more)))
    return spark.createDataFrame([tuple(r[c] for c in SILVER.fieldNames()) for r in out], SILVER)


def raw_frame(spark, rows, first_offset=0):
    from tallyguard.schemas import DECODED

    out = []
    for k, change in enumerate(rows):
        r = RAW_ROW | {"kafka_partition": 0, "kafka_offset": first_offset + k, "kafka_timestamp": T0, "kafka_confluent_magic": "00", "kafka_schema_id": 1} | change
        out.append(tuple(r[c] for c in DECODED.fieldNames()))
    return spark.createDataFrame(out, DECODED)


def oracle(sf_dir, sql):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con.sql(sql).df()


def same(a: pd.DataFrame, b: pd.DataFrame) -> None:
    assert sorted(a.columns) == sorted(b.columns)

    def value(x):
        if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and x != x):
            return None
        x = x.item() if hasattr(x, "item") else x
        return int(x) if isinstance(x, (bool, int)) else round(x, 6) if isinstance(x, float) else str(x)

    def rows(d):
        return sorted((tuple(map(value, r)) for r in d[sorted(d.columns)].astype(object).itertuples(index=False, name=None)), key=str)

    assert rows(a) == rows(b)
