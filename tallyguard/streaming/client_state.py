"""Point-in-time features of a stream from state kept for each client, instead of history that is read again.

What add_features() reads from windows is kept by client: the rows of the last hour, the last 30 amounts, the row before, and the second
of each device's last use. A client's rows of a micro-batch are taken second by second, so that rows of one second see each other, as in a RANGE
frame. Where events come in order and no second is split over two batches, the features are those of add_features() over the
whole table; a row that comes late, within the watermark, sees what the state then holds.

An event-time timer clears a client's state 30 days after its last event, and the devices not used for as long go within a day of the client's
time. State lies in RocksDB, in partitions by client; a hot client is one key, whose rows of one micro-batch a task takes one after the other.
Each call of the state is an answer to wait for, so nearly all of it lies in one value, and a timer is set again only when it has run out.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from decimal import Decimal
from itertools import groupby

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tallyguard.operators.features import DEVICE_SECONDS, PRIOR_ROWS, SUM_SECONDS, VELOCITY_SECONDS, seconds
from tallyguard.schemas import FEATURE_NAMES

OUT = "transaction_id bigint, client_id bigint, event_time timestamp, " + ", ".join(f"{c} double" for c in FEATURE_NAMES)
MADE = Row(*(c.split()[0] for c in OUT.split(", ")))
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY = 86400

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package


def both(amount):
    """An amount as it is and as a float."""
    return None if amount is None else (amount, float(amount))


def mean_and_deviation(amounts: list) -> tuple[float, float]:
    known = [x for x in amounts if x is not None]
    if not known:
        return 0.0, 0.0
    mean = float(sum(x for x, _ in known)) / len(known)
    return mean, math.sqrt(sum((x - mean) ** 2 for _, x in known) / len(known))


#: What is kept of a client in one value, so that its rows of a micro-batch cost one read and one write of it, however many there are.
HELD = "seconds bigint, country string, expires bigint, oldest bigint, recent_seconds array<bigint>, recent_amounts array<string>, prior array<string>, near array<bigint>, near_seconds array<bigint>, far boolean"
#: The value has the last uses of so many devices. Each device has a row of its own too, which is written when it comes and when it leaves the value, and
#: read only of one that isn't in the value, if any has left it.
NEAR_DEVICES = 32


class ClientFeatures(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.client = handle.getValueState("client", HELD)
        self.devices = handle.getMapState("devices", "device bigint", "seconds bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        rows = sorted(rows, key=lambda r: (r["_seconds"], r["transaction_id"]))
        number = lambda x: None if x is None else Decimal(x)
        held = self.client.get()
        before, country, _, oldest, times, amounts, prior, devices, uses, far = held if held is not None else (None, None, None, None, (), (), (), (), (), False)
        recent, prior, near, fresh = list(zip(times, map(number, amounts))), [both(number(a)) for a in prior], dict(zip(devices, uses)), held is None
        for now, peers in groupby(rows, key=lambda r: r["_seconds"]):
            peers = list(peers)
            recent = [x for x in recent if x[0] >= now - SUM_SECONDS] + [(now, r["amount_usd"]) for r in peers]
            count = float(sum(now - VELOCITY_SECONDS <= t <= now for t, _ in recent))
            total = float(sum(a for t, a in recent if a is not None and t <= now))
            seen = {d: self._use(d, near, far) for d in {r["device_id"] for r in peers if r["device_id"] is not None}}
            for r in peers:
                device, amount = r["device_id"], r["amount_usd"]
                mean, deviation = mean_and_deviation(prior)
                new = before is not None and (device is None or seen[device] is None or now - seen[device] > DEVICE_SECONDS)
                changed = before is not None and country is not None and r["country_src"] is not None and r["country_src"] != country
                ratio = 1.0 if mean <= 0 else float(amount) / mean if amount is not None else None
                yield MADE(r["transaction_id"], key[0], r["event_time"], count, total, mean, deviation, float(max(0, now - before)) if before is not None else 0.0, float(new), float(changed), ratio)
                before, country, prior = now, r["country_src"], [*prior, both(amount)][-PRIOR_ROWS:]
            for device, use in seen.items():
                if use is None:
                    self.devices.updateValue((device,), (now,))
                near[device] = max(now, use or now)
        oldest = min((t for t in (oldest, *near.values()) if t is not None), default=None)
        if oldest is not None and oldest < before - DEVICE_SECONDS - DAY:  # no device is looked for before one of them can go
            oldest = self._prune(near, before - DEVICE_SECONDS)
        for device in sorted(near, key=near.get)[:-NEAR_DEVICES]:
            self.devices.updateValue((device,), (near.pop(device),))
            far = True
        expires = (max(before, *(t for t, _ in recent)) + DEVICE_SECONDS) * 1000
        if fresh:
            self.handle.registerTimer(expires)
        text = lambda x: None if x is None else str(x)
        self.client.update((before, country, expires, oldest, [t for t, _ in recent], [text(a) for _, a in recent], [text(a and a[0]) for a in prior], list(near), list(near.values()), far))

    def _use(self, device: int, near: dict, far: bool) -> int | None:
        """The second of a device's last use before now."""
        if device in near or not far:
            return near.get(device)
        found = self.devices.getValue((device,))
        return found[0] if found is not None else None

    def _prune(self, near: dict, since: int) -> int | None:
        """Let the devices go that were last used before ``since``; the least second of those that stay."""
        held = {device: near.get(device, t) for (device,), (t,) in list(self.devices.iterator())}
        for device, t in held.items():
            if t < since:
                self.devices.removeKey((device,))
                near.pop(device, None)
        return min((t for t in held.values() if t >= since), default=None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """A client has one timer, set by its first rows. Where later ones came, it is set again for the end that they have moved."""
        expires = self.client.get()[2]
        if expires > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(expires)
        else:
            self.client.clear()
            self.devices.clear()
        return iter([])

    def close(self) -> None:
        pass


def stream_features(silver: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """(transaction_id, client_id, event_time, features) of a stream of Silver rows. The session must keep state in RocksDB."""
    rows = silver.select("transaction_id", "client_id", "device_id", "amount_usd", "country_src", "event_time").withWatermark("event_time", watermark).withColumn("_seconds", seconds())
    return rows.groupBy("client_id").transformWithState(ClientFeatures(), OUT, "append", "EventTime")


def run_features(spark: SparkSession, silver: DataFrame, target: str, checkpoint: str, interval: str | None = None, watermark: str = "2 hours"):
    """Start the query into Parquet files; with ``interval`` None it takes what is there and ends. A later start goes on from the checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return stream_features(silver, watermark).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(**trigger).start()
