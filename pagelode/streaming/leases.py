"""Leases as keyed state with an event-time timer."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pagelode.options import CrawlOptions

# Keys of the state of URLs. A bucket that has an event is read and written as a whole; so there should be some hundred
# or thousand URLs in one, whatever the number of events.
BUCKETS = 4096
OUTPUT = "url string, at_ms long, status string, worker_id string"
_STATE = "url array<string>, status array<string>, worker_id array<string>, reserved_ms array<long>"


def url_bucket(buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64("url"), F.lit(buckets)).alias("bucket")


class LeaseTracker(StatefulProcessor):
    """queued -> inflight -> visited per URL; an unacknowledged lease runs out to queued.

    A key is a bucket of URLs and its state the rows of those URLs, so that a call, its trips to the state
    store and its frames serve many URLs. Events of a URL are taken in time order within a
    micro-batch, whose size the source's trigger options bound. A lease that ran out before the next event is seen
    at that event, otherwise by the bucket's timer, which is set to its earliest end, so the result does not depend on
    how events are batched.
    """

    def __init__(self, lease_ms: int):
        self.lease_ms = lease_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.leases = handle.getValueState("leases", _STATE)

    def _held(self) -> dict:
        kept = self.leases.get()
        return {} if kept is None else {url: rest for url, *rest in zip(*kept)}

    def _keep(self, held: dict, before: int | None) -> None:
        """Store the bucket and move its timer from the earliest end `before` to the one now."""
        if held:
            self.leases.update((list(held), *map(list, zip(*held.values()))))
        after = self._first_end(held)
        if before != after:
            if before is not None:
                self.handle.deleteTimer(before)
            if after is not None:
                self.handle.registerTimer(after)

    def _first_end(self, held: dict) -> int | None:
        since = [s for status, _, s in held.values() if status == "inflight" and s is not None]
        return min(since) + self.lease_ms if since else None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows)).sort_values(["at_ms", "event_id"])
        held = self._held()
        before, out = self._first_end(held), []
        # One null time makes floats of a column. Events without a time come last, and their leases do not end.
        times = [None if pd.isna(at) else int(at) for at in events["at_ms"].tolist()]
        for url, at, action, who in zip(events["url"].tolist(), times, events["action"].tolist(), events["worker_id"].tolist()):
            status, worker, since = held.get(url, (None, None, None))
            if status == "inflight" and None not in (at, since) and at >= since + self.lease_ms:
                out.append((url, since + self.lease_ms, "queued", worker))
                status, worker, since = held[url] = ("queued", None, None)
            if action == "enqueue" and status is None:
                held[url] = ("queued", None, None)
            elif action == "reserve" and status == "queued":
                held[url] = ("inflight", who, at)
            elif action == "acknowledge" and status != "visited":
                held[url] = ("visited", who, None)
            else:
                continue
            out.append((url, at, held[url][0], who))
        self._keep(held, before)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """All leases of the bucket that ended before the watermark: a timer set now would be seen a micro-batch later."""
        held, ended = self._held(), timerValues.getCurrentWatermarkInMs() - self.lease_ms
        out = []
        for url, (status, worker, since) in held.items():
            if status == "inflight" and since is not None and since < ended:
                out.append((url, since + self.lease_ms, "queued", worker))
                held[url] = ("queued", None, None)
        # The timer that rang is deleted by its caller.
        self._keep(held, None)
        yield self._frame(out)

    def close(self) -> None:
        pass

    @staticmethod
    def _frame(out) -> pd.DataFrame:
        urls, times, statuses, workers = zip(*out) if out else ((), (), (), ())
        return pd.DataFrame({
            "url": pd.Series(urls, dtype=object), "at_ms": pd.Series(times, dtype="Int64"),
            "status": pd.Series(statuses, dtype=object), "worker_id": pd.Series(workers, dtype=object)})


def stream_leases(events: DataFrame, lease_seconds: int = CrawlOptions.lease_seconds,
                  delay: str = "1 minute", buckets: int = BUCKETS) -> DataFrame:
    """State changes per URL. Expects `url, ts, event_id, action, worker_id`; the session needs
    the RocksDB state store. Events may come out of order by `delay`; timers wait for it. State is kept in
    `buckets` of URLs, which a checkpoint is bound to."""
    timed = (
        events.where(F.col("action").isin("enqueue", "reserve", "acknowledge"))
        .withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
        .withColumn("at_ms", F.unix_millis("ts"))
        .select("url", "ts", "at_ms", "event_id", "action", F.col("worker_id").cast("string").alias("worker_id"))
    )
    return timed.withColumn("bucket", url_bucket(buckets)).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=LeaseTracker(lease_seconds * 1000), outputStructType=OUTPUT,
        outputMode="Append", timeMode="EventTime")
