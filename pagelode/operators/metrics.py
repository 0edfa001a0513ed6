"""Gauges, rates and monitoring tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagelode import options as O
from pagelode.operators import spread

# What an event does to its URL. Other events change nothing.
STATE_AFTER = {"enqueue": "queued", "reserve": "inflight", "acknowledge": "visited"}
STATES = ("queued", "inflight", "visited")


def state_after(action: Column) -> Column:
    pairs = [F.lit(x) for pair in STATE_AFTER.items() for x in pair]
    return F.element_at(F.create_map(*pairs), action)


def url_states(events: DataFrame) -> DataFrame:
    """Latest state per URL. Expects `url, ts, event_id, action`."""
    steps = events.withColumn("state", state_after(F.col("action"))).where(F.col("state").isNotNull())
    return steps.groupBy("url").agg(F.max_by("state", F.struct("ts", "event_id")).alias("state"))


def frontier_gauges(states: DataFrame) -> DataFrame:
    """Queue, inflight and visited sizes, and whether no work is left."""
    sizes = states.agg(*[F.count_if(F.col("state") == s).alias(f"{s}_size") for s in STATES])
    return sizes.select(
        F.col("queued_size").alias("queue_size"), "inflight_size",
        F.col("visited_size").alias("visited_count"),
        ((F.col("queued_size") == 0) & (F.col("inflight_size") == 0)).alias("is_empty"))


def frontier_pressure(gauges: DataFrame, max_queue: int = O.CrawlOptions.max_frontier_queue_size) -> DataFrame:
    high = F.lit(max_queue > 0) & (F.col("queue_size") > F.lit(max_queue * 0.8))
    return gauges.withColumn("threshold", F.lit(max_queue).cast("long")).withColumn("pressure", high)


def crawl_rate(acks: DataFrame, batch: Column) -> DataFrame:
    """Pages per second per worker, up to the end of each of its batches.

    Expects `worker_id`, `ts`. Rows are reduced to one per worker and batch before anything
    is ordered.
    """
    per_batch = acks.groupBy("worker_id", batch.alias("batch")).agg(
        F.count(F.lit(1)).alias("batch_size"), F.min("ts").alias("_from"), F.max("ts").alias("_to"))
    so_far = W.partitionBy("worker_id").orderBy("batch").rowsBetween(W.unboundedPreceding, 0)
    elapsed = F.greatest(
        (F.unix_micros(F.max("_to").over(so_far)) - F.unix_micros(F.min("_from").over(so_far))) / F.lit(1e6),
        F.lit(1.0))
    return per_batch.withColumn("pages_crawled", F.sum("batch_size").over(so_far)) \
        .withColumn("elapsed_seconds", elapsed) \
        .withColumn("indexed_rate", F.round(F.col("pages_crawled") / F.col("elapsed_seconds"), 2)) \
        .drop("_from", "_to")


def state_changes(events: DataFrame, target: int = spread.BUCKET_ROWS) -> DataFrame:
    """Events that change a state, with the state before (null for a new URL)."""
    steps = events.withColumn("state", state_after(F.col("action"))).where(F.col("state").isNotNull()) \
        .withColumn("_at", F.col("ts").cast("timestamp"))
    return spread.previous_value(steps, "url", ["_at", "event_id"], "state", "before", target)


def monitor_ticks(events: DataFrame, seconds: int = 5,
                  max_queue: int = O.CrawlOptions.max_frontier_queue_size,
                  target: int = spread.BUCKET_ROWS) -> DataFrame:
    """Gauges and pressure at the end of every tick that saw a change.

    Each change adds one to its new state and takes one from the old; changes are summed per
    tick, and the running sum goes over ticks only, in two steps.
    """
    changes = state_changes(events, target)
    tick = F.floor(F.unix_seconds("_at") / seconds)
    net = [
        F.sum((F.col("state") == s).cast("long") - F.coalesce((F.col("before") == s).cast("long"), F.lit(0)))
        .alias(f"net_{s}") for s in STATES]
    return gauges_of(changes.groupBy(tick.alias("tick")).agg(*net), seconds, max_queue)


def gauges_of(per_tick: DataFrame, seconds: int, max_queue: int) -> DataFrame:
    """Gauges and pressure from what each tick adds to every state: tick (its number), net_<state>."""
    out = spread.bucket_offsets(per_tick, "tick", {f"net_{s}": f"_b{s}" for s in STATES})
    sizes = out.select(
        F.timestamp_seconds(F.col("tick") * seconds).alias("tick_start"),
        *[(F.col(f"net_{s}") + F.col(f"_b{s}")).alias(f"_{s}") for s in STATES])
    gauges = sizes.select(
        "tick_start", F.col("_queued").alias("queue_size"), F.col("_inflight").alias("inflight_size"),
        F.col("_visited").alias("visited_count"))
    return frontier_pressure(gauges, max_queue)
