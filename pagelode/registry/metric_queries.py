"""Gauges, rates and monitoring on the event table as a frontier log."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelode.operators import metrics
from pagelode.registry import derived as D
from pagelode.registry import query
from pagelode.registry.frontier_queries import LOG_SQL

_STATE = "CASE action WHEN 'enqueue' THEN 'queued' WHEN 'reserve' THEN 'inflight' ELSE 'visited' END"
_STATES_SQL = f"""{LOG_SQL}, states AS (
  SELECT url, arg_max({_STATE}, (ts, event_id)) AS state FROM log WHERE action IN ('enqueue', 'reserve', 'acknowledge') GROUP BY url),
gauges AS (SELECT count(*) FILTER (WHERE state = 'queued') AS queue_size, count(*) FILTER (WHERE state = 'inflight') AS inflight_size,
  count(*) FILTER (WHERE state = 'visited') AS visited_count FROM states)"""


def gauges(spark, sf_dir):
    return metrics.frontier_gauges(metrics.url_states(D.lease_events(spark, sf_dir, per_user=True)))


@query("frontier_gauges", f"WITH {_STATES_SQL} SELECT *, queue_size = 0 AND inflight_size = 0 AS is_empty FROM gauges")
def frontier_gauges(spark, sf_dir):
    return gauges(spark, sf_dir)


@query("frontier_pressure", f"""WITH {_STATES_SQL} SELECT queue_size, threshold, queue_size > threshold * 0.8 AS pressure
FROM gauges, (SELECT unnest([1000, 200000])::BIGINT AS threshold)""")
def frontier_pressure(spark, sf_dir):
    found = gauges(spark, sf_dir)
    low = metrics.frontier_pressure(found, 1000).unionByName(metrics.frontier_pressure(found, 200_000))
    return low.select("queue_size", "threshold", "pressure")


@query("crawl_rate", f"""WITH {LOG_SQL}, b AS (
  SELECT worker_id, date_trunc('day', ts)::TIMESTAMP AS batch, count(*) AS batch_size, min(ts) AS f, max(ts) AS t
  FROM log WHERE action = 'acknowledge' GROUP BY ALL),
r AS (SELECT worker_id, batch, batch_size, (sum(batch_size) OVER w)::BIGINT AS pages_crawled,
  greatest((epoch_us(max(t) OVER w) - epoch_us(min(f) OVER w)) / 1000000.0::DOUBLE, 1.0::DOUBLE) AS elapsed_seconds
  FROM b WINDOW w AS (PARTITION BY worker_id ORDER BY batch ROWS UNBOUNDED PRECEDING))
SELECT worker_id, batch, batch_size, pages_crawled, elapsed_seconds, round(pages_crawled / elapsed_seconds, 2) AS indexed_rate FROM r""")
def crawl_rate(spark, sf_dir):
    acks = D.lease_events(spark, sf_dir).where(F.col("action") == "acknowledge").withColumn("ts", F.col("ts").cast("timestamp"))
    return metrics.crawl_rate(acks, F.date_trunc("day", "ts").cast("timestamp_ntz"))


TICKS_SQL = f"""WITH {LOG_SQL}, s AS (
  SELECT url, ts, {_STATE} AS state, lag({_STATE}) OVER (PARTITION BY url ORDER BY ts, event_id) AS before
  FROM log WHERE action IN ('enqueue', 'reserve', 'acknowledge')),
d AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS tick_start,
  sum((state = 'queued')::INT - coalesce((before = 'queued')::INT, 0)) AS q,
  sum((state = 'inflight')::INT - coalesce((before = 'inflight')::INT, 0)) AS i,
  sum((state = 'visited')::INT - coalesce((before = 'visited')::INT, 0)) AS v FROM s GROUP BY 1),
c AS (SELECT tick_start, (sum(q) OVER w)::BIGINT AS queue_size, (sum(i) OVER w)::BIGINT AS inflight_size, (sum(v) OVER w)::BIGINT AS visited_count
  FROM d WINDOW w AS (ORDER BY tick_start ROWS UNBOUNDED PRECEDING))
SELECT *, 500::BIGINT AS threshold, queue_size > 400 AS pressure FROM c"""


@query("monitor_ticks", TICKS_SQL)
def monitor_ticks(spark, sf_dir):
    ticks = metrics.monitor_ticks(D.lease_events(spark, sf_dir, per_user=True), 3600, 500)
    return ticks.withColumn("tick_start", F.col("tick_start").cast("timestamp_ntz"))
