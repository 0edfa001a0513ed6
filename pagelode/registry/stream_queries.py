"""Continuous operators over the tables' files as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelode import schemas
from pagelode.functions import html, urls
from pagelode.operators import links
from pagelode.registry import derived as D
from pagelode.registry import query
from pagelode.registry import sql as S
from pagelode.registry.frontier_queries import LOG_SQL
from pagelode.registry.metric_queries import TICKS_SQL
from pagelode.registry.page_queries import _PUBLISHED, _UPSERT_SQL
from pagelode.session import workdir
from pagelode.streaming import leases, streams


def _pages(spark, sf_dir):
    return streams.file_stream(spark, sf_dir, "pages.parquet", schemas.PAGES)


def _events(spark, sf_dir):
    return streams.file_stream(spark, sf_dir, "events.parquet", schemas.EVENTS)


def _drain(stream, spark, label, schema=None, mode="append", fmt="parquet"):
    path = workdir(spark, label)
    streams.to_table(stream, f"{path}/out", f"{path}/checkpoint", mode, fmt).awaitTermination()
    return spark.read.schema(schema or stream.schema).parquet(f"{path}/out")


@query("stream_discovered", f"SELECT DISTINCT {S.norm('url')} AS url FROM pages")
def stream_discovered(spark, sf_dir):
    with streams.disk_state(spark):
        return _drain(streams.stream_discovered(_pages(spark, sf_dir).select("url")), spark, "discovered")


def _accesses(spark, sf_dir):
    return _events(spark, sf_dir).select("ts", F.concat(
        F.lit("d"), (F.col("user_id") % 20).cast("string"), F.lit(".edu")).alias("domain"))


_COUNTS_SQL = "SELECT 'd' || (user_id % 20) || '.edu' AS domain, count(*) AS n, max(ts) AS last_access FROM events GROUP BY 1"


@query("stream_domain_counts", _COUNTS_SQL)
def stream_domain_counts(spark, sf_dir):
    path = workdir(spark, "domain-counts")
    counts = streams.stream_domain_counts(_accesses(spark, sf_dir))
    streams.keep_updates(counts, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return streams.read_updates(spark, f"{path}/out", "domain", "domain string, n long, last_access timestamp_ntz")


@query("monitor_top_domains", f"SELECT * FROM ({_COUNTS_SQL}) ORDER BY n DESC, domain LIMIT 5")
def monitor_top_domains(spark, sf_dir):
    path = workdir(spark, "top-domains")
    counts = streams.stream_domain_counts(_accesses(spark, sf_dir))
    streams.stream_top_domains(counts, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return streams.read_latest(spark, f"{path}/out", "domain string, n long, last_access timestamp_ntz")


@query("stream_index_upsert", _UPSERT_SQL)
def stream_index_upsert(spark, sf_dir):
    docs = html.parse_pages(_pages(spark, sf_dir), S.DOMAINS).select(
        "page_id", urls.normalize_url(F.col("url")).alias("url"), "title", "content", F.size("links").cast("long").alias("n_links"),
        F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01 00:00:00")) + F.col("page_id")).cast("timestamp_ntz").alias("fetched_at"))
    path = workdir(spark, "index-stream")
    order = ["fetched_at", "page_id"]
    streams.stream_index_upsert(docs, path, f"{path}/checkpoint", order).awaitTermination()
    return streams.read_index_stream(
        spark, path, "url string, page_id long, title string, content string, n_links long, fetched_at timestamp_ntz", order).drop("page_id")


@query("stream_url_batches", f"""WITH {S.LINKS} SELECT link AS url, 1 AS depth, '{_PUBLISHED}' AS published_at, count(*) AS n
FROM links WHERE ({S.verdict('link')}) = 'ok' GROUP BY link""")
def stream_url_batches(spark, sf_dir):
    """Accepted links go out as JSON messages and are read back as a second stream."""
    docs = html.parse_pages(_pages(spark, sf_dir), S.DOMAINS, want=("links",))
    items = links.accepted(links.link_rows(docs, ("page_id",))).select("page_id", "pos", F.col("link").alias("url"), F.lit(1).alias("depth"))
    path = workdir(spark, "url-batches")
    streams.stream_url_batches(items, f"{path}/out", f"{path}/sent", F.lit(_PUBLISHED), ["page_id", "pos"]).awaitTermination()
    back = _drain(streams.read_url_batch_stream(spark, f"{path}/out"), spark, "url-batches-read")
    return back.groupBy("url", "depth", "published_at").agg(F.count(F.lit(1)).alias("n"))


@query("monitor_ticks_stream", f"""WITH {LOG_SQL} SELECT time_bucket(INTERVAL 1 HOUR, ts) AS tick_start,
  count(*) FILTER (WHERE action = 'enqueue') AS to_queued, count(*) FILTER (WHERE action = 'reserve') AS to_inflight,
  count(*) FILTER (WHERE action = 'acknowledge') AS to_visited FROM log GROUP BY 1""")
def monitor_ticks_stream(spark, sf_dir):
    kind = F.create_map(*[F.lit(x) for p in {
        "signup": "enqueue", "view": "reserve", "purchase": "acknowledge"}.items() for x in p])
    events = _events(spark, sf_dir).select("ts", kind[F.col("event_type")].alias("action"))
    ticks = streams.stream_ticks(events, "1 hour").withColumn("tick_start", F.col("tick_start").cast("timestamp_ntz"))
    path = workdir(spark, "ticks")
    streams.keep_updates(ticks, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return streams.read_updates(spark, f"{path}/out", "tick_start",
                                "tick_start timestamp_ntz, to_queued long, to_inflight long, to_visited long")


@query("stream_gauges", TICKS_SQL)
def stream_gauges(spark, sf_dir):
    """Queue, inflight, visited and pressure at the end of every tick, from the stream."""
    path = workdir(spark, "gauges")
    with streams.disk_state(spark):
        events = D.lease_events(spark, sf_dir, per_user=True, rows=_events(spark, sf_dir))
        streams.stream_gauges(events, f"{path}/out", f"{path}/checkpoint", 3600).awaitTermination()
    ticks = streams.read_gauges(spark, f"{path}/out", 3600, 500)
    return ticks.withColumn("tick_start", F.col("tick_start").cast("timestamp_ntz"))


_DAY = 86_400_000
_RAN_OUT = f"acc.status = 'inflight' AND e.at >= acc.since + {_DAY}"
_TAKES = f"e.action = 'reserve' AND (acc.status = 'queued' OR ({_RAN_OUT}))"
# The state machine as a fold over the ordered events of each URL; a lease still running at the
# end is given back if it ran out before the end of the log, less the delay.
_LEASES_SQL = f"""WITH ev AS (
  SELECT 'https://en.wikipedia.org/wiki/K' || regexp_extract(props, '[0-9]+') || '_' || user_id AS url, epoch_us(ts) // 1000 AS at_ms, event_id,
    CASE event_type WHEN 'signup' THEN 'enqueue' WHEN 'view' THEN 'reserve' ELSE 'acknowledge' END AS action, 'worker-' || user_id AS worker
  FROM events WHERE event_type IN ('signup', 'view', 'purchase')),
ended AS (SELECT max(at_ms) - 60000 AS until FROM ev),
seqs AS (SELECT url, list({{'at': at_ms, 'action': action, 'worker': worker}} ORDER BY at_ms, event_id) AS es FROM ev GROUP BY url),
run AS (SELECT url, list_reduce(es, lambda acc, e: {{
    'status': CASE WHEN e.action = 'enqueue' AND acc.status = '' THEN 'queued'
      WHEN {_TAKES} THEN 'inflight'
      WHEN e.action = 'acknowledge' THEN 'visited'
      WHEN {_RAN_OUT} THEN 'queued' ELSE acc.status END,
    'worker': CASE WHEN {_TAKES} THEN e.worker ELSE acc.worker END,
    'since': CASE WHEN {_TAKES} THEN e.at ELSE acc.since END,
    'out': acc.out
      || CASE WHEN {_RAN_OUT} THEN [{{'at_ms': acc.since + {_DAY}, 'status': 'queued', 'worker_id': acc.worker}}] ELSE [] END
      || CASE WHEN e.action = 'enqueue' AND acc.status = '' THEN [{{'at_ms': e.at, 'status': 'queued', 'worker_id': e.worker}}]
           WHEN {_TAKES} THEN [{{'at_ms': e.at, 'status': 'inflight', 'worker_id': e.worker}}]
           WHEN e.action = 'acknowledge' AND acc.status <> 'visited' THEN [{{'at_ms': e.at, 'status': 'visited', 'worker_id': e.worker}}] ELSE [] END
  }}, {{'status': '', 'worker': '', 'since': 0::BIGINT, 'out': []::STRUCT(at_ms BIGINT, status VARCHAR, worker_id VARCHAR)[]}}) AS fin FROM seqs),
tail AS (SELECT url, unnest(fin.out) AS o FROM run UNION ALL
  SELECT url, {{'at_ms': fin.since + {_DAY}, 'status': 'queued', 'worker_id': fin.worker}} FROM run, ended
  WHERE fin.status = 'inflight' AND fin.since + {_DAY} <= until)
SELECT url, o.at_ms AS at_ms, o.status AS status, o.worker_id AS worker_id FROM tail"""


@query("stream_leases", _LEASES_SQL)
def stream_leases(spark, sf_dir):
    """State changes of every URL's lease; leases last a day here."""
    with streams.disk_state(spark):
        events = D.lease_events(spark, sf_dir, per_user=True, rows=_events(spark, sf_dir))
        return _drain(leases.stream_leases(events, 86400), spark, "leases", leases.OUTPUT)
