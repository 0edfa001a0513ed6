"""Frontier operators on URLs of the page store and on the event table as a lease log."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelode.functions import urls
from pagelode.operators import frontier
from pagelode.registry import derived as D
from pagelode.registry import query
from pagelode.registry import sql as S
from pagelode.session import through_table, workdir

# Candidates are the links of all pages. Links with a short last segment count as visited, those
# a letter longer as discovered.
_CAND_SQL = f"""{S.LINKS}, cand AS (
  SELECT page_id * 64 + pos AS seq, {S.norm('link')} AS url, 1 AS depth FROM links UNION ALL
  SELECT page_id * 64, '' AS url, 1 FROM pages WHERE contains(url, 'utm_source')),
visited AS (SELECT DISTINCT url FROM cand WHERE length({S.last_segment('url')}) BETWEEN 1 AND 2),
discovered AS (SELECT DISTINCT url FROM cand WHERE length({S.last_segment('url')}) BETWEEN 1 AND 3),
acks AS (SELECT {S.netloc('url')} AS domain, count(*) AS n FROM pages GROUP BY 1)"""


def candidates(spark, sf_dir):
    """Stored, since every set below is made from them."""
    links = D.page_links(spark, sf_dir).select(
        (F.col("page_id") * 64 + F.col("pos")).alias("seq"), F.col("link").alias("url"), F.lit(1).alias("depth"))
    blank = D.pages(spark, sf_dir).where(F.contains("url", F.lit("utm_source"))).select(
        (F.col("page_id") * 64).alias("seq"), F.lit("").alias("url"), F.lit(1).alias("depth"))
    return through_table(links.unionByName(blank), workdir(spark, "candidates"))


def short(rows, most):
    u = urls.normalize_url(F.col("url"))
    return rows.select(u.alias("url")).where(F.length(urls.last_segment(F.col("url"))).between(1, most)).distinct()


def page_urls(spark, sf_dir):
    return D.pages(spark, sf_dir).select("page_id", urls.normalize_url(F.col("url")).alias("url"))


def page_domains(spark, sf_dir):
    rows = D.pages(spark, sf_dir).select(urls.url_domain(F.col("url")).alias("domain"))
    return rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n"))


_STATUS_SQL = f"""{_CAND_SQL}, facts AS (
  SELECT c.*, v.url IS NOT NULL AS vis, d.url IS NOT NULL AS dis, coalesce(a.n, 0) >= 5 AS over
  FROM cand c LEFT JOIN visited v ON c.url = v.url LEFT JOIN discovered d ON c.url = d.url
  LEFT JOIN acks a ON a.domain = {S.netloc('c.url')}),
firsts AS (SELECT url, min(seq) AS seq FROM facts WHERE url <> '' AND NOT vis AND NOT dis AND NOT over GROUP BY url),
placed AS (SELECT url, seq, row_number() OVER (ORDER BY seq) AS place FROM firsts),
counted AS (
  SELECT f.*, p.seq AS first_seq, p.place,
    count(q.seq) OVER (ORDER BY f.seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM facts f LEFT JOIN placed p ON f.url = p.url LEFT JOIN placed q ON f.seq = q.seq),
status AS (
  SELECT seq, url, depth, CASE WHEN url = '' THEN 'dropped' WHEN vis THEN 'visited' WHEN dis THEN 'exists'
    WHEN NOT over AND seq <> first_seq AND place <= 300 THEN 'exists' WHEN before >= 300 THEN 'throttled'
    WHEN over THEN 'domain_budget_exceeded' ELSE 'added' END AS status FROM counted)"""


def statuses(spark, sf_dir):
    rows = candidates(spark, sf_dir)
    return frontier.admission(
        rows, short(rows, 2), short(rows, 3), page_domains(spark, sf_dir), queue_size=100, max_queue=400,
        default_budget=5)


@query("seed_scan", f"""SELECT page_id AS seq, {S.clean('url')} AS url, 0 AS depth, CAST(NULL AS DOUBLE) AS score
FROM pages WHERE {S.valid('url')}""")
def seed_scan(spark, sf_dir):
    none = spark.createDataFrame([], "url string")
    start = D.pages(spark, sf_dir).select(F.col("page_id").alias("seq"), "url")
    return frontier.seeds(start, none, none, S.DOMAINS)


@query("visited_lookup", f"""WITH {_CAND_SQL} SELECT seq, url, TRUE AS is_visited FROM cand WHERE url IN (SELECT url FROM visited) UNION ALL
SELECT seq, url, FALSE FROM cand WHERE url NOT IN (SELECT url FROM visited)""")
def visited_lookup(spark, sf_dir):
    rows = candidates(spark, sf_dir).select("seq", "url")
    seen = short(rows, 2)
    return frontier.visited_lookup(rows, seen).withColumn("is_visited", F.lit(True)).unionByName(
        frontier.visited_lookup(rows, seen, False).withColumn("is_visited", F.lit(False)))


@query("discovered_antijoin", f"WITH {_CAND_SQL} SELECT seq, url FROM cand WHERE url NOT IN (SELECT url FROM discovered)")
def discovered_antijoin(spark, sf_dir):
    rows = candidates(spark, sf_dir).select("seq", "url")
    return frontier.unseen(rows, short(rows, 3))


@query("frontier_except", f"""WITH {_CAND_SQL} SELECT DISTINCT url FROM cand WHERE url NOT IN (SELECT url FROM visited)
AND url NOT IN (SELECT url FROM discovered)""")
def frontier_except(spark, sf_dir):
    rows = candidates(spark, sf_dir).select("url")
    return frontier.unseen(rows.distinct(), short(rows, 2), short(rows, 3))


@query("discovered_union", f"WITH {_CAND_SQL} SELECT url FROM discovered UNION SELECT {S.norm('url')} FROM pages")
def discovered_union(spark, sf_dir):
    return frontier.set_union(short(candidates(spark, sf_dir), 3), page_urls(spark, sf_dir))


_BUDGET_SQL = f"""stats AS (SELECT {S.netloc('url')} AS domain, count(*) AS n FROM pages GROUP BY 1),
facts AS (SELECT domain, n AS domain_count, CASE WHEN length(domain) % 3 = 1 THEN length(domain) // 3 ELSE 4 END::BIGINT AS budget FROM stats)"""


@query("budget_join", f"""WITH {_BUDGET_SQL} SELECT page_id, domain, domain_count, budget, domain_count >= budget AS over_budget
FROM (SELECT page_id, {S.netloc('url')} AS domain FROM pages) JOIN facts USING (domain)""")
def budget_join(spark, sf_dir):
    """Some domains have a number as budget, some a text that is none, some nothing."""
    from pagelode.operators import spread

    counts = page_domains(spark, sf_dir)
    size = F.length("domain")
    budgets = counts.where(size % 3 != 0).select("domain", F.when(
        size % 3 == 1, F.floor(size / 3).cast("string")).otherwise("many").alias("budget"))
    known = frontier.domain_budgets(counts, budgets, 4)
    rows = D.pages(spark, sf_dir).select("page_id", urls.url_domain(F.col("url")).alias("domain"))
    return spread.lookup_join(rows, known, "domain", "page_id")


@query("admission", f"WITH {_STATUS_SQL} SELECT seq, url, depth, status FROM status")
def admission(spark, sf_dir):
    return statuses(spark, sf_dir).select("seq", "url", "depth", "status")


@query("admission_bare", f"""WITH {_STATUS_SQL} SELECT url, 0 AS depth, 1 AS tier, CAST(NULL AS DOUBLE) AS score, seq
FROM status WHERE status = 'added'""")
def admission_bare(spark, sf_dir):
    """Candidates that are URLs alone: queued at depth 0, behind all that have a score."""
    rows = candidates(spark, sf_dir).select("seq", "url")
    return frontier.decide(
        rows, short(rows, 2), short(rows, 3), page_domains(spark, sf_dir), queue_size=100, max_queue=400,
        default_budget=5).queue().drop("round")


@query("enqueue_summary", f"""WITH {_STATUS_SQL} SELECT count(*) FILTER (WHERE status = 'added') AS added,
count(*) FILTER (WHERE status <> 'added') AS dropped FROM status""")
def enqueue_summary(spark, sf_dir):
    return frontier.enqueue_summary(statuses(spark, sf_dir))


@query("enqueue_details", f"""WITH {_STATUS_SQL} SELECT seq, url, status, CASE status WHEN 'dropped' THEN 'empty_url'
  WHEN 'visited' THEN 'already_visited' WHEN 'exists' THEN 'already_discovered' WHEN 'throttled' THEN 'queue_pressure'
  WHEN 'domain_budget_exceeded' THEN 'domain_limit' ELSE 'ok' END AS message FROM status""")
def enqueue_details(spark, sf_dir):
    return frontier.with_message(statuses(spark, sf_dir)).select("seq", "url", "status", "message")


# A queue of both tiers: pages with a query are queued without a score.
_QUEUE_SQL = f"""queue AS (SELECT {S.norm('url')} AS url, (page_id % 4)::INTEGER AS depth,
  CASE WHEN contains(url, '?') THEN 1 ELSE 0 END AS tier,
  CASE WHEN contains(url, '?') THEN NULL ELSE page_id % 4 + 1.0::DOUBLE END AS score, page_id AS seq FROM pages)"""


def queue(spark, sf_dir):
    rows = D.pages(spark, sf_dir).select(
        urls.normalize_url(F.col("url")).alias("url"), (F.col("page_id") % 4).cast("int").alias("depth"),
        F.contains("url", F.lit("?")).alias("plain"), F.col("page_id").alias("seq"))
    scored = rows.where(~F.col("plain")).withColumn("score", F.col("depth") + 1.0)
    return frontier.queue_union(scored.select("url", "depth", "score", "seq"), rows.where("plain").select("url", "depth", "seq"))


@query("queue_union", f"WITH {_QUEUE_SQL} SELECT url, depth, tier, coalesce(score, -1.0::DOUBLE) AS score, seq FROM queue")
def queue_union(spark, sf_dir):
    return queue(spark, sf_dir).withColumn("score", F.coalesce("score", F.lit(-1.0)))


@query("reserve_batch", f"""WITH {_QUEUE_SQL}, keyed AS (SELECT *, {S.payload_key('url', 'depth')} AS payload FROM queue)
SELECT url, depth, tier, payload, 'worker-1' AS worker_id, 1704067200.5::DOUBLE AS reserved_at, 300 AS lease_seconds
FROM (SELECT * FROM keyed ORDER BY tier, score NULLS LAST, CASE WHEN tier = 0 THEN payload END, seq LIMIT 200)""")
def reserve_batch(spark, sf_dir):
    return frontier.reserve_batch(queue(spark, sf_dir), 200, "worker-1", 1704067200.5).drop("score", "seq")


@query("domain_stats", """SELECT 'd' || (user_id % 20) || '.edu' AS domain, count(*) AS n, max(ts) AS last_access FROM events GROUP BY 1""")
def domain_stats(spark, sf_dir):
    return frontier.domain_stats(D.domain_access(spark, sf_dir))


@query("top_domains", f"SELECT {S.netloc('url')} AS domain, count(*) AS n FROM pages GROUP BY 1 ORDER BY n DESC, domain LIMIT 5")
def top_domains(spark, sf_dir):
    return frontier.top_domains(page_domains(spark, sf_dir))


_ACTION = """CASE event_type WHEN 'signup' THEN 'enqueue' WHEN 'view' THEN 'reserve' WHEN 'purchase' THEN 'acknowledge'
  WHEN 'error' THEN 'crash' ELSE 'tick' END"""
LOG_SQL = f"""log AS (SELECT event_id, ts, {_ACTION} AS action,
  'https://en.wikipedia.org/wiki/K' || regexp_extract(props, '[0-9]+') || '_' || user_id AS url,
  'worker-' || user_id AS worker_id, user_id, regexp_extract(props, '[0-9]+')::INTEGER AS k FROM events)"""
_NOW = 1706500000.0
_AGE = 864000.0
_LEASE_SQL = f"""{LOG_SQL}, held AS (
  SELECT url, max(ts) AS ts, any_value(k) AS k, any_value(user_id) AS user_id FROM log WHERE action = 'reserve' GROUP BY url),
seen AS (SELECT DISTINCT url FROM log WHERE action = 'acknowledge')"""


def held(spark, sf_dir):
    """Latest lease per URL. One user's payloads are broken, another's have a depth that is no number,
    a third's have it as text; one user's lease data are broken."""
    log = D.lease_events(spark, sf_dir, per_user=True)
    last = log.where(F.col("action") == "reserve").groupBy("url").agg(
        F.max("ts").alias("ts"), F.first("k").alias("k"), F.first("user_id").alias("user_id"))
    payload = frontier.encode_payload(F.col("url"), F.col("k") % 4)
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    meta = frontier.lease_meta(F.col("user_id"), at, F.lit(300))
    return log, last.select(
        "url", F.when(F.col("user_id") == 7, F.concat(F.lit("{"), payload))
        .when(F.col("user_id") == 11, F.regexp_replace(payload, '"depth":.*', '"depth":"deep"}'))
        .when(F.col("user_id") == 13, F.regexp_replace(payload, '"depth":([0-9]+)', '"depth":"$1"'))
        .otherwise(payload).alias("payload"),
        F.when(F.col("user_id") == 9, F.lit("??")).otherwise(meta).alias("meta"))


def seen_urls(log):
    return log.where(F.col("action") == "acknowledge").select("url").distinct()


@query("requeue_stale", f"""WITH {_LEASE_SQL} SELECT 'queued' AS outcome, url, (k % 4)::INTEGER AS depth, 0 AS tier, (k % 4)::DOUBLE AS score
FROM held WHERE user_id NOT IN (7, 9, 11) AND {_NOW} - epoch_us(ts) / 1000000.0::DOUBLE >= {_AGE} AND url NOT IN (SELECT url FROM seen) UNION ALL
SELECT 'kept', CASE WHEN user_id IN (7, 11) THEN '' ELSE url END, CASE WHEN user_id IN (7, 11) THEN 0 ELSE k % 4 END::INTEGER, 0, 0.0::DOUBLE
FROM held WHERE user_id = 9 OR {_NOW} - epoch_us(ts) / 1000000.0::DOUBLE < {_AGE}""")
def requeue_stale(spark, sf_dir):
    log, leases = held(spark, sf_dir)
    kept, back = frontier.requeue_stale(leases.select("payload", "meta"), seen_urls(log), _NOW, _AGE)
    item = frontier.decode_payload(F.col("payload"))
    return back.select(F.lit("queued").alias("outcome"), "url", "depth", "tier", "score").unionByName(
        kept.select(F.lit("kept").alias("outcome"), item["url"].alias("url"), item["depth"].alias("depth"),
                    F.lit(0).alias("tier"), F.lit(0.0).alias("score")))


@query("acknowledge", f"""WITH {_LEASE_SQL} SELECT 'visited' AS kind, url FROM seen UNION ALL
SELECT 'inflight', url FROM held WHERE url NOT IN (SELECT url FROM seen)""")
def acknowledge(spark, sf_dir):
    log = D.lease_events(spark, sf_dir, per_user=True)
    payload = frontier.encode_payload(F.col("url"), F.col("k") % 4).alias("payload")
    leases = log.where(F.col("action") == "reserve").select("url", payload).distinct()
    acks = log.where(F.col("action") == "acknowledge").select("url", payload)
    left, visited = frontier.acknowledged(spark.createDataFrame([], "url string"), leases, acks)
    return visited.select(F.lit("visited").alias("kind"), "url").unionByName(
        left.select(F.lit("inflight").alias("kind"), "url"))


@query("politeness_gaps", """WITH a AS (SELECT event_id, 'd' || (user_id % 20) || '.edu' AS domain, ts FROM events),
g AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY domain ORDER BY ts, event_id))) / 1000000.0::DOUBLE AS gap FROM a)
SELECT event_id, domain, ts, coalesce(gap, -1.0::DOUBLE) AS gap_seconds, coalesce(gap < 600, FALSE) AS too_soon FROM g""")
def politeness_gaps(spark, sf_dir):
    gaps = frontier.politeness_gaps(D.domain_access(spark, sf_dir), 600)
    return gaps.select("event_id", "domain", "ts", F.coalesce("gap_seconds", F.lit(-1.0)).alias("gap_seconds"), "too_soon")


# Accesses as wishes: every domain may be entered every ten minutes, and not within ten minutes of its last
# access before the second week.
_STARTS = """a AS (SELECT event_id, 'd' || (user_id % 20) || '.edu' AS domain, epoch_us(ts) AS t, ts FROM events),
early AS (SELECT domain, max(t) + 600000000 AS from_us FROM a WHERE ts < TIMESTAMP '2024-01-08 00:00:00' GROUP BY domain),
n AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY t, event_id) - 1 AS i FROM a WHERE ts >= TIMESTAMP '2024-01-08 00:00:00'),
starts AS (SELECT event_id, n.domain, t, i * 600000000 + greatest(
    max(t - i * 600000000) OVER (PARTITION BY n.domain ORDER BY i), coalesce(from_us, 0)) AS start_micros
  FROM n LEFT JOIN early ON early.domain = n.domain)"""


def _schedule(spark, sf_dir):
    accesses, week = D.domain_access(spark, sf_dir), F.lit("2024-01-08 00:00:00").cast("timestamp_ntz")
    stats = frontier.domain_stats(accesses.where(F.col("ts") < week))
    return frontier.politeness_schedule(accesses.where(F.col("ts") >= week), stats, 600)


@query("politeness_schedule", f"""WITH {_STARTS} SELECT event_id, domain, start_micros::BIGINT AS start_micros,
  (start_micros - t) / 1000000.0::DOUBLE AS wait_seconds FROM starts""")
def politeness_schedule(spark, sf_dir):
    return _schedule(spark, sf_dir).select("event_id", "domain", "start_micros", "wait_seconds")


@query("politeness_due", f"""WITH {_STARTS} SELECT event_id, domain FROM starts
WHERE start_micros <= epoch_us(TIMESTAMP '2024-01-15 00:00:00')""")
def politeness_due(spark, sf_dir):
    return frontier.politeness_due(_schedule(spark, sf_dir), F.lit("2024-01-15 00:00:00")).select("event_id", "domain")


@query("politeness_wait", """WITH a AS (SELECT 'd' || (user_id % 20) || '.edu' AS domain, max(ts) AS last FROM events
  WHERE ts <= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1),
p AS (SELECT page_id, 'd' || (page_id % 25) || '.edu' AS domain FROM pages)
SELECT page_id, domain, CASE WHEN last IS NULL THEN 0 ELSE greatest(0, 7200 - (epoch_us(TIMESTAMP '2024-01-15 00:00:00') - epoch_us(last)) / 1000000.0::DOUBLE) END::DOUBLE
  AS wait_seconds FROM p LEFT JOIN a USING (domain)""")
def politeness_wait(spark, sf_dir):
    now = F.lit("2024-01-15 00:00:00").cast("timestamp")
    accesses = D.domain_access(spark, sf_dir).where(F.col("ts") <= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    rows = D.pages(spark, sf_dir).select("page_id", "url", F.concat(
        F.lit("d"), (F.col("page_id") % 25).cast("string"), F.lit(".edu")).alias("domain"))
    return frontier.politeness_wait(rows, frontier.domain_stats(accesses), now, 7200).drop("url")
