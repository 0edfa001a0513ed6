"""The crawl over a page store derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelode.functions import urls

from pagelode.options import CrawlOptions
from pagelode.plans import crawl, worker_crawl
from pagelode.registry import derived as D
from pagelode.registry import query
from pagelode.registry import sql as S
from pagelode.session import workdir
from pagelode.sources import url_batches as batches

_HERE = CrawlOptions(valid_domains=S.DOMAINS)

_NO_LIMIT = 10**9


def _levels_sql(options: CrawlOptions) -> str:
    """The crawl level by level. Offered links are in the order of their pages and places; the queue
    takes as many as it may, nothing goes in once the domain's pages read before the round are
    as many as its budget."""
    parts = [S.WIKI, """offers AS (SELECT url, link, pos FROM wiki_links WHERE pos <= 50),
level_0 AS (SELECT url, row_number() OVER (ORDER BY s) AS place FROM wiki_seeds)"""]
    for d in range(options.max_depth + 1):
        known = " UNION ALL ".join(f"SELECT url FROM level_{k}" for k in range(d + 1))
        before = " + ".join(["0", *(f"(SELECT count(*) FROM level_{k})" for k in range(d))])
        parts.append(f"""level_{d + 1} AS (
  SELECT url, row_number() OVER (ORDER BY {S.payload_key('url', str(d + 1))}) AS place FROM (
    SELECT link AS url, min((place, pos)) AS first FROM level_{d} JOIN offers USING (url)
    WHERE link NOT IN ({known}) AND {before} < {options.domain_max_requests_default}
    GROUP BY link ORDER BY first LIMIT {options.max_frontier_queue_size}))""")
    found = " UNION ALL ".join(f"SELECT url, {d} AS depth FROM level_{d}" for d in range(options.max_depth + 2))
    return f"WITH {', '.join(parts)}, found AS ({found})"


def _bfs_sql(options: CrawlOptions = CrawlOptions(), out: str = """
SELECT url, depth::INTEGER AS depth, 'en.wikipedia.org' AS domain,
  depth <= {max_depth} AND url IN (SELECT url FROM wiki_links) AS fetched FROM found""") -> str:
    return _levels_sql(options) + out.replace("{max_depth}", str(options.max_depth))


def stored_wiki(spark, sf_dir):
    return crawl.write_store(D.wiki_store(spark, sf_dir), workdir(spark, "store"))


def bfs(spark, sf_dir, options=CrawlOptions(), **more):
    store = stored_wiki(spark, sf_dir)
    path = workdir(spark, "crawl")
    state = crawl.crawl_bfs(store.drop("s"), D.wiki_seeds(store), path, options, stored=True, **more)
    return store, path, state


def visited(state):
    return state.acks(state.last().round)


@query("depth_gate", f"""WITH {S.WIKI} SELECT url, length(s::VARCHAR)::INTEGER AS depth, length(s::VARCHAR) <= 3 AS fetch FROM (SELECT DISTINCT s, url FROM wiki_links)""")
def depth_gate(spark, sf_dir):
    rows = D.wiki_store(spark, sf_dir).select("url", F.length(F.col("s").cast("string")).alias("depth"))
    due, deep = crawl.depth_gate(rows)
    return due.withColumn("fetch", F.lit(True)).unionByName(deep.withColumn("fetch", F.lit(False)))


@query("frontier_pages_join", f"""WITH {S.WIKI}, want AS (SELECT DISTINCT link AS url FROM wiki_links UNION SELECT 'https://en.wikipedia.org/wiki/None_' || s FROM wiki_links),
store AS (SELECT url, count(*) AS n FROM wiki_links GROUP BY url)
SELECT want.url, store.url IS NOT NULL AS fetched, coalesce(n, 0) AS n_links FROM want LEFT JOIN store ON want.url = store.url""")
def frontier_pages_join(spark, sf_dir):
    store = D.wiki_store(spark, sf_dir)
    want = D.wiki_links(spark, sf_dir).select(F.explode(F.array(
        "link", F.concat(F.lit("https://en.wikipedia.org/wiki/None_"), "s"))).alias("url")).distinct()
    return want.join(store.select("url", F.size("links").alias("n")), "url", "left").select(
        "url", F.col("n").isNotNull().alias("fetched"), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"))


@query("crawl_step", f"""WITH {S.LINKS}, newest AS (SELECT max(page_id) AS page_id, {S.norm('url')} AS url FROM pages GROUP BY 2),
offered AS (SELECT n.page_id, length({S.last_segment('n.url')}) AS d, n.url AS src, l.link AS url, row_number() OVER (PARTITION BY n.page_id ORDER BY pos) AS place
  FROM newest n JOIN links l USING (page_id) WHERE length({S.last_segment('n.url')}) <= 3 AND ({S.verdict('l.link')}) = 'ok'),
cand AS (SELECT page_id * 51 + place AS seq, *, {S.norm('url')} AS u FROM offered WHERE place <= 50),
facts AS (SELECT *, u IN (SELECT url FROM newest) AS known, min(seq) OVER (PARTITION BY u) AS first_seq FROM cand)
SELECT src, u AS url, (d + 1)::INTEGER AS depth, (d + 1)::DOUBLE AS score,
  CASE WHEN known THEN 'exists' WHEN seq = first_seq THEN 'added' ELSE 'exists' END AS status FROM facts""")
def crawl_step(spark, sf_dir):
    """One round over all pages, as deep as their last segment is long; all pages are discovered."""
    pages = D.pages(spark, sf_dir)
    store = crawl.parsed_store(pages, _HERE)
    batch = pages.select(F.col("page_id"), urls.normalize_url(F.col("url")).alias("url")).groupBy("url").agg(
        F.max("page_id").alias("seq")).withColumn(
        "depth", F.length(urls.last_segment(F.col("url"))))
    none = spark.createDataFrame([], "url string")
    step = crawl.crawl_step(batch, store, none, batch.select("url"), spark.createDataFrame([], "domain string, n long"), options=_HERE)
    return step.statuses().select("src", "url", "depth", "score", "status")


@query("crawl_bfs", _bfs_sql())
def crawl_bfs(spark, sf_dir):
    return visited(bfs(spark, sf_dir)[2])


_WIDE = CrawlOptions(domain_max_requests_default=_NO_LIMIT)
# Both bind at any size of the tables: the queue in the second round, the budget in the last.
_NARROW = CrawlOptions(max_depth=4, max_frontier_queue_size=40, domain_max_requests_default=80)


@query("crawl_bfs_deep", _bfs_sql(_WIDE))
def crawl_bfs_deep(spark, sf_dir):
    return visited(bfs(spark, sf_dir, _WIDE)[2])


@query("crawl_bfs_limits", _bfs_sql(_NARROW))
def crawl_bfs_limits(spark, sf_dir):
    """A queue and a domain budget that are used up on the way."""
    return visited(bfs(spark, sf_dir, _NARROW)[2])


# What a crawl leaves behind, over a store whose pages have links that are turned down as well.
_LEFT = CrawlOptions()


def _left(spark, sf_dir):
    store = D.wiki_store(spark, sf_dir)
    extra = F.array_compact(F.array(
        F.when(F.col("s") % 3 == 0, F.concat("url", F.lit(".png"))), F.when(F.col("s") % 5 == 0, F.concat("url", F.lit("?action=edit"))),
        F.when(F.col("s") % 5 == 0, F.concat("url", F.lit("_timeline")))))
    full = store.withColumn("links", F.concat("links", extra)).withColumn("title", F.concat(F.lit("Part "), F.col("s").cast("string")))
    stored = crawl.write_store(full, workdir(spark, "store"))
    return crawl.crawl_bfs(stored.drop("s"), D.wiki_seeds(stored), workdir(spark, "crawl"), _LEFT, stored=True, published_at=F.lit("now"))


_READ = f"{_levels_sql(_LEFT)}, read AS (SELECT DISTINCT url, depth, s FROM found JOIN wiki_links USING (url) WHERE depth <= {_LEFT.max_depth})"


@query("crawl_documents", f"""{_READ} SELECT url, 'Part ' || s AS title, depth::INTEGER AS depth, (depth + 1)::INTEGER AS round,
  (SELECT count(*) FROM wiki_links w WHERE w.url = read.url) + (s % 3 = 0)::INTEGER + 2 * (s % 5 = 0)::INTEGER AS n_links FROM read""")
def crawl_documents(spark, sf_dir):
    """Pages to index, with title and all links."""
    return _left(spark, sf_dir).documents().select("url", "title", "depth", "round", F.size("links").cast("long").alias("n_links"))


@query("crawl_rejects", f"""{_READ} SELECT url, (s % 3 = 0)::BIGINT AS extension, (s % 5 = 0)::BIGINT AS query_params, (s % 5 = 0)::BIGINT AS timeline_pages,
  (s % 3 = 0)::BIGINT + 2 * (s % 5 = 0)::BIGINT AS total FROM read WHERE s % 3 = 0 OR s % 5 = 0""")
def crawl_rejects(spark, sf_dir):
    return _left(spark, sf_dir).rejects().select("url", "extension", "query_params", "timeline_pages", "total")


@query("crawl_messages", _levels_sql(_LEFT) + ", sent AS (" + " UNION ALL ".join(f"""
  SELECT {d + 1} AS round, link AS url, {d + 1} AS depth, row_number() OVER (ORDER BY place, pos) - 1 AS n FROM level_{d} JOIN offers USING (url)"""
    for d in range(_LEFT.max_depth + 1)) + f""")
SELECT round, n // {_LEFT.url_batch_size} AS batch, (n % {_LEFT.url_batch_size} + 1)::INTEGER AS pos, url, depth, 'now' AS published_at FROM sent""")
def crawl_messages(spark, sf_dir):
    """URL batches of every round, as published and read back."""
    back = batches.read_url_batches(_left(spark, sf_dir).messages())
    return back.select("round", "batch", "pos", "url", "depth", "published_at")


@query("resume_state", _bfs_sql())
def resume_state(spark, sf_dir):
    """The same crawl, stopped after one round and taken up again from its tables."""
    store, path, _ = bfs(spark, sf_dir, max_rounds=1)
    return visited(crawl.crawl_bfs(store.drop("s"), D.wiki_seeds(store), path, CrawlOptions(), stored=True))


@query("page_budget", _bfs_sql(CrawlOptions(), """, levels AS (SELECT depth, count(*) AS n FROM found GROUP BY depth),
upto AS (SELECT depth, coalesce(sum(n) OVER (ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM levels)
SELECT depth::INTEGER AS depth, count(*) AS n FROM found JOIN upto USING (depth) WHERE before < 100 GROUP BY depth"""))
def page_budget(spark, sf_dir):
    """Stop at 100 visited pages; the round that gets there is finished."""
    state = bfs(spark, sf_dir, CrawlOptions(max_pages=100))[2]
    return visited(state).groupBy("depth").agg(F.count(F.lit(1)).alias("n"))


@query("crawl_progress", _bfs_sql(CrawlOptions(), """, levels AS (SELECT depth, count(*) AS n FROM found GROUP BY depth)
SELECT (depth + 1)::INTEGER AS round, n AS batch_size, (sum(n) OVER (ORDER BY depth))::BIGINT AS pages_crawled FROM levels"""))
def crawl_progress(spark, sf_dir):
    state = bfs(spark, sf_dir)[2]
    return state.progress().where("round > 0").select("round", "batch_size", "pages_crawled")


# Pages whose name ends in 3 lose their first worker, those that end in 7 have one that is late.
_SLOW = CrawlOptions(max_depth=_NO_LIMIT, domain_max_requests_default=_NO_LIMIT, lease_seconds=50, per_domain_delay_seconds=0.001)


def _outcome(leases):
    first, digit = F.col("epoch") == 1, F.substring("url", -1, 1)
    return leases.withColumn("after_seconds", F.when(first & (digit == "3"), F.lit(None)).when(first & (digit == "7"), 70.0).otherwise(0.001))


@query("worker_crawl", f"""WITH RECURSIVE {S.WIKI},
found AS (SELECT url FROM wiki_seeds UNION SELECT link FROM found JOIN wiki_links USING (url) WHERE pos <= 50)
SELECT url, CASE WHEN right(url, 1) IN ('3', '7') THEN 2 ELSE 1 END AS epoch, 'done' AS status FROM found
UNION ALL SELECT url, 1, 'late' FROM found WHERE right(url, 1) = '7'""")
def worker_crawl_query(spark, sf_dir):
    """All pages that can be reached, by workers of which some crash and some are late."""
    store = stored_wiki(spark, sf_dir)
    workers = worker_crawl.Workers(_outcome, count=8)
    state = worker_crawl.crawl_by_workers(store.drop("s"), D.wiki_seeds(store), workdir(spark, "worker-crawl"), workers, _SLOW)
    return state.acknowledged().select("url", "epoch", "status")
