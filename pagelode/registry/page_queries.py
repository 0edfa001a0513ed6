"""Page parsing, links, URL batches and the document index over the page store."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelode.functions import html, urls
from pagelode.operators import links as L
from pagelode.registry import derived as D
from pagelode.registry import query
from pagelode.registry import sql as S
from pagelode.session import through_table, workdir
from pagelode.sources import crawl_log as log
from pagelode.sources import index
from pagelode.sources import pages as store
from pagelode.sources import url_batches as batches

_PUBLISHED = "2024-01-01T00:00:00"
_DEPTH = f"length({S.last_segment('d.url')})"


@query("page_scan", f"""WITH wanted AS (SELECT DISTINCT unnest([u, u || '/missing']) AS url FROM (SELECT {S.norm('url')} AS u FROM pages)),
kept AS (SELECT {S.norm('url')} AS url, max(page_id) AS page_id FROM pages GROUP BY 1)
SELECT w.url, coalesce(k.page_id, -1) AS page_id, coalesce(length(p.html), 0) AS html_chars, p.html IS NOT NULL AS fetched
FROM wanted w LEFT JOIN kept k ON w.url = k.url LEFT JOIN pages p ON p.page_id = k.page_id""")
def page_scan(spark, sf_dir):
    pages = D.pages(spark, sf_dir)
    u = urls.normalize_url(F.col("url"))
    wanted = pages.select(F.explode(F.array(u, F.concat(u, F.lit("/missing")))).alias("url")).distinct()
    return store.fetched(wanted, pages).select(
        "url", F.coalesce("page_id", F.lit(-1)).cast("long").alias("page_id"),
        F.coalesce(F.length("html"), F.lit(0)).cast("long").alias("html_chars"), F.col("html").isNotNull().alias("fetched"))


@query("page_title", f"WITH {S.DOCS} SELECT page_id, title FROM docs")
def page_title(spark, sf_dir):
    return D.docs(spark, sf_dir, ("title",)).select("page_id", "title")


@query("page_text", f"WITH {S.DOCS} SELECT page_id, content FROM docs")
def page_text(spark, sf_dir):
    return D.docs(spark, sf_dir, ("content",)).select("page_id", "content")


@query("page_links", f"WITH {S.LINKS} SELECT page_id, pos, link FROM links")
def page_links(spark, sf_dir):
    return D.page_links(spark, sf_dir).select("page_id", F.col("pos").cast("long").alias("pos"), "link")


@query("page_sizes", f"""WITH {S.DOCS}, {S.LINKS} SELECT d.page_id,
  CASE WHEN {_DEPTH} > 3 THEN 0 ELSE length(content) END AS content_chars,
  CASE WHEN {_DEPTH} > 3 THEN 0 ELSE coalesce(n, 0) END AS n_links
  FROM docs d LEFT JOIN (SELECT page_id, count(*) AS n FROM links GROUP BY page_id) l USING (page_id)""")
def page_sizes(spark, sf_dir):
    """Pages beyond the depth limit are skipped: (0, 0). Depth is the length of the last segment."""
    read = F.length(urls.last_segment(F.col("url"))) <= 3
    return D.docs(spark, sf_dir, ("content", "links")).select(
        "page_id", F.when(read, F.length("content")).otherwise(0).cast("long").alias("content_chars"),
        F.when(read, F.size("links")).otherwise(0).cast("long").alias("n_links"))


@query("sublinks_raw", f"""WITH {S.HREFS} SELECT page_id, hpos AS pos,
  CASE WHEN starts_with(href, 'http') THEN href ELSE url || href END AS sublink FROM hrefs""")
def sublinks_raw(spark, sf_dir):
    return L.sublinks(html.read_pages(D.pages(spark, sf_dir), ("hrefs",))).withColumn("pos", F.col("pos").cast("long"))


@query("url_split", f"""WITH {S.LINKS}, v AS (SELECT page_id, pos, link, {S.verdict('link')} AS reason FROM links)
SELECT page_id, pos, link, 'accepted' AS route, CAST(NULL AS VARCHAR) AS reason FROM v WHERE reason = 'ok' UNION ALL
SELECT page_id, pos, link, 'rejected', reason FROM v WHERE reason <> 'ok'""")
def url_split(spark, sf_dir):
    rows = L.judged(D.page_links(spark, sf_dir).drop("url"))
    ok = F.col("reason") == "ok"
    return rows.select("page_id", F.col("pos").cast("long").alias("pos"), "link",
                       F.when(ok, "accepted").otherwise("rejected").alias("route"),
                       F.when(~ok, F.col("reason")).alias("reason"))


def _reject_sql(by: str, columns: str) -> str:
    counters = ", ".join(f"count(*) FILTER (WHERE reason = '{v}') AS {k}" for k, v in L.REJECT_COUNTERS.items())
    known = ", ".join(f"'{v}'" for v in ("ok", *L.REJECT_COUNTERS.values()))
    return f"""WITH {S.LINKS}, v AS (SELECT page_id, {S.verdict('link')} AS reason FROM links)
    SELECT {columns}{counters}, count(*) FILTER (WHERE reason NOT IN ({known})) AS other,
    count(*) FILTER (WHERE reason <> 'ok') AS total, count(*) FILTER (WHERE reason = 'ok') AS accepted FROM v {by}"""


@query("reject_stats", _reject_sql("GROUP BY page_id", "page_id, "))
def reject_stats(spark, sf_dir):
    return L.reject_stats(D.page_links(spark, sf_dir))


@query("reject_totals", _reject_sql("", ""))
def reject_totals(spark, sf_dir):
    return L.reject_stats(D.page_links(spark, sf_dir), ())


@query("link_dedupe_order", f"""WITH {S.HREFS}, t AS (SELECT page_id, hpos, {S.clean(S.RESOLVED)} AS link FROM hrefs)
SELECT page_id, link, min(hpos) AS pos FROM t GROUP BY page_id, link""")
def link_dedupe_order(spark, sf_dir):
    raw = html.read_pages(D.pages(spark, sf_dir), ("targets",)).withColumnRenamed("targets", "links")
    rows = L.link_rows(raw).withColumn("link", urls.clean_url(F.col("link")))
    return L.dedupe_links(rows).select("page_id", "link", F.col("pos").cast("long").alias("pos"))


@query("fanout_cap", f"""WITH {S.LINKS}, ok AS (
  SELECT page_id, pos, link, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS r FROM links WHERE ({S.verdict('link')}) = 'ok')
SELECT page_id, r AS place, link FROM ok WHERE r <= 3""")
def fanout_cap(spark, sf_dir):
    kept = D.docs(spark, sf_dir, ("links",)).select(
        "page_id", F.posexplode(L.accepted_links(F.col("links"), 3)).alias("i", "link"))
    return kept.select("page_id", (F.col("i") + 1).cast("long").alias("place"), "link")


@query("link_graph", f"WITH {S.LINKS} SELECT url AS src, link AS dst, pos FROM links")
def link_graph(spark, sf_dir):
    return L.link_graph(D.docs(spark, sf_dir, ("links",))).withColumn("pos", F.col("pos").cast("long"))


@query("link_degrees", f"""WITH {S.LINKS}, ends AS (SELECT url, 1 AS o, 0 AS i FROM links UNION ALL SELECT link, 0, 1 FROM links)
SELECT url, sum(o)::BIGINT AS out_degree, sum(i)::BIGINT AS in_degree FROM ends GROUP BY url""")
def link_degrees(spark, sf_dir):
    return L.degrees(L.link_graph(D.docs(spark, sf_dir, ("links",))))


_ACCEPTED_SQL = f"""{S.LINKS}, pub AS (SELECT page_id, pos, link AS url, row_number() OVER (ORDER BY page_id, pos) AS seq
  FROM links WHERE ({S.verdict('link')}) = 'ok')"""


def published(spark, sf_dir):
    """Accepted links in publishing order, at depth 1; stored, since numbering reads them twice."""
    rows = L.accepted(D.page_links(spark, sf_dir).drop("url")).select(
        "page_id", "pos", F.col("link").alias("url"), F.lit(1).alias("depth"))
    return through_table(rows, workdir(spark, "published"))


@query("batch_number", f"WITH {_ACCEPTED_SQL} SELECT page_id, pos, url, seq, (seq - 1) // 25 AS batch FROM pub")
def batch_number(spark, sf_dir):
    rows = batches.batch_number(published(spark, sf_dir), ["page_id", "pos"], 25)
    return rows.select("page_id", F.col("pos").cast("long").alias("pos"), "url", "seq", "batch")


@query("url_batches", f"""WITH {_ACCEPTED_SQL} SELECT (seq - 1) // 25 AS batch,
  to_json({{'items': list({{'url': url, 'depth': 1}} ORDER BY seq), 'batch_size': count(*), 'published_at': '{_PUBLISHED}'}})::VARCHAR AS value
  FROM pub GROUP BY 1""")
def url_batches(spark, sf_dir):
    return batches.url_batches(published(spark, sf_dir), F.lit(_PUBLISHED), ["page_id", "pos"])


@query("url_batches_read", f"""WITH {_ACCEPTED_SQL} SELECT (seq - 1) // 25 AS batch, '{_PUBLISHED}' AS published_at,
  (count(*) OVER (PARTITION BY (seq - 1) // 25))::INTEGER AS batch_size, ((seq - 1) % 25 + 1)::INTEGER AS pos, url, 1 AS depth FROM pub""")
def url_batches_read(spark, sf_dir):
    return batches.read_url_batches(url_batches(spark, sf_dir))


_UPSERT_SQL = f"""WITH {S.DOCS}, {S.LINKS}, w AS (
  SELECT {S.norm('url')} AS url, arg_max(page_id, page_id) AS page_id FROM pages GROUP BY 1)
SELECT w.url, d.title, d.content, coalesce(n, 0) AS n_links, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(w.page_id) AS fetched_at
FROM w JOIN docs d USING (page_id) LEFT JOIN (SELECT page_id, count(*) AS n FROM links GROUP BY page_id) l USING (page_id)"""


def fetched_docs(spark, sf_dir):
    docs = D.docs(spark, sf_dir)
    at = F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01 00:00:00")) + F.col("page_id"))
    return docs.withColumn("url", urls.normalize_url(F.col("url"))).withColumn("fetched_at", at)


def _shown(docs):
    return docs.select("url", "title", "content", F.size("links").cast("long").alias("n_links"),
                       F.col("fetched_at").cast("timestamp_ntz").alias("fetched_at"))


@query("index_upsert", _UPSERT_SQL)
def index_upsert(spark, sf_dir):
    return _shown(index.upsert(fetched_docs(spark, sf_dir), ["fetched_at", "page_id"]))


@query("index_scan", _UPSERT_SQL)
def index_scan(spark, sf_dir):
    path = workdir(spark, "docs")
    index.write_index(fetched_docs(spark, sf_dir), path, ["fetched_at", "page_id"])
    return _shown(index.read_index(spark, path))


@query("index_bulk_summary", """WITH r AS (SELECT (row_number() OVER (ORDER BY page_id) - 1) // 100 AS chunk, contains(url, 'utm_source') AS bad FROM pages)
SELECT chunk, count(*) AS bulk_size, count(*) FILTER (WHERE NOT bad) AS indexed_count, count(*) FILTER (WHERE bad) AS failed_count FROM r GROUP BY chunk""")
def index_bulk_summary(spark, sf_dir):
    """Rows of one kind of URL lose it, so that every chunk has rows that cannot be keyed."""
    docs = D.pages(spark, sf_dir).select("page_id", F.when(~F.contains("url", F.lit("utm_source")), F.col("url")).alias("url"))
    return index.bulk_summary(docs, ["page_id"], 100)


@query("crawl_log", """SELECT '{"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '","level":"' ||
  CASE WHEN event_type = 'error' THEN 'WARNING' ELSE 'INFO' END || '","message":"' || event_type || '","worker_id":"worker-' || user_id || '"' ||
  CASE WHEN event_type = 'view' THEN ',"url":"https://en.wikipedia.org/wiki/K' || regexp_extract(props, '[0-9]+') || '"' ELSE '' END ||
  CASE WHEN event_type = 'view' THEN ',"depth":' || (event_id % 4) ELSE '' END || '}' AS value FROM events""")
def crawl_log(spark, sf_dir):
    rows = D.table(spark, sf_dir, "events")
    view = F.col("event_type") == "view"
    k = F.get_json_object("props", "$.k")
    return log.log_lines(rows.select(
        "ts", F.when(F.col("event_type") == "error", "WARNING").otherwise("INFO").alias("level"),
        F.col("event_type").alias("message"), F.concat(F.lit("worker-"), F.col("user_id").cast("string")).alias("worker_id"),
        F.when(view, F.concat(F.lit("https://en.wikipedia.org/wiki/K"), k)).alias("url"),
        F.when(view, F.col("event_id") % 4).alias("depth"), F.lit("not written").alias("domain")))


@query("result_projection", f"""WITH {S.DOCS} SELECT page_id, CASE WHEN title = 'No Title' THEN 'No Title' ELSE title END AS title,
  split_part(url, '#', 1) AS url, CASE WHEN length(content) > 200 THEN substr(content, 1, 200) || '...' ELSE content END AS preview FROM docs""")
def result_projection(spark, sf_dir):
    from pagelode.operators import ranking

    title, shown = ranking.result_projection(F.col("title"), F.col("content"))
    return D.docs(spark, sf_dir, ("title", "content")).select(
        "page_id", title, F.split_part("url", F.lit("#"), F.lit(1)).alias("url"), shown)
