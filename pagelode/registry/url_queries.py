"""URL expressions over the URLs of the page store and variants of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelode.functions import text, urls
from pagelode.registry import derived as D
from pagelode.registry import query
from pagelode.registry import sql as S

_VARIANT_SQL = """variants AS (SELECT page_id, unnest([url, url || '/', url || '#a#b', replace(url, 'http', 'HTTP'),
    url || '?', ' ' || url, replace(url, '/en/', chr(9) || '/en//'), replace(url, '://', '://U@') || ';v']) AS url FROM pages)"""


def variants(spark, sf_dir):
    u = F.col("url")
    forms = [u, F.concat(u, F.lit("/")), F.concat(u, F.lit("#a#b")), F.replace(u, F.lit("http"), F.lit("HTTP")),
             F.concat(u, F.lit("?")), F.concat(F.lit(" "), u), F.replace(u, F.lit("/en/"), F.lit("\t/en//")),
             F.concat(F.replace(u, F.lit("://"), F.lit("://U@")), F.lit(";v"))]
    return D.pages(spark, sf_dir).select("page_id", F.explode(F.array(*forms)).alias("url"))


_RULED_SQL = f"""{S.LINKS}, ruled AS (
  SELECT page_id, link AS url FROM links UNION ALL
  SELECT page_id, unnest([url, split_part(split_part(url, '?', 1), '#', 1), split_part(split_part(url, '?', 1), '#', 1) || '.PNG',
    'https://en.wikipedia.org/wiki/' || page_id, 'https://de.wikipedia.org/wiki/P' || page_id || 'x',
    'https://wikipedia.org/wiki/Pag' || page_id, 'https://en.wikipedia.org/wiki/' || page_id || ';v',
    'https://en.wikipedia.org/wiki/List_of_' || page_id, 'https://en.wikipedia.org/wiki/Help:' || page_id,
    'https://en.wikipedia.org/wiki/Cat_(Disambiguation)_' || page_id, 'https://en.wikipedia.org/wiki/Timeline_' || page_id,
    'https://arxiv.org/abs/%41%42%43%44%45%46' || page_id, 'https://arxiv.org/abs/' || repeat('a', 178) || page_id,
    'https://evil.com/a.edu/credit/' || page_id, 'https://en.wikipedia.org/wiki/History_of_' || page_id, '']) FROM pages)"""


def ruled(spark, sf_dir):
    """Links, page URLs and wiki-like URLs that reach every rule."""
    u, i = F.col("url"), F.col("page_id").cast("string")
    bare = F.split_part(F.split_part(u, F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1))

    def wiki(head, tail="", host="en.wikipedia.org/wiki/"):
        return F.concat(F.lit("https://" + host + head), i, F.lit(tail))

    forms = [u, bare, F.concat(bare, F.lit(".PNG")), wiki(""), wiki("P", "x", "de.wikipedia.org/wiki/"),
             wiki("Pag", "", "wikipedia.org/wiki/"), wiki("", ";v"), wiki("List_of_"), wiki("Help:"),
             wiki("Cat_(Disambiguation)_"), wiki("Timeline_"), wiki("%41%42%43%44%45%46", "", "arxiv.org/abs/"),
             wiki("a" * 178, "", "arxiv.org/abs/"), wiki("credit/", "", "evil.com/a.edu/"), wiki("History_of_"), F.lit("")]
    made = D.pages(spark, sf_dir).select("page_id", F.explode(F.array(*forms)).alias("url"))
    return D.page_links(spark, sf_dir).select("page_id", F.col("link").alias("url")).unionByName(made)


@query("clean_url", f"WITH {_VARIANT_SQL} SELECT page_id, url, {S.clean('url')} AS cleaned FROM variants")
def clean_url(spark, sf_dir):
    return variants(spark, sf_dir).select("page_id", "url", urls.clean_url(F.col("url")).alias("cleaned"))


@query("normalize_url", f"WITH {_VARIANT_SQL} SELECT page_id, url, {S.norm('url')} AS normalized FROM variants")
def normalize_url(spark, sf_dir):
    return variants(spark, sf_dir).select("page_id", "url", urls.normalize_url(F.col("url")).alias("normalized"))


@query("url_domain", f"WITH {_VARIANT_SQL} SELECT page_id, url, {S.netloc("ltrim(regexp_replace(url, '[\\t\\r\\n]', '', 'g'))")} AS domain FROM variants")
def url_domain(spark, sf_dir):
    return variants(spark, sf_dir).select("page_id", "url", urls.url_domain(F.col("url")).alias("domain"))


@query("valid_url", f"WITH {_RULED_SQL} SELECT page_id, url, {S.valid('url', S.O.VALID_DOMAINS)} AS valid, "
       f"{S.valid('url')} AS valid_here FROM ruled")
def valid_url(spark, sf_dir):
    return ruled(spark, sf_dir).select(
        "page_id", "url", urls.valid_url(F.col("url")).alias("valid"),
        urls.valid_url(F.col("url"), S.DOMAINS).alias("valid_here"))


@query("junk_url", f"WITH {_RULED_SQL} SELECT page_id, url, {S.junk('url')} AS junk FROM ruled")
def junk_url(spark, sf_dir):
    return ruled(spark, sf_dir).select("page_id", "url", urls.junk_url(F.col("url")).alias("junk"))


@query("trusted_url", f"WITH {_RULED_SQL} SELECT page_id, url, {S.trusted('url')} AS trusted FROM ruled")
def trusted_url(spark, sf_dir):
    return ruled(spark, sf_dir).select("page_id", "url", urls.trusted_url(F.col("url")).alias("trusted"))


@query("url_verdict", f"WITH {_RULED_SQL} SELECT page_id, url, {S.verdict('url')} AS reason, "
       f"({S.verdict('url')}) = 'ok' AS allowed FROM ruled")
def url_verdict(spark, sf_dir):
    rows = ruled(spark, sf_dir).withColumn("reason", urls.url_verdict(F.col("url")))
    return rows.select("page_id", "url", "reason", (F.col("reason") == "ok").alias("allowed"))


@query("url_features", f"""WITH {_RULED_SQL} SELECT page_id, url, length(url) AS url_length,
  length(url) - length(replace(url, '%', '')) AS percents, {S.last_segment('url')} AS last_segment,
  regexp_extract(lower(url), '\\.([^./]*)$', 1) AS extension, lower(url) AS lowered FROM ruled""")
def url_features(spark, sf_dir):
    u = F.col("url")
    return ruled(spark, sf_dir).select(
        "page_id", "url", F.length(u).cast("long").alias("url_length"),
        urls.percent_count(u).cast("long").alias("percents"), urls.last_segment(u).alias("last_segment"),
        urls.url_extension(u).alias("extension"), F.lower(u).alias("lowered"))


@query("url_priority", f"""WITH {_RULED_SQL} SELECT page_id, url, depth,
  (depth + 1 + CASE WHEN {S.junk('url')} THEN 10000 ELSE 0 END
   - CASE WHEN contains(lower(url), '/wiki/') AND NOT contains(lower(url), ':') THEN 1 ELSE 0 END)::DOUBLE AS score,
  (depth + 1 + CASE WHEN {S.junk('url')} THEN 10000 ELSE 0 END
   - CASE WHEN contains(lower(url), '/wiki/') AND NOT contains(regexp_replace(lower(url), '^{S.SCHEME}//[^/]*', ''), ':')
     THEN 1 ELSE 0 END)::DOUBLE AS path_score
  FROM (SELECT *, (page_id % 4)::INTEGER AS depth FROM ruled)""")
def url_priority(spark, sf_dir):
    rows = ruled(spark, sf_dir).withColumn("depth", (F.col("page_id") % 4).cast("int"))
    u, d = F.col("url"), F.col("depth")
    return rows.select("page_id", "url", "depth", urls.url_priority(u, d).alias("score"),
                       urls.url_priority(u, d, "path").alias("path_score"))


@query("payload_codec", f"""WITH {S.LINKS} SELECT page_id, pos, '{{"url":"' || link || '","depth":' || (pos % 3) || '}}' AS payload,
  link AS url, (pos % 3)::INTEGER AS depth, '' AS bad_url, 0 AS bad_depth,
  CASE WHEN pos % 5 IN (2, 3) THEN '' ELSE link END AS odd_url,
  CASE pos % 5 WHEN 0 THEN 7 WHEN 1 THEN 2 ELSE 0 END AS odd_depth FROM links""")
def payload_codec(spark, sf_dir):
    from pagelode.operators import frontier

    rows = D.page_links(spark, sf_dir).select(
        "page_id", F.col("pos").cast("long").alias("pos"),
        frontier.encode_payload(F.col("link"), F.col("pos") % 3).alias("payload"))
    back = frontier.decode_payload(F.col("payload"))
    bad = frontier.decode_payload(F.substr("payload", F.lit(3)))
    # Depth as text, as a fraction, as text that is no number, as null, and missing.
    given = F.element_at(F.array(*[F.lit(x) for x in (',"depth":"7"', ',"depth":2.7', ',"depth":"x"', ',"depth":null', "")]),
                         (F.col("pos") % 5 + 1).cast("int"))
    odd = frontier.decode_payload(F.concat(F.regexp_replace("payload", ',"depth":[0-9]+}$', ""), given, F.lit("}")))
    return rows.select("page_id", "pos", "payload", back["url"].alias("url"), back["depth"].alias("depth"),
                       bad["url"].alias("bad_url"), bad["depth"].alias("bad_depth"),
                       odd["url"].alias("odd_url"), odd["depth"].alias("odd_depth"))


@query("resolve_url", f"""WITH {S.HREFS}, forms AS (
  SELECT page_id, hpos, url, unnest([href, 'https://o.example.org' || href, '//o.example.org' || href, '', '?q=1', '#f',
    '..' || href, substr(href, 2)]) AS href, unnest([1, 2, 3, 4, 5, 6, 7, 8]) AS form FROM hrefs),
parts AS (SELECT *, regexp_extract(url, '^https?://[^/?#]*') AS root, regexp_extract(url, '^[^?#]*') AS bare,
  regexp_replace(regexp_extract(url, '^[^?#]*'), '[^/]*$', '') AS folder FROM forms)
SELECT page_id, hpos, form, CASE form WHEN 1 THEN root || href WHEN 2 THEN href WHEN 3 THEN split_part(url, '//', 1) || href
  WHEN 4 THEN url WHEN 5 THEN bare || href WHEN 6 THEN split_part(url, '#', 1) || href
  WHEN 7 THEN regexp_replace(folder, '[^/]+/$', '') || substr(href, 4) WHEN 8 THEN folder || href END AS resolved FROM parts""")
def resolve_url(spark, sf_dir):
    from pagelode.functions import html

    hrefs = html.read_pages(D.pages(spark, sf_dir), ("hrefs",)).select(
        "page_id", "url", F.posexplode("hrefs").alias("i", "href"))
    h = F.col("href")
    forms = [h, F.concat(F.lit("https://o.example.org"), h), F.concat(F.lit("//o.example.org"), h), F.lit(""),
             F.lit("?q=1"), F.lit("#f"), F.concat(F.lit(".."), h), F.substr(h, F.lit(2))]
    rows = hrefs.select("page_id", "url", (F.col("i") + 1).cast("long").alias("hpos"),
                        F.posexplode(F.array(*forms)).alias("f", "href"))
    return rows.select("page_id", "hpos", (F.col("f") + 1).alias("form"),
                       urls.resolve_url(F.col("url"), F.col("href")).alias("resolved"))


@query("iso_time", """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN ''
  ELSE strftime(ts, '.%f') END AS iso, epoch_us(ts) / 1000000.0::DOUBLE AS epoch FROM events""")
def iso_time(spark, sf_dir):
    return D.table(spark, sf_dir, "events").select(
        "event_id", text.iso_time(F.col("ts")).alias("iso"), text.epoch_seconds(F.col("ts")).alias("epoch"))


@query("backoff_delay", """SELECT event_id, attempt::INTEGER AS attempt, pow(2.0::DOUBLE, attempt) AS delay_seconds,
  pow(2.0::DOUBLE, attempt) - 1.0::DOUBLE AS starts_after
  FROM (SELECT event_id, unnest(range(0, 3)) AS attempt FROM events WHERE event_type = 'error')""")
def backoff_delay(spark, sf_dir):
    failed = D.table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    plan = failed.select("event_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("attempt"))
    delay = text.backoff_delay(F.col("attempt"))
    return plan.select("event_id", "attempt", delay.alias("delay_seconds"), (delay - 1.0).alias("starts_after"))
