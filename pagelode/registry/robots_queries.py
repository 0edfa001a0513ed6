"""Robots rules of the page store's domains."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagelode.functions import urls
from pagelode.operators import robots
from pagelode.registry import derived as D
from pagelode.registry import query
from pagelode.registry import sql as S

_PAGES_SQL = f"""p AS (SELECT page_id, url, {S.netloc('url')} AS domain, {S.path('url')} AS path,
  regexp_replace(regexp_extract(url, '^https?://[^/?#]*(.*)$', 1), '[?]', '%3F') AS rest FROM pages),
low AS (SELECT domain, substr(min(path), 2, 1) AS letter, length(domain) % 2 = 0 AS named,
  CASE WHEN length(domain) % 3 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-01-01 11:30:00' END AS fetched_at
  FROM p GROUP BY domain),
rules AS (
  SELECT domain, 1 AS group_no, '*' AS agents, 1 AS rule_pos, FALSE AS allow, '/' || letter AS path FROM low UNION ALL
  SELECT domain, 1, '*', 2, TRUE, '/' FROM low UNION ALL
  SELECT domain, 2, 'minisearch', 5, FALSE, '/' || letter || 'n' FROM low WHERE named)"""


def rules(spark, sf_dir):
    return robots.robots_rules(D.robots(spark, sf_dir))


def page_rows(spark, sf_dir):
    return D.pages(spark, sf_dir).select("page_id", "url", urls.url_domain(F.col("url")).alias("domain"))


@query("robots_rules", f"WITH {_PAGES_SQL} SELECT domain, group_no, agents, rule_pos, allow, path FROM rules")
def robots_rules(spark, sf_dir):
    return rules(spark, sf_dir).select(
        "domain", F.col("group_no").cast("int").alias("group_no"), F.array_join("agents", ",").alias("agents"),
        "rule_pos", "allow", "path")


@query("robots_prefix_join", f"""WITH {_PAGES_SQL} SELECT page_id, p.domain, group_no, rule_pos, allow, r.path
FROM p JOIN rules r ON p.domain = r.domain AND starts_with(p.path, r.path)""")
def robots_prefix_join(spark, sf_dir):
    found = robots.prefix_matches(page_rows(spark, sf_dir), rules(spark, sf_dir))
    return found.drop("url").withColumn("group_no", F.col("group_no").cast("int"))


@query("robots_filter", f"""WITH {_PAGES_SQL}, bound AS (
  SELECT p.page_id, arg_min(r.allow, r.rule_pos) AS allow FROM p JOIN low USING (domain)
  JOIN rules r ON p.domain = r.domain AND r.group_no = CASE WHEN named THEN 2 ELSE 1 END AND starts_with(p.path, r.path)
  GROUP BY p.page_id)
SELECT page_id, url, domain, coalesce(allow, TRUE) AS allowed FROM p LEFT JOIN bound USING (page_id)""")
def robots_filter(spark, sf_dir):
    return robots.robots_filter(page_rows(spark, sf_dir), rules(spark, sf_dir))


@query("robots_cache_lookup", f"""WITH {_PAGES_SQL} SELECT domain,
  CASE WHEN fetched_at = TIMESTAMP '2024-01-01 11:30:00' THEN 'Disallow: /' || letter ELSE '' END AS first_rule FROM low""")
def robots_cache_lookup(spark, sf_dir):
    """Two bodies per domain, the older one with other rules; some domains have none alive."""
    bodies = D.robots(spark, sf_dir)
    older = bodies.select("domain", F.lit("User-agent: *\nDisallow: /old").alias("body"),
                          (F.col("fetched_at") - F.expr("INTERVAL 20 MINUTES")).alias("fetched_at"))
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    found = robots.robots_lookup(bodies, bodies.select("domain", "body", "fetched_at").unionByName(older), now)
    return found.select("domain", F.coalesce(F.get(F.split("body", "\n"), F.lit(1)), F.lit("")).alias("first_rule"))
