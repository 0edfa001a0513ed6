"""robots.txt rules as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagelode import options as O
from pagelode.functions import urls
from pagelode.operators import spread

# The line ends that split a robots body, and the keys that matter.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
RULE_KEYS = ("allow", "disallow")
OTHER_KEYS = ("crawl-delay", "request-rate")


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def _decoded(text: Column) -> Column:
    """Percent-decoded; a text with a broken escape is left as it is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def _encoded(text: Column) -> Column:
    """Percent-encoded, all but letters, digits and `_.-~/`."""
    out = F.url_encode(text)
    # Where form encoding differs from path encoding.
    for form, path in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        out = F.replace(out, F.lit(form), F.lit(path))
    return out


def rule_path(value: Column) -> Column:
    return _encoded(_decoded(value))


def match_path(url: Column) -> Column:
    """What rules are compared with: everything after the host, or '/'."""
    rest = F.regexp_replace(_decoded(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?", "")
    rest = F.regexp_replace(rest, r"\?(?=#|\z)", "")
    coded = _encoded(F.regexp_replace(rest, r"#\z", ""))
    return F.when(coded == "", "/").otherwise(coded)


def robots_lines(robots: DataFrame) -> DataFrame:
    """Lines of each body with key and value. Expects one row per domain: `domain`, `body`."""
    rows = robots.select("domain", F.posexplode(F.split("body", LINE_END)).alias("pos", "raw"))
    line = _strip(F.regexp_replace("raw", r"(?s)#.*\z", ""))
    pair = F.contains(line, F.lit(":"))
    return rows.select(
        "domain", "pos", (F.col("raw") == "").alias("blank"),
        F.when(pair, F.lower(_strip(F.split_part(line, F.lit(":"), F.lit(1))))).alias("key"),
        F.when(pair, _strip(F.regexp_replace(line, r"(?s)^[^:]*:", ""))).alias("value"),
    )


def robots_rules(robots: DataFrame) -> DataFrame:
    """Ordered rules per agent group: `domain, group_no, agents, rule_pos, allow, path`.

    A run of user-agent lines opens a group, an empty line ends it, rules outside a group are
    void. A group without rules that names an agent still counts (it allows all), with a null
    path. The windows run over the lines of one body only.
    """
    lines = robots_lines(robots)
    kind = (
        F.when(F.col("blank"), "end")
        .when(F.col("key") == "user-agent", "agent")
        .when(F.col("key").isin(*RULE_KEYS), "rule")
        .when(F.col("key").isin(*OTHER_KEYS), "other")
    )
    by_line = W.partitionBy("domain").orderBy("pos")
    so_far = by_line.rowsBetween(W.unboundedPreceding, 0)
    marked = (
        lines.withColumn("kind", kind).where(F.col("kind").isNotNull())
        .withColumn("border", F.last(F.when(F.col("kind").isin("agent", "end"), F.col("kind")),
                                     ignorenulls=True).over(so_far))
        # Rules before any agent line are void and do not open or close anything.
        .where(F.col("kind").isin("agent", "end") | (F.col("border") == "agent"))
        .withColumn("opens", (F.col("kind") == "agent")
                    & (F.coalesce(F.lag("kind").over(by_line), F.lit("end")) != "agent"))
        .withColumn("group_no", F.count_if(F.col("opens")).over(so_far))
        .where(F.col("kind") != "end")
    )
    groups = marked.groupBy("domain", "group_no").agg(
        F.array_sort(F.collect_set(F.when(F.col("kind") == "agent", _decoded(F.col("value"))))).alias("agents"),
        F.count_if(F.col("kind") != "agent").alias("n"),
    ).where(F.col("n") > 0).drop("n")
    rules = marked.where(F.col("kind") == "rule").select(
        "domain", "group_no", F.col("pos").alias("rule_pos"),
        # An empty Disallow allows all.
        ((F.col("key") == "allow") | (_decoded(F.col("value")) == "")).alias("allow"),
        rule_path(F.col("value")).alias("path"))
    return groups.join(rules, ["domain", "group_no"], "left")


def rules_for_agent(rules: DataFrame, agent: str = O.ROBOTS_AGENT) -> DataFrame:
    """One row per domain: the rules that bind the agent, in order.

    The first group that names it wins; the first `*` group is for agents named nowhere.
    """
    name = agent.split("/")[0].lower()
    star = F.array_contains("agents", "*")
    named = ~star & F.exists("agents", lambda a: F.contains(F.lit(name), F.lower(a)))
    rule = F.when(F.col("path").isNotNull(), F.struct("rule_pos", "allow", "path"))
    per_group = rules.where(star | named).groupBy("domain", "group_no").agg(
        F.first(F.when(star, 1).otherwise(0)).alias("rank"),
        F.array_sort(F.collect_list(rule)).alias("rules"))
    return per_group.groupBy("domain").agg(F.min_by("rules", F.struct("rank", "group_no")).alias("rules"))


def prefix_matches(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules of the URL's domain whose path starts the URL's path, one row per match.

    The rules of a domain come as one row, so rows are not multiplied before the test.
    """
    packed = rules.where(F.col("path").isNotNull()).groupBy("domain").agg(
        F.collect_list(F.struct("group_no", "rule_pos", "allow", "path")).alias("_rules"))
    joined = spread.lookup_join(rows, packed, "domain", "url", "inner")
    path = match_path(F.col("url"))
    hits = joined.withColumn("_path", path).withColumn(
        "hit", F.explode(F.filter("_rules", lambda r: F.startswith(F.col("_path"), r["path"]))))
    return hits.select(*rows.columns, "hit.*")


def robots_filter(rows: DataFrame, rules: DataFrame, agent: str = O.ROBOTS_AGENT,
                  hot_rows: int = spread.HOT_ROWS) -> DataFrame:
    """`allowed` per URL: the first rule in file order that matches decides, none allows."""
    bound = rules_for_agent(rules, agent).withColumnRenamed("rules", "_rules")
    keyed = rows if "domain" in rows.columns else rows.withColumn("domain", urls.url_domain(F.col("url")))
    joined = spread.lookup_join(keyed, bound, "domain", "url", hot_rows=hot_rows)
    path = match_path(F.col("url"))
    hit = F.filter("_rules", lambda r: F.startswith(F.col("_path"), r["path"]))
    return joined.withColumn("_path", path).withColumn(
        "allowed", F.coalesce(F.get(hit, F.lit(0))["allow"], F.lit(True))).drop("_rules", "_path")


def cached_robots(robots: DataFrame, now: Column,
                  ttl_seconds: int = O.CrawlOptions.robots_ttl_seconds) -> DataFrame:
    """The newest body per domain that has not expired; empty bodies are never cached."""
    age = F.unix_micros(now) - F.unix_micros(F.col("fetched_at").cast("timestamp"))
    live = robots.where((age >= 0) & (age < ttl_seconds * 1_000_000) & (F.col("body") != ""))
    return live.groupBy("domain").agg(
        F.max_by("body", "fetched_at").alias("body"), F.max("fetched_at").alias("fetched_at"))


def robots_lookup(domains: DataFrame, robots: DataFrame, now: Column,
                  ttl_seconds: int = O.CrawlOptions.robots_ttl_seconds) -> DataFrame:
    """Each domain with its live body, null where there is none. One row per domain."""
    return domains.select("domain").distinct().join(cached_robots(robots, now, ttl_seconds), "domain", "left")
