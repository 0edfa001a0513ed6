import random
from urllib.robotparser import RobotFileParser

from pyspark.sql import functions as F

from pagelode.operators import robots

BOT = "MiniSearchBot"
EXAMPLES = [
    ("User-agent: *\nAllow: /a\nDisallow: /a/b", "/a/b", True),
    ("User-agent: *\nDisallow: /a\nAllow: /a/b", "/a/b", False),
    ("User-agent: *\nDisallow: /\n\nUser-agent: minisearchbot\nAllow: /", "/q", True),
    ("User-agent: search\nDisallow: /", "/q", False),
    ("", "/q", True),
    ("User-agent: *\nDisallow:", "/q", True),
    ("User-agent: *\nDisallow: /*.pdf", "/q.pdf", True),
]


def allowed(spark, cases, **more):
    bodies = spark.createDataFrame([(f"d{i}.edu", b) for i, (b, _) in enumerate(cases)], "domain string, body string")
    rows = spark.createDataFrame([(i, f"https://d{i}.edu{p}") for i, (_, p) in enumerate(cases)], "i int, url string")
    out = robots.robots_filter(rows, robots.robots_rules(bodies), BOT, **more).select("i", "allowed").collect()
    return [r.allowed for r in sorted(out)]


def standard(body, url):
    parser = RobotFileParser()
    parser.parse(body.splitlines())
    return parser.can_fetch(BOT, url)


def test_examples(spark):
    assert allowed(spark, [(b, p) for b, p, _ in EXAMPLES]) == [a for _, _, a in EXAMPLES]


def test_matches_the_standard_parser(spark):
    rng = random.Random(11)
    lines = ["User-agent: *", "User-agent: MiniSearch", "user-agent: other", "User-Agent:search/2 # c", "Disallow: /a", "Allow: /a/b",
             "Disallow:", "Disallow: /%61", "Allow: /ü?x", "Disallow: /", "allow : /c d", "Crawl-delay: 3", "", "", "  ", "# note",
             "Request-rate: 1/2", "Sitemap: http://x/s", "junk", "Disallow: /x+y", "Disallow: /*", "Disallow: /a~b"]
    paths = ["", "/", "/a", "/a/b", "/a/c", "/b", "/c%20d", "/c d", "/%C3%BC?x=1", "/x+y", "/x%20y", "/*", "/a~b", "/a?", "/b#f"]
    ends = ["\n", "\r\n"]
    cases = [(rng.choice(ends).join(rng.choices(lines, k=rng.randint(0, 9))), rng.choice(paths)) for _ in range(400)]
    want = [standard(b, f"https://d{i}.edu{p}") for i, (b, p) in enumerate(cases)]
    assert allowed(spark, cases, hot_rows=1) == want


def test_cache_expires(spark):
    bodies = spark.createDataFrame([("a", "old", 10), ("a", "new", 50), ("b", "gone", 10), ("c", "later", 200), ("d", "", 50)],
                                   "domain string, body string, s int").withColumn("fetched_at", F.timestamp_seconds("s"))
    got = robots.robots_lookup(bodies, bodies, F.timestamp_seconds(F.lit(100)), 90)
    assert {r.domain: r.body for r in got.collect()} == {"a": "new", "b": None, "c": None, "d": None}
