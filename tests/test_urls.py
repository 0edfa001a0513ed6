import json
import random
import re
from urllib.parse import urljoin, urlparse, urlsplit, urlunsplit

from pyspark.sql import functions as F

from pagelode import options
from pagelode.functions import text, urls

WIKI = "https://en.wikipedia.org/wiki/"

VERDICTS = [
    (None, "empty"), ("", "empty"), (WIKI + "a" * 200, "url_length"), (WIKI + "Cat?x=1", "query_params"),
    (WIKI + "Cat.PNG", "extension"), (WIKI + "Help:Contents", "namespace"),
    ("https://de.wikipedia.org/wiki/Katze", "non_en_wikipedia"),
    ("https://www.wikipedia.org/wiki/Cat", "non_en_wikipedia"), ("https://wikipedia.org/wiki/Cat", "ok"),
    ("https://en.m.wikipedia.org/wiki/Cat", "ok"), (WIKI + "12345", "numeric_page"), (WIKI + "1999", "numeric_page"),
    (WIKI + "1999;v", "numeric_page"), (WIKI + "١٢٣", "numeric_page"), (WIKI + "List_of_cats", "list_page"),
    (WIKI + "Cat_(disambiguation)", "disambiguation"), (WIKI + "Disambiguation_(x)", "disambiguation"),
    (WIKI + "Disambiguation", "ok"), (WIKI + "Timeline_of_cats", "timeline"), (WIKI + "C", "low_quality"),
    ("https://en.wikipedia.org", "ok"), ("https://arxiv.org/abs/" + "%41" * 6, "low_quality"),
    ("https://arxiv.org/abs/" + "%41" * 5, "ok"), ("https://mit.edu/about", "ok"),
]

PREDICATES = [
    (WIKI + "Cat", True, False, True, "en.wikipedia.org"),
    ("https://wikipedia.org.evil.com/x", True, False, True, "wikipedia.org.evil.com"),
    ("https://evil.com/a.edu", False, False, True, "evil.com"),
    ("https://u@MIT.edu:80/credit", True, True, True, "u@mit.edu:80"),
    ("ftp://mit.edu/x", False, False, True, "mit.edu"),
    (WIKI + "History_of_art", True, True, True, "en.wikipedia.org"),
    ("http:///wikipedia.org", False, False, True, ""), ("", False, False, False, ""), (None, False, False, False, ""),
]


def column(spark, values, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, u string")
    return [r.x for r in rows.select("i", expr(F.col("u")).alias("x")).orderBy("i").collect()]


def test_verdicts(spark):
    assert column(spark, [u for u, _ in VERDICTS], urls.url_verdict) == [v for _, v in VERDICTS]


def test_verdict_holds_for_cleaned_url(spark):
    values = [u for u, _ in VERDICTS]
    assert column(spark, values, urls.url_verdict) == column(spark, values, lambda u: urls.url_verdict(
        F.when(u.isNull(), u).otherwise(urls.clean_url(u))))


def test_predicates(spark):
    given = [p[0] for p in PREDICATES]
    for at, expr in ((1, urls.valid_url), (2, urls.junk_url), (3, urls.trusted_url), (4, urls.url_domain)):
        assert column(spark, given, expr) == [p[at] for p in PREDICATES]


def verdict(url):
    """The rules one after the other."""
    low, path = url.lower(), urlparse(url).path
    last = path.rstrip("/").split("/")[-1]
    rules = [
        ("empty", not url), ("url_length", len(url) > 200), ("query_params", "?" in url),
        ("extension", low.endswith(tuple("." + e for e in options.BLOCKED_EXTENSIONS))),
        ("namespace", any(n in low for n in options.BLOCKED_NAMESPACES)),
        ("non_en_wikipedia", ".wikipedia.org" in low and not re.match("https?://en\\.", low)),
        ("numeric_page", re.fullmatch(r"/wiki/\d+", path)), ("list_page", "list_of" in low or "list%5fof" in low),
        ("disambiguation", "disambiguation" in low and "(" in url), ("timeline", "timeline" in low),
        ("low_quality", 0 < len(last) < 3 or url.count("%") > 5),
    ]
    return next((reason for reason, hit in rules if hit), "ok")


def test_verdicts_of_odd_urls(spark):
    rng = random.Random(23)
    starts = ["http://", "https://en.", "HTTP://", "ftp://", "//", "", "/", "mailto:", "foo://", "https://de."]
    hosts = ["h.edu", "wikipedia.org", "a.wikipedia.org", "u@M.edu:80", ""]
    pieces = ["/", "a", "bc", "//", "#", "f", ";p", ";", "\t", "..", "%20", ":", "ü", "12", "/wiki/", "1", "Talk:", "x.png",
              "List_of", "(", "disambiguation", "timeline", "\U0001f600", "%41%42%43"]
    given = [rng.choice(starts) + rng.choice(hosts) + "".join(rng.choices(pieces, k=rng.randint(0, 6))) for _ in range(6000)]
    want = [verdict(u) for u in given]
    assert column(spark, given, urls.url_verdict) == want
    assert len(set(want)) == 9


def test_priority(spark):
    def score(u):
        return urls.url_priority(u, F.lit(2))
    given = [WIKI + "Cat", WIKI + "User:X", "/wiki/Cat"]
    assert column(spark, given, score) == [3.0, 10003.0, 2.0]
    assert column(spark, given, lambda u: urls.url_priority(u, F.lit(2), "path")) == [2.0, 10003.0, 2.0]


def normal(url):
    if not url:
        return ""
    parts = urlsplit(url)
    return urlunsplit(parts._replace(fragment="")).rstrip("/")


def random_urls(n, seed):
    rng = random.Random(seed)
    schemes = ["http://", "https://", "HTTP://", "ftp://", "//", "", "/", "mailto:", "http:/", "http:"]
    hosts = ["h.edu", "X.Org:80", "u@MIT.edu", "a.b.c", ""]
    pieces = ["/", "a", "b c", "//", "?", "q=1", "#", "f", ";p", "\t", ".", "..", "%20", ":", "ü", "\n", "~", "A"]
    out = []
    for _ in range(n):
        out.append(rng.choice(schemes) + rng.choice(hosts) + "".join(rng.choices(pieces, k=rng.randint(0, 7))))
    return out


def test_normalize_and_parts_match_the_standard_library(spark):
    given = random_urls(3000, 1) + ["http://x.edu/a//", "HTTP://X.edu/a?", " http://x.edu/a ", None, "http:", "http:///x"]
    assert column(spark, given, urls.normalize_url) == [normal(u) for u in given]
    assert column(spark, given, urls.netloc) == ["" if u is None else urlsplit(u).netloc.lower() for u in given]
    assert column(spark, given, urls.url_path) == [None if u is None else urlparse(u).path for u in given]
    assert column(spark, given, urls.clean_url) == [None if u is None else u.split("#")[0].rstrip("/") for u in given]


def test_resolve_matches_the_standard_library(spark):
    bases = ["http://h.edu/a/b?q=1#f", "https://h.edu", "http://h.edu/a/", "http://h.edu/a;p/c;x", "http://h.edu/?"]
    hrefs = random_urls(600, 2) + ["", "#x", "?", "../x", "./y", "x/../y", "http://[bad", "javascript:void(0)"]
    pairs = [(b, h) for b in bases for h in hrefs]

    def want(b, h):
        try:
            return urljoin(b, h)
        except ValueError:
            return None
    rows = spark.createDataFrame([(i, b, h) for i, (b, h) in enumerate(pairs)], "i int, b string, h string")
    got = [r.x for r in rows.select("i", urls.resolve_url(F.col("b"), F.col("h")).alias("x")).orderBy("i").collect()]
    assert got == [want(b, h) for b, h in pairs]


def test_payload_key_is_ascii_json(spark):
    given = ["http://a/b", 'q"\\', "ü\U0001f600\x01\n\té", ""]
    got = column(spark, given, lambda u: text.payload_key(u, F.lit(3)))
    assert got == [json.dumps({"url": u, "depth": 3}) for u in given]


def test_preview_and_backoff(spark):
    assert column(spark, ["x" * 201, "x" * 200, None], text.preview) == ["x" * 200 + "...", "x" * 200, ""]
    assert [r.d for r in spark.range(3).select(text.backoff_delay(F.col("id")).alias("d")).collect()] == [1.0, 2.0, 4.0]
