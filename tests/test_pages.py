import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from pagelode.functions import html
from pagelode.operators import links
from pagelode.session import workdir
from pagelode.sources import crawl_log, index, pages, url_batches

CASES = [
    ("<p>a</p>", "No Title", "a"),
    ("<title> T </title><p> x <b>y</b></p>", "T", "T x y"),
    ("<title>  </title>", "", ""),
    ("<title></title>z", "No Title", "z"),
    ("<title>a<b>c</b></title>", "No Title", "a c"),
    ("<title><b>c</b></title>", "c", "c"),
    ("<p>a&amp;b<!-- c -->d</p>", "No Title", "a&b d"),
    ("<script>s</script><style>t</style>u", "No Title", "u"),
    ("<div><template>x<b>y</b></div>z", "No Title", "z"),
    ("<p>a&am</p>&amp", "No Title", "a&am &amp"),
    ("<p>&nosuch; &#65;&#x42;&#150;&#xD800;</p>", "No Title", "&nosuch AB–�"),
    ("<p>a<br>b<p>c", "No Title", "a b c"),
    ("<ruby>k<rt>r</rt></ruby>", "No Title", "k"),
    (" x y ", "No Title", "x y"),
]


@pytest.mark.parametrize("page,title,content", CASES)
def test_reader(page, title, content):
    assert html.PageReader().read(page)[:2] == (title, content)


def test_links_in_order_once(spark):
    page = ('<a href="/wiki/B">1</a><a href="/wiki/A#x">2</a><a href="https://en.wikipedia.org/wiki/B/">3</a>'
            '<a href="/w/login">4</a><a href="https://evil.com/x">5</a><a>6</a><a href>7</a><a href="../C">8</a>')
    rows = spark.createDataFrame([(1, "https://en.wikipedia.org/wiki/X/Y", page), (2, "u", None), (3, "u", "")],
                                 "page_id long, url string, html string")
    got = html.parse_pages(rows).collect()
    root = "https://en.wikipedia.org/wiki/"
    assert len(got) == 1
    assert got[0].links == [root + "B", root + "A", root + "X/Y", root + "C"]


def test_reject_counters(spark):
    docs = spark.createDataFrame([(1, "u", [
        "https://en.wikipedia.org/wiki/12", "https://en.wikipedia.org/wiki/C", "https://arxiv.org/abs/" + "%41" * 6,
        "https://en.wikipedia.org/wiki/Cat", ""])], "page_id long, url string, links array<string>")
    row = links.reject_stats(links.link_rows(docs)).first()
    assert (row.numeric_pages, row.low_quality_pages, row.other, row.total, row.accepted) == (1, 2, 1, 4, 1)


def test_both_fanout_caps_agree(spark, sf_dir):
    from pagelode.registry import derived as D

    docs = D.docs(spark, sf_dir, ("links",))
    by_array = docs.select("page_id", F.explode(links.accepted_links(F.col("links"), 2)).alias("link"))
    by_rows = links.fanout_cap(links.accepted(links.link_rows(docs)), cap=2).select("page_id", "link")
    assert by_array.exceptAll(by_rows).count() == by_rows.exceptAll(by_array).count() == 0 < by_rows.count()


def test_batches_come_back(spark):
    rows = spark.range(60).select((F.col("id") * 7).alias("n"), F.concat(F.lit("u"), "id").alias("url"),
                                  F.when(F.col("id") % 2 == 0, 3).alias("depth"))
    messages = url_batches.url_batches(rows.repartition(5), F.lit("t"), ["n"], target=20)
    assert messages.count() == 3
    back = url_batches.read_url_batches(messages).orderBy("batch", "pos").collect()
    assert [(r.url, r.depth) for r in back] == [(f"u{i}", 3 if i % 2 == 0 else 0) for i in range(60)]
    assert [r.batch_size for r in back][::25] == [25, 25, 10]


def test_upsert_keeps_last_and_sets_bad_rows_aside(spark):
    docs = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "3", 1), ("", "4", 1), (None, "5", 1)],
                                 "url string, title string, at int")
    assert sorted((r.url, r.title) for r in index.upsert(docs, ["at"]).collect()) == [("a", "2"), ("b", "3")]
    assert index.quarantined(docs).count() == 2
    chunks = index.bulk_summary(docs, ["at", "title"], 2, target=1).orderBy("chunk").collect()
    assert [(c.bulk_size, c.indexed_count, c.failed_count) for c in chunks] == [(2, 2, 0), (2, 0, 2), (1, 1, 0)]


def test_index_write_is_one_pass_with_counts(spark):
    rows = [("a", "1", 1), ("a", "2", 2), ("b", "3", 1), ("", "4", 1), (None, "5", 1), (None, "5", 1)]
    docs = spark.createDataFrame(rows, "url string, title string, s int").select(
        "url", "title", F.lit("c").alias("content"), F.array().cast("array<string>").alias("links"),
        F.timestamp_seconds("s").alias("fetched_at"))
    path, seen = workdir(spark, "docs"), Observation()
    stored = index.write_index(docs.repartition(4), path, ["fetched_at"], seen)
    assert sorted((r.url, r.title) for r in stored.collect()) == [("a", "2"), ("b", "3")]
    assert sorted(r.title for r in index.read_quarantine(spark, path).collect()) == ["4", "5", "5"]
    assert seen.get == {"bulk_size": 6, "indexed_count": 3, "failed_count": 3}


def test_fetch_finds_newest_copy_or_nothing(spark):
    store = spark.createDataFrame([(1, "http://a/x#1", "old"), (2, "http://a/x/", "new")],
                                  "page_id long, url string, html string")
    want = spark.createDataFrame([("http://a/x",), ("http://a/y",)], "url string")
    assert {(r.url, r.html) for r in pages.fetched(want, store).collect()} == {("http://a/x", "new"), ("http://a/y", None)}


def test_log_keeps_known_keys_only(spark):
    rows = spark.createDataFrame([("2024-01-01 00:00:01", "INFO", "m", None, 3, "x")],
                                 "t string, level string, message string, url string, depth int, domain string")
    line = crawl_log.log_lines(rows.withColumn("ts", F.col("t").cast("timestamp"))).first().value
    assert line == '{"ts":"2024-01-01T00:00:01","level":"INFO","message":"m","depth":3}'
