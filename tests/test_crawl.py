import json
import random

import pytest
from pyspark.sql import functions as F

from pagelode.operators import robots
from pagelode.options import CrawlOptions
from pagelode.plans import crawl
from pagelode.session import workdir

ROOT = "https://{}.edu/page{}"


def graph(seed, n=60):
    rng = random.Random(seed)
    names = [ROOT.format(rng.choice("aaab"), i) for i in range(n)]
    return {u: rng.sample(names, rng.randint(0, 5)) + rng.choices([u, "https://a.edu/page7.PNG", "https://a.edu/gone"], k=1)
            for u in names if rng.random() < 0.9}, names


def frames(spark, links, starts):
    store = spark.createDataFrame(list(links.items()), "url string, links array<string>")
    start = spark.createDataFrame(list(enumerate(starts)), "seq long, url string")
    return store, start


def by_hand(links, starts, options, batch_size):
    """Items one after the other, with statuses decided as items are queued."""
    queue, discovered, acks, counts = [], set(), [], {}

    def offer(items, budget_counts):
        for u, depth, score, at in items:
            domain = u.split("/")[2]
            if u in discovered or len(queue) >= options.max_frontier_queue_size:
                continue
            if budget_counts.get(domain, 0) >= options.domain_budgets.get(domain, options.domain_max_requests_default):
                continue
            discovered.add(u)
            queue.append((0 if score is not None else 1, score or 0.0, json.dumps({"url": u, "depth": depth}) if score is not None else "", at, u, depth))

    offer([(u, 0, None, (0, i)) for i, u in enumerate(starts)], counts)
    round_no = 0
    while queue and len(acks) < options.max_pages:
        round_no += 1
        queue.sort()
        batch = queue[:batch_size] if batch_size else queue[:]
        del queue[:len(batch)]
        before = dict(counts)
        for place, (_, _, _, _, u, depth) in enumerate(batch):
            fetched = depth <= options.max_depth and u in links
            if fetched:
                good = [t for t in links[u] if not t.endswith(".PNG")]
                offer([(t, depth + 1, depth + 1.0, (round_no, place, i)) for i, t in enumerate(good[:options.max_urls_per_page])], before)
            acks.append((u, depth, fetched))
        for u, _, _ in acks[-len(batch):]:
            counts[u.split("/")[2]] = counts.get(u.split("/")[2], 0) + 1
    return set(acks)


@pytest.mark.parametrize("seed,batch_size,options", [
    (1, None, CrawlOptions()),
    (2, 4, CrawlOptions(max_frontier_queue_size=9, max_urls_per_page=3)),
    (3, 5, CrawlOptions(domain_max_requests_default=12, domain_budgets={"b.edu": 3}, max_pages=40)),
    (4, None, CrawlOptions(max_frontier_queue_size=12, max_depth=2)),
])
def test_crawl_equals_one_by_one(spark, seed, batch_size, options):
    links, names = graph(seed)
    starts = names[:3]
    store, start = frames(spark, links, starts)
    state = crawl.crawl_bfs(store, start, workdir(spark, "crawl"), options, batch_size)
    last = state.last()
    got = {(r.url, r.depth, r.fetched) for r in state.acks(last.round).collect()}
    assert got == by_hand(links, starts, options, batch_size)
    assert last.pages_crawled == len(got)


def test_stop_and_go_on(spark):
    links, names = graph(5)
    store, start = frames(spark, links, names[:2])
    path = workdir(spark, "crawl")
    crawl.crawl_bfs(store, start, path, max_rounds=1)
    # A round that was begun and lost leaves files but no progress; it is done again.
    store.limit(0).select("url").write.parquet(f"{path}/batch/gen=2")
    resumed = crawl.crawl_bfs(store, start, path)
    whole = crawl.crawl_bfs(store, start, workdir(spark, "crawl"))
    a, b = (s.acks(s.last().round) for s in (resumed, whole))
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0 < b.count()
    counts = {r.domain: r.n for r in resumed.domains(resumed.last().round).collect()}
    assert sum(counts.values()) == b.count()
    assert resumed.documents().count() == b.where("fetched").count()
    lines = [json.loads(r.value) for r in resumed.log("w").collect()]
    assert {x["pages_crawled"] for x in lines} == {r.pages_crawled for r in resumed.progress().where("round > 0").collect()}
    assert all(x["message"] == "crawl_batch_complete" and x["worker_id"] == "w" for x in lines)
    assert crawl.CrawlState(spark, workdir(spark, "none")).documents() is None


def test_a_crawl_leaves_documents_batches_and_rejects(spark):
    links, names = graph(6)
    store, start = frames(spark, links, names[:3])
    full = store.withColumn("title", F.concat(F.lit("T "), "url"))
    state = crawl.crawl_bfs(full, start, workdir(spark, "crawl"), published_at=F.lit("t"))
    read = {r.url for r in state.acks(state.last().round).where("fetched").collect()}
    assert {(r.url, r.title) for r in state.documents().collect()} == {(u, "T " + u) for u in read}
    bad = {u: sum(t.endswith(".PNG") for t in links[u]) for u in read}
    assert {(r.url, r.extension, r.total) for r in state.rejects().collect()} == {(u, n, n) for u, n in bad.items() if n}
    sent = [(x["url"], x["depth"]) for r in state.messages().collect() for x in json.loads(r.value)["items"]]
    depth = {r.url: r.depth for r in state.documents().collect()}
    assert sorted(sent) == sorted((t, depth[u] + 1) for u in read for t in links[u] if not t.endswith(".PNG"))


def test_denied_pages_are_acknowledged_without_a_document(spark):
    links = {ROOT.format("a", 1): [ROOT.format("b", 2)], ROOT.format("b", 2): [ROOT.format("a", 3)]}
    store, start = frames(spark, links, [ROOT.format("a", 1)])
    bodies = spark.createDataFrame([("b.edu", "User-agent: *\nDisallow: /page2")], "domain string, body string")
    state = crawl.crawl_bfs(store, start, workdir(spark, "crawl"), rules=robots.robots_rules(bodies))
    got = {(r.url, r.fetched) for r in state.acks(state.last().round).collect()}
    assert got == {(ROOT.format("a", 1), True), (ROOT.format("b", 2), False)}


def test_step_reports(spark):
    links = {ROOT.format("a", 1): [ROOT.format("a", 2), "https://a.edu/x.png", "https://a.edu/y"]}
    store, _ = frames(spark, links, [])
    batch = spark.createDataFrame([(ROOT.format("a", 1), 0, 1), (ROOT.format("a", 9), 0, 2), (ROOT.format("a", 1) + "0", 4, 3)],
                                  "url string, depth int, seq long")
    none, counts = batch.limit(0).select("url"), spark.createDataFrame([], "domain string, n long")
    step = crawl.crawl_step(batch, store, none, none, counts)
    assert [(r.url, r.extension, r.low_quality_pages, r.accepted) for r in step.rejects().collect()] == [(ROOT.format("a", 1), 1, 1, 1)]
    assert [(r.url, r.depth, r.score, r.status) for r in step.statuses().collect()] == [(ROOT.format("a", 2), 1, 1.0, "added")]
    assert step.documents().count() == 1
    assert [r.value for r in step.messages(F.lit("t")).collect()] == [
        '{"items":[{"url":"https://a.edu/page2","depth":1}],"batch_size":1,"published_at":"t"}']
    assert sorted(r.fetched for r in step.acks.collect()) == [False, False, True]


def test_store_keeps_the_newest_copy(spark):
    rows = spark.createDataFrame([(1, "https://a.edu/x#1", '<a href="/old1">'), (2, "https://a.edu/x", '<a href="/new1">')],
                                 "page_id long, url string, html string")
    assert [(r.url, r.links) for r in crawl.parsed_store(rows).collect()] == [("https://a.edu/x", ["https://a.edu/new1"])]


def test_the_store_is_not_dealt_out_again(spark):
    rows = [(ROOT.format("a", i), [ROOT.format("b", i)], f"T {i}") for i in range(50)]
    store = spark.createDataFrame(rows, "url string, links array<string>, title string")
    path = workdir(spark, "store")
    crawl.write_store(store, path)
    kept = crawl.open_store(spark, path)  # as a later session would
    assert sorted((r.url, r.links, r.title) for r in kept.collect()) == sorted(rows)
    batch = kept.select("url").limit(20).selectExpr("url", "0 AS depth", "1L AS seq")
    plan = batch.hint("merge").join(kept, "url")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_a_store_leaves_no_table_and_may_lie_anywhere(spark):
    store = spark.createDataFrame([(ROOT.format("a", i), [ROOT.format("b", i)]) for i in range(30)], "url string, links array<string>")
    before = {t.name for t in spark.catalog.listTables()}
    kept = crawl.write_store(store, workdir(spark, "it's a store"))
    assert {t.name for t in spark.catalog.listTables()} == before
    assert kept.count() == 30 and kept.join(store.select("url"), "url").count() == 30
