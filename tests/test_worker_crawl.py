import json
import random

from pyspark.sql import functions as F

from pagelode.operators import robots
from pagelode.options import CrawlOptions
from pagelode.plans import worker_crawl as wc
from pagelode.session import workdir

PAGE = "https://{}.edu/page{}"
OPTIONS = CrawlOptions(max_depth=4, lease_seconds=50, per_domain_delay_seconds=15.0, robots_ttl_seconds=100)
BODIES = [("b.edu", "User-agent: *\nDisallow: /page1", 0.0), ("b.edu", "User-agent: *\nAllow: /", 130.0)]


def number(url):
    return int(url.rsplit("page", 1)[1])


def after(url, epoch):
    """Seconds until the acknowledgement: some workers crash, some are late."""
    return {1: None, 2: 70.0}.get(number(url) % 5, 1.0) if epoch == 1 else 1.0


def outcome(leases):
    n = F.regexp_extract("url", r"page(\d+)", 1).cast("int") % 5
    first = F.col("epoch") == 1
    return leases.withColumn("after_seconds", F.when(first & (n == 1), F.lit(None)).when(first & (n == 2), 70.0).otherwise(1.0))


def graph(seed=3, n=16):
    rng = random.Random(seed)
    names = [PAGE.format("aab"[i % 3], i) for i in range(n)]
    return {u: rng.sample(names, rng.randint(0, 4)) for u in names[:-3]}, names


def by_hand(links, starts, options, workers, rounds):
    """The crawl one URL at a time; acknowledgements and documents."""
    key = lambda u, d: json.dumps({"url": u, "depth": d})
    queue = {u: (1, 0.0, "", 0, i, 0, 0) for i, u in enumerate(starts)}  # tier, score, key, round, seq, depth, epoch
    leases, pending, found, last, cache = {}, [], set(starts), {}, {}
    acks, documents = [], []
    for r in range(1, rounds + 1):
        now = workers.begin + (r - 1) * workers.round_seconds
        end = now + workers.round_seconds
        for u, (epoch, at, depth, _) in list(leases.items()):
            if at + options.lease_seconds <= now:
                queue[u] = (0, float(depth), key(u, depth), r, 0, depth, epoch)
                del leases[u]
        due, seen = [], {}
        for u in sorted(queue, key=lambda u: queue[u][:5]):
            domain = u.split("/")[2]
            i = seen.get(domain, 0)
            at = max(now, last.get(domain, -1e9) + options.per_domain_delay_seconds) + i * options.per_domain_delay_seconds
            if at < end:
                seen[domain] = i + 1
                due.append((u, domain, at))
        for domain in seen:
            if domain not in cache or now - cache[domain] >= options.robots_ttl_seconds:
                cache[domain] = now
        arriving = pending
        for u, domain, at in due[:workers.batch_size]:
            body = [b for d, b, since in BODIES if d == domain and since <= cache[domain]][-1:]
            allowed = not (body and "Disallow" in body[0] and u.split("/")[3].startswith("page1"))
            depth, epoch = queue[u][5], queue[u][6] + 1
            leases[u] = (epoch, at, depth, allowed)
            last[domain] = max(last.get(domain, at), at)
            del queue[u]
            if after(u, epoch) is not None:
                arriving.append((u, epoch, at + after(u, epoch)))
        pending, done = [a for a in arriving if a[2] >= end], []
        for u, epoch, at in (a for a in arriving if a[2] < end):
            if u in leases and leases[u][0] == epoch:
                acks.append((u, epoch, at, "done", r))
                done.append((at, u, *leases[u][2:]))
            else:
                acks.append((u, epoch, at, "late", r))
        for at, u, depth, allowed in sorted(done):
            del leases[u]
            if allowed and depth <= options.max_depth and u in links:
                documents.append((u, depth, r))
                for t in links[u]:
                    if t not in found:
                        found.add(t)
                        queue[t] = (0, depth + 1.0, key(t, depth + 1), r, 0, depth + 1, 0)
        if not queue and not leases and not pending:
            break
    return sorted(acks), sorted(documents)


def run(spark, path, links, starts, workers, **more):
    store = spark.createDataFrame(list(links.items()), "url string, links array<string>")
    start = spark.createDataFrame(list(enumerate(starts)), "seq long, url string")
    history = spark.createDataFrame(BODIES, "domain string, body string, valid_from double")
    return wc.crawl_by_workers(store, start, path, workers, OPTIONS, history, **more)


def seen(state):
    acks = sorted((r.url, r.epoch, r.at, r.status, r["round"]) for r in state.acknowledged().collect())
    return acks, sorted((r.url, r.depth, r["round"]) for r in state.documents().collect())


def test_workers_that_crash_or_are_late(spark):
    """Leases, waits and rules that change, against a walk; stopped once and taken up again."""
    links, names = graph()
    workers = wc.Workers(outcome, 3, 9, 60.0)
    path = workdir(spark, "workers")
    run(spark, path, links, names[:4], workers, max_rounds=3)
    # A round that was begun and lost leaves parts but no progress.
    spark.createDataFrame([("https://a.edu/page0", 0, 9)], "url string, depth int, seq long").write.parquet(f"{path}/batch/gen=4")
    state = run(spark, path, links, names[:4], workers)
    acks, documents = by_hand(links, names[:4], OPTIONS, workers, 100)
    assert seen(state) == (acks, documents)
    assert {a[3] for a in acks} == {"done", "late"} and len(documents) < len([a for a in acks if a[3] == "done"])
    done = [a[0] for a in acks if a[3] == "done"]
    assert len(done) == len(set(done))
    progress = state.progress().orderBy("round").collect()
    assert sum(p.recovered for p in progress) > 0 and progress[-1].waiting + progress[-1].open_leases + progress[-1].under_way == 0
    # The rules of b.edu change while old ones are kept: some pages are turned down, later ones are read.
    read = {u for u, *_ in documents}
    assert any(u in read for u in done if "b.edu/page1" in u) or not any("b.edu/page1" in u for u in done)


def test_robots_by_age(spark):
    cache = spark.createDataFrame([("a", 50.0), ("b", 10.0), ("c", 5.0)], "domain string, fetched_at double")
    history = spark.createDataFrame([("a", "old", 0.0), ("a", "new", 40.0), ("a", "newest", 60.0), ("b", "late", 11.0)],
                                    "domain string, body string, valid_from double")
    assert [(r.domain, r.body) for r in wc.robots_at(cache, history).collect()] == [("a", "new")]
    domains = spark.createDataFrame([("a",), ("b",), ("d",), ("d",)], "domain string")
    assert sorted(r.domain for r in wc.robots_to_read(domains, cache, 100.0, 60).collect()) == ["b", "d"]
    assert robots.robots_rules(wc.robots_at(cache, history)).count() == 0


def test_a_domain_takes_one_page_per_delay(spark):
    waiting = spark.createDataFrame([(PAGE.format("ab"[i % 2], i), 1, 0, 1.0, i, 0, 0) for i in range(40)], wc.QUEUE)
    visits = spark.createDataFrame([("b.edu", 3, 95.0)], wc.VISITS)
    due = wc.due_in_round(waiting, visits, 100.0, 160.0, 15.0).collect()
    starts = {d: sorted(r.start for r in due if r.domain == d) for d in ("a.edu", "b.edu")}
    assert starts == {"a.edu": [100.0, 115.0, 130.0, 145.0], "b.edu": [110.0, 125.0, 140.0, 155.0]}
    assert wc.due_in_round(waiting, visits, 100.0, 160.0, 0).count() == 40
