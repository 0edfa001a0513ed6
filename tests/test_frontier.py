import json
import random

from pyspark.sql import functions as F

from pagelode.operators import frontier, spread
from pagelode.session import no_rows


def url(name):
    return f"https://{name[0]}.edu/{name[1:]}" if name else ""


def frames(spark, items, visited, discovered, counts, budgets=None):
    cand = spark.createDataFrame([(i, u) for i, u in items], "seq long, url string").repartition(3)
    one = lambda urls: spark.createDataFrame([(u,) for u in urls], "url string") if urls else no_rows(spark, "url string")
    acks = spark.createDataFrame(list(counts.items()), "domain string, n long") if counts else no_rows(spark, "domain string, n long")
    lim = spark.createDataFrame(list(budgets.items()), "domain string, budget string") if budgets else None
    return cand, one(visited), one(discovered), acks, lim


def one_by_one(items, visited, discovered, counts, budgets, queue, limit, default):
    known, out = set(discovered), {}
    for seq, u in sorted(items):
        domain = u.split("/")[2] if u else ""
        budget = default
        if domain in budgets:
            try:
                budget = int(budgets[domain])
            except ValueError:
                budget = default
        if not u:
            out[seq] = "dropped"
        elif u in visited:
            out[seq] = "visited"
        elif u in known:
            out[seq] = "exists"
        elif queue >= limit:
            out[seq] = "throttled"
        elif counts.get(domain, 0) >= budget:
            out[seq] = "domain_budget_exceeded"
        else:
            out[seq] = "added"
            known.add(u)
            queue += 1
    return out


def statuses(df):
    return {r.seq: r.status for r in df.collect()}


def test_admission_example(spark):
    names = ["", "a1", "a2", "b1", "a3", "a3", "c1", "c2", "b1", "c1"]
    items = [(i, url(n)) for i, n in enumerate(names, 1)]
    args = frames(spark, items, [url("a1")], [url("a1"), url("a2")], {"b.edu": 5})
    got = statuses(frontier.admission(*args, queue_size=0, max_queue=2, default_budget=5))
    assert [got[i] for i in range(1, 11)] == [
        "dropped", "visited", "exists", "domain_budget_exceeded", "added", "exists", "added", "throttled", "throttled", "exists"]


def test_admission_equals_one_by_one(spark, monkeypatch):
    rng = random.Random(7)
    for round_no in range(12):
        names = ["".join((rng.choice("abcd"), str(rng.randint(1, 12)))) for _ in range(80)] + ["", "", "a1", "a1", "a1"] * 3
        rng.shuffle(names)
        items = [(s, url(n)) for s, n in zip(sorted(rng.sample(range(10_000), len(names))), names)]
        pool = [url(f"{d}{i}") for d in "abcd" for i in range(1, 13)]
        visited = rng.sample(pool, rng.randint(0, 6))
        discovered = set(visited) | set(rng.sample(pool, rng.randint(0, 8)))
        counts = {f"{d}.edu": rng.randint(0, 4) for d in "abc"}
        budgets = {"a.edu": "2", "c.edu": "many", "d.edu": "0"} if round_no % 2 else {}
        queue, limit, default = rng.randint(0, 5), rng.choice([0, 3, 10, 20, 500]), rng.choice([0, 3, 100])
        # Every other round takes the domains for too many to be broadcast.
        monkeypatch.setattr(spread, "is_small", lambda rows: bool(round_no % 2))
        want = one_by_one(items, set(visited), discovered, counts, budgets, queue, limit, default)
        cand, vis, dis, acks, lim = frames(spark, items, visited, sorted(discovered), counts, budgets)
        got = statuses(frontier.admission(cand, vis, dis, acks, lim, queue, limit, default, target=10, hot_rows=4))
        assert got == want


def test_admitting_twice_adds_nothing(spark):
    items = [(i, url(f"a{i % 7}")) for i in range(1, 30)]
    cand, vis, dis, acks, _ = frames(spark, items, [], [], {})
    added = frontier.admission(cand, vis, dis, acks).where("status = 'added'").select("url")
    assert added.count() == 7
    again = frontier.admission(cand, vis, added, acks)
    assert frontier.enqueue_summary(again).first().added == 0


def test_reserve_order(spark):
    rng = random.Random(9)
    rows = [(f"https://x.edu/{rng.choice('aü~')}{i}", rng.randint(0, 2), t, float(rng.randint(0, 3)) if t == 0 else None, i)
            for i in range(60) for t in [rng.randint(0, 1)]]
    queue = spark.createDataFrame(rows, "url string, depth int, tier int, score double, seq long")
    payload = lambda r: json.dumps({"url": r[0], "depth": r[1]})
    want = sorted((r for r in rows if r[2] == 0), key=lambda r: (r[3], payload(r).encode())) + [r for r in rows if r[2] == 1]
    got = frontier.reserve_batch(queue.repartition(4), 45, "w", 5.0, 60).collect()
    assert [r.payload for r in got] == [payload(r) for r in want[:45]]
    assert {(r.worker_id, r.reserved_at, r.lease_seconds) for r in got} == {("w", 5.0, 60)}


def test_requeue_example(spark):
    def lease(name, depth, at):
        return (json.dumps({"url": url(name), "depth": depth}), json.dumps({"worker_id": "w", "reserved_at": at, "lease_seconds": 9}))
    rows = [lease("p1", 2, 700), lease("p2", 1, 701), lease("p3", 1, 100), (lease("p4", 1, 0)[0], "??"),
            ("{broken", lease("q", 0, 100)[1]), lease("p5", 0, 600)]
    inflight = spark.createDataFrame(rows, "payload string, meta string")
    visited = spark.createDataFrame([(url("p3"),)], "url string")
    kept, back = frontier.requeue_stale(inflight, visited, 1000, 300)
    assert {json.loads(r.payload)["url"] for r in kept.collect()} == {url("p2"), url("p4")}
    assert {(r.url, r.depth, r.tier, r.score) for r in back.collect()} == {(url("p1"), 2, 0, 2.0), (url("p5"), 0, 0, 0.0)}
    _, fifo = frontier.requeue_stale(inflight, visited, 1000, 300, priority=False)
    assert {(r.tier, r.score) for r in fifo.collect()} == {(1, None)}


def test_seeds_only_when_no_work_is_left(spark):
    start = frontier.start_frame(spark, ("https://en.wikipedia.org/wiki/A/#x", "https://evil.com/"))
    none, some = no_rows(spark, "url string"), spark.createDataFrame([("u",)], "url string")
    assert [(r.seq, r.url, r.depth, r.score) for r in frontier.seeds(start, none, none).collect()] == [
        (1, "https://en.wikipedia.org/wiki/A", 0, None)]
    assert frontier.seeds(start, none, some).count() == 0 == frontier.seeds(start, some, none).count()


def test_unknown_ack_counts(spark):
    leases = spark.createDataFrame([("p", "a")], "payload string, url string")
    acks = spark.createDataFrame([("p", "http://x.edu/a/"), ("q", "http://x.edu/b"), ("r", "")], "payload string, url string")
    left, visited = frontier.acknowledged(no_rows(spark, "url string"), leases, acks)
    assert left.count() == 0
    assert {r.url for r in visited.collect()} == {"http://x.edu/a", "http://x.edu/b"}


def test_politeness(spark):
    rows = spark.createDataFrame([("a.edu", "u1"), ("b.edu", "u2"), ("c.edu", "u3")], "domain string, url string")
    stats = spark.createDataFrame([("a.edu", 99.5), ("b.edu", 10.0)], "domain string, s double").select(
        "domain", F.col("s").cast("timestamp").alias("last_access"))
    now = F.timestamp_seconds(F.lit(100))
    got = {r.domain: r.wait_seconds for r in frontier.politeness_wait(rows, stats, now, 2).collect()}
    assert got == {"a.edu": 1.5, "b.edu": 0.0, "c.edu": 0.0}


def test_decode_payload_depths(spark):
    u = "https://a.edu/page"
    cases = [('"3"', u, 3), ("2.7", u, 2), ('"x"', "", 0), ('"2.7"', "", 0), ("null", "", 0), ("true", u, 1), ('" 4 "', u, 4), ("-1", u, -1), ("[1]", "", 0)]
    rows = [(json.dumps({"url": u})[:-1] + f', "depth": {d}}}', want_url, want) for d, want_url, want in cases]
    rows += [(json.dumps({"url": u}), u, 0), ("{broken", "", 0), ("[]", "", 0), (None, "", 0), (json.dumps({"depth": 2}), "", 2)]
    got = spark.createDataFrame(rows, "p string, want_url string, want int").withColumn("i", frontier.decode_payload(F.col("p")))
    for r in got.collect():
        assert (r.i.url, r.i.depth) == (r.want_url, r.want), r.p


def test_bare_urls_are_queued_at_depth_0(spark):
    rows = spark.createDataFrame([(1, "https://a.edu/a"), (2, "https://a.edu/b"), (3, "https://a.edu/a")], "seq long, url string")
    decided = frontier.decide(rows, None, no_rows(spark, "url string"), no_rows(spark, "domain string, n long"))
    assert {(r.url, r.depth, r.tier, r.score) for r in decided.queue().collect()} == {("https://a.edu/a", 0, 1, None), ("https://a.edu/b", 0, 1, None)}
