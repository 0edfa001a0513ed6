"""A crawl by workers that may crash: leases with epochs, waits per domain, robots rules by age.

Time goes on in rounds. At the start of a round, leases that ran out go back to the queue, ahead of the others of
their depth. Of the queue, what may be entered in the round is reserved, best first: a domain takes one page
per delay, also after its last access. Robots rules are those that were read last; a domain whose rules are
older than their time to live reads them anew, as they are then. A reservation is a lease with the epoch of
its URL, one more than the lease before. What workers acknowledge until the end of the round counts if the lease
of that epoch is still open; a late one is recorded as such and changes nothing, as the URL has a newer lease, or was
read by then.

State is one part of each table per round, and a round without its row of progress never happened, as in `crawl`.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagelode.operators import frontier, robots
from pagelode.options import CrawlOptions
from pagelode.plans import crawl
from pagelode.session import no_rows, path_exists
from pagelode.sources.url_log import UrlLog

QUEUE = f"{frontier.QUEUE}, epoch int"
LEASES = "url string, depth int, seq long, epoch int, worker_id string, reserved_at double, allowed boolean"
ACKS = "url string, epoch int, worker_id string, at double"
TAKEN = f"{ACKS}, status string, depth int, allowed boolean, seq long"
VISITS = "domain string, n long, last_access double"
CACHE = "domain string, fetched_at double"
PROGRESS = "round int, now double, waiting long, open_leases long, under_way long, recovered long, reserved long, done long, late long"


@dataclass(frozen=True)
class Workers:
    """How a crawl is worked off. `outcome` takes leases and adds `after_seconds`: how long after its reservation a
    worker acknowledges, null for never."""

    outcome: Callable[[DataFrame], DataFrame]
    count: int = 8
    batch_size: int | None = None
    round_seconds: float = 60.0
    begin: float = 0.0


class WorkerCrawl:
    """The tables of such a crawl below a shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.found = UrlLog.at(spark, f"{path}/discovered")

    def folder(self, name: str, r: int) -> str:
        return f"{self.path}/{name}/gen={r}"

    def write(self, rows: DataFrame, name: str, r: int, schema: str) -> DataFrame:
        rows.select(*[c.split()[0] for c in schema.split(", ")]).write.mode("overwrite").parquet(self.folder(name, r))
        return self.read(name, r, schema)

    def read(self, name: str, r: int, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.folder(name, r))

    def upto(self, name: str, last: int, schema: str) -> DataFrame:
        return self.spark.read.schema(f"{schema}, gen int").parquet(f"{self.path}/{name}").where(F.col("gen") <= last)

    def progress(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).parquet(f"{self.path}/progress")

    def last(self):
        if not path_exists(self.spark, f"{self.path}/progress"):
            return None
        return self.progress().orderBy(F.desc("round")).first()

    def commit(self, **row):
        fields = [f.split() for f in PROGRESS.split(", ")]
        self.spark.range(0, 1, 1, 1).select(*[F.lit(row[n]).cast(k).alias(n) for n, k in fields]).write.mode("append").parquet(f"{self.path}/progress")
        return self.last()

    def acknowledged(self) -> DataFrame:
        """All acknowledgements so far: url, epoch, worker_id, at, status (done or late), round."""
        last = self.last()
        rows = self.upto("acks", last.round, TAKEN).where("gen > 0")
        return rows.select("url", "epoch", "worker_id", "at", "status", F.col("gen").alias("round"))

    def documents(self) -> DataFrame:
        """The pages that were read: all columns of the store, depth and round."""
        rows = self.spark.read.parquet(f"{self.path}/documents").where(F.col("gen") <= self.last().round)
        return rows.withColumnRenamed("gen", "round").drop("seq")


def robots_at(cache: DataFrame, history: DataFrame) -> DataFrame:
    """domain, body: the rules that a domain had when they were read. `cache` has domain and fetched_at, `history`
    domain, body and valid_from; a domain without rules by then has none."""
    known = cache.join(history, "domain").where(F.col("valid_from") <= F.col("fetched_at"))
    return known.groupBy("domain").agg(F.max_by("body", F.struct("valid_from", "body")).alias("body"))


def robots_to_read(domains: DataFrame, cache: DataFrame, now: float, ttl_seconds: float) -> DataFrame:
    """Of the domains, those that have no rules younger than their time to live."""
    fresh = cache.where(F.lit(now) - F.col("fetched_at") < ttl_seconds)
    return domains.select("domain").distinct().join(fresh.select("domain"), "domain", "left_anti")


def due_in_round(waiting: DataFrame, visits: DataFrame, now: float, end: float, delay: float) -> DataFrame:
    """Rows of the queue that can be entered in [now, end), with `start`: the first ones of each domain, one per
    delay. No more than fit into a round are kept of a domain by any task, so a hot one is no single task."""
    named = frontier.with_domain(waiting)
    if delay <= 0:
        return named.withColumn("start", F.lit(now))
    order = W.partitionBy("domain").orderBy(*frontier.queue_order(("round", "seq")))
    most = math.ceil((end - now) / delay)
    first = named.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= most)
    free = F.greatest(F.lit(now), F.coalesce(F.col("last_access") + delay, F.lit(now)))
    start = free + (F.col("_place") - 1) * F.lit(float(delay))
    return first.join(visits.select("domain", "last_access"), "domain", "left").withColumn("start", start) \
        .where(F.col("start") < end).drop("_place", "last_access")


def crawl_by_workers(store: DataFrame, start: DataFrame, path: str, workers: Workers, options: CrawlOptions = CrawlOptions(),
                     history: DataFrame | None = None, max_rounds: int | None = None) -> WorkerCrawl:
    """Rounds until no work is left, `max_pages` are read, or `max_rounds` are done. `store` is a parsed store
    (see `crawl.write_store`), `history` robots bodies as `domain, body, valid_from` (seconds). Called again on
    the same path, it goes on where it stopped."""
    state = WorkerCrawl(store.sparkSession, path)
    budgets = crawl._budget_frame(state.spark, options.domain_budgets)
    last = state.last() or _begin(state, start, options, budgets, workers)
    rounds = 0
    while last.waiting + last.open_leases + last.under_way and (max_rounds is None or rounds < max_rounds):
        if _pages(state, last.round) >= options.max_pages:
            break
        last = _round(state, last, store, options, budgets, workers, history)
        rounds += 1
    return state


def _pages(state: WorkerCrawl, r: int) -> int:
    return state.read("visits", r, VISITS).agg(F.sum("n")).first()[0] or 0


def _begin(state: WorkerCrawl, start: DataFrame, options: CrawlOptions, budgets: DataFrame | None, workers: Workers):
    spark = state.spark
    none = no_rows(spark, "url string")
    empty = no_rows(spark, frontier.QUEUE)
    seeds = frontier.seeds(start, empty, empty, options.valid_domains)
    decision = frontier.decide(
        seeds, None, none, no_rows(spark, "domain string, n long"), budgets, 0,
        options.max_frontier_queue_size, options.domain_max_requests_default, state.folder("facts", 0))
    queue = state.write(decision.queue(options.priority_enabled).withColumn("epoch", F.lit(0)), "queue", 0, QUEUE)
    state.found.append(queue, 0)
    for name, schema in (("leases", LEASES), ("pending", ACKS), ("visits", VISITS), ("robots", CACHE), ("acks", TAKEN)):
        state.write(no_rows(spark, schema), name, 0, schema)
    return state.commit(round=0, now=workers.begin, waiting=decision.added, open_leases=0, under_way=0, recovered=0, reserved=0, done=0, late=0)


def _round(state: WorkerCrawl, last, store: DataFrame, options: CrawlOptions, budgets: DataFrame | None, workers: Workers,
           history: DataFrame | None):
    r, now = last.round + 1, workers.begin + last.round * workers.round_seconds
    end = now + workers.round_seconds
    leases, visits = state.read("leases", last.round, LEASES), state.read("visits", last.round, VISITS)

    # 1. Leases that ran out.
    over = F.col("reserved_at") + options.lease_seconds <= now
    back = leases.where(over).select("url", "depth", F.lit(0).alias("tier"), F.col("depth").cast("double").alias("score"), "seq",
                                     F.lit(r).alias("round"), "epoch")
    waiting = state.write(state.read("queue", last.round, QUEUE).unionByName(back), "waiting", r, QUEUE)

    # 2. What may be entered, under the rules that were read last.
    due = due_in_round(waiting, visits, now, end, options.per_domain_delay_seconds)
    cache = state.read("robots", last.round, CACHE)
    if history is not None:
        again = robots_to_read(due, cache, now, options.robots_ttl_seconds).withColumn("fetched_at", F.lit(now))
        cache = cache.join(again.select("domain"), "domain", "left_anti").unionByName(again)
    cache = state.write(cache, "robots", r, CACHE)
    ordered = due.orderBy(*frontier.queue_order(("round", "seq")))
    taken = ordered.limit(workers.batch_size) if workers.batch_size else due
    if history is None:
        judged = taken.withColumn("allowed", F.lit(True))
    else:
        judged = robots.robots_filter(taken, robots.robots_rules(robots_at(cache, history)), options.robots_agent)
    worker = F.concat(F.lit("worker-"), F.pmod(F.xxhash64("url", "epoch"), F.lit(workers.count)).cast("string"))
    reserved = state.write(judged.select(
        "url", "depth", "seq", (F.col("epoch") + 1).alias("epoch"), worker.alias("worker_id"), F.col("start").alias("reserved_at"), "allowed"),
        "reserved", r, LEASES)

    # 3. Acknowledgements until the end of the round, by the epoch of their lease.
    ran = workers.outcome(reserved).where(F.col("after_seconds").isNotNull()).select(
        "url", "epoch", "worker_id", (F.col("reserved_at") + F.col("after_seconds")).alias("at"))
    arriving = state.write(state.read("pending", last.round, ACKS).unionByName(ran), "arriving", r, ACKS)
    pending = state.write(arriving.where(F.col("at") >= end), "pending", r, ACKS)
    open_now = leases.where(~over).unionByName(reserved)
    known = open_now.select("url", "epoch", "depth", "allowed", "seq", F.lit(True).alias("_open"))
    acks = state.write(arriving.where(F.col("at") < end).join(known, ["url", "epoch"], "left").withColumn(
        "status", F.when(F.col("_open"), "done").otherwise("late")), "acks", r, TAKEN)
    done = acks.where("status = 'done'")
    left = state.write(open_now.join(done.select("url", "epoch"), ["url", "epoch"], "left_anti"), "leases", r, LEASES)

    # 4. Pages that were read, and their links.
    n_left = waiting.count() - reserved.count()
    batch = done.where("allowed").orderBy("at", "url").select("url", "depth", F.monotonically_increasing_id().alias("seq"))
    batch = state.write(batch, "batch", r, crawl.CrawlState._BATCH)
    step = crawl.crawl_step(batch, store, None, state.found.read(last.round).distinct(), visits.select("domain", "n"), budgets,
                            n_left, options, None, state.folder("step", r), state.folder("documents", r))
    added = step.admission.queue(options.priority_enabled, r).withColumn("epoch", F.lit(0))
    rest = waiting.join(reserved.select("url"), "url", "left_anti")
    queue = state.write(rest.unionByName(added), "queue", r, QUEUE)
    state.found.append(queue.where((F.col("round") == r) & (F.col("epoch") == 0)), r)
    read = frontier.with_domain(done).groupBy("domain").agg(F.count(F.lit(1)).alias("n"))
    entered = frontier.with_domain(reserved).groupBy("domain").agg(F.max("reserved_at").alias("last_access"))
    news = read.select("domain", "n", F.lit(None).cast("double").alias("last_access")).unionByName(
        entered.select("domain", F.lit(0).cast("long").alias("n"), "last_access"))
    state.write(visits.unionByName(news).groupBy("domain").agg(F.sum("n").alias("n"), F.max("last_access").alias("last_access")), "visits", r, VISITS)
    counts = acks.agg(F.count_if(F.col("status") == "done").alias("done"), F.count_if(F.col("status") == "late").alias("late")).first()
    out = state.commit(round=r, now=now, waiting=queue.count(), open_leases=left.count(), under_way=pending.count(),
                       recovered=leases.where(over).count(), reserved=reserved.count(), done=counts.done, late=counts.late)
    state.found.compact_if_due(r)
    return out
