"""The crawl frontier as tables: membership, admission, reservation, acknowledgement, recovery."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode import options as O
from pagelode import schemas
from pagelode.functions import text, urls
from pagelode.operators import spread
from pagelode.session import through_table, workdir

# Message that goes with each status.
MESSAGES = {
    "dropped": "empty_url",
    "visited": "already_visited",
    "exists": "already_discovered",
    "throttled": "queue_pressure",
    "domain_budget_exceeded": "domain_limit",
    "added": "ok",
}
QUEUE = "url string, depth int, tier int, score double, seq long, round int"


def seeds(start: DataFrame, queued: DataFrame, inflight: DataFrame, domains=O.VALID_DOMAINS) -> DataFrame:
    """Valid start URLs, cleaned, at depth 0 without a score; none while work is left."""
    busy = queued.select(F.lit(1).alias("one")).limit(1).unionByName(
        inflight.select(F.lit(1).alias("one")).limit(1)).agg(F.count(F.lit(1)).alias("n"))
    return (
        start.where(urls.valid_url(F.col("url"), domains))
        .where(busy.scalar() == 0)
        .select(*[c for c in start.columns if c != "url"], urls.clean_url(F.col("url")).alias("url"),
                F.lit(0).alias("depth"), F.lit(None).cast("double").alias("score"))
    )


def start_frame(spark: SparkSession, start_urls=O.START_URLS) -> DataFrame:
    return spark.createDataFrame([(i, u) for i, u in enumerate(start_urls, 1)], "seq long, url string")


def with_domain(rows: DataFrame, column: str = "url") -> DataFrame:
    return rows.withColumn("domain", urls.url_domain(F.col(column)))


def is_member(rows: DataFrame, members: DataFrame, out: str) -> DataFrame:
    """Flag rows whose URL is in a set. Rows hold each URL once, so no key is hot."""
    marked = members.select("url", F.lit(True).alias(out))
    return rows.join(marked, "url", "left").withColumn(out, F.coalesce(F.col(out), F.lit(False)))


def visited_lookup(rows: DataFrame, visited: DataFrame, seen: bool = True,
                   hot_rows: int = spread.HOT_ROWS) -> DataFrame:
    """Rows whose normalised URL is (or is not) in the visited set."""
    keyed = rows.withColumn("_key", urls.normalize_url(F.col("url")))
    keys = visited.select(F.col("url").alias("_key"), F.lit(True).alias("_seen"))
    joined = spread.lookup_join(keyed, keys, "_key", F.struct(*[F.col(c) for c in rows.columns]), hot_rows=hot_rows)
    return joined.where(F.col("_seen").isNotNull() if seen else F.col("_seen").isNull()).select(*rows.columns)


def unseen(rows: DataFrame, *sets: DataFrame) -> DataFrame:
    """Rows in none of the URL sets. The sets are looked up by distinct URLs, so a URL that many
    rows share is hot in the last join only, which cuts it."""
    known = rows.select("url").distinct()
    for members in sets:
        known = known.join(members.select("url"), "url", "left_anti")
    return spread.lookup_join(rows, known, "url", F.struct(*[F.col(c) for c in rows.columns]), "inner")


def set_union(*sets: DataFrame) -> DataFrame:
    out = sets[0].select("url")
    for more in sets[1:]:
        out = out.unionByName(more.select("url"))
    return out.distinct()


def domain_budgets(counts: DataFrame, budgets: DataFrame | None = None,
                   default: int = O.CrawlOptions.domain_max_requests_default) -> DataFrame:
    """Acknowledged count, budget and whether it is used up, per domain that has either.

    `counts` and `budgets` have one row per domain. A budget that is no integer falls back to
    the default.
    """
    out = counts.select("domain", F.col("n").alias("_n"))
    if budgets is not None:
        out = out.join(budgets.select("domain", F.col("budget").cast("string").alias("_b")), "domain", "full")
    else:
        out = out.withColumn("_b", F.lit(None).cast("string"))
    count = F.coalesce(F.col("_n"), F.lit(0)).cast("long")
    budget = F.coalesce(F.col("_b").try_cast("long"), F.lit(default).cast("long"))
    return out.select("domain", count.alias("domain_count"), budget.alias("budget"),
                      (count >= budget).alias("over_budget"))


def url_facts(rows: DataFrame, visited: DataFrame | None, discovered: DataFrame, domain_counts: DataFrame,
              budgets: DataFrame | None, default_budget: int, hot_rows: int) -> DataFrame:
    """What admission needs to know of each distinct URL: its first place with depth and score,
    its copies, and whether it is visited, discovered or in a domain over budget."""
    carried = [c for c in ("depth", "score") if c in rows.columns]
    first = rows.where(F.col("url") != "").groupBy("url").agg(
        F.min("seq").alias("_first"), F.count(F.lit(1)).alias("_copies"),
        *[F.min_by(c, "seq").alias(f"_{c}") for c in carried])
    first = is_member(first, discovered, "_discovered")
    if visited is None:
        first = first.withColumn("_visited", F.lit(False))
    else:
        first = is_member(first, visited, "_visited")
    unknown = default_budget <= 0  # a domain without a count or a budget of its own
    special = domain_budgets(domain_counts, budgets, default_budget).where(
        F.col("over_budget") != F.lit(unknown)).select("domain", F.col("over_budget").alias("_over"))
    if spread.is_small(special):
        joined = with_domain(first).join(F.broadcast(special), "domain", "left")
    else:
        joined = spread.lookup_join(with_domain(first), special, "domain", "url", hot_rows=hot_rows)
    return joined.withColumn("_over", F.coalesce(F.col("_over"), F.lit(unknown))).drop("domain")


@dataclass(frozen=True)
class Admission:
    """Decision on a set of candidates: `added` of them take a place, the last one at `last`
    (None if places are left over). `facts` has one row per distinct URL."""

    rows: DataFrame
    facts: DataFrame
    added: int
    last: int | None
    most_copies: int
    hot_rows: int

    def statuses(self) -> DataFrame:
        """Status of every candidate. Rows of a hot URL are spread in the join."""
        table = self.facts.select("url", "_first", "_visited", "_discovered", "_over")
        if self.most_copies > self.hot_rows:
            hot = spread.hot_pieces(self.facts, "url", "_copies", self.hot_rows)
            joined = spread.lookup_join(self.rows, table, "url", "seq", hot=hot)
        else:
            joined = self.rows.join(table, "url", "left")
        late = F.lit(False) if self.last is None else F.col("seq") > self.last
        first_fits = F.lit(True) if self.last is None else F.col("_first") <= self.last
        copy = ~F.col("_over") & (F.col("seq") > F.col("_first"))
        status = (
            F.when(F.col("url") == "", "dropped")
            .when(F.col("_visited"), "visited")
            .when(F.col("_discovered"), "exists")
            .when(copy & first_fits, "exists")
            .when(late, "throttled")
            .when(F.col("_over"), "domain_budget_exceeded")
            .otherwise("added")
        )
        return joined.withColumn("status", status).drop("_first", "_visited", "_discovered", "_over")

    def queue(self, priority: bool = True, round_no: int = 0) -> DataFrame:
        """Queue rows of the admitted URLs, from the facts alone: candidates are not joined back."""
        fits = F.lit(True) if self.last is None else F.col("_first") <= self.last
        # Candidates may come without a depth or a score: depth 0, and the tier without priority.
        depth = F.col("_depth") if "_depth" in self.facts.columns else F.lit(0)
        score = F.col("_score") if "_score" in self.facts.columns else F.lit(None).cast("double")
        rows = self.facts.where(_eligible() & fits).select(
            "url", depth.alias("depth"), score.alias("score"), F.col("_first").alias("seq"))
        return queued(rows, priority, round_no)


def _eligible() -> Column:
    return ~F.col("_visited") & ~F.col("_discovered") & ~F.col("_over")


def decide(candidates: DataFrame, visited: DataFrame | None, discovered: DataFrame,
           domain_counts: DataFrame, budgets: DataFrame | None = None, queue_size: int = 0,
           max_queue: int = O.CrawlOptions.max_frontier_queue_size,
           default_budget: int = O.CrawlOptions.domain_max_requests_default, path: str | None = None,
           target: int = spread.BUCKET_ROWS, hot_rows: int = spread.HOT_ROWS) -> Admission:
    """Decide on all candidates as if they were queued one by one in `seq` order.

    `candidates` has a unique integer `seq`, `url`, and any other columns. Only the first
    copy of a new URL in a domain under budget takes a place, and the places run out at one
    point of the order: the `seq` of the last such copy that fits. So one selection over
    distinct URLs decides all rows; nothing is numbered.

    Facts per distinct URL are written once (to `path`, or a new folder), because the cut, the
    hot URLs and the rows all need them. `visited` may be None if it is part of `discovered`
    and the two statuses need not be told apart.
    """
    rows = candidates.withColumn("url", urls.normalize_url(F.col("url")))
    facts = through_table(
        url_facts(rows, visited, discovered, domain_counts, budgets, default_budget, hot_rows),
        path or workdir(candidates.sparkSession, "admission"))
    room = max(max_queue - queue_size, 0)
    sizes = facts.agg(F.count_if(_eligible()).alias("eligible"), F.coalesce(F.max("_copies"), F.lit(0)).alias("most")).first()
    if not room:
        last = -(2**63)
    elif sizes.eligible <= room:
        last = None
    else:
        last = spread.kth_smallest(facts.where(_eligible()), "_first", room, target).first()[0]
    return Admission(rows, facts, min(room, sizes.eligible), last, sizes.most, hot_rows)


def admission(*candidates_and_state, **limits) -> DataFrame:
    """Status of every candidate; takes what `decide` takes."""
    return decide(*candidates_and_state, **limits).statuses()


def with_message(rows: DataFrame) -> DataFrame:
    pairs = [F.lit(x) for pair in MESSAGES.items() for x in pair]
    return rows.withColumn("message", F.element_at(F.create_map(*pairs), F.col("status")))


def enqueue_summary(statuses: DataFrame) -> DataFrame:
    """Added and dropped totals. Every status but 'added' is a drop."""
    return statuses.agg(
        F.count_if(F.col("status") == "added").alias("added"),
        F.count_if(F.col("status") != "added").alias("dropped"))


def queued(rows: DataFrame, priority: bool = True, round_no: int = 0) -> DataFrame:
    """Queue rows of admitted URLs: tier 0 by score, tier 1 in arrival order, which is the round
    of the crawl and the place in it. Expects `url, depth, score, seq`."""
    scored = F.col("score").isNotNull() if priority else F.lit(False)
    return rows.select(
        "url", F.col("depth").cast("int").alias("depth"),
        F.when(scored, 0).otherwise(1).alias("tier"),
        F.when(scored, F.col("score")).alias("score"),
        F.col("seq").cast("long").alias("seq"), F.lit(round_no).alias("round"))


def queue_union(priority: DataFrame, fifo: DataFrame) -> DataFrame:
    """Both tiers as one queue. `priority` has url, depth, score, seq; `fifo` url, depth, seq."""
    return priority.select("url", "depth", F.lit(0).alias("tier"), F.col("score").cast("double"), "seq").unionByName(
        fifo.select("url", "depth", F.lit(1).alias("tier"), F.lit(None).cast("double").alias("score"), "seq"))


def queue_order(arrival=("seq",)) -> list[Column]:
    """Priority tier by score, then payload bytes; then the other tier by arrival."""
    key = F.when(F.col("tier") == 0, text.payload_key(F.col("url"), F.col("depth")))
    return [F.col("tier"), F.col("score").asc_nulls_last(), key.asc_nulls_last(), *[F.col(c) for c in arrival]]


def reserve_batch(queue: DataFrame, size: int, worker_id: str, now: float,
                  lease_seconds: int = O.CrawlOptions.lease_seconds) -> DataFrame:
    """The next `size` items with their lease. The sort keeps only `size` rows per task."""
    return queue.orderBy(*queue_order()).limit(size).select(
        "url", "depth", "tier", "score", "seq",
        text.payload_key(F.col("url"), F.col("depth")).alias("payload"),
        F.lit(worker_id).alias("worker_id"), F.lit(float(now)).alias("reserved_at"),
        F.lit(int(lease_seconds)).alias("lease_seconds"))


def lease_meta(worker: Column, reserved_at: Column, lease_seconds: Column) -> Column:
    return F.to_json(F.struct(worker.cast("string").alias("worker_id"),
                              reserved_at.cast("double").alias("reserved_at"),
                              lease_seconds.cast("int").alias("lease_seconds")))


def encode_payload(url: Column, depth: Column) -> Column:
    return F.to_json(F.struct(url.alias("url"), depth.cast("int").alias("depth")))


def decode_payload(payload: Column) -> Column:
    """Struct of url and depth; a malformed payload is ('', 0), and so is one whose depth is no number.

    A depth may be a number (cut to an integer), an integer as text, or missing, which is 0.
    """
    parsed = F.try_parse_json(payload)
    given = F.try_variant_get(parsed, "$.depth", "variant")
    kind, words = F.schema_of_variant(given), F.trim(F.try_variant_get(parsed, "$.depth", "string"))
    depth = (
        F.when(given.isNull(), 0)
        .when(kind == "STRING", F.when(words.rlike("^[+-]?[0-9]+$"), words.try_cast("int")))
        .when(kind == "BOOLEAN", (words == "true").cast("int"))
        .otherwise(words.try_cast("double").try_cast("int")))
    good = depth.isNotNull()
    return F.struct(
        F.when(good, urls.normalize_url(F.try_variant_get(parsed, "$.url", "string"))).otherwise("").alias("url"),
        F.coalesce(depth, F.lit(0)).alias("depth"))


def acknowledged(visited: DataFrame, inflight: DataFrame, acks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leases left, and the visited set, after acknowledging `acks(payload, url)`.

    An unknown lease does no harm: its URL becomes visited all the same.
    """
    done = acks.where(F.coalesce(F.col("url"), F.lit("")) != "").select(
        urls.normalize_url(F.col("url")).alias("url"))
    left = inflight.join(acks.select("payload").distinct(), "payload", "left_anti")
    return left, set_union(visited, done)


def domain_stats(acks: DataFrame) -> DataFrame:
    """Acknowledgements and last access per domain; duplicates count. Expects `domain`, `ts`."""
    return acks.groupBy("domain").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_access"))


def top_domains(stats: DataFrame, size: int = 5) -> DataFrame:
    return stats.orderBy(F.col("n").desc(), "domain").limit(size)


def requeue_stale(inflight: DataFrame, visited: DataFrame, now: float, max_age: float,
                  priority: bool = True) -> tuple[DataFrame, DataFrame]:
    """Leases kept, and queue rows of the stale ones that still need a visit.

    `inflight` has `payload` and `meta`, both JSON. Age is judged by the argument, not by the
    length stored on the lease; unreadable meta counts as reserved now. A recovered URL gets
    its depth as score, one less than when it was first queued, so it goes first.
    """
    meta = F.from_json("meta", schemas.LEASE_META)
    leases = inflight.withColumn("_at", F.coalesce(meta["reserved_at"], F.lit(float(now)))) \
        .withColumn("_stale", F.lit(float(now)) - F.col("_at") >= float(max_age))
    kept = leases.where(~F.col("_stale")).drop("_at", "_stale")
    item = decode_payload(F.col("payload"))
    back = (
        leases.where("_stale").select(item.alias("i"), F.col("_at")).select("i.*", "_at")
        .where(F.col("url") != "")
        .join(visited.select("url"), "url", "left_anti")
        .groupBy("url", "depth").agg(F.min("_at").alias("_at"))  # one payload, one queue row
    )
    return kept, back.select(
        "url", "depth", F.lit(0 if priority else 1).alias("tier"),
        (F.col("depth").cast("double") if priority else F.lit(None).cast("double")).alias("score"),
        (F.col("_at") * 1e6).cast("long").alias("seq"))


def politeness_wait(rows: DataFrame, stats: DataFrame, now: Column,
                    delay_seconds: float = O.CrawlOptions.per_domain_delay_seconds,
                    hot_rows: int = spread.HOT_ROWS) -> DataFrame:
    """Seconds to wait before each URL: what is left of the delay since the last access."""
    last = stats.select("domain", F.col("last_access").alias("_last"))
    passed = text.epoch_seconds(now) - text.epoch_seconds(F.col("_last"))
    wait = F.coalesce(F.greatest(F.lit(0.0), F.lit(float(delay_seconds)) - passed), F.lit(0.0))
    return spread.lookup_join(rows, last, "domain", "url", hot_rows=hot_rows).withColumn(
        "wait_seconds", wait).drop("_last")


def politeness_schedule(rows: DataFrame, stats: DataFrame | None = None,
                        delay_seconds: float = O.CrawlOptions.per_domain_delay_seconds,
                        target: int = spread.BUCKET_ROWS) -> DataFrame:
    """When each access can start, `start_micros`, if the accesses of a domain keep the delay, also to the last
    one in `stats` (domain, last_access), and how long it waits. Expects `domain`, `ts` (from when
    on it can start) and a unique `event_id` to order equal times. A hot domain is no single task."""
    micros = round(delay_seconds * 1e6)
    earliest = None if stats is None else stats.select(
        "domain", (F.unix_micros(F.col("last_access").cast("timestamp")) + micros).alias("_from"))
    rows = rows.withColumn("_ts", F.col("ts").cast("timestamp"))
    out = spread.spaced_starts(rows, "domain", ["_ts", "event_id"], micros, "start_micros", earliest, target)
    return out.withColumn("wait_seconds", (F.col("start_micros") - F.unix_micros("_ts")) / F.lit(1e6)).drop("_ts")


def politeness_due(schedule: DataFrame, now: Column) -> DataFrame:
    """The accesses of a schedule that a round at `now` may take."""
    return schedule.where(F.col("start_micros") <= F.unix_micros(now.cast("timestamp")))


def politeness_gaps(accesses: DataFrame, delay_seconds: float = O.CrawlOptions.per_domain_delay_seconds,
                    target: int = spread.BUCKET_ROWS) -> DataFrame:
    """Seconds since the access before, per domain, and whether that is too soon.

    Expects `domain`, `ts` and a unique `event_id` to order equal times.
    """
    rows = accesses.withColumn("_ts", F.col("ts").cast("timestamp"))
    gaps = spread.previous_value(rows, "domain", ["_ts", "event_id"], "_ts", "_prev", target)
    gap = (F.unix_micros("_ts") - F.unix_micros("_prev")) / F.lit(1e6)
    return gaps.withColumn("gap_seconds", gap).withColumn(
        "too_soon", F.coalesce(gap < float(delay_seconds), F.lit(False))).drop("_ts", "_prev")
