"""The crawl: one round as a plan over a whole batch, and the breadth-first loop of rounds."""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelode.functions import html, urls
from pagelode.operators import frontier, links, robots
from pagelode.options import CrawlOptions
from pagelode.session import no_rows, path_exists, through_table, workdir
from pagelode.sources import crawl_log, index, url_batches
from pagelode.sources.url_log import UrlLog


@dataclass(frozen=True)
class CrawlStep:
    """What a round does. `found` are the pages read, `admission` the decision on the offered
    links, `acks` all rows of the batch."""

    found: DataFrame
    admission: frontier.Admission
    acks: DataFrame

    def statuses(self) -> DataFrame:
        """Status of every offered link, with the page it is on."""
        return self.admission.statuses()

    def documents(self) -> DataFrame:
        """Pages to index, with all their links."""
        return self.found.drop("seq")

    def messages(self, published_at: Column, size: int = CrawlOptions.url_batch_size) -> DataFrame:
        """URL batches of all offered links, admitted or not, in the order they were offered."""
        return url_batches.url_batches(self.admission.rows.select("seq", "url", "depth"), published_at, ["seq"], size)

    def rejects(self) -> DataFrame:
        """Rejected links per reason, for pages that have any."""
        return rejected_links(self.found)


def rejected_links(documents: DataFrame) -> DataFrame:
    return links.reject_stats(links.link_rows(documents, ("url",)), ("url",)).where(F.col("total") > 0)


def depth_gate(batch: DataFrame, max_depth: int = CrawlOptions.max_depth) -> tuple[DataFrame, DataFrame]:
    """Rows to fetch, and rows too deep, which are acknowledged unread."""
    return batch.where(F.col("depth") <= max_depth), batch.where(F.col("depth") > max_depth)


def parsed_store(pages: DataFrame, options: CrawlOptions = CrawlOptions(), want=("links",)) -> DataFrame:
    """The page store as documents by normalised URL, newest copy of each, parsed once.

    Rounds need the links only; parsing a page every time it is asked for, or joining HTML in
    every round, would read the whole store per round. Pages are parsed where they are read,
    so the HTML is never shuffled; copies are dropped on the parsed rows.
    """
    docs = html.parse_pages(pages, options.valid_domains, options.junk_patterns, want)
    return index.latest(docs.withColumn("url", urls.normalize_url(F.col("url"))), ["page_id"]).select("url", *want)


def crawl_step(batch: DataFrame, store: DataFrame, visited: DataFrame | None, discovered: DataFrame,
               domain_counts: DataFrame, budgets: DataFrame | None = None, queue_size: int = 0,
               options: CrawlOptions = CrawlOptions(), rules: DataFrame | None = None,
               path: str | None = None, documents_path: str | None = None) -> CrawlStep:
    """One round over `batch(url, depth, seq)`; `store` is a parsed store, `rules` robots rules.

    A page is indexed before its links are judged. A page that is missing or denied is
    acknowledged like any other and leaves no document. The batch is joined to the store once;
    what came of it is written as the round's documents, its links are judged once and written
    as narrow rows, and the rest works on those.
    """
    path = path or workdir(batch.sparkSession, "step")
    due, _ = depth_gate(batch, options.max_depth)
    if rules is not None:
        due = robots.robots_filter(due, rules, options.robots_agent).where("allowed").select(*batch.columns)
    found = through_table(due.join(store, "url"), documents_path or f"{path}/documents")
    cap = options.max_urls_per_page
    offered = found.select(
        F.col("url").alias("src"), F.col("seq").alias("_page"), F.col("depth").alias("_depth"),
        F.posexplode(links.accepted_links(F.col("links"), cap)).alias("_pos", "url"))
    candidates = through_table(offered.select(
        (F.col("_page") * (cap + 1) + F.col("_pos") + 1).alias("seq"), "src", "url",
        (F.col("_depth") + 1).alias("depth"),
        urls.url_priority(F.col("url"), F.col("_depth"), options.article_bonus).alias("score")), f"{path}/offered")
    decision = frontier.decide(
        candidates, visited, discovered, domain_counts, budgets, queue_size,
        options.max_frontier_queue_size, options.domain_max_requests_default, f"{path}/facts")
    return CrawlStep(found, decision, acks(batch, found))


def acks(batch: DataFrame, found: DataFrame) -> DataFrame:
    """All rows of the batch as acknowledged, with their domain and whether their page was read."""
    read = found.select("url", F.lit(True).alias("fetched"))
    return frontier.with_domain(batch.select("url", "depth")).join(read, "url", "left").select(
        "url", "depth", "domain", F.coalesce("fetched", F.lit(False)).alias("fetched"))


class CrawlState:
    """Crawl state as tables in a shared folder, one part (`gen`) of each per finished round.

    A round first writes its parts and then one row of progress. A round without that row
    never happened: after a restart it is done again from the state before it, so its leases
    come back exactly once. What is discovered is kept in buckets by URL as well, so that a round looks
    its links up without a shuffle of all that was ever found.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.found = UrlLog.at(spark, f"{path}/discovered")

    _PROGRESS = "round int, batch_size long, added long, left_over long, pages_crawled long, at double, seconds double"
    _QUEUE = frontier.QUEUE
    _BATCH = "url string, depth int, seq long"

    def progress(self) -> DataFrame:
        return self.spark.read.schema(self._PROGRESS).parquet(f"{self.path}/progress")

    def last(self):
        if not path_exists(self.spark, f"{self.path}/progress"):
            return None
        return self.progress().orderBy(F.desc("round")).first()

    def read(self, name: str, schema: str, first: int, last: int) -> DataFrame:
        """Rows of the rounds from first to last: one table, of which other parts are not read."""
        if first > last:
            return no_rows(self.spark, schema)
        if first == last:
            return self.spark.read.schema(schema).parquet(self.folder(name, first))
        rows = self.spark.read.schema(f"{schema}, gen int").parquet(f"{self.path}/{name}")
        return rows.where(F.col("gen").between(first, last)).drop("gen")

    def queue(self, last) -> DataFrame:
        fresh = self.read("added", self._QUEUE, last.round, last.round)
        if not last.left_over:
            return fresh
        return fresh.unionByName(self.read("left", self._QUEUE, last.round, last.round))

    def discovered(self, r: int) -> DataFrame:
        """Distinct URLs that were queued in the rounds up to r, in buckets."""
        return self.found.read(r).distinct()

    def acks(self, r: int) -> DataFrame:
        """All URLs of the rounds up to r: domain, depth and whether their page was read. Worked out from
        what the rounds took and read; a URL is taken once."""
        return acks(self.read("batch", self._BATCH, 1, r), self.read("documents", "url string", 1, r))

    def _outputs(self, name: str) -> DataFrame | None:
        """What the finished rounds wrote, with its own columns and the round; None before the first."""
        last = self.last()
        if last is None or not last.round:
            return None
        rows = self.spark.read.parquet(f"{self.path}/{name}").where(F.col("gen") <= last.round)
        return rows.withColumnRenamed("gen", "round")

    def documents(self) -> DataFrame | None:
        """The pages read so far, to be indexed: all columns of the store, depth and round."""
        found = self._outputs("documents")
        return None if found is None else found.drop("seq")

    def messages(self) -> DataFrame | None:
        """The URL batches published so far: round, batch, value."""
        return self._outputs("messages")

    def rejects(self) -> DataFrame | None:
        """Rejected links per reason, for pages that have any."""
        found = self.documents()
        return None if found is None else rejected_links(found)

    def log(self, worker_id: str = "crawl") -> DataFrame:
        """A log line per finished round."""
        rows = self.progress().where("round > 0").select(
            F.timestamp_seconds("at").alias("ts"), F.lit("INFO").alias("level"), F.lit("crawl_batch_complete").alias("message"),
            F.lit(worker_id).alias("worker_id"), "batch_size", (F.col("added") + F.col("left_over")).alias("queue_size"),
            F.lit(0).alias("inflight_size"), "pages_crawled",
            F.round(F.col("batch_size") / F.greatest("seconds", F.lit(1.0)), 2).alias("indexed_rate"))
        return crawl_log.log_lines(rows)

    def domains(self, r: int) -> DataFrame:
        return self.read("domains", "domain string, n long", r, r)

    def folder(self, name: str, r: int) -> str:
        return f"{self.path}/{name}/gen={r}"

    def write(self, df: DataFrame, name: str, r: int) -> None:
        df.write.mode("overwrite").parquet(self.folder(name, r))

    def commit(self, r: int, batch_size: int, added: int, left_over: int, pages_crawled: int, began: float | None = None):
        now = time.time()
        done = Row(round=r, batch_size=batch_size, added=added, left_over=left_over, pages_crawled=pages_crawled,
                   at=now, seconds=now - (began or now))
        columns = [F.lit(done[f.split(" ")[0]]).cast(f.split(" ")[1]).alias(f.split(" ")[0])
                   for f in self._PROGRESS.split(", ")]
        self.spark.range(0, 1, 1, 1).select(*columns).write.mode("append").parquet(f"{self.path}/progress")
        return done


# Bytes of URLs and links in a bucket of a store.
STORE_BUCKET_BYTES = 128 * 2**20
MOST_STORE_BUCKETS = 4096


def write_store(store: DataFrame, path: str, buckets: int | None = None) -> DataFrame:
    """Write a parsed store in buckets by URL, so that a round deals out its batch alone and the store stays
    where it lies. Their number follows the size of URLs and links, unless it is given, and is no less than
    the session's shuffle partitions."""
    spark = store.sparkSession
    if buckets is None:
        size = F.octet_length("url") + F.coalesce(F.octet_length(F.array_join("links", " ")), F.lit(0))
        total = store.agg(F.sum(size.cast("long"))).first()[0] or 0
        buckets = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // STORE_BUCKET_BYTES)), MOST_STORE_BUCKETS)
    name = f"store_{uuid.uuid4().hex}"
    store.repartition(buckets, "url").write.mode("overwrite").option("path", f"{path}/rows") \
        .bucketBy(buckets, "url").sortBy("url").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    spark.range(0, 1, 1, 1).select(F.lit(buckets).alias("buckets"), F.lit(store.schema.json()).alias("schema")) \
        .write.mode("overwrite").parquet(f"{path}/layout")
    return open_store(spark, path)


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """A written store, in this session or a later one. The catalog names it only until it is resolved."""
    layout = spark.read.schema("buckets int, schema string").parquet(f"{path}/layout").first()
    columns = T.StructType.fromJson(json.loads(layout.schema)).toDDL()
    name, place = f"store_{uuid.uuid4().hex}", f"{path}/rows".replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (url) SORTED BY (url) "
              f"INTO {layout.buckets} BUCKETS LOCATION '{place}'")
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return rows


def _budget_frame(spark: SparkSession, budgets: dict) -> DataFrame | None:
    # An option of the caller, not data.
    return spark.createDataFrame([(d, str(b)) for d, b in budgets.items()], "domain string, budget string") \
        if budgets else None


def crawl_bfs(store: DataFrame, start: DataFrame, path: str, options: CrawlOptions = CrawlOptions(),
              batch_size: int | None = None, max_rounds: int | None = None,
              rules: DataFrame | None = None, stored: bool = False, published_at: Column | None = None) -> CrawlState:
    """Rounds of `crawl_step` until `max_pages` are visited or no work is left.

    `batch_size` reserves that many URLs per round; without it a round takes the whole queue,
    which is one level of the search. The page limit is checked between rounds, so the last
    round may go beyond it. Called again on the same path, it goes on where it stopped.
    The URLs and links of the store are written first, because every round reads them, unless
    `stored` says that the store is a table already. Every round leaves its documents, URL
    batches (of the time `published_at`, now if not given) and a row of progress; see
    `CrawlState`.
    """
    spark = store.sparkSession
    state = CrawlState(spark, path)
    budgets = _budget_frame(spark, options.domain_budgets)
    last = state.last()
    if not stored:
        if last is None:
            write_store(store, f"{path}/store")
        store = open_store(spark, f"{path}/store")
    last = last or _begin(state, start, options, budgets)
    rounds = 0
    while last.added + last.left_over and last.pages_crawled < options.max_pages:
        if max_rounds is not None and rounds >= max_rounds:
            break
        last = _round(state, last, store, options, budgets, batch_size, rules, published_at)
        rounds += 1
    return state


def _begin(state: CrawlState, start: DataFrame, options: CrawlOptions, budgets: DataFrame | None):
    spark = state.spark
    none = no_rows(spark, "url string")
    empty = no_rows(spark, state._QUEUE)
    no_counts = no_rows(spark, "domain string, n long")
    seeds = frontier.seeds(start, empty, empty, options.valid_domains)
    decision = frontier.decide(
        seeds, None, none, no_counts, budgets, 0,
        options.max_frontier_queue_size, options.domain_max_requests_default, state.folder("facts", 0))
    state.write(decision.queue(options.priority_enabled), "added", 0)
    state.found.append(state.read("added", state._QUEUE, 0, 0), 0)
    state.write(no_counts, "domains", 0)
    return state.commit(0, 0, decision.added, 0, 0)


def _round(state: CrawlState, last, store: DataFrame, options: CrawlOptions, budgets: DataFrame | None,
           batch_size: int | None, rules: DataFrame | None, published_at: Column | None):
    r, began = last.round + 1, time.time()
    queue, waiting = state.queue(last), last.added + last.left_over
    ordered = queue.orderBy(*frontier.queue_order(("round", "seq")))
    reserved = ordered.limit(batch_size) if batch_size else ordered
    # After the sort the ids rise with the order; written once, they stay what they are.
    state.write(reserved.select("url", "depth", F.monotonically_increasing_id().alias("seq")), "batch", r)
    batch = state.read("batch", state._BATCH, r, r)
    taken = min(batch_size, waiting) if batch_size else waiting
    left_over = waiting - taken
    if left_over:
        state.write(queue.join(batch.select("url"), "url", "left_anti").select(*[f.name for f in queue.schema]), "left", r)

    # Whatever is visited was discovered before, so the discovered set alone keeps URLs out.
    step = crawl_step(batch, store, None, state.discovered(last.round), state.domains(last.round), budgets,
                      left_over, options, rules, state.folder("step", r), state.folder("documents", r))
    state.write(step.admission.queue(options.priority_enabled, r), "added", r)
    state.found.append(state.read("added", state._QUEUE, r, r), r)
    counts = state.domains(last.round).unionByName(
        frontier.with_domain(batch).groupBy("domain").agg(F.count(F.lit(1)).alias("n")))
    state.write(counts.groupBy("domain").agg(F.sum("n").alias("n")), "domains", r)
    now = F.date_format(F.timestamp_seconds(F.lit(began)), "yyyy-MM-dd'T'HH:mm:ss")
    state.write(step.messages(now if published_at is None else published_at, options.url_batch_size), "messages", r)
    done = state.commit(r, taken, step.admission.added, left_over, last.pages_crawled + taken, began)
    state.found.compact_if_due(r)
    return done
