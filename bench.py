"""Headline queries, timed. Prints one JSON line.

Every query runs once to warm up and then BENCH_RUNS times; the median counts. Results are
written to nowhere, so the whole query runs. Index and page store are built as queries of their
own, and reused by the searches and the crawl, as they would be in use.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from pagelode.functions import urls  # noqa: E402
from pagelode.operators import frontier  # noqa: E402
from pagelode.options import CrawlOptions  # noqa: E402
from pagelode.plans import crawl, search, segment_search, segments  # noqa: E402
from pagelode.registry import QUERIES, derived as D, load  # noqa: E402
from pagelode.registry import frontier_queries, url_queries  # noqa: E402
from pagelode.session import local_session, through_table, workdir  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    load()
    spark = local_session(CPUS)
    sizes = {name: D.table(spark, SF_DIR, name).count() for name in ("pages", "documents", "events", "lineitem")}

    index = D.search_index(spark, SF_DIR)
    # 100 queries with terms: 20 terms in five forms each.
    asked = through_table(D.search_queries(index.vocab, 20).where("query_id >= 10"), workdir(spark, "queries"))
    one = through_table(asked.where("query_id = 14"), workdir(spark, "query"))
    wiki = crawl.write_store(D.wiki_store(spark, SF_DIR), workdir(spark, "store"))
    live = segments.upsert(segments.create(spark, workdir(spark, "segments")), D.search_docs(spark, SF_DIR))
    # Some one in a hundred documents, written again with another text.
    fresh = through_table(D.search_docs(spark, SF_DIR).where(F.pmod(F.xxhash64("url"), F.lit(100)) == 0).withColumn(
        "content", F.concat("content", F.lit(" again"))), workdir(spark, "fresh"))
    n_asked = asked.count()
    n_ruled = url_queries.ruled(spark, SF_DIR).count()
    ruled = through_table(url_queries.ruled(spark, SF_DIR), workdir(spark, "ruled"))
    candidates = through_table(frontier_queries.candidates(spark, SF_DIR), workdir(spark, "candidates"))
    n_candidates = candidates.count()
    rounds = {}

    def admission():
        drain(frontier.admission(
            candidates, frontier_queries.short(candidates, 2), frontier_queries.short(candidates, 3),
            frontier_queries.page_domains(spark, SF_DIR), queue_size=100, max_queue=400, default_budget=5))

    def bfs():
        options = CrawlOptions(domain_max_requests_default=10**9)
        state = crawl.crawl_bfs(wiki.drop("s"), D.wiki_seeds(wiki), workdir(spark, "crawl"), options, stored=True)
        rounds["n"] = state.last().round

    def registered(name):
        return lambda: drain(QUERIES[name](spark, SF_DIR))

    timed = {
        "parse_pages": lambda: drain(D.docs(spark, SF_DIR)),
        "reject_stats": registered("reject_stats"),
        "url_verdict": lambda: drain(ruled.select(urls.url_verdict(F.col("url")).alias("reason"))),
        "admission": admission,
        "reserve_batch": registered("reserve_batch"),
        "url_batches": registered("url_batches"),
        "index_upsert": registered("index_upsert"),
        "robots_filter": registered("robots_filter"),
        "requeue_stale": registered("requeue_stale"),
        "domain_stats": registered("domain_stats"),
        "politeness_gaps": registered("politeness_gaps"),
        "monitor_ticks": registered("monitor_ticks"),
        "corpus_stats": registered("corpus_stats"),
        "build_index": lambda: D.search_index(spark, SF_DIR),
        "search_100": lambda: drain(search.search(index, asked)),
        "search_1": lambda: drain(search.search(index, one)),
        "segment_search_100": lambda: drain(segment_search.search(live, asked)),
        "segment_search_1": lambda: drain(segment_search.search(live, one)),
        "segment_upsert": lambda: segments.upsert(live, fresh),
        "crawl_bfs": bfs,
        "stream_discovered": registered("stream_discovered"),
        "stream_domain_counts": registered("stream_domain_counts"),
    }
    seconds = {}
    for name, run in timed.items():
        run()
        taken = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
        print(f"{name:22s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    rates = {
        "parse_pages_per_sec": round(sizes["pages"] / seconds["parse_pages"]),
        "verdicts_per_sec": round(n_ruled / seconds["url_verdict"]),
        "admission_rows_per_sec": round(n_candidates / seconds["admission"]),
        "search_ms_per_query_of_100": round(1000 * seconds["search_100"] / n_asked, 1),
        "search_ms_alone": round(1000 * seconds["search_1"], 1),
        "segment_search_ms_alone": round(1000 * seconds["segment_search_1"], 1),
        "crawl_sec_per_level": round(seconds["crawl_bfs"] / rounds["n"], 3),
    }
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": SF_DIR.rsplit("sf", 1)[-1], "cpus": CPUS, "rates": rates, "rows": sizes}))
    spark.stop()


if __name__ == "__main__":
    main()
