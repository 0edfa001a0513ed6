"""Inputs of the queries, derived from the given tables. `sql.py` has the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagelode.functions import html, urls
from pagelode.operators import links as link_ops
from pagelode.plans import index_build
from pagelode.registry.sql import DOMAINS
from pagelode.session import workdir
from pagelode.sources.pages import read_pages

WIKI_ROOT = "https://en.wikipedia.org/wiki/Part_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_pages(spark, f"{sf_dir}/pages.parquet")


def docs(spark: SparkSession, sf_dir: str, want=("title", "content", "links")) -> DataFrame:
    return html.parse_pages(pages(spark, sf_dir), DOMAINS, want=want)


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_ops.link_rows(docs(spark, sf_dir, ("links",)))


def wiki_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order and line number are matched, so an order of any size pairs each line once."""
    lines = table(spark, sf_dir, "lineitem")
    one = lines.select("l_orderkey", F.col("l_partkey").alias("s"), (F.col("l_linenumber") + 1).alias("n"))
    two = lines.select("l_orderkey", F.col("l_partkey").alias("d"), F.col("l_linenumber").alias("n"))
    edges = one.join(two, ["l_orderkey", "n"]).where(F.col("s") != F.col("d")).select("s", "d").distinct()
    place = F.row_number().over(W.partitionBy("s").orderBy("d"))
    return edges.withColumn("pos", place).select(
        "s", F.concat(F.lit(WIKI_ROOT), "s").alias("url"), F.concat(F.lit(WIKI_ROOT), "d").alias("link"), "pos")


def wiki_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = wiki_links(spark, sf_dir).groupBy("s", "url").agg(
        F.array_sort(F.collect_list(F.struct("pos", "link"))).alias("_l"))  # links of one page
    return packed.select("s", "url", F.transform("_l", lambda x: x["link"]).alias("links"))


def wiki_seeds(store: DataFrame) -> DataFrame:
    return store.select("s", "url").orderBy("s").limit(7).select(F.col("s").alias("seq"), "url")


def search_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_search_docs(table(spark, sf_dir, "documents"))


def as_search_docs(documents: DataFrame) -> DataFrame:
    host = F.when(F.col("lang").isin("en", "fr"), F.concat("lang", F.lit(".wikipedia.org"))).otherwise("example.org")
    return documents.select(
        F.concat(F.lit("https://"), host, F.lit("/wiki/Doc_"), F.floor(F.col("doc_id") / 2).cast("string"),
                 F.lit("#"), (F.col("doc_id") % 2).cast("string")).alias("url"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), F.col("text").alias("content"))


def search_index(spark: SparkSession, sf_dir: str) -> index_build.TextIndex:
    return index_build.build_index(search_docs(spark, sf_dir), workdir(spark, "index"))


def search_queries(vocab: DataFrame, picks: int = 10) -> DataFrame:
    size = F.length("term")
    common = vocab.where((F.col("field") == "content") & size.between(4, 12)).orderBy(
        F.desc("df"), "term").limit(picks + 1)
    picked = common.select("term", F.row_number().over(W.orderBy(F.desc("df"), "term")).alias("r"))  # picks + 1 rows
    nxt = picked.withColumn("nxt", F.lead("term").over(W.orderBy("r"))).where(F.col("r") <= picks)

    def sub(a, n=None):
        return F.substr(F.col("term"), F.lit(a), F.lit(n)) if n else F.substr(F.col("term"), F.lit(a))

    forms = [F.col("term"), F.concat(sub(2, 1), sub(1, 1), sub(3)), F.concat(sub(1, 2), sub(4)),
             F.concat(sub(1, 1), F.lit("q"), sub(3)), F.concat("term", F.lit(" "), "nxt")]
    made = nxt.select("r", F.posexplode(F.array(*forms)).alias("i", "q")).select(
        (F.col("r") * 10 + F.col("i")).cast("long").alias("query_id"), "q")
    fixed = vocab.sparkSession.createDataFrame(
        [(1, "  "), (2, "of"), (3, "zzzzqqqqxxxx")], "query_id long, q string")
    return made.unionByName(fixed)


def lease_events(spark: SparkSession, sf_dir: str, per_user: bool = False, rows: DataFrame | None = None) -> DataFrame:
    """Events (or `rows` of them, as a stream) as frontier actions on URLs; with `per_user` each user
    has URLs of their own."""
    actions = {"signup": "enqueue", "view": "reserve", "purchase": "acknowledge", "error": "crash", "click": "tick"}
    pairs = F.create_map(*[F.lit(x) for p in actions.items() for x in p])
    k = F.get_json_object("props", "$.k")
    name = F.concat_ws("_", k, F.col("user_id").cast("string")) if per_user else k
    events = table(spark, sf_dir, "events") if rows is None else rows
    return events.select(
        "event_id", "ts", F.element_at(pairs, F.col("event_type")).alias("action"),
        F.concat(F.lit("https://en.wikipedia.org/wiki/K"), name).alias("url"),
        F.concat(F.lit("worker-"), F.col("user_id").cast("string")).alias("worker_id"), "user_id",
        k.cast("int").alias("k"))


def domain_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", F.concat(F.lit("d"), (F.col("user_id") % 20).cast("string"), F.lit(".edu")).alias("domain"))


def robots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A robots body per domain of the page store: closed below the first letter of its lowest
    path, with a group of its own for the bot on every other domain; every third one is old."""
    paths = pages(spark, sf_dir).select(urls.url_domain(F.col("url")).alias("domain"),
                                        urls.url_path(F.col("url")).alias("path"))
    per = paths.groupBy("domain").agg(F.min("path").alias("low"), F.count(F.lit(1)).alias("n"))
    letter = F.substr("low", F.lit(2), F.lit(1))
    body = F.concat(F.lit("User-agent: *\nDisallow: /"), letter, F.lit("\nAllow: /\n"),
                    F.when(F.length("domain") % 2 == 0, F.concat(
                        F.lit("\nUser-agent: minisearch # ours\nDisallow:/"), letter, F.lit("n\n"))).otherwise(""))
    at = F.when(F.length("domain") % 3 == 0, F.lit("2024-01-01 00:00:00")).otherwise(
        F.lit("2024-01-01 11:30:00")).cast("timestamp")
    return per.select("domain", "low", body.alias("body"), at.alias("fetched_at"))
