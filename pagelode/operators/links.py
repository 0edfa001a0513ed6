"""Operators on the links of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pagelode import options as O
from pagelode.functions import urls

# Counter names, and the verdict each one counts.
REJECT_COUNTERS = {
    "non_en_wikipedia": "non_en_wikipedia",
    "namespace": "namespace",
    "query_params": "query_params",
    "extension": "extension",
    "url_length": "url_length",
    "numeric_pages": "numeric_page",
    "year_pages": "year_page",
    "list_pages": "list_page",
    "disambiguation_pages": "disambiguation",
    "timeline_pages": "timeline",
    "low_quality_pages": "low_quality",
}


def link_rows(docs: DataFrame, keep=("page_id", "url"), out: str = "link") -> DataFrame:
    """One row per link with its position on the page, from 1."""
    return docs.select(*keep, F.posexplode("links").alias("_pos", out)).select(
        *keep, (F.col("_pos") + 1).alias("pos"), out)


def judged(rows: DataFrame, column: str = "link") -> DataFrame:
    """Adds the verdict as `reason`. What several rules look at is made once, as columns."""
    url = F.col(column)
    made = rows.select("*", F.lower(url).alias("_low"), urls.prepared(url).alias("_text"))
    reason = urls.url_verdict(url, low=F.col("_low"), text=F.col("_text"))
    return made.select(*rows.columns, reason.alias("reason"))


def accepted(rows: DataFrame, column: str = "link") -> DataFrame:
    return judged(rows, column).where(F.col("reason") == "ok").drop("reason")


def rejected(rows: DataFrame, column: str = "link") -> DataFrame:
    return judged(rows, column).where(F.col("reason") != "ok")


def accepted_links(links: Column, cap: int = O.MAX_URLS_PER_PAGE) -> Column:
    """The first `cap` accepted links of a page, from the array itself: no shuffle."""
    return F.slice(F.filter(links, lambda u: urls.url_verdict(u) == "ok"), 1, cap)


def fanout_cap(rows: DataFrame, page: str = "page_id", cap: int = O.MAX_URLS_PER_PAGE) -> DataFrame:
    """The same on link rows. The row-number filter is also applied before the shuffle."""
    place = F.row_number().over(W.partitionBy(page).orderBy("pos"))
    return rows.withColumn("_place", place).where(F.col("_place") <= cap).drop("_place")


def dedupe_links(rows: DataFrame, page: str = "page_id") -> DataFrame:
    """First occurrence of each link of a page, as an aggregate that combines before the shuffle."""
    return rows.groupBy(page, "link").agg(F.min("pos").alias("pos"))


def _counters(reason: Column, weight: Column) -> list[Column]:
    def total(test):
        return F.sum(F.when(test, weight).otherwise(0)).cast("long")

    cols = [total(reason == v).alias(k) for k, v in REJECT_COUNTERS.items()]
    known = reason.isin("ok", *REJECT_COUNTERS.values())
    return [*cols, total(~known).alias("other"), total(reason != "ok").alias("total"),
            total(reason == "ok").alias("accepted")]


def reject_stats(rows: DataFrame, by=("page_id",), column: str = "link") -> DataFrame:
    """Rejected links per reason, and the accepted ones, per page (or for all with by=()).

    All links of a page come from one row, so the partial aggregate leaves one row per page
    to shuffle.
    """
    return judged(rows, column).groupBy(*by).agg(*_counters(F.col("reason"), F.lit(1)))


def scored(rows: DataFrame, depth: Column, article_bonus: str = "whole", column: str = "link") -> DataFrame:
    return rows.withColumn("score", urls.url_priority(F.col(column), depth, article_bonus))


def sublinks(pages: DataFrame) -> DataFrame:
    """Hrefs as they stand: those that start with `http` unchanged, others put behind the page
    URL by plain concatenation. Expects `url` and `hrefs`."""
    rows = pages.select("page_id", "url", F.posexplode("hrefs").alias("_pos", "href"))
    return rows.select(
        "page_id", (F.col("_pos") + 1).alias("pos"),
        F.when(F.col("href").startswith("http"), F.col("href"))
        .otherwise(F.concat("url", "href")).alias("sublink"))


def link_graph(docs: DataFrame) -> DataFrame:
    """Edges of the indexed corpus."""
    return link_rows(docs, ("url",), "dst").select(F.col("url").alias("src"), "dst", "pos")


def degrees(edges: DataFrame) -> DataFrame:
    """Out- and in-degree per URL, in one aggregate over both ends."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("url"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("dst").alias("url"), F.lit(0).alias("o"), F.lit(1).alias("i")),
    )).alias("e")).select("e.*")
    return ends.groupBy("url").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))
